"""Folders for what a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL = "curatrix.scratch.dir"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder URI below the session's ``spark.checkpoint.dir``.

    Only where that is unset and the master is local is a temporary folder
    used; on a cluster, whose machines share no such folder, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL, None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="curatrix-")
        spark.conf.set(_LOCAL, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
