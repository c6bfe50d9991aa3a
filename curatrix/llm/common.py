"""Helpers that several of the training-data operators share."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Folders that ``shared_dir`` gave and that are not deleted, oldest first.
made: list[str] = []
_BATCH_BYTES, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder URI below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session.  Only where it is unset
    and the master is local (single-machine tests) a temporary folder is made
    and registered; on a cluster, whose machines share no such folder, that is
    an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("curatrix.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="curatrix-")
        spark.conf.set("curatrix.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return made[-1]


def drop_shared(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``shared_dir`` gave and that nothing reads any more."""
    for path in paths:
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)
        if path in made:
            made.remove(path)


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts lineage: what follows survives the loss of any executor without
    running what came before again.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold about 4 MB.

    The default of 64 MB is for each of an executor's tasks and Python workers;
    a bound that the session sets itself is left alone.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_BYTES) == _BATCH_DEFAULT:
        conf.set(_BATCH_BYTES, str(4 << 20))
    return df


def open_store(uri: str):
    """``(filesystem, path)`` of a URI in a store that all executors reach."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path or uri
    return fs.FileSystem.from_uri(uri)


def child_uri(base: str, *names: str) -> str:
    return posixpath.join(base.rstrip("/"), *names)


def text_or_empty(text: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column) -> Column:
    """Number of words as a long; null counts as none."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
