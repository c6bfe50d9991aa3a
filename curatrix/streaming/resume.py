"""Resumable runs over chunks that keep arriving."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def process_new_chunks(spark: SparkSession, folder: str, schema: str, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Run ``process`` on each file set that is new since the last run, and stop when none is left.

    The file source's checkpoint says what is done; a batch that is run again
    after a failure overwrites its own folder, so no row is written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
