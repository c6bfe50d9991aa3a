"""Work in micro-batches that ends at a target and resumes where it was left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import numbered


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def until(candidates: DataFrame, attempt: Callable[[DataFrame], DataFrame], target: int, path: str, order: str, most: int | None = None, each: int = 1, batch: int = 100_000) -> DataFrame:
    """Rows that ``attempt`` accepts, in the order of the candidates, until there are ``target`` of them.

    ``attempt`` gives rows with ``attempt_place`` (carried along) and
    ``accepted``; a candidate gives at most ``each`` accepted rows.  A batch
    holds the fewest candidates that can reach the target, so none is tried
    that one after the other would not have been.  It ends at the target, after
    ``most`` candidates (default: all), or when none is left.

    Candidates and each batch's rows are kept below ``path``: another call goes
    on after the last whole batch, and tries nothing again that is there.
    """
    spark = candidates.sparkSession
    listed = f"{path.rstrip('/')}/candidates"
    if not _finished(spark, listed):
        chosen = candidates if most is None else candidates.orderBy(order).limit(most)
        numbered(chosen, order, name="attempt_place").write.mode("overwrite").parquet(listed)
    rows = spark.read.parquet(listed)
    total, tried, got, folders = rows.count(), 0, 0, []
    while got < target and tried < total:
        folder = f"{path.rstrip('/')}/attempts-{tried:012d}"
        size = min(batch, -(-(target - got) // each), total - tried)
        if not _finished(spark, folder):
            attempt(rows.where(F.col("attempt_place").between(tried, tried + size - 1))).write.mode("overwrite").parquet(folder)
        folders.append(folder)
        got += spark.read.parquet(folder).where("accepted").count()
        tried += size
    if not folders:
        return attempt(rows.limit(0)).drop("accepted", "attempt_place")
    return spark.read.parquet(*folders).where("accepted").orderBy("attempt_place").limit(target).drop("accepted", "attempt_place")
