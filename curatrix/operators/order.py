"""Places of rows in a total order, without one task for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PART_BITS = 33


def numbered(df: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """``df`` with its rows' places from 0, as a long.

    Rows are sorted over ranges, one range for each partition; the places
    before a range come from the counts of the ranges, a row each.  The sorted
    rows are written first: sorted once for the counts and again for the rows,
    the ranges would differ.
    """
    from ..sources.scratch import scratch_dir

    spark = df.sparkSession
    marked = df.orderBy(*order).withColumn("order_mark", F.monotonically_increasing_id())
    marked = marked.withColumn("order_part", F.shiftright("order_mark", _PART_BITS))
    path = scratch_dir(spark, "sorted")
    marked.write.parquet(path)
    marked = spark.read.schema(marked.schema).parquet(path)
    sizes = marked.groupBy("order_part").agg(F.count("*").alias("n"))
    parts = sizes.agg(F.array_sort(F.collect_list(F.struct("order_part", "n"))).alias("parts"))
    before = parts.select(F.inline(F.transform("parts", lambda p: F.struct(p["order_part"].alias("order_part"), F.aggregate(F.filter("parts", lambda q: q["order_part"] < p["order_part"]), F.lit(0).cast("long"), lambda s, q: s + q["n"]).alias("before")))))
    placed = marked.join(before, "order_part").withColumn(name, F.col("order_mark") - F.shiftleft(F.col("order_part"), _PART_BITS) + F.col("before"))
    return placed.drop("order_mark", "order_part", "before")
