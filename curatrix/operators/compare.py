"""Comparison of datasets: metrics, common sources and question types, verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import verdict_score, words


def dataset_metrics(df: DataFrame) -> DataFrame:
    """One row per ``dataset``: count, mean lengths in characters, ratings (zeros and nulls aside), distinct sources and question types."""
    first = F.try_element_at(words(F.lower(F.coalesce("question", F.lit("")))), F.lit(1))
    rating = F.when(F.col("rating") != 0, F.col("rating"))
    return df.groupBy("dataset").agg(
        F.count("*").alias("n"), F.avg(F.length(F.coalesce("question", F.lit("")))).alias("avg_question_length"), F.avg(F.length(F.coalesce("answer", F.lit("")))).alias("avg_answer_length"),
        F.avg(rating).alias("avg_rating"), F.min(rating).alias("min_rating"), F.max(rating).alias("max_rating"),
        F.countDistinct(F.coalesce("source", F.lit("unknown"))).alias("unique_sources"), F.countDistinct(first).alias("question_types"),
    )


def most_common(df: DataFrame, column: str, k: int, order: str = "idx", missing: str | None = None) -> DataFrame:
    """The ``k`` most frequent values, of equals the first to appear."""
    value = F.coalesce(column, F.lit(missing)) if missing is not None else F.col(column)
    counts = df.select(value.alias("value"), order).where(F.col("value").isNotNull()).groupBy("value").agg(F.count("*").alias("n"), F.min(order).alias("first_at"))
    return counts.orderBy(F.desc("n"), "first_at").limit(k).drop("first_at")


def question_types(df: DataFrame, k: int = 5, order: str = "idx") -> DataFrame:
    first = F.try_element_at(words(F.lower(F.coalesce("question", F.lit("")))), F.lit(1))
    return most_common(df.withColumn("first_word", first), "first_word", k, order)


def rating_counts(df: DataFrame) -> DataFrame:
    return df.where("rating != 0").groupBy("rating").agg(F.count("*").alias("n"))


def winner(judgments: DataFrame) -> DataFrame:
    """The dataset of the highest score, of equals the first; unreadable scores count 0."""
    scored = judgments.withColumn("score", F.coalesce(verdict_score("judgment"), F.lit(0.0)))
    return scored.orderBy(F.desc("score"), "idx").limit(1).select("dataset", "score")


def report(metrics: DataFrame, decision: str | None = None) -> DataFrame:
    """One JSON row with all metrics."""
    body = F.to_json(F.struct(F.sort_array(F.collect_list(F.struct(*metrics.columns))).alias("metrics"), F.lit(decision).alias("decision"), F.current_timestamp().alias("comparison_date")))
    return metrics.agg(body.alias("report"))


def outcome_summary(df: DataFrame, status: str = "status") -> DataFrame:
    """Count and share of every status, and the mean score of all."""
    total = Window.partitionBy()
    counts = df.groupBy(status).agg(F.count("*").alias("n"), F.sum("score").alias("score_sum"))
    return counts.withColumns({"percent": 100.0 * F.col("n") / F.sum("n").over(total), "avg_score": F.sum("score_sum").over(total) / F.sum("n").over(total)}).drop("score_sum")
