"""The documented pipelines: pairs from chunks, and training lines from tools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import curation, execution, export, filters, models, scoring, tools
from ..sources.templates import TEMPLATES

QA_PROMPT = "Write question and answer pairs about this text as a JSON list of objects with question and answer.\n{content}"
RATE_PROMPT = "Rate this pair as a JSON list of one object with rating, clarity, accuracy, usefulness, difficulty and topic_relevant.\nQuestion: {question}\nAnswer: {answer}"
ENRICH_PROMPT = 'Rewrite the answer as a JSON object with enriched_answer.\nQuestion: {question}\nAnswer: {answer}'
COT_PROMPT = "Add reasoning as a JSON list of one object with reasoning.\nQuestion: {question}\nAnswer: {answer}"
TOOL_PROMPT = "Write requests that need this tool as a JSON list of objects with question.\n{name}: {description}"
COMPLEXITY_PROMPT = "How complex is this question, from 1 to 10? Answer with a JSON list of one object with complexity.\n{question}"
QUALITY_PROMPT = "How good is this answer, from 1 to 10? Answer with a JSON list of one object with quality.\nQuestion: {question}\nAnswer: {answer}"
COMPARE_PROMPT = "Judge the dataset {dataset} of {n} pairs by these samples and metrics; end with a line SCORE: n/10.\n{samples}\n{metrics}"
DECIDE_PROMPT = "Choose the dataset to train on; end with a line WINNER: name.\n{quality_scores}"
EXAMPLE_PROMPT = "Rate this use of tools as a JSON list of one object with rating, clarity, accuracy, usefulness and difficulty.\n{instruction}\n{solution_summary}\n{final_output}"
OUTCOME_PROMPT = "Judge the solution as a JSON list of one object with overall_score.\n{instruction}\n{solution_summary}\n{final_output}"


def curate_pairs(pairs: DataFrame, threshold: float = 7.0, patterns: list[str] | None = None, raw_path: str | None = None, **options) -> DataFrame:
    """Cheap filters first, then the judge, the penalty; all rated rows come back, with ``kept``."""
    rated = models.rate_pairs(filters.skip_questions(filters.non_empty(pairs), patterns or []), RATE_PROMPT, raw_path=raw_path, **options)
    return curation.penalise(rated).withColumn("kept", (F.col("rating") >= threshold) & F.col("topic_relevant"))


def qa_pipeline(chunks: DataFrame, threshold: float = 7.0, kind: str = "chatml", skips: list[str] | None = None, least: int = 200, **options) -> DataFrame:
    """Chunks to generated, enriched, curated and exported records."""
    ready = filters.min_content(filters.skip_sources(chunks, filters.DEFAULT_SKIPS if skips is None else skips), least)
    pairs = models.enrich(filters.non_empty(models.generate_pairs(ready, QA_PROMPT, **options)), ENRICH_PROMPT, **options)
    return export.to_format(curate_pairs(pairs, threshold, **options).where("kept"), kind)


def curate_examples(examples: DataFrame, rate: float = 1.0, least_rating: float = 0.7, by_turn: bool = False, ratios: dict[str, float] | None = None) -> DataFrame:
    """Executed, well-rated, distinct and balanced examples, in this order."""
    kept = filters.executed(examples, rate)
    if by_turn:
        kept = filters.good_turns(kept, least_rating)
    kept = kept.where(F.coalesce("rating", F.lit(0.0)) >= least_rating)
    return scoring.balance(scoring.first_of_each(kept, "instruction", "idx"), ratios or tools.DIFFICULTY_MIX)


def tool_examples(tool_rows: DataFrame, n_per_tool: int = 2, **options) -> DataFrame:
    """Examples of one-step use: requests for each tool, and solutions that the model gives."""
    # Tools in few files are dealt to all tasks.  Answers are never broadcast: asking takes longer than a broadcast may.
    asked = models.instructions_for_tools(tool_rows.repartition("tool_id"), TOOL_PROMPT, n_per_tool, **options).hint("merge")
    known = tool_rows.select("tool_id", F.concat(F.lit("Tool: "), "name", F.lit("\n"), F.coalesce("description", F.lit(""))).alias("api_documentation"))
    rows = asked.join(known, "tool_id").withColumn("example_id", F.xxhash64("tool_id", "n"))
    return models.annotate(rows, TEMPLATES["tool_solution_single"], **options).drop("api_documentation")


def tool_pipeline(tool_rows: DataFrame, n_per_tool: int = 2, least: float = 0.7, mode: str = "simulated", threshold: float = 0.0, kind: str | None = None, work: str | None = None, ratios: dict[str, float] | None = None, **options) -> DataFrame:
    """Tools to training records: generate, execute, curate, export.

    Curated are examples that ran, that the judge rates at ``threshold`` or
    more, whose outcome reaches ``least``, once for each instruction, and by
    ``ratios`` of difficulty if given.  Without ``kind`` the messages of each
    example come back, else records of the format.  With ``work``, a shared
    folder, each step's rows are written there, so that no model is asked twice.
    """
    def written(df: DataFrame, name: str) -> DataFrame:
        if work is None:
            return df
        df.write.mode("overwrite").parquet(f"{work}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{work}/{name}")

    made = written(tool_examples(tool_rows, n_per_tool, **options), "generated")
    ran = written(execution.execute_examples(made, tool_rows, mode, **options), "executed")
    # Written between the two judges, so that no task holds the batches of both.
    rated = written(models.rate_examples(filters.executed(ran), EXAMPLE_PROMPT, **options).where(F.col("rating") >= threshold), "rated")
    judged = models.judge_examples(rated, OUTCOME_PROMPT, **options).withColumn("outcome", tools.outcome("overall_score", F.lit(True)))
    kept = scoring.first_of_each(tools.satisfied(judged, least).withColumn("idx", F.col("example_id")), "instruction", "idx")
    kept = written(scoring.balance(kept.withColumn("difficulty", F.lit("simple")), ratios) if ratios else kept, "curated")
    if kind is None:
        return export.example_to_chatml(kept).select("idx", "messages")
    return export.to_format(kept.select("instruction", "reasoning_path", "final_answer"), kind)
