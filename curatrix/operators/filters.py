"""Filters over chunks, pairs and tool-use examples (``DataFrame -> DataFrame``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, count_contained

# Fixed values that results depend on.
DEFAULT_SKIPS = ["_log.md", "login.md", "retrieval_progress", "signup"]
INFRASTRUCTURE_KEYWORDS = [
    "github actions", "workflow", "ci/cd", "pipeline job", "devcontainer", "cmake", "build system", "test script", "operating system", "runs on", "docker", "container",
    "ubuntu-latest", "windows-latest", "macos-latest", ".yml file", "yaml file", "workflow trigger", "job depend", "build step", "test framework", "makefile", "ctest",
]
BUILD_KEYWORDS = [
    "compile", "compilation", "build the", "building the", "install the", "installation of", "installing the", "clone the repository", "pull the branch", "checkout the",
    "commit hash", "version number", "release tag", "from the repository", "from the source code", "what happens when you compile", "what happens when you build",
    "how do you install", "how to install", "steps to install", "download the source", "extract the archive", "gcc", "clang", "toolchain", "compiler flag",
]
TECHNICAL_MARKS = ["function", "api", "method", "class", "()", "parameter"]


def stripped(c: str | Column) -> Column:
    return F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), r"^\s+|\s+$", "")


def only_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``ids`` (semi join)."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def resume(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done yet (anti join)."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def head(df: DataFrame, n: int, order: str = "idx") -> DataFrame:
    return df.orderBy(order).limit(n)


def skip_sources(df: DataFrame, patterns: list[str] = DEFAULT_SKIPS, column: str = "source_file") -> DataFrame:
    """Rows whose source holds none of the patterns, case-sensitively."""
    return df.where(~contains_any(F.coalesce(F.col(column), F.lit("")), patterns)) if patterns else df


def min_content(df: DataFrame, least: int = 200, column: str = "content") -> DataFrame:
    return df.where((F.length(stripped(column)) >= least) & (F.length(F.coalesce(column, F.lit(""))) > 0))


def not_blank(df: DataFrame, column: str = "content") -> DataFrame:
    return df.where(F.length(stripped(column)) > 0)


def skip_questions(df: DataFrame, patterns: list[str], column: str = "question") -> DataFrame:
    """Rows whose question matches none of the lower-cased patterns, case-insensitively."""
    if not patterns:
        return df
    text = F.lower(F.coalesce(F.col(column), F.lit("")))
    hit = text.rlike("(?i)" + "|".join(f"(?:{p.lower()})" for p in patterns))
    return df.where(~hit)


def at_least(df: DataFrame, threshold: float, rating: str = "rating", topic: str | None = "topic_relevant") -> DataFrame:
    """Rated rows that reach the threshold and are on topic; a null topic counts as on topic."""
    keep = F.col(rating) >= threshold
    return df.where(keep & F.coalesce(F.col(topic), F.lit(True)) if topic else keep)


def on_topic(df: DataFrame, topic: str = "topic_relevant") -> DataFrame:
    return df.where(F.coalesce(F.col(topic), F.lit(True)))


def few_infrastructure_words(df: DataFrame, most: int = 1) -> DataFrame:
    return df.where(count_contained(["question", "answer"], INFRASTRUCTURE_KEYWORDS) <= most)


def no_build_questions(df: DataFrame) -> DataFrame:
    question, answer = F.lower(F.coalesce("question", F.lit(""))), F.lower(F.coalesce("answer", F.lit("")))
    bare = contains_any(answer, ["compile", "compilation", "build"]) & ~contains_any(answer, TECHNICAL_MARKS)
    return df.where(~(contains_any(question, BUILD_KEYWORDS) | bare))


def structured(df: DataFrame, columns: tuple[str, ...] = ("question", "reasoning", "answer")) -> DataFrame:
    """Rows that have all of the fields."""
    return df.dropna(subset=list(columns))


def non_empty(df: DataFrame, columns: tuple[str, ...] = ("question", "answer")) -> DataFrame:
    for c in columns:
        df = df.where(F.length(F.coalesce(c, F.lit(""))) > 0)
    return df


def empty_reasoning(df: DataFrame, column: str = "reasoning") -> DataFrame:
    """Rows that need their reasoning repaired."""
    return df.where(F.length(stripped(column)) == 0)


def executed(df: DataFrame, rate: float = 1.0, result: str = "execution_result") -> DataFrame:
    """Examples that ran well: all pass at a rate of 0, whole success from 1, else the share of good steps."""
    if rate <= 0:
        return df
    if rate >= 1:
        return df.where(F.coalesce(F.col(result)["success"], F.lit(False)))
    steps = F.col(result)["step_results"]
    share = F.try_divide(F.size(F.filter(steps, lambda s: F.coalesce(s["success"], F.lit(False)))), F.size(steps))
    return df.where(F.coalesce(share >= rate, F.lit(False)))


def good_turns(df: DataFrame, least: float = 0.7, ratings: str = "step_ratings") -> DataFrame:
    """Examples all of whose steps are rated well, with ``avg_step_quality``; null ratings count 0.5."""
    clamped = F.transform(ratings, lambda r: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(r, F.lit(0.5)))))
    df = df.withColumn("rated_steps", clamped).where((F.size("rated_steps") > 0) & F.forall("rated_steps", lambda r: r >= least))
    mean = F.aggregate("rated_steps", F.lit(0.0), lambda x, y: x + y) / F.size("rated_steps")
    return df.withColumn("avg_step_quality", mean).drop("rated_steps")


def non_empty_solutions(df: DataFrame, path: str = "reasoning_path") -> DataFrame:
    return df.where(F.size(path) > 0)


def format_errors(instruction: str = "instruction", path: str = "reasoning_path", answer: str = "final_answer") -> Column:
    """What is wrong with a tool-use example, as a list of messages."""
    blank = lambda c: F.length(F.coalesce(c, F.lit(""))) == 0
    said = lambda i, what: F.concat(F.lit("Step "), i + 1, F.lit(f": {what}"))
    steps = F.flatten(F.transform(path, lambda s, i: F.array(F.when(blank(s["tool"]), said(i, "no tool")), F.when(s["args"].isNull(), said(i, "args is not a dict")))))
    return F.array_compact(F.concat(
        F.array(
            F.when(F.length(F.coalesce(F.col(instruction), F.lit(""))) < 10, "instruction too short"),
            F.when(F.coalesce(F.size(path), F.lit(0)) <= 0, "no reasoning steps"),
        ),
        F.coalesce(steps, F.array().cast("array<string>")),
        F.array(F.when(blank(F.col(answer)), "no final answer")),
    ))
