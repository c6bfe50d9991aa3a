"""Training formats: ``question, answer`` or example rows to nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import think_wrap
from ..functions.values import plain, written

#: Fixed value: the system turn that exports use by default.
SYSTEM_PROMPT = "You are a helpful assistant that provides accurate information."
FORMATS = ("chatml", "alpaca", "sharegpt", "jsonl")


def _turn(role: str, text: Column, names: tuple[str, str] = ("role", "content")) -> Column:
    return F.struct(F.lit(role).alias(names[0]), text.alias(names[1]))


def solution_text(path: str = "reasoning_path", answer: str = "final_answer") -> Column:
    """``Step n: thought``, ``Tool: name(k='v')`` and an empty line for each step, then the answer."""
    args = lambda s: F.array_join(F.transform(F.map_entries(s["args"]), lambda e: F.concat(e["key"], F.lit("="), written(e["value"]))), ", ")
    step = lambda s: F.concat(F.lit("Step "), s["step"], F.lit(": "), s["thought"], F.lit("\nTool: "), s["tool"], F.lit("("), F.coalesce(args(s), F.lit("")), F.lit(")\n"))
    return F.regexp_replace(F.array_join(F.concat(F.transform(path, step), F.array(F.coalesce(F.col(answer), F.lit("")))), "\n"), r"^\s+|\s+$", "")


def is_tool_example(df: DataFrame) -> bool:
    return {"instruction", "reasoning_path"} <= set(df.columns)


def _sides(df: DataFrame) -> tuple[Column, Column]:
    return (F.col("instruction"), solution_text()) if is_tool_example(df) else (F.col("question"), F.col("answer"))


def to_format(df: DataFrame, kind: str, system: str = SYSTEM_PROMPT, keep: tuple[str, ...] = ()) -> DataFrame:
    """One column ``record`` in the wanted format, after the columns to ``keep``; unknown formats raise ``ValueError``."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format: {kind}")
    user, assistant = _sides(df)
    if kind == "chatml":
        return df.select(*keep, F.struct(F.array(_turn("system", F.lit(system)), _turn("user", user), _turn("assistant", assistant)).alias("messages")).alias("record"))
    if kind == "alpaca":
        return df.select(*keep, F.struct(user.alias("instruction"), F.lit("").alias("input"), assistant.alias("output")).alias("record"))
    if kind == "sharegpt":
        names = ("from", "value")
        return df.select(*keep, F.struct(F.array(_turn("system", F.lit(system), names), _turn("human", user, names), _turn("gpt", assistant, names)).alias("conversations")).alias("record"))
    used = {"instruction", "reasoning_path", "final_answer"} if is_tool_example(df) else {"question", "answer"}
    rest = [c for c in df.columns if c not in used]
    keys = ("instruction", "response") if is_tool_example(df) else ("question", "answer")
    fields = [user.alias(keys[0]), assistant.alias(keys[1])]
    return df.select(*keep, F.struct(*fields, *([F.struct(*rest).alias("metadata")] if rest else [])).alias("record"))


def example_to_chatml(df: DataFrame) -> DataFrame:
    """User turn, a call and a tool turn for each step, then the answer; no system turn."""
    text = F.lit(None).cast("string")
    turn = lambda role, content, call=text, args=text: F.struct(F.lit(role).alias("role"), content.alias("content"), call.alias("tool_call"), args.alias("tool_args"))
    steps = F.flatten(F.transform("reasoning_path", lambda s: F.array(turn("assistant", s["thought"], s["tool"], F.to_json(s["args"])), turn("tool", F.coalesce(plain(s["actual_result"]), F.lit(""))))))
    return df.withColumn("messages", F.concat(F.array(turn("user", F.col("instruction"))), steps, F.array(turn("assistant", F.col("final_answer")))))


def example_to_alpaca(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    step = lambda s: F.concat(F.lit("Thought: "), s["thought"], F.lit("\nAction: "), s["tool"], F.lit("("), F.to_json(s["args"]), F.lit(")\nObservation: "), F.coalesce(plain(s["actual_result"]), F.lit("")))
    body = F.array_join(F.concat(F.transform("reasoning_path", step), F.array(F.concat(F.lit("Final Answer: "), F.col("final_answer")))), "\n")
    return df.select(*keep, F.struct(F.col("instruction"), F.lit("").alias("input"), body.alias("output")).alias("record"))


def example_to_sharegpt(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    step = lambda s: F.concat(F.lit("**Step "), s["step"], F.lit("**: "), s["thought"], F.lit("\n`"), s["tool"], F.lit("("), F.to_json(s["args"]), F.lit(")`"))
    body = F.array_join(F.concat(F.transform("reasoning_path", step), F.array(F.col("final_answer"))), "\n\n")
    names = ("from", "value")
    return df.select(*keep, F.struct(F.array(_turn("human", F.col("instruction"), names), _turn("gpt", body, names)).alias("conversations")).alias("record"))


def template_text(df: DataFrame, begin: str = "<start_of_turn>", end: str = "<end_of_turn>\n", names: dict[str, str] | None = None) -> DataFrame:
    """``text``: all turns of ``messages`` between the marks of a chat template, the assistant being the model."""
    said = {"assistant": "model"} if names is None else names
    role = lambda m: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in said.items() for x in kv]), m["role"]), m["role"]) if said else m["role"]
    turn = lambda m: F.concat(F.lit(begin), role(m), F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(end))
    return df.withColumn("text", F.array_join(F.transform("messages", turn), ""))


def think_chat(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """Chat rows whose assistant thinks first."""
    return df.withColumn("messages", F.array(_turn("user", F.col("question")), _turn("assistant", think_wrap("reasoning", "answer", prefixes))))


def call_chat(df: DataFrame) -> DataFrame:
    """Chat rows with numbered calls; steps without arguments are left out."""
    steps = F.filter("reasoning_path", lambda s: F.coalesce(F.size(s["args"]), F.lit(0)) > 0)
    calls = F.transform(steps, lambda s, i: F.struct(F.concat(F.lit("call_"), i).alias("id"), s["tool"].alias("name"), F.to_json(s["args"]).alias("arguments"), F.coalesce(plain(s["actual_result"]), F.lit("Done")).alias("output")))
    return df.where(F.length(F.coalesce("instruction", F.lit(""))) > 0).withColumn("calls", calls).where(F.size("calls") > 0)


def as_lines(records: DataFrame) -> DataFrame:
    """JSON lines; null fields are left out."""
    return records.select(F.to_json("record").alias("value"))
