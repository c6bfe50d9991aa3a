"""Tools and tool-use examples: execution, coverage, outcomes, validation, rendering.

An example is a row with ``instruction``, ``reasoning_path`` (array of structs
``step, thought, tool, args, actual_result, status, error_message``; ``args`` a
map of JSON values, results JSON values, see ``functions.values``) and ``final_answer``.  A tool is a row with ``tool_id``, ``name``,
``description``, ``category`` and ``parameters`` (array of structs ``name,
type, description, required``).
"""

from __future__ import annotations

import ast
import json
import operator
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import as_json, from_text, plain

#: The types that a parameter may have.
PARAMETER_TYPES = ["string", "number", "integer", "boolean", "array", "object", "any"]
DIFFICULTY_MIX = {"simple": 0.3, "medium": 0.5, "complex": 0.2}


def step_rows(examples: DataFrame, key: str = "example_id", path: str = "reasoning_path") -> DataFrame:
    return examples.select(key, F.posexplode(path).alias("position", "step")).select(key, "position", "step.*")


def join_tools(steps: DataFrame, tools: DataFrame) -> DataFrame:
    """Steps with the tool they name, by name or otherwise by id; unknown tools give nulls."""
    by_name = tools.select(F.col("name").alias("tool"), F.lit(1).alias("rank"), F.struct(*tools.columns).alias("found"))
    by_id = tools.select(F.col("tool_id").alias("tool"), F.lit(0).alias("rank"), F.struct(*tools.columns).alias("found"))
    known = by_id.unionByName(by_name).groupBy("tool").agg(F.max_by("found", "rank").alias("found"))
    return steps.join(known, "tool", "left")


def required_tools(examples: DataFrame, tools: DataFrame, key: str = "example_id", needed: str = "required_tools", fallback: int = 3) -> DataFrame:
    """``(example, tool_id)``: the tools an example asks for, or the first few where it asks for none known."""
    asked = examples.select(key, F.explode(needed).alias("name")).join(tools.select("tool_id", "name"), "name").select(key, "tool_id")
    first = tools.orderBy("idx").limit(fallback).select("tool_id")
    rest = examples.join(asked, key, "left_anti").select(key).crossJoin(F.broadcast(first))
    return asked.unionByName(rest)


def previous_steps(steps: DataFrame, key: str, order: str, text: Column) -> DataFrame:
    """``context``: the texts of all steps before each, one per line."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return steps.withColumn("context", F.array_join(F.collect_list(text).over(before), "\n"))


def step_context(path: str = "reasoning_path") -> Column:
    """A map from ``step_i_result`` and ``last_result`` to the results of a path, folded in order."""
    entries = F.transform(path, lambda s, i: F.struct(F.concat(F.lit("step_"), i + 1, F.lit("_result")).alias("k"), s["actual_result"].alias("v")))
    last = F.array(F.struct(F.lit("last_result").alias("k"), F.try_element_at(F.col(path), F.lit(-1))["actual_result"].alias("v")))
    return F.map_from_entries(F.when(F.size(path) > 0, F.concat(entries, last)).otherwise(entries))


def execution_result(path: str = "step_results") -> Column:
    """Whole success, and the output of the last step that went well."""
    good = F.filter(path, lambda s: s["success"])
    return F.struct((F.size(path) > 0).__and__(F.forall(path, lambda s: s["success"])).alias("success"), F.try_element_at(good, F.lit(-1))["output"].alias("output"))


def placeholder(return_type: Column | str, name: Column | str = "name") -> Column:
    """JSON of a stand-in result for a tool's declared return type."""
    t = F.coalesce(F.col(return_type) if isinstance(return_type, str) else return_type, F.lit("object"))
    named = F.concat(F.lit('"Result for '), F.col(name) if isinstance(name, str) else name, F.lit('"'))
    return (
        F.when(t == "string", named).when(t == "number", "42.0").when(t == "integer", "42").when(t == "boolean", "true")
        .when(t == "array", '[{"item": 1}, {"item": 2}]').otherwise('{"status": "success", "result": "placeholder"}')
    )


def tool_usage(examples: DataFrame, tools: DataFrame, least: int = 1, key: str = "example_id") -> DataFrame:
    """Per tool the number of examples that use it, by id or name, and whether those are too few.

    Examples are counted once for each tool, also where its id is its name.
    """
    used = step_rows(examples, key).select(key, F.col("tool").alias("label")).distinct()
    labels = tools.select("tool_id", F.explode(F.array_distinct(F.array("tool_id", "name"))).alias("label"))
    counts = used.join(labels, "label").select(key, "tool_id").distinct().groupBy("tool_id").agg(F.count("*").alias("n_examples"))
    out = tools.select("tool_id").join(counts, "tool_id", "left").fillna(0, ["n_examples"])
    return out.withColumn("under_covered", F.col("n_examples") < least)


def outcome(score: Column | str, executed: Column | str, missing: Column | str | None = None, strict: bool = False) -> Column:
    """``struct(status, score)`` of a judged example; a null score cannot be judged."""
    s = F.col(score) if isinstance(score, str) else score
    ok = F.col(executed) if isinstance(executed, str) else executed
    lacks = F.lit(False) if missing is None or not strict else F.coalesce(F.size(F.col(missing) if isinstance(missing, str) else missing), F.lit(0)) > 0
    status = F.when(~F.coalesce(ok, F.lit(True)), "execution_failed").when(s.isNull(), "cannot_evaluate").when(lacks, "not_satisfied")
    status = status.when(s >= 0.9, "fully_satisfied").when(s >= 0.5, "partially_satisfied").otherwise("not_satisfied")
    value = F.when(~F.coalesce(ok, F.lit(True)), 0.0).when(s.isNull(), 0.5).when(lacks, F.least(s, F.lit(0.5))).otherwise(s)
    return F.struct(status.alias("status"), value.alias("score"))


def satisfied(df: DataFrame, least: float = 0.7, fully: bool = False) -> DataFrame:
    """Examples whose outcome reaches the score and, if asked, is fully satisfied."""
    keep = F.col("outcome.score") >= least
    return df.where(keep & (F.col("outcome.status") == "fully_satisfied") if fully else keep)


def tool_errors() -> Column:
    """What is wrong with a tool, as a list of messages."""
    blank = lambda c: F.length(F.coalesce(c, F.lit(""))) == 0
    names = F.transform("parameters", lambda p: p["name"])
    per = F.flatten(F.transform("parameters", lambda p: F.array(F.when(blank(p["name"]), "parameter without name"), F.when(~F.coalesce(p["type"].isin(PARAMETER_TYPES), F.lit(False)), F.concat(F.lit("unknown type of "), F.coalesce(p["name"], F.lit("?")))))))
    own = F.array(*[F.when(blank(F.col(c)), f"no {c}") for c in ("tool_id", "name", "description")], F.when(F.size(F.array_distinct(names)) < F.size(names), "repeated parameter names"))
    return F.array_compact(F.concat(own, F.coalesce(per, F.array().cast("array<string>"))))


def invalid_tools(tools: DataFrame) -> DataFrame:
    return tools.withColumn("errors", tool_errors()).where(F.size("errors") > 0).select("tool_id", "errors")


def refine_generated(tools: DataFrame) -> DataFrame:
    """Generated tools with name and description; parameters without a name go, missing fields are filled in."""
    keep = tools.where((F.length(F.coalesce("name", F.lit(""))) > 0) & (F.length(F.coalesce("description", F.lit(""))) > 0))
    good = F.filter("parameters", lambda p: F.length(F.coalesce(p["name"], F.lit(""))) > 0)
    filled = F.transform(good, lambda p: F.struct(p["name"].alias("name"), F.coalesce(p["type"], F.lit("string")).alias("type"), F.coalesce(p["description"], F.lit("")).alias("description"), F.coalesce(p["required"], F.lit(False)).alias("required")))
    return keep.withColumn("parameters", F.coalesce(filled, F.array()))


def category_counts(tools: DataFrame) -> DataFrame:
    return tools.groupBy(F.coalesce("category", F.lit("other")).alias("category")).agg(F.count("*").alias("n"))


def json_schema() -> Column:
    """A tool's function schema as JSON text."""
    properties = F.map_from_entries(F.transform("parameters", lambda p: F.struct(p["name"], F.struct(p["type"].alias("type"), p["description"].alias("description")))))
    needed = F.transform(F.filter("parameters", lambda p: p["required"]), lambda p: p["name"])
    body = F.struct(F.col("name"), F.col("description"), F.struct(F.lit("object").alias("type"), properties.alias("properties"), needed.alias("required")).alias("parameters"))
    return F.to_json(F.struct(F.lit("function").alias("type"), body.alias("function")))


def documentation() -> Column:
    """A tool as readable text."""
    line = lambda p: F.concat(F.lit("- "), p["name"], F.lit(" ("), p["type"], F.when(p["required"], ", required").otherwise(""), F.lit("): "), F.coalesce(p["description"], F.lit("")))
    return F.concat(F.col("name"), F.lit("\n"), F.col("description"), F.lit("\nParameters:\n"), F.array_join(F.transform("parameters", line), "\n"))


def solution_summary(path: str = "reasoning_path", cut: int = 200) -> Column:
    """A path as lines ``Step n: tool(args) -> result [status] ERROR: message``."""
    args = lambda s: F.coalesce(F.when(F.size(s["args"]) > 0, F.to_json(s["args"])), F.lit("{}"))
    result = lambda s: F.coalesce(F.when(F.length(plain(s["actual_result"])) > 0, F.concat(F.lit(" -> "), F.substring(as_json(s["actual_result"]), 1, cut))), F.lit(""))
    tail = lambda s: F.concat(F.coalesce(F.concat(F.lit(" ["), s["status"], F.lit("]")), F.lit("")), F.coalesce(F.concat(F.lit(" ERROR: "), s["error_message"]), F.lit("")))
    return F.array_join(F.transform(path, lambda s: F.concat(F.lit("Step "), s["step"], F.lit(": "), s["tool"], F.lit("("), args(s), F.lit(")"), result(s), tail(s))), "\n")


#: Numbers in an expression, and what powers give, are at most so long in bits.
MOST_BITS = 4096
_OPERATIONS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.Mod: operator.mod, ast.Pow: operator.pow, ast.FloorDiv: operator.floordiv, ast.USub: operator.neg, ast.UAdd: operator.pos}


def calculate(expression: str) -> float:
    """The value of an arithmetic expression; anything else raises ``ValueError``."""

    def value(node):
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)):
            return node.value
        if isinstance(node, ast.BinOp) and type(node.op) in _OPERATIONS:
            left, right = value(node.left), value(node.right)
            if isinstance(node.op, ast.Pow) and isinstance(left, int) and isinstance(right, int) and left.bit_length() * abs(right) > MOST_BITS:
                raise ValueError(f"too large: {expression}")
            if isinstance(left, int) and isinstance(right, int) and left.bit_length() + right.bit_length() > MOST_BITS:
                raise ValueError(f"too large: {expression}")
            return _OPERATIONS[type(node.op)](left, right)
        if isinstance(node, ast.UnaryOp) and type(node.op) in _OPERATIONS:
            return _OPERATIONS[type(node.op)](value(node.operand))
        raise ValueError(f"not arithmetic: {expression}")

    return value(ast.parse(expression, mode="eval").body)


BUILTINS: dict[str, object] = {
    "calculator": lambda expression: calculate(expression),
    "string_length": lambda text: len(text),
    "reverse_string": lambda text: text[::-1],
    "current_time": lambda: datetime.now(UTC).strftime("%H:%M:%S"),
    "current_date": lambda: datetime.now(UTC).strftime("%Y-%m-%d"),
}


def builtin(name: str):
    """Register a function as a tool's implementation."""

    def register(f):
        BUILTINS[name] = f
        return f

    return register


def run_steps(examples: DataFrame, key: str = "example_id", path: str = "reasoning_path", implementations: dict | None = None) -> DataFrame:
    """Execute each step by its registered implementation: ``(example, position, success, output, error)``.

    Arguments and outputs keep their types; what JSON has no form for comes back as text.
    """
    import pandas as pd

    known = {**BUILTINS, **(implementations or {})}

    def run(frames):
        for frame in frames:
            rows = []
            for k, position, tool, args in frame[[key, "position", "tool", "args"]].itertuples(index=False):
                try:
                    if tool not in known:
                        raise KeyError(f"no implementation of {tool}")
                    rows.append((k, position, True, json.dumps(known[tool](**json.loads(args or "{}")), default=str), None))
                except Exception as e:  # noqa: BLE001 - a step's failure is its result
                    rows.append((k, position, False, None, str(e)))
            yield pd.DataFrame(rows, columns=[key, "position", "success", "output", "error"])

    ran = step_rows(examples, key, path).select(key, "position", "tool", F.to_json("args").alias("args")).mapInPandas(run, f"`{key}` {examples.schema[key].dataType.simpleString()}, position int, success boolean, output string, error string")
    return ran.withColumn("output", from_text(F.col("output")))
