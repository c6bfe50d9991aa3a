"""Execution of tool-use examples: real, simulated by a model, or by a model for each tool."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import RESULT, STEP, from_text
from ..sources.templates import TEMPLATES
from . import models
from .tools import BUILTINS

MODES = ("simulated", "real", "multi_agent")


def known_steps(examples: DataFrame, tools: DataFrame, key: str) -> DataFrame:
    """``(key, steps)``: each step with the definition of the tool it names, by id or else by name; null if there is none."""
    definition = F.struct("tool_id", "name", "description", F.col("returns.type").alias("return_type"), F.transform(F.filter("parameters", lambda p: p["required"]), lambda p: p["name"]).alias("required"))
    by_id = tools.select(F.col("tool_id").alias("tool"), F.lit(1).alias("rank"), definition.alias("known"))
    by_name = tools.select(F.col("name").alias("tool"), F.lit(0).alias("rank"), definition.alias("known"))
    names = by_id.unionByName(by_name).groupBy("tool").agg(F.max_by("known", "rank").alias("known"))
    steps = examples.select(key, F.posexplode("reasoning_path").alias("position", "s")).withColumn("tool", F.col("s.tool"))
    # Merged, never broadcast: files tell little of how large definitions are.
    met = steps.join(names.hint("merge"), "tool", "left").select(key, F.struct("position", F.col("s.step").alias("step"), "tool", F.to_json("s.args").alias("args"), "known").alias("step"))
    return met.groupBy(key).agg(F.array_sort(F.collect_list("step")).alias("steps"))


def execute_examples(examples: DataFrame, tools: DataFrame, mode: str = "simulated", template: str = TEMPLATES["tool_simulation"], implementations: dict | None = None, provider: str = "stub", key: str = "example_id", threads: int = 8, **options) -> DataFrame:
    """Examples with the results of their steps, and ``execution_result``.

    The steps of an example run one after the other, each knowing the results
    before it; examples run side by side.  A step fails where its tool is not
    known, where the real tool lacks a required argument or raises, and where
    the model cannot be reached.  ``multi_agent`` gives each tool a client of
    its own, ``simulated`` one client for all.  Arguments and results keep
    their types; an answer that is no JSON is a text.  An example succeeds if it has
    steps and all are good.  Examples without steps come back with no result.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    real = {**BUILTINS, **(implementations or {})}
    factory = models.factory(provider)
    kind = examples.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        clients: dict = {}

        def typed(answer: str):
            """What a model's answer holds: JSON, within a fence or not, or else its text."""
            text = answer.strip()
            if text.startswith("```"):
                text = text.partition("\n")[2].rpartition("```")[0].strip()
            try:
                return json.loads(text)
            except ValueError:
                return text

        def call(step, before: dict):
            tool, args = step["known"], json.loads(step["args"] or "{}")
            if tool is None:
                raise LookupError(f"Unknown tool: {step['tool']}")
            if mode == "real":
                found = real.get(tool["tool_id"]) or real.get(tool["name"])
                if found is None:
                    raise LookupError(f"No implementation of {tool['tool_id']}")
                for name in tool["required"] if tool["required"] is not None else ():
                    if name not in args:
                        raise ValueError(f"Missing required parameter: {name}")
                return found(**args)
            name = tool["tool_id"] if mode == "multi_agent" else None
            if name not in clients:
                clients[name] = factory(**options)
            prompt = template
            for place, value in {"tool_name": tool["name"], "tool_description": tool["description"], "return_type": tool["return_type"] or "object", "args_json": json.dumps(args), "context": json.dumps(before) if before else ""}.items():
                prompt = prompt.replace("{" + place + "}", str(value or ""))
            return typed(models.ask_with_retries(clients[name], prompt, temperature=0.3))

        def one(steps) -> list[tuple]:
            out, before = [], {}
            for step in steps:
                try:
                    # What JSON has no form for becomes text.
                    result = json.loads(written := json.dumps(call(step, before), default=str))
                    before[f"step_{len(out) + 1}_result"] = before["last_result"] = result
                    out.append((int(step["position"]), True, written, None))
                except Exception as e:  # noqa: BLE001 - a step's failure is its result
                    out.append((int(step["position"]), False, None, str(e)))
            return out

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                schema = pa.schema([batch.schema.field(0), ("position", pa.int32()), ("good", pa.bool_()), ("output", pa.string()), ("error", pa.string())])
                keys, steps = (column.to_pylist() for column in batch.columns)
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (k, *r), strict=True)) for k, done in zip(keys, pool.map(one, steps), strict=True) for r in done], schema=schema)

    done = known_steps(examples, tools, key).mapInArrow(run, f"`{key}` {kind}, position int, good boolean, output string, error string")
    told = F.struct("position", "good", F.when(F.col("good"), F.col("output")).alias("output"), "error")
    listed = done.groupBy(key).agg(F.array_sort(F.collect_list(told)).alias("done_steps"))
    # Results are never broadcast: they grow with the examples, and running takes longer than a broadcast may.
    joined = examples.drop("execution_result").join(listed.hint("merge"), key, "left")
    expected = (lambda s: s["expected_result"]) if "expected_result" in examples.schema["reasoning_path"].dataType.elementType.names else (lambda s: F.lit(None))
    path = F.transform("reasoning_path", lambda s, i: F.struct(s["step"].alias("step"), s["thought"].alias("thought"), s["tool"].alias("tool"), s["args"].alias("args"), expected(s).alias("expected_result"), from_text(F.get("done_steps", i)["output"]).alias("actual_result"), F.when(F.get("done_steps", i)["good"], "success").otherwise("failure").alias("status"), F.get("done_steps", i)["error"].alias("error_message")).cast(STEP))
    results = F.transform("done_steps", lambda d, i: F.struct((i + 1).cast("int").alias("step"), d["good"].alias("success"), from_text(d["output"]).alias("output"), d["error"].alias("error")))
    whole = F.coalesce(F.forall("done_steps", lambda d: d["good"]), F.lit(False))
    last = F.try_element_at(F.filter("done_steps", lambda d: d["good"]), F.lit(-1))["output"]
    wrong = F.get(F.filter("done_steps", lambda d: ~d["good"]), 0)["error"]
    result = F.struct(whole.alias("success"), from_text(last).alias("output"), wrong.alias("error"), F.coalesce(results, F.array()).alias("step_results")).cast(RESULT)
    return joined.withColumns({"reasoning_path": path, "execution_result": result}).drop("done_steps")
