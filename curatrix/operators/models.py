"""The one boundary to language models: rows to prompts to raw answers to parsed rows.

Raw answers are written before they are parsed, so a second action never asks
again.  ``StubModel`` answers offline and deterministically.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import complexity, parse_json, quality, rescue_enriched, sanitise_chunk, strip_fence
from ..functions.values import ARGS, STEP


class ModelClient(Protocol):
    def generate(self, prompt: str, temperature: float | None = None, max_tokens: int | None = None) -> str: ...


class RateLimited(Exception):
    """The server asks to wait; the only failure that is tried again."""


class StubModel:
    """Answers from the prompt alone: JSON whose numbers come from its hash."""

    def generate(self, prompt: str, temperature: float | None = None, max_tokens: int | None = None) -> str:
        h = int(hashlib.md5(prompt.encode()).hexdigest()[:8], 16)
        tail = prompt.strip(" \t\n\f\r").rpartition("\n")[2]
        return json.dumps([{"question": f"What is said about {tail[:40]}?", "answer": tail[:200], "reasoning": "Step 1: read it.", "rating": h % 11, "clarity": h % 3, "accuracy": h % 4, "usefulness": h % 3, "difficulty": h % 2, "topic_relevant": h % 7 != 0, "overall_score": h % 101 / 100} | self._solution(prompt)])

    @staticmethod
    def _solution(prompt: str) -> dict:
        """One call of the first tool that the prompt documents by a line ``Tool: name``."""
        tool = next((line[6:].strip() for line in prompt.splitlines() if line.startswith("Tool: ")), None)
        return {} if tool is None else {"reasoning_path": [{"step": 1, "thought": f"Use {tool}.", "tool": tool, "args": {"request": "as asked"}}], "final_answer": f"{tool} answered."}


class EchoModel:
    """Answers with the prompt itself, so that the handling of any answer can be tried offline."""

    def generate(self, prompt: str, temperature: float | None = None, max_tokens: int | None = None) -> str:
        return prompt


class HttpModel:
    """A chat-completions server."""

    def __init__(self, url: str, model: str, key: str | None = None, timeout: float = 600.0, most: int = 24576):
        self.url, self.model, self.key, self.timeout, self.most = url, model, key, timeout, most

    def heads(self) -> dict[str, str]:
        return {"Authorization": f"Bearer {self.key}"} if self.key else {}

    def body(self, prompt: str, temperature: float, max_tokens: int) -> dict:
        return {"model": self.model, "messages": [{"role": "user", "content": prompt}], "temperature": temperature, "max_tokens": max_tokens}

    def text(self, answer: dict) -> str:
        return answer["choices"][0]["message"]["content"]

    def generate(self, prompt: str, temperature: float | None = None, max_tokens: int | None = None) -> str:
        import urllib.error
        import urllib.request

        body = self.body(prompt, 0.7 if temperature is None else temperature, self.most if max_tokens is None else max_tokens)
        heads = {"Content-Type": "application/json"} | self.heads()
        try:
            with urllib.request.urlopen(urllib.request.Request(self.url, json.dumps(body).encode(), heads), timeout=self.timeout) as answer:
                return self.text(json.load(answer))
        except urllib.error.HTTPError as e:
            if e.code in (429, 503, 529):
                raise RateLimited(str(e)) from e
            raise


class MessagesModel(HttpModel):
    """A server of the messages protocol: key in a header of its own, a list of content blocks."""

    def heads(self) -> dict[str, str]:
        return {"anthropic-version": "2023-06-01"} | ({"x-api-key": self.key} if self.key else {})

    def text(self, answer: dict) -> str:
        return "".join(block.get("text", "") for block in answer["content"])


class ContentsModel(HttpModel):
    """A server of the generate-content protocol: the model in the address, parts of contents."""

    def __init__(self, url: str, model: str, **options):
        super().__init__(url.replace("{model}", model), model, **options)

    def heads(self) -> dict[str, str]:
        return {"x-goog-api-key": self.key} if self.key else {}

    def body(self, prompt: str, temperature: float, max_tokens: int) -> dict:
        return {"contents": [{"parts": [{"text": prompt}]}], "generationConfig": {"temperature": temperature, "maxOutputTokens": max_tokens}}

    def text(self, answer: dict) -> str:
        return "".join(part.get("text", "") for part in answer["candidates"][0]["content"]["parts"])


_FACTORIES: dict[str, Callable[..., ModelClient]] = {"stub": lambda **_: StubModel(), "echo": lambda **_: EchoModel()}
_SERVERS: dict[str, tuple[type[HttpModel], str]] = {
    "ollama": (HttpModel, "http://localhost:11434/v1/chat/completions"), "vllm": (HttpModel, "http://localhost:8000/v1/chat/completions"), "openai": (HttpModel, "https://api.openai.com/v1/chat/completions"),
    "anthropic": (MessagesModel, "https://api.anthropic.com/v1/messages"), "claude": (MessagesModel, "https://api.anthropic.com/v1/messages"),
    "google": (ContentsModel, "https://generativelanguage.googleapis.com/v1beta/models/{model}:generateContent"),
}
for _name, (_kind, _url) in _SERVERS.items():
    _FACTORIES[_name] = lambda model="default", url=_url, kind=_kind, key=None, max_tokens=24576, timeout=600.0, **_: kind(url, model, key=key, timeout=timeout, most=max_tokens)


def register_provider(name: str, factory: Callable[..., ModelClient]) -> None:
    _FACTORIES[name] = factory


def providers() -> list[str]:
    return sorted(_FACTORIES)


def client(provider: str, **options) -> ModelClient:
    return factory(provider)(**options)


def factory(provider: str) -> Callable[..., ModelClient]:
    """What makes a provider's clients; unknown names raise ``ValueError``."""
    if provider not in _FACTORIES:
        raise ValueError(f"unknown provider: {provider}")
    return _FACTORIES[provider]


def ask_with_retries(model: ModelClient, prompt: str, tries: int = 3, wait: float = 5.0, **options) -> str:
    for k in range(tries):
        try:
            return model.generate(prompt, **options)
        except RateLimited:
            if k + 1 == tries:
                raise
            time.sleep(wait * 2**k)
    raise AssertionError


def ask(df: DataFrame, prompt: Column, provider: str = "stub", temperature: float | None = None, threads: int = 8, raw_path: str | None = None, max_tokens: int | None = None, **options) -> DataFrame:
    """``df`` with ``raw`` and ``error``: a client per task, and a few calls at a time within it.

    Rows whose prompt is null are not asked.  With ``raw_path`` the answers are written there before anything reads them,
    and what follows goes on from the files: no second action asks again.
    """
    import pyarrow as pa
    from pyspark.sql.types import StringType, StructField, StructType

    make = factory(provider)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make(**options)

        def one(text: str | None) -> tuple[str | None, str | None]:
            if not isinstance(text, str):
                return None, None
            try:
                return ask_with_retries(model, text, temperature=temperature, max_tokens=max_tokens), None
            except Exception as e:  # noqa: BLE001 - a failed call is a row's result
                return None, str(e)

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                # The prompt is the last column; the others pass as they are, nested ones too.
                answers = list(pool.map(one, batch.column(batch.num_columns - 1).to_pylist()))
                told = [pa.array(part, pa.string()) for part in zip(*answers, strict=True)] or [pa.array([], pa.string())] * 2
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *told], schema=pa.schema([*list(batch.schema)[:-1], pa.field("raw", pa.string()), pa.field("error", pa.string())]))

    asked = df.select("*", prompt.alias("model_prompt"))
    answers = asked.mapInArrow(run, StructType([*df.schema.fields, StructField("raw", StringType()), StructField("error", StringType())]))
    return store_raw(answers, f"{raw_path.rstrip('/')}/{uuid.uuid4().hex}") if raw_path else answers


def store_raw(answers: DataFrame, path: str) -> DataFrame:
    """Write raw answers and go on from what was written."""
    answers.write.parquet(path)
    return answers.sparkSession.read.schema(answers.schema).parquet(path)


def fill(template: str, **fields: Column) -> Column:
    """A prompt template with named places as a Column; places that the values themselves name stay as they are."""
    shown = {f"{{{name}}}": F.coalesce(value.cast("string"), F.lit("")) for name, value in fields.items()}
    pieces = re.split(f"({'|'.join(map(re.escape, shown))})", template) if shown else [template]
    return F.concat(*[shown[p] if k % 2 else F.lit(p) for k, p in enumerate(pieces)])


def fill_from(df: DataFrame, template: str) -> Column:
    """A prompt template whose named places are columns of ``df``."""
    return fill(template, **{c: F.col(f"`{c}`") for c in df.columns if "{" + c + "}" in template})


def generate_pairs(chunks: DataFrame, template: str, fields: str = "question string, answer string", per_chunk: tuple[int, int] = (3, 5), keep: tuple[str, ...] = (), sanitise: bool = True, **options) -> DataFrame:
    """Several pairs from each chunk, with ``chunk_id`` and the time and model they come from.

    The template may name ``content`` or ``text``, ``n_pairs_min`` and
    ``n_pairs_max``.  Columns to ``keep`` come with each pair.  Without
    ``sanitise`` the model sees the text as it is, quotes in code too.
    """
    text = sanitise_chunk("content") if sanitise else F.col("content")
    answers = ask(chunks.select("chunk_id", "source_file", "content", *keep), fill(template, n_pairs_min=F.lit(per_chunk[0]), n_pairs_max=F.lit(per_chunk[1]), content=text, text=text), **options)
    each = answers.select("chunk_id", "source_file", *keep, F.posexplode(parse_json(strip_fence("raw"), f"array<struct<{fields.replace(' ', ':')}>>".replace(",:", ","))).alias("n", "pair"))
    return each.select("chunk_id", "source_file", *keep, "n", "pair.*", F.current_timestamp().alias("generated_at"), F.lit(options.get("model", "offline")).alias("model"))


def rate_pairs(pairs: DataFrame, template: str, **options) -> DataFrame:
    """Pairs with a judge's fields; what cannot be read has the defaults."""
    from .curation import DEFAULTS

    shown = F.to_json(F.array(F.struct("question", "answer")))
    answers = ask(pairs, fill(template, pairs=shown, question=F.col("question"), answer=F.col("answer")), temperature=0.1, **options)
    fields = "array<struct<rating:double,clarity:double,accuracy:double,usefulness:double,difficulty:double,topic_relevant:boolean>>"
    verdict = F.get(parse_json(strip_fence("raw"), fields), 0)
    out = answers.withColumn("verdict", verdict)
    return out.withColumns({k: F.coalesce(F.col("verdict")[k], F.lit(v)) for k, v in DEFAULTS.items()}).drop("verdict", "raw", "error")


def enrich(pairs: DataFrame, template: str, **options) -> DataFrame:
    """Pairs with a rewritten answer, or the old one where the model gave none."""
    answers = ask(pairs, fill_from(pairs, template), temperature=0.3, **options)
    # The whole object first, then the innermost one that has the wanted field.
    new = F.coalesce(*[F.get_json_object(found, "$.enriched_answer") for found in (F.regexp_extract("raw", r"(?s)\{.*\}", 0), rescue_enriched("raw"))])
    return answers.withColumns({"original_answer": F.col("answer"), "answer": F.coalesce(new, "answer")}).drop("raw", "error")


def add_reasoning(pairs: DataFrame, template: str, **options) -> DataFrame:
    """Pairs with ``reasoning``; a failed call leaves it empty.  All columns are carried along, so rows keep their keys.

    The template may name ``question``, ``answer`` and ``conversations``, the
    pair as a list of one conversation.  The model answers with objects with
    ``reasoning``, or with conversations whose assistant gives it in a field of
    its own or before the answer.
    """
    turn = lambda role, column: F.struct(F.lit(role).alias("role"), F.col(column).alias("content"))
    given = F.to_json(F.array(F.struct(F.array(turn("user", "question"), turn("assistant", "answer")).alias("conversations"))))
    answers = ask(pairs, fill(template, conversations=given, question=F.col("question"), answer=F.col("answer")), temperature=0.2, **options)
    first = F.get(parse_json(strip_fence("raw"), "array<struct<reasoning:string,conversations:array<struct<role:string,content:string,reasoning:string>>>>"), 0)
    said = F.get(F.filter("told.conversations", lambda t: t["role"].isin("assistant", "gpt", "model")), 0)
    # Columns of their own, so that the answer is read once.
    read = answers.withColumn("told", first).withColumn("said", said)
    content = F.col("said.content")
    before = F.when(F.endswith(content, F.col("answer")) & (F.length(content) > F.length("answer")), F.trim(F.substring(content, F.lit(1), F.length(content) - F.length("answer"))))
    found = F.coalesce(F.col("told.reasoning"), F.col("said.reasoning"), before)
    return read.withColumn("reasoning", F.coalesce(found, F.lit(""))).drop("raw", "error", "told", "said")


def _example_places(examples: DataFrame) -> dict[str, Column]:
    """What templates on whole examples may name."""
    from .tools import solution_summary

    path = examples.schema["reasoning_path"].dataType.elementType.names
    calls = F.to_json(F.transform("reasoning_path", lambda s: F.struct(s["tool"].alias("name"), s["args"].alias("args"))))
    result = F.to_json("execution_result") if "execution_result" in examples.columns else F.lit("N/A")
    summary = solution_summary() if {"actual_result", "status", "error_message"} <= set(path) else calls
    return {"solution_summary": summary, "steps_summary": summary, "tool_calls": calls, "result": result, "instruction": F.col("instruction"), "final_output": F.col("final_answer"), "final_answer": F.col("final_answer"), "answer": F.col("final_answer")}


def judge_examples(examples: DataFrame, template: str, **options) -> DataFrame:
    """Examples with the model's ``overall_score`` (null if it cannot be read)."""
    answers = ask(examples, fill(template, **_example_places(examples)), temperature=0.1, **options)
    score = F.get(parse_json(strip_fence("raw"), "array<struct<overall_score:double>>"), 0)["overall_score"]
    return answers.withColumn("overall_score", score).drop("raw", "error")


def rate_examples(examples: DataFrame, template: str, **options) -> DataFrame:
    """Examples with the judge's ``rating`` and its four parts as ``rating_breakdown``; defaults where it gave none."""
    from .curation import DEFAULTS

    answers = ask(examples.drop("rating", "rating_breakdown"), fill(template, **_example_places(examples)), temperature=0.1, **options)
    parts = ("clarity", "accuracy", "usefulness", "difficulty")
    verdict = F.get(parse_json(strip_fence("raw"), "array<struct<rating:double," + ",".join(f"{p}:double" for p in parts) + ">>"), 0)
    breakdown = F.struct(*[F.coalesce(F.col("example_verdict")[p], F.lit(DEFAULTS[p])).alias(p) for p in parts])
    rated = answers.withColumn("example_verdict", verdict).withColumns({"rating": F.coalesce(F.col("example_verdict.rating"), F.lit(DEFAULTS["rating"])), "rating_breakdown": breakdown})
    return rated.drop("example_verdict", "raw", "error")


def score_pairs(pairs: DataFrame, complexity_template: str, quality_template: str, **options) -> DataFrame:
    """Pairs with the model's ``complexity`` and ``quality`` from 1 to 10; the heuristics where an answer cannot be read."""
    out = pairs
    for name, template, otherwise in (("complexity", complexity_template, complexity("question")), ("quality", quality_template, quality("question", "answer"))):
        answers = ask(out, fill(template, question=F.col("question"), answer=F.col("answer")), temperature=0.1, **options)
        said = F.get(parse_json(strip_fence("raw"), f"array<struct<{name}:double,rating:double>>"), 0)
        score = F.coalesce(said[name], said["rating"])
        out = answers.withColumn(name, F.when(score.isNotNull(), F.greatest(F.lit(1.0), F.least(F.lit(10.0), score))).otherwise(otherwise.cast("double"))).drop("raw", "error")
    return out


def judge_datasets(sets: DataFrame, template: str, samples: int = 5, order: str = "idx", **options) -> DataFrame:
    """A row for each dataset with its metrics, the judge's ``score`` and whether it ``wins`` (best score, of equals the first).

    The template may name ``dataset`` or ``dataset_name``, ``n``, ``metrics``,
    ``sample_count`` and ``samples``: the first few pairs by ``order``.  Only these rows of metrics reach the model.
    """
    from pyspark.sql import Window

    from ..functions.text import verdict_score
    from .compare import dataset_metrics

    metrics = dataset_metrics(sets)
    ranked = sets.select("dataset", F.row_number().over(Window.partitionBy("dataset").orderBy(order)).alias("k"), F.concat(F.lit("Q: "), "question", F.lit("\nA: "), "answer").alias("shown")).where(F.col("k") <= samples)
    shown = ranked.groupBy("dataset").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "shown"))), lambda s: s["shown"]), "\n\n").alias("samples"))
    rows = metrics.withColumn("metrics", F.to_json(F.struct(*metrics.columns))).join(shown, "dataset").withColumns({"dataset_name": F.col("dataset"), "sample_count": F.least(F.lit(samples).cast("long"), "n")})
    answers = ask(rows, fill_from(rows, template), temperature=0.1, **options)
    scored = answers.withColumn("score", F.coalesce(verdict_score("raw"), F.lit(0.0)))
    best = scored.agg(F.min(F.struct(-F.col("score"), F.col("dataset"))).getField("dataset").alias("best"))
    return scored.crossJoin(F.broadcast(best)).withColumn("wins", F.col("dataset") == F.col("best")).drop("raw", "error", "best", "samples", "dataset_name", "sample_count")


def decide(judged: DataFrame, template: str, **options) -> str | None:
    """The dataset that the model names as the winner; where it names none of them, the one of the best score.

    ``judged`` has a row for each dataset, so few rows reach the driver.
    """
    from ..functions.text import verdict_winner

    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dataset", "score", "metrics"))), lambda r: F.concat(r["dataset"], F.lit(": "), r["score"], F.lit(" "), r["metrics"])), "\n")
    row = judged.agg(line.alias("quality_scores"), F.to_json(F.collect_list("metrics")).alias("metrics_comparison"), F.collect_list("dataset").alias("names"), F.max(F.when(F.col("wins"), F.col("dataset"))).alias("best"))
    said = ask(row, fill_from(row, template), temperature=0.1, **options).select(verdict_winner("raw").alias("winner"), "names", "best").first()
    return said["winner"] if said["winner"] in (said["names"] or []) else said["best"]


def tools_from_topics(topics: DataFrame, template: str, **options) -> DataFrame:
    """Tools that the model invents for each ``topic``, those without name or description left out."""
    from .tools import refine_generated

    answers = ask(topics.select("topic"), fill(template, topic=F.col("topic")), temperature=0.8, **options)
    kind = "array<struct<name:string,description:string,category:string,parameters:array<struct<name:string,type:string,description:string,required:boolean>>>>"
    each = answers.select("topic", F.explode(parse_json(strip_fence("raw"), kind)).alias("t")).select("topic", "t.*")
    return refine_generated(each).withColumn("tool_id", F.replace(F.lower("name"), F.lit(" "), F.lit("_")))


def rate_steps(examples: DataFrame, template: str, key: str = "example_id", **options) -> DataFrame:
    """``step_ratings`` of each example, in the order of its path, within [0, 1]; 0.5 where the model gave none.

    The template may name the example's ``instruction``, the step's
    ``step_number``, ``thought``, ``tool``, ``args`` and ``result``, and
    ``total_steps`` and ``previous_context``, the calls before it.
    """
    from ..functions.values import as_json

    path = examples.schema["reasoning_path"].dataType.elementType.names
    result = (lambda s: F.coalesce(as_json(s["actual_result"]), F.lit("N/A"))) if "actual_result" in path else (lambda s: F.lit("N/A"))
    call = lambda s, i: F.concat(F.lit("Step "), i + 1, F.lit(": Used "), s["tool"], F.lit("("), F.coalesce(F.to_json(s["args"]), F.lit("{}")), F.lit(") -> "), result(s))
    each = examples.select(key, "instruction" if "instruction" in examples.columns else F.lit("").alias("instruction"), F.size("reasoning_path").alias("total_steps"), F.transform("reasoning_path", call).alias("calls"), F.posexplode("reasoning_path").alias("position", "s"))
    before = F.array_join(F.slice("calls", F.lit(1), F.col("position")), "\n")
    steps = each.select(key, "position", (F.col("position") + 1).alias("step_number"), "total_steps", F.col("s.thought").alias("thought"), F.col("s.tool").alias("tool"), F.to_json("s.args").alias("args"), result(F.col("s")).alias("result"), before.alias("previous_context"), "instruction")
    answers = ask(steps, fill_from(steps, template), temperature=0.1, **options)
    score = F.get(parse_json(strip_fence("raw"), "array<struct<overall_score:double>>"), 0)["overall_score"]
    rated = answers.select(key, F.struct("position", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(score, F.lit(0.5)))).alias("r")).alias("s"))
    lists = rated.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["r"]).alias("step_ratings"))
    return examples.join(lists, key, "left").withColumn("step_ratings", F.coalesce("step_ratings", F.array().cast("array<double>")))


def instructions_for_tools(tools: DataFrame, template: str, n: int, **options) -> DataFrame:
    """At most ``n`` instructions for each tool.

    The template may name ``name`` or ``tool_name``, ``description`` or
    ``tool_description``, ``parameters``, ``examples`` and the numbers
    ``n_instructions_min`` and ``n_instructions_max``.
    """
    shown = {c: F.to_json(c) if c in tools.columns else F.lit("[]") for c in ("parameters", "examples")}
    places = {"n_instructions_min": F.lit(n), "n_instructions_max": F.lit(n), "name": F.col("name"), "tool_name": F.col("name"), "description": F.col("description"), "tool_description": F.col("description")}
    asked = tools.select("tool_id", fill(template, **places, **shown).alias("filled"))
    answers = ask(asked, F.col("filled"), temperature=0.8, **options)
    each = F.slice(parse_json(strip_fence("raw"), "array<struct<question:string>>"), 1, n)
    return answers.select("tool_id", F.posexplode(each).alias("n", "e")).select("tool_id", "n", F.col("e.question").alias("instruction"))


def tool_pairs(tools: DataFrame) -> DataFrame:
    """Neighbouring tools within a category, for instructions that need both."""
    from pyspark.sql import Window

    order = Window.partitionBy(F.coalesce("category", F.lit("other"))).orderBy("idx")
    return tools.withColumn("next_tool", F.lead("tool_id").over(order)).where("next_tool is not null").select("tool_id", "next_tool", "category")


def hybrid(chain_first: DataFrame, query_first: DataFrame, n: int, ratio: float = 0.4, order: str = "idx") -> DataFrame:
    """A mix: ``int(n * ratio)`` examples built from chains, the rest from queries."""
    first = chain_first.orderBy(order).limit(int(n * ratio))
    return first.unionByName(query_first.orderBy(order).limit(n - int(n * ratio)), allowMissingColumns=True)


def category_leaders(tools: DataFrame) -> DataFrame:
    """The first tool of every category, for instructions across categories."""
    first = tools.groupBy(F.coalesce("category", F.lit("other")).alias("category")).agg(F.min(F.struct("idx", "tool_id")).alias("first"))
    return first.select("category", "first.tool_id")


_PATH = f"array<{STEP}>"


def annotate(instructions: DataFrame, template: str, several: bool = False, **options) -> DataFrame:
    """``reasoning_path`` and ``final_answer`` for each instruction; rows the model cannot solve go."""
    answers = ask(instructions, fill_from(instructions, template), temperature=0.5 if several else 0.3, **options)
    body = F.from_json(F.regexp_extract("raw", r"(?s)\{.*\}", 0), f"reasoning_path {_PATH}, final_answer string")
    solved = answers.withColumns({"reasoning_path": body["reasoning_path"], "final_answer": body["final_answer"]}).drop("raw", "error")
    return solved.where(F.coalesce(F.size("reasoning_path"), F.lit(0)) > 0)


def chain_first(chains: DataFrame, template: str, n: int, least_steps: int = 2, **options) -> DataFrame:
    """At most ``n`` examples that start from chains of tools; of three times as many asked, those that can be read stay."""
    ready = chains.where(F.size("chain") >= least_steps).withColumn("chain_text", F.array_join("chain", " -> ")).orderBy("chain_text").limit(3 * n)
    answers = ask(ready, fill(template, chain=F.col("chain_text")), temperature=0.7, **options)
    question = F.get(parse_json(strip_fence("raw"), "array<struct<question:string>>"), 0)["question"]
    made = answers.withColumns({"instruction": question, "difficulty": F.when(F.size("chain") >= 3, "complex").otherwise("medium")}).drop("raw", "error")
    return made.where(F.length(F.coalesce("instruction", F.lit(""))) > 0).orderBy("chain_text").limit(n)


def chain_attempts(tools: DataFrame, n: int, least: int = 2, most: int = 4, shown: int = 50) -> DataFrame:
    """``n`` candidates for a chain of calls: the categories of at least ``least`` tools in turn, with their first ``shown`` tools."""
    from pyspark.sql import Window

    category = F.coalesce("category", F.lit("other"))
    ranked = tools.select(category.alias("category"), "tool_id", "name", "description", "parameters", F.row_number().over(Window.partitionBy(category).orderBy("idx")).alias("k")).where(F.col("k") <= shown)
    definition = F.struct("k", "name", "description", "parameters")
    listed = ranked.groupBy("category").agg(F.to_json(F.array_sort(F.collect_list(definition))).alias("tools_json"), F.collect_set("tool_id").alias("ids"), F.collect_set("name").alias("names"))
    turns = listed.where(F.size("ids") >= least).withColumns({"turn": F.row_number().over(Window.orderBy("category")) - 1, "n_turns": F.count("*").over(Window.partitionBy(F.lit(1)))})
    each = turns.select("*", F.explode(F.sequence(F.lit(0), F.lit(max(0, n - 1)))).alias("round")).where(F.col("round") * F.col("n_turns") + F.col("turn") < n)
    place = (F.col("round") * F.col("n_turns") + F.col("turn")).alias("number")
    return each.select(place, "category", "tools_json", F.array_union("ids", "names").alias("known"), F.lit(least).alias("min_steps"), F.lit(most).alias("max_steps"))


def chain_examples(candidates: DataFrame, chain_template: str, query_template: str, **options) -> DataFrame:
    """Examples made from chains of calls: the model gives a chain, then the request that it serves.

    ``accepted``: the chain has as many steps as asked, all of known tools, and
    there is a request.  The first template may name ``tools_json``,
    ``min_steps`` and ``max_steps``, the second ``chain_steps``, ``tools_used``
    and ``final_result``.  Answers may be a list of steps or an object with
    ``steps`` or ``reasoning_path``, and for the request a list of one object
    or an object with ``query``, ``question`` or ``instruction``.
    """
    answers = ask(candidates, fill_from(candidates, chain_template), temperature=0.7, **options).withColumnsRenamed({"raw": "chain_raw", "error": "chain_error"})
    told = F.from_json(F.regexp_extract("chain_raw", r"(?s)\{.*\}", 0), f"steps {_PATH}, reasoning_path {_PATH}, final_answer string")
    bare = parse_json(strip_fence("chain_raw"), f"array<struct<tool:string,thought:string,args:{ARGS},expected_result:variant>>")
    listed = F.filter(F.transform(bare, lambda s, i: F.struct((i + 1).cast("int").alias("step"), s["thought"].alias("thought"), s["tool"].alias("tool"), s["args"].alias("args"), s["expected_result"].alias("expected_result"), F.lit(None).alias("actual_result"), F.lit(None).alias("status"), F.lit(None).alias("error_message")).cast(STEP)), lambda s: s["tool"].isNotNull())
    some = lambda c: F.when(F.size(c) > 0, c)
    path = F.coalesce(some(F.col("told.steps")), some(F.col("told.reasoning_path")), some(listed), F.array().cast(_PATH))
    read = answers.withColumn("told", told).withColumn("reasoning_path", path).withColumn("final_answer", F.coalesce("told.final_answer", F.lit("The task is complete."))).drop("told")
    used = F.transform("reasoning_path", lambda s: s["tool"])
    sound = F.size("reasoning_path").between(F.col("min_steps"), F.col("max_steps")) & (F.size(F.array_except(used, "known")) == 0)
    steps = F.array_join(F.transform("reasoning_path", lambda s, i: F.concat(i + 1, F.lit(". "), s["tool"], F.lit("("), F.coalesce(F.to_json(s["args"]), F.lit("{}")), F.lit(")"))), "\n")
    marked = read.withColumns({"sound": F.coalesce(sound, F.lit(False)), "chain_steps": steps, "tools_used": F.array_join(used, ", "), "final_result": F.col("final_answer")})
    # A request is asked for sound chains only.
    good = ask(marked, F.when(F.col("sound"), fill_from(marked, query_template)), temperature=0.6, **options)
    body, text = F.regexp_extract("raw", r"(?s)\{.*\}", 0), F.trim("raw")
    request = F.coalesce(*[F.get_json_object(body, f"$.{k}") for k in ("query", "question", "instruction")], F.when((F.length(text) < 500) & (F.contains(text, F.lit("?")) | F.contains(F.lower(text), F.lit("please"))), text))
    made = good.withColumn("instruction", request).withColumn("accepted", F.length(F.coalesce("instruction", F.lit(""))) > 0)
    kept = [c for c in candidates.columns if c not in ("tools_json", "known", "min_steps", "max_steps")]
    out = [*kept, "instruction", "reasoning_path", "final_answer", F.lit("chain_first").alias("generation_method"), F.when(F.size("reasoning_path") >= 3, "complex").otherwise("medium").alias("difficulty"), "accepted"]
    return made.select(*out)


def generate_chain_first(tools: DataFrame, n: int, path: str, chain_template: str, query_template: str, least: int = 2, most: int = 4, factor: int = 3, **options) -> DataFrame:
    """``n`` examples that start from chains, of at most ``factor`` times as many attempts.

    Asking stops at the target; attempts are kept below ``path``, and another
    call goes on from them.
    """
    from ..streaming.until import until

    return until(chain_attempts(tools, factor * n, least, most), lambda some: chain_examples(some, chain_template, query_template, **options), n, path, "number", factor * n)


def model_chains(tools: DataFrame, template: str, least: int = 2, most: int = 4, shown: int = 50, **options) -> DataFrame:
    """``(chain, length)``: for each category, an order of its tools that the model proposes.

    The template may name ``category``, ``tools_json`` (the first ``shown``
    tools of the category), ``min_steps`` and ``max_steps``.  Chains of too few
    or too many steps, or with tools that are not in the category, are rejected.
    """
    from pyspark.sql import Window

    category = F.coalesce("category", F.lit("other"))
    ranked = tools.select(category.alias("category"), "tool_id", "name", "description", F.row_number().over(Window.partitionBy(category).orderBy("idx")).alias("k")).where(F.col("k") <= shown)
    listed = ranked.groupBy("category").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("k", "tool_id", "description"))), lambda t: F.struct(t["tool_id"], t["description"]))).alias("tools_json"))
    rows = listed.withColumns({"min_steps": F.lit(least), "max_steps": F.lit(most)})
    answers = ask(rows, fill_from(rows, template), temperature=0.7, **options)
    chain = F.get(parse_json(strip_fence("raw"), "array<struct<chain:array<string>>>"), 0)["chain"]
    made = answers.select("category", chain.alias("chain")).where(F.size("chain").between(least, most))
    # All tools of the category count, also those that the prompt did not show.
    known = tools.select(category.alias("category"), F.col("tool_id").alias("tool")).distinct()
    named = made.select("category", "chain", F.explode_outer(F.array_distinct("chain")).alias("tool"))
    met = named.join(known.withColumn("there", F.lit(1)), ["category", "tool"], "left").groupBy("category", "chain").agg(F.count("there").alias("n_known"))
    return met.where(F.col("n_known") == F.size(F.array_distinct("chain"))).select("category", "chain", F.size("chain").alias("length"))


def simulate_steps(examples: DataFrame, template: str, key: str = "example_id", **options) -> DataFrame:
    """Each step with a result that the model makes up: ``(example, position, success, output, error)``."""
    from .tools import step_rows

    steps = step_rows(examples, key).select(key, "position", "thought", "tool", F.to_json("args").alias("args_text"))
    answers = ask(steps, fill(template, tool=F.col("tool"), args=F.col("args_text")), temperature=0.3, **options)
    return answers.select(key, "position", F.col("error").isNull().alias("success"), F.col("raw").alias("output"), "error")


def verify(examples: DataFrame, template: str, **options) -> DataFrame:
    """``verified``: whether the model finds the answer sound (``valid`` or ``correct``); true where it fails to say."""
    answers = ask(examples, fill(template, **_example_places(examples)), temperature=0.1, **options)
    body = F.regexp_extract("raw", r"(?s)\{.*\}", 0)
    said = F.coalesce(F.get_json_object(body, "$.valid"), F.get_json_object(body, "$.correct"))
    return answers.withColumn("verified", F.coalesce(F.lower(said) == "true", F.lit(True))).drop("raw", "error")


def requirements(examples: DataFrame, template: str, key: str = "example_id", **options) -> DataFrame:
    """``(example, n, requirement)``: what an instruction asks for."""
    answers = ask(examples.select(key, "instruction"), fill(template, instruction=F.col("instruction")), temperature=0.1, **options)
    listed = F.from_json(F.regexp_extract("raw", r"(?s)\[.*\]", 0), "array<string>")
    return answers.select(key, F.posexplode(listed).alias("n", "requirement"))
