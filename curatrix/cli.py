"""Command line: ``python -m curatrix.cli COMMAND ...``.

Paths are those of the session's file systems; results are folders that Spark
writes.  Prompts are the built-in ones unless ``--prompts`` names a folder.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.text import parse_json, strip_fence
from .operators import compare, coverage, curation, execution, export, filters, graph, models, scoring, tools
from .plans import pipelines
from .sources import config, readers, sinks, tool_parsers
from .sources.templates import TEMPLATES
from .streaming.until import until

PAIR_SCHEMA = "question string, answer string, reasoning string, chunk_id string, source_file string, source string, model string, rating double, topic_relevant boolean"


def _session() -> SparkSession:
    return SparkSession.builder.appName("curatrix").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def _prompt(args, name: str, default: str | None = None) -> str:
    """The folder's template of the name, or the built-in one."""
    default = TEMPLATES[name] if default is None else default
    return config.prompts(args.prompts).get(name, default) if getattr(args, "prompts", None) else default


def _model(args) -> dict:
    """Provider and options: those of the command line before those of the configuration's ``llm`` section."""
    section = config.load(args.config).get("llm", {}) if getattr(args, "config", None) else {}
    chosen = config.resolve(section, args.provider)
    key = args.api_key or (os.environ.get(args.api_key_variable) if args.api_key_variable else None)
    given = {"model": args.model or (chosen.model if chosen.model != "offline" else None), "key": key, "url": args.url, "max_tokens": args.max_tokens}
    return {"provider": chosen.provider} | {k: v for k, v in {**chosen.options, **given}.items() if v is not None}


def _raw(args) -> dict:
    """As ``_model``, with the folder that raw answers are written to before they are read."""
    return _model(args) | {"raw_path": f"{args.output.rstrip('/')}.raw"}


def _keyed(df: DataFrame) -> DataFrame:
    """``idx``: a hash of the row, and of a number among rows that are the same in all columns, so that reruns give the same keys."""
    body = F.to_json(F.struct(*df.columns))
    same = Window.partitionBy("row_hash").orderBy("row_hash")
    return df.withColumn("row_hash", F.sha2(body, 256)).withColumn("idx", F.xxhash64("row_hash", F.row_number().over(same))).drop("row_hash")


def _pairs(spark: SparkSession, path: str) -> DataFrame:
    return readers.json_array(spark, path, PAIR_SCHEMA) if path.endswith(".json") else _keyed(readers.json_lines(spark, path, PAIR_SCHEMA))


def _chunks(spark: SparkSession, args) -> DataFrame:
    df = readers.tables(spark, dict(p.split("=", 1) if "=" in p else (readers.stem(p), p) for p in args.table))
    df = df.withColumn("chunk_id", F.col("id").cast("string")) if "chunk_id" not in df.columns else df
    df = df if "source_file" in df.columns else df.withColumn("source_file", F.col("source") if "source" in df.columns else F.lit(""))
    df = filters.min_content(filters.skip_sources(df, args.skip or filters.DEFAULT_SKIPS), args.min_length)
    if args.resume:
        df = filters.resume(df, spark.read.parquet(args.resume), "chunk_id")
    return df if args.max_chunks is None else filters.head(df, args.max_chunks, "chunk_id")


def list_providers(spark, args):
    print("\n".join(models.providers()))


def generate(spark, args):
    pairs = models.generate_pairs(_chunks(spark, args), _prompt(args, "qa_generation"), raw_path=f"{args.output}/raw", **_model(args))
    sinks.append(pairs.withColumn("generated_at", F.col("generated_at").cast("string")), f"{args.output}/pairs")
    sinks.result_bundle(spark.read.parquet(f"{args.output}/pairs"), args.output)
    answers = spark.read.parquet(f"{args.output}/raw/*")
    sinks.unparsed(answers.withColumn("parsed", parse_json(strip_fence("raw"), "array<struct<question:string,answer:string>>")), f"{args.output}/unparsed")


def generate_cot(spark, args):
    """Chunk by chunk until ``--target-pairs`` is reached, if given; a second run goes on where the first was left."""
    template, options = _prompt(args, "cot_generation"), {"fields": "question string, reasoning string, answer string", "per_chunk": (1, args.pairs_per_chunk)}

    def attempt(some: DataFrame) -> DataFrame:
        return filters.structured(models.generate_pairs(some, template, keep=("attempt_place",), **options, **_model(args))).withColumn("accepted", F.lit(True))

    if args.target_pairs:
        kept = until(_chunks(spark, args), attempt, args.target_pairs, f"{args.output}/work", "chunk_id", each=args.pairs_per_chunk)
    else:
        kept = filters.structured(models.generate_pairs(_chunks(spark, args), template, raw_path=f"{args.output}/raw", **options, **_model(args)))
    if args.topic_filter:
        kept = filters.on_topic(models.rate_pairs(kept, _prompt(args, "qa_rating"), **_raw(args)))
    sinks.records(kept, f"{args.output}/pairs")


def curate(spark, args):
    rated = pipelines.curate_pairs(_pairs(spark, args.input), args.threshold, args.skip, raw_path=f"{args.output}/raw", **_model(args))
    sinks.curation_bundle(rated, args.threshold, args.output)


def enhance_cot(spark, args):
    sinks.records(models.add_reasoning(_pairs(spark, args.input), _prompt(args, "cot_enhancement"), **_raw(args)), args.output)


def resume_cot(spark, args):
    done = readers.json_lines(spark, args.done, PAIR_SCHEMA)
    rest = filters.resume(_pairs(spark, args.input), done, "question")
    new = models.add_reasoning(rest, _prompt(args, "cot_enhancement"), **_raw(args))
    sinks.records(done.unionByName(new, allowMissingColumns=True), args.output)


def fix_cot(spark, args):
    pairs = _pairs(spark, args.input)
    fixed = models.add_reasoning(filters.empty_reasoning(pairs).drop("reasoning"), _prompt(args, "cot_enhancement"), **_raw(args))
    out = curation.repair(pairs, fixed, "idx")
    sinks.records(out, args.output)
    curation.failure_counts(pairs).show()
    curation.failure_counts(spark.read.json(args.output)).show()


def enrich(spark, args):
    sinks.records(models.enrich(_pairs(spark, args.input), _prompt(args, "qa_enrichment"), **_raw(args)), args.output)


def multi_score(spark, args):
    """Scores by the model with ``--use-model``; diversity against all earlier vectors with ``--vectors``, else neutral."""
    pairs = _pairs(spark, args.input)
    scored = scoring.score(pairs)
    if args.use_model:
        asked = models.score_pairs(pairs, _prompt(args, "complexity", pipelines.COMPLEXITY_PROMPT), _prompt(args, "quality", pipelines.QUALITY_PROMPT), **_raw(args))
        scored = asked.withColumn("diversity", F.lit(scoring.NEUTRAL)).withColumn("combined", scoring.combined())
    if args.vectors:
        near = scoring.diversity_before(spark.read.parquet(args.vectors), args.vector, args.key_column).select(F.col(args.key_column).alias("idx"), "diversity")
        scored = scored.drop("diversity").join(near, "idx", "left").withColumn("diversity", F.coalesce("diversity", F.lit(scoring.NEUTRAL))).withColumn("combined", scoring.combined())
    out = scoring.top_k(scored, args.top_k, args.strategy) if args.top_k else scoring.score_at_least(scored, args.min_score)
    sinks.records(out, args.output)
    scoring.score_summary(scored).show()


def select_coverage(spark, args):
    v = spark.read.parquet(args.input)
    if args.encoder:
        v = coverage.embed_cached(coverage.embedding_text(v), coverage.ENCODERS[args.encoder](), args.cache or f"{args.output.rstrip('/')}.vectors", model=args.encoder)
        v = v.withColumnRenamed("embedding", args.vector) if args.vector != "embedding" else v
    n = coverage.target_size(v.count(), args.target, args.ratio)
    clustered = coverage.kmeans(v, coverage.cluster_count(v.count(), args.clusters), args.vector)
    pick = coverage.select_diverse if args.strategy == "diverse" else coverage.select_centroid
    out = pick(clustered, n, args.vector, "cluster", args.key)
    out.write.mode("overwrite").parquet(args.output)
    coverage.coverage_score(v, spark.read.parquet(args.output), args.vector).show()


def export_lines(spark, args):
    df = readers.examples(spark, args.input) if args.examples else _pairs(spark, args.input)
    sinks.training_lines(df, args.format, args.output)


def pipeline(spark, args):
    records = pipelines.qa_pipeline(_chunks(spark, args), args.threshold, args.format, least=args.min_length, **_model(args))
    export.as_lines(records).write.mode("overwrite").text(args.output)


def compare_sets(spark, args):
    good, wrong = readers.split_errors(readers.checked_array(spark, args.input, PAIR_SCHEMA), f"{args.output.rstrip('/')}.read")
    sets = good.withColumn("dataset", readers.dataset_name())
    wrong.write.mode("overwrite").json(f"{args.output.rstrip('/')}.errors")
    m = compare.dataset_metrics(sets)
    m.show(truncate=False)
    decision = None
    if args.judge:
        judged = models.judge_datasets(sets, _prompt(args, "qa_comparison_evaluation"), args.samples, **_raw(args))
        judged.select("dataset", "n", "score", "wins").show(truncate=False)
        decision = models.decide(judged, _prompt(args, "qa_comparison_selection"), **_raw(args))
        print(f"winner: {decision}")
    compare.report(m, decision).write.mode("overwrite").text(args.output)


def tool_parse(spark, args):
    with open(args.input, encoding="utf-8") as f:
        found = tool_parsers.frame(spark, tool_parsers.load(f.read(), args.kind))
    tools.invalid_tools(found).show(truncate=False)
    sinks.records(found, args.output)


def tool_deps(spark, args):
    df = readers.tools(spark, args.input)
    nodes, params = graph.from_tools(df, "idx")
    graph.type_statistics(nodes, params).show()
    if args.chains:
        graph.first_chains(nodes, params, least=2, most=args.max_length, entries=args.entries, each=args.per_entry).orderBy("entry", "number").show(args.entries * args.per_entry, truncate=False)
    if args.validate:
        chain = spark.createDataFrame([("chain", graph.parse_chain(args.validate))], "chain_id string, chain array<string>")
        graph.type_chain_issues(chain, nodes, params).show(truncate=False)
    if args.output:
        sinks.graph_files(nodes, graph.edges(nodes, params), args.output)


def tool_generate(spark, args):
    made = models.instructions_for_tools(readers.tools(spark, args.input), _prompt(args, "tool_instruction_generation"), args.n, **_raw(args))
    sinks.records(made, args.output)


def tool_generate_from_topic(spark, args):
    topic = spark.createDataFrame([(args.topic,)], "topic string")
    template = _prompt(args, "tool_from_topic", "Invent tools for {topic} as a JSON list of objects with name, description and parameters.")
    sinks.records(models.tools_from_topics(topic, template, **_raw(args)), args.output)


def tool_generate_chain(spark, args):
    """Examples that start from chains; with ``--hybrid`` the rest starts from requests for single tools."""
    listed = readers.tools(spark, args.input)
    first = int(args.target_pairs * args.chain_ratio) if args.hybrid else args.target_pairs
    work = f"{args.output.rstrip('/')}.work"
    made = models.generate_chain_first(listed, first, f"{work}/chains", _prompt(args, "chain_generation"), _prompt(args, "query_synthesis"), args.min_steps, args.max_steps, **_model(args))
    rest = args.target_pairs - first
    if rest:
        some = listed.orderBy("idx").limit(rest)
        asked = pipelines.tool_examples(some, max(1, rest // max(1, some.count())), raw_path=f"{work}/raw", **_model(args)).withColumn("idx", F.col("example_id"))
        made = models.hybrid(made.withColumn("idx", F.col("number").cast("long")), asked, args.target_pairs, args.chain_ratio)
    sinks.records(made.drop("idx", "number", "category"), args.output)


def tool_execute(spark, args):
    """Steps by a model that acts as the tools, or by registered implementations; without ``--tools`` the registered ones run.

    With ``--verify`` the model says whether each executed example is sound,
    and lists what the requests ask for in a folder of its own.
    """
    found = readers.examples(spark, args.input)
    if args.tools is None:
        sinks.records(tools.run_steps(found), args.output)
        return
    ran = execution.execute_examples(found, readers.tools(spark, args.tools), args.mode, _prompt(args, "tool_simulation"), **_model(args))
    if args.verify:
        needs = models.requirements(found, _prompt(args, "requirements", "List what this request asks for as a JSON list of texts.\n{instruction}"), **_raw(args))
        sinks.records(needs, f"{args.output.rstrip('/')}.requirements")
        ran = models.verify(ran, _prompt(args, "tool_semantic_verification"), **_raw(args))
    sinks.records(ran, args.output)


def tool_curate(spark, args):
    df = readers.examples(spark, args.input).withColumn("difficulty", F.coalesce(F.try_element_at("metadata", F.lit("difficulty")), F.lit("medium")))
    sinks.records(pipelines.curate_examples(df, args.rate, args.min_rating), args.output)


def tool_evaluate(spark, args):
    judged = models.judge_examples(readers.examples(spark, args.input), _prompt(args, "outcome_evaluation", pipelines.OUTCOME_PROMPT), **_raw(args))
    out = judged.withColumn("outcome", tools.outcome("overall_score", F.col("execution_result.success")))
    compare.outcome_summary(out.select("outcome.status", "outcome.score")).show()
    sinks.records(tools.satisfied(out, args.min_score), args.output)


def tool_pipeline(spark, args):
    """Generate, execute, curate and export; about ``--target-pairs`` examples over all tools."""
    listed = readers.tools(spark, args.input)
    n = args.n if args.target_pairs is None else max(1, args.target_pairs // max(1, listed.count()))
    records = pipelines.tool_pipeline(listed, n, args.min_score, args.mode, args.threshold, args.format, f"{args.output.rstrip('/')}.work", **_model(args))
    export.as_lines(records).write.mode("overwrite").text(args.output)


COMMANDS = {
    "list-providers": (list_providers, ""), "generate": (generate, "chunks"), "curate": (curate, "io curate"), "select-coverage": (select_coverage, "io coverage"), "multi-score": (multi_score, "io score"),
    "enrich": (enrich, "io"), "generate-cot": (generate_cot, "chunks topic early"), "enhance-cot": (enhance_cot, "io"), "resume-cot": (resume_cot, "io done"), "fix-cot": (fix_cot, "io"),
    "export": (export_lines, "io format"), "pipeline": (pipeline, "chunks curate format"), "compare": (compare_sets, "many judge"), "tool-parse": (tool_parse, "io kind"), "tool-deps": (tool_deps, "io deps"),
    "tool-generate": (tool_generate, "io n"), "tool-generate-from-topic": (tool_generate_from_topic, "topic_text"), "tool-generate-chain": (tool_generate_chain, "io steps hybrid"), "tool-execute": (tool_execute, "io execute"),
    "tool-curate": (tool_curate, "io example"), "tool-evaluate": (tool_evaluate, "io score"), "tool-pipeline": (tool_pipeline, "io n score execute format target"),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="curatrix")
    sub = top.add_subparsers(dest="command", required=True)
    for name, (_, groups) in COMMANDS.items():
        p, groups = sub.add_parser(name), groups.split()
        p.add_argument("--provider")
        p.add_argument("--model")
        p.add_argument("--config")
        p.add_argument("--url")
        p.add_argument("--api-key")
        p.add_argument("--api-key-variable", help="environment variable that holds the key")
        p.add_argument("--max-tokens", type=int)
        p.add_argument("--prompts")
        if "io" in groups:
            p.add_argument("input")
        if "many" in groups:
            p.add_argument("input", nargs="+")
        if groups:
            p.add_argument("--output", required=name != "tool-deps")
        if "chunks" in groups:
            p.add_argument("--table", action="append", required=True)
            p.add_argument("--skip", action="append")
            p.add_argument("--min-length", type=int, default=200)
            p.add_argument("--max-chunks", type=int)
            p.add_argument("--resume")
        if "curate" in groups:
            p.add_argument("--threshold", type=float, default=7.0)
            if "chunks" not in groups:
                p.add_argument("--skip", action="append")
        if "format" in groups:
            p.add_argument("--format", choices=export.FORMATS, default="chatml")
            p.add_argument("--examples", action="store_true")
        if "score" in groups:
            p.add_argument("--min-score", type=float, default=0.7 if name.startswith("tool") else 6.0)
            p.add_argument("--top-k", type=int)
            p.add_argument("--strategy", default="combined")
            p.add_argument("--use-model", action="store_true")
            p.add_argument("--vectors")
            p.add_argument("--vector", default="embedding")
            p.add_argument("--key-column", default="idx")
        if "execute" in groups:
            p.add_argument("--mode", choices=execution.MODES, default="simulated")
            p.add_argument("--tools")
            p.add_argument("--verify", action="store_true")
        if "target" in groups:
            p.add_argument("--target-pairs", type=int)
            p.add_argument("--threshold", type=float, default=7.0)
        if "judge" in groups:
            p.add_argument("--judge", action="store_true")
            p.add_argument("--samples", type=int, default=5)
        if "coverage" in groups:
            p.add_argument("--target", type=int)
            p.add_argument("--ratio", type=float, default=0.2)
            p.add_argument("--clusters", type=int)
            p.add_argument("--strategy", choices=("centroid", "diverse"), default="centroid")
            p.add_argument("--encoder", choices=sorted(coverage.ENCODERS), help="make the vectors of the rows' texts")
            p.add_argument("--cache", help="table of vectors that is kept from run to run")
            p.add_argument("--vector", default="embedding")
            p.add_argument("--key", default="vec_id")
        if "deps" in groups:
            p.add_argument("--chains", action="store_true")
            p.add_argument("--validate")
            p.add_argument("--max-length", type=int, default=4)
            p.add_argument("--entries", type=int, default=5)
            p.add_argument("--per-entry", type=int, default=10)
        if "steps" in groups:
            p.add_argument("--min-steps", type=int, default=2)
            p.add_argument("--max-steps", type=int, default=4)
        if "hybrid" in groups:
            p.add_argument("--target-pairs", type=int, default=50)
            p.add_argument("--hybrid", action="store_true")
            p.add_argument("--chain-ratio", type=float, default=0.4)
        if "early" in groups:
            p.add_argument("--target-pairs", type=int, help="stop once there are so many")
            p.add_argument("--pairs-per-chunk", type=int, default=5)
        if "n" in groups:
            p.add_argument("--n", type=int, default=2)
        if "example" in groups:
            p.add_argument("--rate", type=float, default=1.0)
            p.add_argument("--min-rating", type=float, default=0.7)
        if "topic" in groups:
            p.add_argument("--topic-filter", action="store_true")
        if "topic_text" in groups:
            p.add_argument("topic")
        if "done" in groups:
            p.add_argument("--done", required=True)
        if "kind" in groups:
            p.add_argument("--kind", choices=("openapi", "json", "python"), default="json")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    COMMANDS[args.command][0](_session(), args)


if __name__ == "__main__":
    main()
