"""Writers: result bundles, curation bundles, training lines, graphs, resumable appends."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import curation, export, graph
from ..operators.order import numbered

#: Numbers of files have as many digits each, so that names are in order; numbers, as texts would be sorted again when written.
_FIRST_FILE = 1_000_000_000


def summary(pairs: DataFrame) -> DataFrame:
    """Count, sources and models of generated pairs."""
    sets = [F.sort_array(F.collect_set(c)).alias(n) if c in pairs.columns else F.array().cast("array<string>").alias(n) for c, n in (("source_file", "sources"), ("model", "models"))]
    return pairs.agg(F.count("*").alias("total_pairs"), *sets)


def result_bundle(pairs: DataFrame, path: str) -> None:
    """Pairs as JSON lines and Parquet, and their summary."""
    pairs.write.mode("overwrite").json(f"{path}/jsonl")
    pairs.write.mode("overwrite").parquet(f"{path}/parquet")
    summary(pairs).write.mode("overwrite").json(f"{path}/summary")


def append(pairs: DataFrame, path: str) -> None:
    """Finished work that a later run resumes from with an anti join."""
    pairs.write.mode("append").parquet(path)


def null_chunks(chunks: DataFrame, pairs: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Ids of chunks that gave no pair."""
    return chunks.join(pairs.select(key).distinct(), key, "left_anti").select(key)


def curation_bundle(rated: DataFrame, threshold: float, path: str) -> None:
    """All rated rows once; the curated ones, metrics and distribution from what was written."""
    rated.write.mode("overwrite").parquet(f"{path}/all_rated")
    kept = rated.sparkSession.read.parquet(f"{path}/all_rated")
    from ..operators.filters import at_least

    at_least(kept, threshold).write.mode("overwrite").json(f"{path}/curated")
    curation.metrics(kept, threshold).write.mode("overwrite").json(f"{path}/metrics")
    curation.histogram(kept).write.mode("overwrite").json(f"{path}/distribution")


def training_lines(df: DataFrame, kind: str, path: str) -> None:
    export.as_lines(export.to_format(df, kind)).write.mode("overwrite").text(path)


def graph_files(nodes: DataFrame, edge: DataFrame, path: str) -> None:
    graph.export(nodes, edge).write.mode("overwrite").json(f"{path}/nodes")
    edge.write.mode("overwrite").json(f"{path}/edges")
    graph.statistics(nodes, edge).write.mode("overwrite").json(f"{path}/statistics")


def records(df: DataFrame, path: str) -> None:
    """Tools or examples as JSON lines, null fields left out."""
    df.write.mode("overwrite").json(path)


def json_array(df: DataFrame, path: str, order: str, name: str | None = None, head: dict[str, str] | None = None) -> str:
    """All rows as one JSON array in one file at ``path``, in the order of a column; ``name`` wraps it in an object.

    ``head`` are the object's other fields, such as name, description and
    version.  JSON is YAML too, so a path may end in either.

    Meant for catalogues and example sets that a tool outside of Spark reads
    whole: one task writes the file.
    """
    rows = df.select(F.struct(F.col(order).alias("at"), F.to_json(F.struct(*df.columns)).alias("line")).alias("r")).agg(F.array_sort(F.collect_list("r")).alias("rows"))
    body = F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["line"]), ",\n"), F.lit("]"))
    before = "{" + "".join(f"{json.dumps(k)}: {json.dumps(v)}, " for k, v in (head or {}).items()) + f"{json.dumps(name)}: "
    body = F.concat(F.lit(before), body, F.lit("}")) if name else body
    rows.select(body.alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}.parts")
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    parts, target = jvm.org.apache.hadoop.fs.Path(f"{path}.parts"), jvm.org.apache.hadoop.fs.Path(path)
    store = parts.getFileSystem(conf)
    for found in store.listStatus(parts):
        if found.getPath().getName().startswith("part-"):
            store.rename(found.getPath(), target)
    store.delete(parts, True)
    return path


def json_arrays(df: DataFrame, path: str, order: str, name: str | None = None, head: dict[str, str] | None = None, per_file: int = 20_000) -> str:
    """As ``json_array``, as a folder of files of ``per_file`` rows each, the next rows in the next file by name.

    Each file is whole JSON with the object's other fields.  Rows are written
    as lines of sorted partitions, so no task holds all of them, nor a file.
    """
    spark = df.sparkSession
    before = "{" + "".join(f"{json.dumps(k)}: {json.dumps(v)}, " for k, v in (head or {}).items()) + f"{json.dumps(name)}: [" if name else "["
    after = "]}" if name else "]"
    placed = numbered(df, order, name="array_place")
    total = placed.count()
    if not total:
        lines = spark.createDataFrame([(before + after, _FIRST_FILE)], "value string, file long")
    else:
        at = F.col("array_place")
        first, last = at % per_file == 0, (at % per_file == per_file - 1) | (at == total - 1)
        line = F.concat(F.when(first, before).otherwise(","), F.to_json(F.struct(*df.columns)), F.when(last, after).otherwise(""))
        dealt = placed.withColumn("file", F.floor(at / per_file) + _FIRST_FILE).repartition("file").sortWithinPartitions("file", "array_place")
        lines = dealt.select(line.alias("value"), "file")
    lines.write.mode("overwrite").partitionBy("file").text(path)
    return path


def merged(parts: list[DataFrame], path: str, key: str, seed: int = 42) -> DataFrame:
    """Several sets one after the other, in seeded order."""
    from ..operators.scoring import shuffled

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    out = shuffled(out, key, seed)
    out.write.mode("overwrite").json(path)
    return out


def unparsed(responses: DataFrame, path: str) -> None:
    """Responses that could not be read, for inspection."""
    responses.where(F.col("parsed").isNull()).write.mode("append").parquet(path)
