"""Readers of chunks, pairs, tools and examples."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import STEP


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """A chunk table in Parquet; ``text`` stands in for a missing ``content``."""
    df = spark.read.parquet(path)
    if "content" not in df.columns and "text" in df.columns:
        df = df.withColumnRenamed("text", "content")
    return df


def cot_chunks(spark: SparkSession, path: str, limit: int | None = None, order: str = "id") -> DataFrame:
    """Chunks that are not blank, then the first ``limit``."""
    from ..operators.filters import head, not_blank

    df = not_blank(chunks(spark, path))
    return df if limit is None else head(df, limit, order)


def tables(spark: SparkSession, paths: dict[str, str], target: int | None = None) -> DataFrame:
    """Several chunk tables one after the other, with ``source_table`` and each one's share of the target."""
    share = None if target is None else target // max(1, len(paths))
    out = None
    for name, path in paths.items():
        one = chunks(spark, path).withColumns({"source_table": F.lit(name), "table_target": F.lit(share).cast("int")})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables")
    return out


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The entries of whole-file JSON arrays with their place ``idx`` and ``source_path``."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source_path"), "value")
    each = raw.select("source_path", F.posexplode(F.from_json("value", f"array<struct<{schema}>>")).alias("idx", "entry"))
    return each.select(F.col("idx").cast("long").alias("idx"), "source_path", "entry.*")


def checked_array(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """As ``json_array``, in one scan with rows for what cannot be read: ``error`` is null, or ``(path, place, cause)``.

    A file that is no JSON, or no array, is one row without a place; an entry
    that is no object, or does not fit the schema, has its place in the file;
    a path that is not there is a row too.
    """
    listed, there, unread = [paths] if isinstance(paths, str) else list(paths), [], []
    for given in listed:
        path = spark._jvm.org.apache.hadoop.fs.Path(given)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        # Files of no bytes have no splits, so no scan tells of them.
        unread += [(f.getPath().toString(), "no JSON") for f in found if f.isFile() and not f.getLen()] if len(found) else [(given, "no such file")]
        there += [given] if len(found) else []
    missing = spark.createDataFrame(unread, "source_path string, missing string").withColumn("body", F.lit(None).cast("variant"))
    raw = spark.read.format("binaryFile").load(there).select(F.col("path").alias("source_path"), F.lit(None).cast("string").alias("missing"), F.try_parse_json(F.col("content").cast("string")).alias("body")) if there else missing.limit(0)
    raw = raw.unionByName(missing)
    each = raw.select("*", F.posexplode_outer(F.try_variant_get("body", "$", "array<variant>")).alias("idx", "value"))
    text = F.to_json("value")
    read = each.withColumn("entry", F.from_json(text, f"{schema}, unread_entry string", {"columnNameOfCorruptRecord": "unread_entry"}))
    whole = F.when(F.col("missing").isNotNull(), F.col("missing")).when(F.col("body").isNull(), "no JSON").when(~F.startswith(F.schema_of_variant("body"), F.lit("ARRAY")), "no array")
    single = F.when(F.col("idx").isNotNull(), F.when(~F.coalesce(F.startswith(F.schema_of_variant("value"), F.lit("OBJECT")), F.lit(False)), "no object").when(F.col("entry.unread_entry").isNotNull(), "does not fit the schema"))
    cause = F.coalesce(whole, single)
    told = read.withColumn("error", F.when(cause.isNotNull(), F.struct(F.col("source_path").alias("path"), F.col("idx").cast("long").alias("place"), cause.alias("cause"))))
    kept = told.where("idx IS NOT NULL OR error IS NOT NULL")
    names = [f.name for f in kept.schema["entry"].dataType.fields if f.name != "unread_entry"]
    return kept.select(F.col("idx").cast("long").alias("idx"), "source_path", *[F.when(F.col("error").isNull(), F.col("entry")[n]).alias(n) for n in names], "error")


def split_errors(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The good rows and the errors of ``checked_array``, both written below ``path`` by one job."""
    checked.withColumn("failed", F.col("error").isNotNull()).write.mode("overwrite").partitionBy("failed").parquet(path)
    both = checked.sparkSession.read.schema(checked.schema.add("failed", "boolean")).parquet(path)
    return both.where("NOT failed").drop("failed", "error"), both.where("failed").select("error.*")


def datasets(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Pairs of several files, ``dataset`` being a file's stem; unreadable entries are left out."""
    df = json_array(spark, paths, schema)
    return df.withColumn("dataset", dataset_name())


def dataset_name() -> Column:
    """The stem of a row's file."""
    return F.regexp_extract("source_path", r"([^/]+?)(?:\.[^./]*)?$", 1)


def json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def domain_documents(spark: SparkSession, path: str, most: int = 50, shown: int = 10, cut: int = 300) -> DataFrame:
    """Domain documents for prompts: at most ``most`` are read, ``shown`` rendered, fields cut."""
    if not path.endswith((".json", ".jsonl")):
        return spark.createDataFrame([], "rendered string")
    df = spark.read.option("multiLine", path.endswith(".json")).json(path).limit(most)
    fields = [F.concat(F.lit(f"{c}: "), F.substring(F.col(c).cast("string"), 1, cut)) for c in df.columns]
    return df.limit(shown).select(F.concat_ws("\n", *fields).alias("rendered"))


def wrapped_array(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """Entries of a JSON file that is a list, or an object with the list under ``name``; otherwise ``ValueError``.

    Of a folder, the files' entries are one list, in the order of the files' names.
    """
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source_path"), "value")
    kinds = raw.select("source_path", F.regexp_extract("value", r"^\s*(.)", 1).alias("k"), F.get_json_object("value", f"$.{name}").alias("inner"), "value")
    if kinds.where("k != '[' and (k != '{' or inner is null)").limit(1).count():
        raise ValueError(f"neither a list nor an object with {name}")
    lists = kinds.select("source_path", F.when(F.col("k") == "[", F.col("value")).otherwise(F.col("inner")).alias("list"))
    # One window over a row for each file.
    sizes = lists.select("source_path", F.coalesce(F.json_array_length("list"), F.lit(0)).alias("n"))
    before = sizes.select("source_path", F.coalesce(F.sum("n").over(Window.orderBy("source_path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    each = lists.select("source_path", F.posexplode(F.from_json("list", f"array<struct<{schema}>>")).alias("idx", "entry"))
    return each.join(F.broadcast(before), "source_path").select((F.col("before") + F.col("idx")).cast("long").alias("idx"), "entry.*")


TOOL_SCHEMA = (
    "tool_id string, name string, description string, parameters array<struct<name:string,type:string,description:string,required:boolean,default:string,enum:array<string>>>, returns struct<type:string,description:string>, "
    "category string, complexity string, documentation_url string, examples array<string>"
)
EXAMPLE_SCHEMA = (
    f"instruction string, solution struct<instruction:string,reasoning_path:array<{STEP}>,final_answer:string>, "
    "execution_result struct<success:boolean,output:variant,error:string,execution_time_ms:double,step_results:array<struct<step:int,success:boolean,output:variant,error:string>>>, "
    "rating double, rating_breakdown map<string,double>, metadata map<string,string>"
)


def tools(spark: SparkSession, path: str) -> DataFrame:
    df = wrapped_array(spark, path, "tools", TOOL_SCHEMA)
    return df.withColumn("tool_id", F.coalesce("tool_id", F.replace(F.lower("name"), F.lit(" "), F.lit("_"))))


def example_lines(spark: SparkSession, path: str) -> DataFrame:
    """Examples as JSON lines, keyed by a hash of the row; their files are split, unlike those of whole arrays."""
    df = json_lines(spark, path, EXAMPLE_SCHEMA)
    return _solved(df.withColumn("idx", F.xxhash64(F.to_json(F.struct(*df.columns)))))


def examples(spark: SparkSession, path: str) -> DataFrame:
    return _solved(wrapped_array(spark, path, "examples", EXAMPLE_SCHEMA))


def _solved(df: DataFrame) -> DataFrame:
    return df.withColumns({"example_id": F.col("idx"), "reasoning_path": F.col("solution.reasoning_path"), "final_answer": F.col("solution.final_answer")})


def question_answer_turns(conversations: DataFrame) -> DataFrame:
    """Pairs of a user's turn and the assistant's next one, in the order of conversations."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    nxt = conversations.withColumns({"next_role": F.lead("role").over(order), "answer": F.lead("text").over(order), "next_turn": F.lead("turn").over(order)})
    pairs = nxt.where("role = 'user' and next_role = 'assistant' and next_turn = turn + 1")
    return pairs.select((F.col("conv_id") * 1000 + F.col("turn")).alias("idx"), "conv_id", "turn", F.col("text").alias("question"), "answer")


def stem(path: str) -> str:
    return posixpath.splitext(posixpath.basename(path))[0]
