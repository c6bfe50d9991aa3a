"""Judged pairs: penalty, joins with judges' batches, metrics and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import PENALTY_KEYWORDS, count_contained

#: What a judge's missing fields count as.
DEFAULTS = {"rating": 5.0, "clarity": 2.0, "accuracy": 2.0, "usefulness": 1.0, "difficulty": 0.0, "topic_relevant": True}


def batch_id(size: int, idx: str = "idx") -> Column:
    return F.floor(F.col(idx) / size)


def join_verdicts(pairs: DataFrame, verdicts: DataFrame, size: int, idx: str = "idx") -> DataFrame:
    """Pairs with their judge's verdicts, by batch and place in it; what is missing has the defaults.

    ``verdicts`` is ``(batch_id, verdicts array<struct>)`` with the fields of ``DEFAULTS``.
    """
    fields = set(verdicts.schema["verdicts"].dataType.elementType.fieldNames())
    each = verdicts.select("batch_id", F.posexplode("verdicts").alias("place", "v"))
    each = each.select("batch_id", "place", *[F.col("v")[k].alias(f"judged_{k}") for k in DEFAULTS if k in fields])
    keyed = pairs.withColumns({"batch_id": batch_id(size, idx), "place": (F.col(idx) % size).cast("int")})
    joined = keyed.join(each, ["batch_id", "place"], "left")
    for k, v in DEFAULTS.items():
        joined = joined.withColumn(k, F.coalesce(F.col(f"judged_{k}"), F.lit(v)) if k in fields else F.lit(v))
    return joined.drop("batch_id", "place", *[f"judged_{k}" for k in DEFAULTS])


def penalise(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Ratings less one for one infrastructure keyword, less three for more, never below 0."""
    n = count_contained(["question", "answer"], PENALTY_KEYWORDS)
    off = F.when(n >= 2, 3).when(n == 1, 1).otherwise(0)
    return df.withColumns({"penalty_hits": n, rating: F.greatest(F.lit(0.0), F.col(rating) - off)})


def metrics(rated: DataFrame, threshold: float, total: DataFrame | None = None) -> DataFrame:
    """One row: total, rated, filtered, retention and mean rating."""
    keep = (F.col("rating") >= threshold) & F.coalesce("topic_relevant", F.lit(True))
    out = rated.agg(F.count("*").alias("rated"), F.count_if(keep).alias("filtered"), F.avg("rating").alias("avg_score"))
    counted = total.agg(F.count("*").alias("total")) if total is not None else None
    out = out.crossJoin(F.broadcast(counted)) if counted is not None else out.withColumn("total", F.col("rated"))
    return out.select("total", "rated", "filtered", F.coalesce(F.try_divide("filtered", "total"), F.lit(0.0)).alias("retention"), "avg_score")


def histogram(rated: DataFrame, rating: str = "rating") -> DataFrame:
    """Counts of ratings in ``[i, i + 1)`` for i from 1 to 10; zeros are in none."""
    buckets = [F.count_if((F.col(rating) >= i) & (F.col(rating) < i + 1)).alias(f"b{i}") for i in range(1, 11)]
    stats = [F.min(rating).alias("min_rating"), F.max(rating).alias("max_rating"), F.avg(rating).alias("avg_rating")]
    row = rated.agg(*buckets, *stats)
    pairs = ", ".join(f"{i}, b{i}" for i in range(1, 11))
    return row.select(F.expr(f"stack(10, {pairs}) as (bucket, n)"), "min_rating", "max_rating", "avg_rating")


#: The columns that may hold each side of a pair, the first that is there and not null counts.
SIDES = {"question": ("question", "prompt", "instruction"), "answer": ("answer", "response", "output"), "reasoning": ("reasoning", "cot", "thinking", "thought")}


def side(df: DataFrame, name: str) -> Column:
    found = [c for c in SIDES[name] if c in df.columns]
    return F.coalesce(*found, F.lit("")) if found else F.lit("")


def to_conversation(df: DataFrame, reasoning: str | None = None) -> DataFrame:
    """``conversations`` of a user and an assistant turn; reasoning, of the given column or one of the usual ones, goes before the answer."""
    thought = F.coalesce(F.col(reasoning), F.lit("")) if reasoning is not None else side(df, "reasoning")
    answer = F.when(F.length(thought) > 0, F.concat(thought, F.lit("\n\n"), side(df, "answer"))).otherwise(side(df, "answer"))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return df.withColumn("conversations", F.array(turn("user", side(df, "question")), turn("assistant", answer)))


def from_conversation(df: DataFrame, column: str = "conversations") -> DataFrame:
    """``question`` and ``answer`` from the last turn of each side."""
    last = lambda roles: F.try_element_at(F.filter(column, lambda m: m["role"].isin(roles)), F.lit(-1))["content"]
    return df.withColumns({"question": last(["user", "human"]), "answer": last(["assistant", "gpt"])})


def detect_format(df: DataFrame) -> str:
    """``cot``, ``conversation`` or ``qa``, from the columns."""
    names = set(df.columns)
    if names & {"reasoning", "cot", "thinking", "thought"}:
        return "cot"
    return "conversation" if names & {"conversations", "messages"} else "qa"


#: What curation adds to a row of any shape.
RATING_KEYS = ("rating", "clarity", "accuracy", "usefulness", "difficulty")


def read_any(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON lines of pairs of any shape: ``original`` (a VARIANT), ``shape``, ``question``, ``answer``, ``reasoning``.

    Shapes are ``conversation``, ``cot`` and ``qa``, told row by row.  Lines
    that are no objects are left out.
    """
    rows = lines.withColumn("original", F.try_parse_json(value)).where(F.startswith(F.schema_of_variant("original"), F.lit("OBJECT")))
    get = lambda name: F.try_variant_get("original", f"$.{name}", "string")
    turns = F.coalesce(*[F.try_variant_get("original", f"$.{c}", "array<map<string,string>>") for c in ("conversations", "messages")])
    last = lambda roles: F.try_element_at(F.filter(turns, lambda m: F.coalesce(F.try_element_at(m, F.lit("role")), F.try_element_at(m, F.lit("from"))).isin(roles)), F.lit(-1))
    said = lambda roles: F.coalesce(F.try_element_at(last(roles), F.lit("content")), F.try_element_at(last(roles), F.lit("value")))
    sides = {name: F.coalesce(*[get(c) for c in names]) for name, names in SIDES.items()}
    shape = F.when(turns.isNotNull(), "conversation").when(sides["reasoning"].isNotNull(), "cot").otherwise("qa")
    return rows.withColumns({"shape": shape, "question": F.coalesce(said(["user", "human"]), sides["question"], F.lit("")), "answer": F.coalesce(said(["assistant", "gpt"]), sides["answer"], F.lit("")), "reasoning": sides["reasoning"]})


def restored(rated: DataFrame) -> DataFrame:
    """``value``: each row of ``read_any`` in its own shape, as a JSON line with the rating merged in.

    All keys of the original stay; those of the rating replace what it had of
    the same name.  Rows of pairs get their question and answer under the names
    ``question`` and ``answer``; a conversation stays as it was.
    """
    from ..functions.values import as_json

    keys = [k for k in RATING_KEYS if k in rated.columns]
    entry = lambda name, column: F.struct(F.lit(name).alias("key"), F.col(column).cast("variant").alias("value"))
    pair = F.when(F.col("shape") != "conversation", F.array(entry("question", "question"), entry("answer", "answer"))).otherwise(F.array().cast("array<struct<key:string,value:variant>>"))
    new = F.concat(pair, F.array(*[entry(k, k) for k in keys]).cast("array<struct<key:string,value:variant>>"))
    own = F.map_entries(F.col("original").cast("map<string,variant>"))
    names = F.transform(new, lambda e: e["key"])
    kept = F.concat(F.filter(own, lambda e: ~F.array_contains(names, e["key"])), new)
    line = F.array_join(F.transform(kept, lambda e: F.concat(as_json(e["key"]), F.lit(":"), F.coalesce(as_json(e["value"]), F.lit("null")))), ",")
    return rated.withColumn("value", F.concat(F.lit("{"), line, F.lit("}")))


def repair(originals: DataFrame, repaired: DataFrame, key: str, column: str = "reasoning") -> DataFrame:
    """Originals with the repaired column where it was blank, joined on a stable key."""
    new = repaired.select(key, F.col(column).alias("repaired_value"))
    blank = F.length(F.trim(F.coalesce(column, F.lit("")))) == 0
    joined = originals.join(new, key, "left")
    return joined.withColumn(column, F.when(blank, F.coalesce("repaired_value", column)).otherwise(F.col(column))).drop("repaired_value")


def failure_counts(df: DataFrame, column: str = "reasoning") -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(F.length(F.trim(F.coalesce(column, F.lit("")))) == 0).alias("failed"))
