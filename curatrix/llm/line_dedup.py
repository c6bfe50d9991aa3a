"""Near-duplicate lines by a deletion-neighbourhood join, in SQL functions only.

Two lines are near copies if one edit of one character turns one into the
other (or none does).  Lines within that bound share a deletion variant: both
lose the character at the same place, or the longer one loses one character.
Every variant is a hashed key, equal keys meet, the edit distance is verified,
and of all lines that match the earliest stays.

A line of n characters has n + 1 variants, so they are made only where they can
meet.  A line is seen as one of ``m`` characters (its own length, or one less,
so that it can meet a shorter line) and cut into blocks; an edit falls into one
block, and all else is equal.  Lines that share no half with another line are
left out first, then those that share no all-but-one-block; what remains emits
the variants of the one block, keyed together with the rest of the line.  A
block that is still long is cut in the same way first, so variants are short
however long a line is, and the edit distance is verified in the block, all
else having to be equal.

Groups are never expanded into pairs: lines that lose the same character at the
same place are all within one edit of each other, and lines that lose one to
become a certain line are all within one edit of that one, so the least member
stands for its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Shorter lines must be equal.
NEAR_CHARS = 16
BLOCK_CHARS, MOST_BLOCKS = 24, 64
#: Longer blocks are cut again.
LONG_BLOCK = 96
#: So many candidate lines are broadcast (about 100 bytes each) at most; beyond, they are joined by shuffles.
BROADCAST_LINES = 500_000
_WHITE = " \t\r\v\f"
_ORDER = ("no_id", "id", "text_hash", "pos")


def _left(text: Column, n: Column) -> Column:
    return F.substring(text, F.lit(1), n.cast("int"))


def _right(text: Column, size: Column, n: Column) -> Column:
    """The last ``n`` of the ``size`` characters."""
    return F.substring(text, (size - n + 1).cast("int"), n.cast("int"))


def _half_keys(text: Column, size: Column) -> Column:
    """Keys of both halves of a line seen as one of ``size`` and of ``size - 1`` characters."""
    keys = []
    for m in (size, size - 1):
        half = F.floor(m / 2)
        keys += [F.xxhash64(F.lit(0), m, _left(text, half)), F.xxhash64(F.lit(1), m, _right(text, size, m - half))]
    return F.array(*keys)


def _lines(docs: DataFrame) -> DataFrame:
    """Every line that is not blank, without the white space around it."""
    split = docs.select("no_id", "id", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    return split.withColumn("line", F.btrim("raw", F.lit(_WHITE))).where("line != ''").drop("raw")


def _cut(rows: DataFrame) -> DataFrame:
    """Block number ``b`` of each ``line``, seen as one of ``m`` characters, as a line of its own.

    ``rest`` is a hash of all that is outside of it, ``at`` and ``tail`` count the characters before and after it.
    """
    start, end = (F.floor((F.col("b") + k) * F.col("m") / F.col("blocks")).cast("int") for k in (0, 1))
    cut = rows.withColumns({"start": start, "end": end, "last": F.col("m") - end})
    line = F.col("line")
    rest = F.xxhash64("rest", "m", "b", F.xxhash64(_left(line, F.col("start"))), F.xxhash64(_right(line, F.col("size"), F.col("last"))))
    size = F.col("size") - F.col("last") - F.col("start")
    inner = {"rest": rest, "line": F.substring(line, F.col("start") + 1, size), "at": F.col("at") + F.col("start"), "tail": F.col("tail") + F.col("last"), "size": size, "m": F.col("end") - F.col("start")}
    return cut.withColumns(inner).drop("start", "end", "last", "blocks")


def _numbered(rows: DataFrame) -> DataFrame:
    """A row for each block of a line."""
    blocks = F.least(F.lit(MOST_BLOCKS), F.greatest(F.lit(2), F.floor(F.col("m") / BLOCK_CHARS))).cast("int")
    return rows.withColumn("blocks", blocks).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))


def _seen(lines: DataFrame) -> DataFrame:
    seen = lines.withColumn("size", F.length("line")).withColumn("seen_as", F.explode(F.array(F.col("size"), F.col("size") - 1)))
    return seen.withColumns({"m": F.col("seen_as"), "rest": F.lit(0).cast("long"), "at": F.lit(0), "tail": F.lit(0)})


def _shared(keys: DataFrame) -> DataFrame:
    """The ``rest`` of more than one line."""
    return keys.groupBy("rest").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("rest")


def _short_blocks(candidates: DataFrame) -> DataFrame:
    """``(h1, order, rest, at, tail, line, size, m)``: the blocks of lines that share all else with another line's, none long."""
    keys = _cut(_numbered(_seen(candidates)).withColumn("number", F.col("b"))).select("rest", "h1", "seen_as", "number")
    places = keys.join(_shared(keys), "rest", "left_semi").select("h1", "seen_as", F.col("number").alias("b"))
    columns = ["h1", "order", "rest", "at", "tail", "line", "size", "m"]
    now = materialise(_cut(_numbered(_seen(candidates)).join(places, ["h1", "seen_as", "b"])).select(*columns), "blocks")
    done = now.where(F.col("m") <= LONG_BLOCK)
    while not now.where(F.col("m") > LONG_BLOCK).isEmpty():
        inner = _cut(_numbered(now.where(F.col("m") > LONG_BLOCK))).select(*columns)
        now = materialise(inner.join(_shared(inner), "rest", "left_semi").select(*columns), "blocks")
        done = done.union(now.where(F.col("m") <= LONG_BLOCK))
    return done


def _variants(rows: DataFrame) -> DataFrame:
    """Hashed deletion variants ``(key, side)`` of the blocks, with where they are.

    Side 0 meets side 0: the same character is lost at the same place.  Side 1
    is a whole line, side 2 a longer one that has lost a character.
    """
    n = F.length("line")
    lost = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(i.alias("i"), F.concat(F.substring(F.col("line"), F.lit(1), i - 1), F.substring(F.col("line"), i + 1, n)).alias("v")))
    whole = F.xxhash64(F.lit(1), "rest", "line")
    same = F.transform(lost, lambda x: F.struct(F.xxhash64(F.lit(0), F.col("rest"), x["i"], x["v"]).alias("key"), F.lit(0).alias("side")))
    longer = F.transform(lost, lambda x: F.struct(F.xxhash64(F.lit(1), F.col("rest"), x["v"]).alias("key"), F.lit(2).alias("side")))
    own = F.when(F.col("size") == F.col("m"), F.concat(same, F.array(F.struct(whole.alias("key"), F.lit(1).alias("side"))))).otherwise(longer)
    return rows.where(n > 0).select("h1", "order", "at", "tail", F.inline(F.array_distinct(own)))


def near_lines(candidates: DataFrame) -> DataFrame:
    """The ``order`` of those of the distinct lines ``(h1, order, line)`` that have an earlier line within one edit.

    Keys travel without the lines' texts; these are joined again where they are needed.
    """
    variants = _variants(_short_blocks(candidates))
    least = variants.groupBy("key", "side").agg(F.min(F.struct("order", "h1")).alias("seen"))
    meets = least.select("key", F.when(F.col("side") == 0, 0).otherwise(3 - F.col("side")).alias("side"), "seen")
    met = variants.join(meets, ["key", "side"]).where(F.col("seen.order") < F.col("order")).select("order", "h1", "at", "tail", F.col("seen.h1").alias("other")).distinct()
    texts = candidates.select("h1", "line")
    both = met.join(texts, "h1").join(texts.select(F.col("h1").alias("other"), F.col("line").alias("earlier")), "other")
    block = lambda c: F.substring(F.col(c), F.col("at") + 1, F.length(c) - F.col("at") - F.col("tail"))
    outside = lambda c: F.struct(_left(F.col(c), F.col("at")), _right(F.col(c), F.length(c), F.col("tail")))
    return both.where(F.levenshtein(block("line"), block("earlier"), 1) >= 0).where(outside("line") == outside("earlier")).select("order").distinct()


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with its text without repeated lines, and ``n_lines``, ``n_removed``, ``n_near``.

    A line goes if an earlier line of the input is equal to it, or (from
    ``NEAR_CHARS`` characters on) within one edit, white space at its ends
    aside; whether that earlier line itself goes makes no difference.  Earlier
    is a smaller id, null ids last, then a smaller place in the text; repeated
    rows of one id and text are one document, and each gets the same result.
    Blank lines stay.  ``n_near`` counts lines that go only for a near copy.  A
    null text stays null and has no lines; an empty table gives no rows;
    columns of ``df`` that have names of the result are replaced.
    """
    names = [c for c in df.columns if c not in ("n_lines", "n_removed", "n_near")]
    others = [F.col(f"`{c}`") for c in names if c != text_col]
    held = (F.struct(*others) if others else F.struct(F.lit(0))).alias("row")
    text = F.col(text_col).cast("string")
    docs = df.select(F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"), held)
    lines = _lines(docs)
    found = lines.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"), *_ORDER, F.when(F.length("line") >= NEAR_CHARS, _half_keys(F.col("line"), F.length("line"))).alias("halves"))
    distinct = materialise(found.groupBy("h1", "h2").agg(F.min(F.struct(*_ORDER)).alias("order"), F.any_value("halves").alias("halves")).drop("h2"), "lines")

    keys = distinct.where("halves is not null").select("h1", F.explode("halves").alias("half"))
    shared = keys.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("half")
    alike = keys.join(shared, "half", "left_semi").select("h1").distinct()
    places = materialise(distinct.join(alike, "h1", "left_semi").select("h1", "order.*"), "alike")
    small = places.count() <= BROADCAST_LINES
    candidates = lines.join(F.broadcast(places) if small else places, list(_ORDER)).where(F.length("line") >= NEAR_CHARS)
    near = near_lines(materialise(candidates.select("h1", F.struct(*_ORDER).alias("order"), "line").distinct(), "candidates"))

    doc = ["no_id", "id", "text_hash"]
    firsts = distinct.select("order.*").groupBy(*doc).agg(F.collect_list("pos").alias("firsts"))
    away = near.select("order.*").groupBy(*doc).agg(F.collect_list("pos").alias("away"))
    joined = docs.join(firsts, doc, "left").join(away, doc, "left")
    split = F.split("text", "\n")
    blank = F.filter(F.transform(split, lambda x, i: F.when(F.btrim(x, F.lit(_WHITE)) == "", i)), lambda i: i.isNotNull())
    none = F.array().cast("array<int>")
    stay = F.array_sort(F.concat(F.array_except(F.coalesce("firsts", none), F.coalesce("away", none)), blank))
    out = joined.withColumns({"stay": stay, "lines": split}).withColumn("new_text", F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"))
    n_near = F.coalesce(F.size("away"), F.lit(0))
    columns = [F.col("new_text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in names]
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(split))
    return out.select(*columns, n_lines.cast("long").alias("n_lines"), (n_lines - F.when(F.col("text").isNull(), 0).otherwise(F.size("stay"))).cast("long").alias("n_removed"), F.greatest(F.lit(0), n_near).cast("long").alias("n_near"))


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without repeated lines; documents of which no line is left go, those without lines before stay."""
    done = dedup_lines(df, id_col, text_col)
    gone = (F.col("n_removed") > 0) & (F.btrim(F.col(text_col), F.lit(_WHITE + "\n")) == "")
    done = done.where(~F.coalesce(gone, F.lit(False)))
    if "n_chars" in df.columns:
        done = done.withColumn("n_chars", F.length(text_col).cast(df.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in df.columns])
