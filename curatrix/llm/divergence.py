"""How much the sources of a language differ in their terms.

The shares of a pair of sources are compared over all kept terms, though only
counts above zero are stored: every term contributes what two zero counts would
give (the baseline), and the stored counts add what they differ from it.  Terms
of one source only need no join, as their sums depend on their counts alone.

The terms of each group that stand out most are found by radix selection:
histograms over the values' bits, from the highest, lead each group to its k-th
value; ties are told apart by histograms over the bytes of the item.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import steps
from .common import materialise, small_batches, text_or_empty

LEAST_DOCS, TOP = 30, 50
SMOOTHING, SCALE = 5, 1_000_000_000
#: Bits of a value and bytes of an item that one histogram takes.
DIGIT_BITS, DIGIT_BYTES = 10, 2
#: Entries that a task holds before it hands its tallies on.
MOST_ENTRIES = 200_000
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, term, count, docs)``: occurrences of each term in a group, and its rows that hold it.

    Terms are runs of A-Z, a-z and characters beyond ASCII, A-Z in lower case.
    Null texts, languages and sources are empty.  Tallied in the tasks first.
    """
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("count", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), (counts, docs) in held.items():
                n = len(counts)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * n, "source": [source] * n, "term": list(counts), "count": list(counts.values()), "docs": [docs[t] for t in counts]}, schema=kind)
            held.clear()

        for batch in batches:
            for part in steps(batch, 0):
                for text, lang, source in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
                    found = Counter(_TERM.findall(text.encode().lower()))
                    counts.update(found)
                    docs.update(found.keys())
                if sum(len(c) for c, _ in held.values()) > MOST_ENTRIES:
                    yield from told()
        yield from told()

    rows = small_batches(df).select(*[text_or_empty(F.col(f"`{c}`").cast("string")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    told = rows.mapInArrow(run, "lang string, source string, term binary, count bigint, docs bigint")
    return told.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")).withColumn("term", F.col("term").cast("string"))


def _share(count: str, total: str, terms: str) -> Column:
    """``1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * terms))`` in whole numbers."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10)) * CAST({count} + {SMOOTHING} AS DECIMAL(20))) DIV CAST({total} + {SMOOTHING} * {terms} AS DECIMAL(20))")


def radix_top(df: DataFrame, groups: list[str], value: str, item: str, k: int) -> DataFrame:
    """The rows of each group with the ``k`` greatest values and their ``rank`` from 1; ties go to the smaller UTF-8 bytes of the item.

    Values are whole numbers from 0 on.  A group's rows are never gathered: each
    step counts them by the next bits of the value, or bytes of the item, among
    those that have not been told apart yet, and goes on in the digit that holds
    the k-th.  Only the selected rows, ``k`` a group, are sorted.  Rows that
    repeat in value and item are ranked in any order.
    """
    df = materialise(df.withColumn("radix_bytes", F.col(item).cast("binary")), "ranked")
    top = df.agg(F.max(value)).first()[0]
    if top is None:
        return df.drop("radix_bytes").withColumn("rank", F.lit(1))
    count = F.count("*").alias("n")
    # Of each group: the bits of the k-th value that are known, the bytes of its item that are known if values did not decide, and how many rows are still to be found among those that share them.
    state = df.groupBy(*groups).agg(count).select(*groups, F.lit(0).cast("long").alias("low"), F.lit(None).cast("binary").alias("prefix"), F.lit(k).cast("long").alias("need"), (F.col("n") <= k).alias("done"))
    bits = max(1, int(top).bit_length())
    bits += -bits % DIGIT_BITS

    def refined(state: DataFrame, digit: Column, inside: Column, ascending: bool, after: dict[str, Column], ended: Column) -> DataFrame:
        tallied = df.join(state.where("NOT done"), groups).where(inside).groupBy(*groups, "low", "prefix", "need", digit.alias("digit")).agg(count)
        seen = Window.partitionBy(*groups).orderBy(F.asc("digit") if ascending else F.desc("digit"))
        found = tallied.withColumn("total", F.sum("n").over(seen)).where((F.col("total") >= F.col("need")) & (F.col("total") - F.col("n") < F.col("need")))
        rest = F.col("need") - (F.col("total") - F.col("n"))
        return materialise(found.select(*groups, *[after.get(c, F.col(c)).alias(c) for c in ("low", "prefix")], rest.alias("need"), ((F.col("n") == rest) | ended).alias("done")).union(state.where("done")), "state")

    state = materialise(state, "state")
    while bits and not state.where("NOT done").isEmpty():
        bits -= DIGIT_BITS
        digit = F.shiftright(F.col(value), bits).bitwiseAND((1 << DIGIT_BITS) - 1)
        state = refined(state, digit, F.shiftright(F.col(value), bits + DIGIT_BITS) == F.shiftright("low", bits + DIGIT_BITS), False, {"low": F.col("low") + F.shiftleft(F.col("digit").cast("long"), bits)}, F.lit(False))
    at = 0
    known = F.coalesce("prefix", F.lit(b""))
    while not state.where("NOT done").isEmpty():
        digit = F.substring("radix_bytes", at + 1, DIGIT_BYTES)
        tied = (F.col(value) == F.col("low")) & (F.substring("radix_bytes", 1, at) == known)
        # Rows of an item that has ended repeat each other; they are told apart no further.
        state = refined(state, digit, tied, True, {"prefix": F.concat(known, "digit")}, F.length("digit") < DIGIT_BYTES)
        at += DIGIT_BYTES
    # Groups without a prefix take all of their rows from ``low`` on.
    taken = (F.col(value) > F.col("low")) | (F.col(value) == F.col("low")) & (F.col("prefix").isNull() | (F.expr("substring(radix_bytes, 1, length(prefix))") <= F.col("prefix")))
    chosen = df.join(state, groups).where(taken)
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc(value), F.asc("radix_bytes")))
    return chosen.withColumn("rank", place).where(F.col("rank") <= k).drop("radix_bytes", "low", "prefix", "need", "done")


def source_divergence(df: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every group of a language and a source.

    Each language keeps the terms of at least ``least_docs`` of its rows.  Part
    ``pair``: every other source of the language by the summed differences of
    all kept terms' shares (0 where no term is kept).  Part ``term``: the
    ``top`` terms whose share exceeds the language's most.

    Null texts, languages and sources count as empty ones; texts without terms
    make a group nevertheless; repeated rows count as often as they are there;
    an empty table gives no rows; other columns are not looked at.
    """
    counts = materialise(term_counts(df, text_col, lang_col, source_col), "counts")
    kept_terms = materialise(counts.groupBy("lang", "term").agg(F.sum("count").alias("of_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select("lang", "term", "of_lang"), "terms")
    kept = materialise(counts.join(kept_terms, ["lang", "term"]).select("lang", "source", "term", "count", "of_lang"), "kept")
    langs = kept_terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("of_lang").alias("lang_total"))
    names = df.select(*[text_or_empty(F.col(f"`{c}`").cast("string")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = names.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = materialise(groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "terms", "lang_total")]).withColumn("zero", F.when(F.col("terms") > 0, _share("0", "total", "terms")).otherwise(0)), "groups")
    shared = materialise(kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "count", "zero", _share("count", "total", "terms").alias("p"), _share("of_lang", "lang_total", "terms").alias("q")), "shares")

    both = groups.select("lang", "source", "zero", "terms").join(groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("zero2")), "lang").where("source <> other")
    base = both.where("source < other").select("lang", "source", "other", (F.col("terms") * F.abs(F.col("zero") - F.col("zero2"))).alias("value"))
    # A term of one source against another's zero: as many times as terms have the same count.
    alike = shared.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    sided = alike.join(both, ["lang", "source"]).groupBy("lang", "source", "other").agg(F.sum(F.col("n") * (F.abs(F.col("p") - F.col("zero2")) - F.abs(F.col("zero") - F.col("zero2")))).alias("value"))
    sided = sided.select("lang", F.least("source", "other").alias("source"), F.greatest("source", "other").alias("other"), "value")
    right = shared.select("lang", "term", F.col("source").alias("other"), F.col("p").alias("p2"), F.col("zero").alias("zero2"))
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    common = shared.join(right, ["lang", "term"]).where("source < other").groupBy("lang", "source", "other").agg(F.sum(gap("p", "p2") - gap("p", "zero2") - gap("zero", "p2") + gap("zero", "zero2")).alias("value"))
    value = base.union(sided).union(common).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("source").alias("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    pairs = value.select("lang", "value", ways.alias("way")).select("lang", "way.source", "way.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    terms = radix_top(shared.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")), ["lang", "source"], "value", "item", top)
    out = [d.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")) for part, d in (("pair", pairs), ("term", terms))]
    return out[0].union(out[1])
