"""Documents resampled towards a target corpus by hashed n-gram importance.

Each task hands slices of its texts to DuckDB, which unnests the words, takes
n-grams by a window and counts the buckets of their CRC-32 (zlib's, registered
as a function).  The counts of every document are written to Parquet in the
shared folder; Spark merges them over all documents, weighs the buckets and
scores the documents from what was written, without the texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import steps
from .common import materialise, small_batches

BUCKETS, MOST_WORDS = 10_000, 3
LEAST_WORDS, PERCENT, SEED = 20, 5, 42
#: Text of one call of DuckDB, and the memory it may take.
CALL_CHARS, MEMORY = 1 << 20, "256MB"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PARTS = 33
_SQL = r"""
WITH texts AS (
    SELECT piece, extra, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM pieces),
words AS (SELECT piece, unnest(words) AS w1, generate_subscripts(words, 1) AS place, len(words) - extra AS last FROM texts),
runs AS (SELECT piece, place, last, w1, lead(w1, 1) OVER following AS w2, lead(w1, 2) OVER following AS w3 FROM words WINDOW following AS (PARTITION BY piece ORDER BY place)),
grams AS (SELECT piece, unnest([w1, w1 || ' ' || w2, w1 || ' ' || w2 || ' ' || w3]) AS gram FROM runs WHERE place <= last)
SELECT piece, crc32(gram) % {buckets} AS bucket, count(*) AS n FROM grams WHERE gram IS NOT NULL GROUP BY ALL
"""


def _crc32(grams: pa.Array) -> pa.Array:
    values = grams.combine_chunks() if isinstance(grams, pa.ChunkedArray) else grams
    return pa.array(np.fromiter(map(zlib.crc32, values.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.uint32, len(values)))


def text_pieces(text: str, most: int | None = None) -> Iterator[tuple[str, int]]:
    """The text in pieces of about ``most`` characters, no word cut, each with the first two words after it and their number."""
    most, at = most or CALL_CHARS, 0
    while len(text) - at > most:
        cut = _GAP.search(text, at + most)
        if cut is None:
            break
        ahead = []
        for word in _WORD.finditer(text, cut.start()):
            ahead.append(word[0])
            if len(ahead) == MOST_WORDS - 1:
                break
        yield " ".join([text[at : cut.start()], *ahead]), len(ahead)
        at = cut.start()
    yield text[at:] if at else text, 0


def bucket_counts(df: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``(id, buckets, counts)`` of every row: the buckets of its n-grams in ascending order, and how many fall in each.

    A text is worked on in pieces, so a task's memory does not grow with it.
    """
    kind = pa.schema([("id", pa.int64()), ("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        base = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
        base.create_function("crc32", _crc32, ["VARCHAR"], "UINTEGER", type="arrow")
        sql = _SQL.format(buckets=buckets)

        def counted(some: list[tuple[int, str, int]]) -> tuple[np.ndarray, np.ndarray]:
            """Row and bucket as one number, and the count."""
            pieces = pa.table({"piece": pa.array(range(len(some)), pa.int32()), "text": pa.array([p[1] for p in some], pa.string()), "extra": pa.array([p[2] for p in some], pa.int32())})
            base.register("pieces", pieces)
            found = base.sql(sql).to_arrow_table()
            base.unregister("pieces")
            rows = np.array([p[0] for p in some], np.int64)[found["piece"].to_numpy()]
            return rows * buckets + found["bucket"].to_numpy(), found["n"].to_numpy()

        for batch in batches:
            for part in steps(batch, 1, CALL_CHARS):
                keys, counts, some, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
                for row, text in enumerate(part.column(1).to_pylist()):
                    for piece, extra in text_pieces(text or ""):
                        if some and held + len(piece) > CALL_CHARS:
                            for out, got in zip((keys, counts), counted(some), strict=True):
                                out.append(got)
                            some, held = [], 0
                        some.append((row, piece, extra))
                        held += len(piece)
                for out, got in zip((keys, counts), counted(some), strict=True):
                    out.append(got)
                key, place = np.unique(np.concatenate(keys), return_inverse=True)
                total = np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)
                bounds = pa.array(np.searchsorted(key, np.arange(part.num_rows + 1) * buckets).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in ((key % buckets).astype(np.int32), total)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], schema=kind)
        base.close()

    rows = small_batches(df).select((F.col(f"`{id_col}`").cast("long") if id_col else F.lit(None).cast("long")).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, buckets array<int>, counts array<bigint>")


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All buckets and counts of a batch's rows, and the row of each."""
    buckets, counts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
    sizes = np.diff(buckets.offsets.to_numpy())
    return buckets.flatten().to_numpy(), counts.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), sizes)


def bucket_totals(counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, total)`` over all rows of ``bucket_counts``; each task sends a row a bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            if batch.num_rows:
                found, counts, _ = _lists(batch)
                np.add.at(total, found, counts)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "total"])

    return counts.select("buckets", "counts").mapInArrow(run, "bucket bigint, total bigint").groupBy("bucket").agg(F.sum("total").alias("total"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """``floor(1000 ln(share in target / share in raw))`` of each bucket, shares smoothed by one; a number for each of ``buckets``."""
    both = raw.withColumn("side", F.lit(0)).union(target.withColumn("side", F.lit(1))).collect()
    seen = np.zeros((2, buckets))
    for bucket, total, side in both:
        seen[side, bucket] = total
    (s, t), (all_s, all_t) = seen, seen.sum(axis=1)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weights(counts: DataFrame, gains: np.ndarray) -> DataFrame:
    """``(id, n_features, weight)`` of every row of ``bucket_counts``."""
    kind = pa.schema([("id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, counts, row = _lists(batch)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row, counts)
            np.add.at(sums[1], row, counts * gains[buckets])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums[0]), pa.array(sums[1])], schema=kind)

    return counts.select("id", "buckets", "counts").mapInArrow(run, "id bigint, n_features bigint, weight bigint")


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """``floor(-1000 ln(-ln u))``, u a number between 0 and 1 from the id's hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with the ``rank`` from 1 of the drawn rows: of those with enough words, ``percent`` of a hundred of the highest scores.

    Rows are sorted over ranges; a range's first rank comes from the counts of the ranges, a row each.
    """
    words = F.when(F.col("n_features") <= 1, F.col("n_features")).otherwise(F.floor((F.col("n_features") + MOST_WORDS) / MOST_WORDS))
    scored = scored.withColumn("words", words)
    marked = scored.where(F.col("words") >= least_words).orderBy(F.desc("score"), "id", "n_features", "weight").withColumn("mark", F.monotonically_increasing_id())
    marked = materialise(marked.withColumn("range", F.shiftright("mark", _PARTS)), "ranges")
    sizes = marked.groupBy("range").agg(F.count("*").alias("n"))
    starts = materialise(sizes.select("range", F.sum("n").over(Window.orderBy("range")).alias("end"), "n"), "starts")
    most = (starts.agg(F.max("end")).first()[0] or 0) * percent // 100
    place = F.col("mark") - F.shiftleft("range", _PARTS) + F.col("end") - F.col("n") + 1
    ranked = marked.join(starts, "range").withColumn("rank", F.when(place <= most, place))
    columns = [c for c in scored.columns if c != "words"]
    return ranked.select(*columns, "rank").union(scored.where(F.col("words") < least_words).select(*columns, F.lit(None).cast("long")))


def resample(df: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """``(id, n_features, weight, score, rank)`` of every row; rows that are not drawn have no rank.

    Null and empty texts have no features, weight 0, and are never drawn.  A
    null id has the noise of the empty id and is before all others in ties.
    Repeated rows are drawn one by one.  An empty table gives no rows; an empty
    target makes all buckets alike but for what the documents hold.  Other
    columns are not looked at.
    """
    counts = materialise(bucket_counts(df, id_col, text_col), "buckets")
    gains = bucket_gains(bucket_totals(counts), bucket_totals(bucket_counts(target, None, target_text_col)))
    scored = weights(counts, gains).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    return draw(materialise(scored, "scored"), percent, least_words).withColumnRenamed("id", id_col)
