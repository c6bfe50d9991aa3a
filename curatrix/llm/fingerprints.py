"""Document fingerprints from prefix polynomial hashes.

A text's modular prefix arrays give the hash of any span in constant time, so
any two spans can be compared, and the longest common extension of two places
is found by binary search.  A fingerprint is the whole text's hash and the
``SKETCH`` smallest mixed hashes of its distinct ``WINDOW``-character spans,
all read off the prefix arrays.  Where both prefix arrays are at hand, the
likeness is the exact share of distinct spans in common (Jaccard); of two bare
fingerprints ``likeness`` estimates it.  Long texts are worked on in pieces:
prefix arrays of one piece at a time, and spans of one range of hashes at a
time, so that memory does not grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: A Mersenne prime, so that a product is reduced by shifts.
PRIME = (1 << 31) - 1
BASES = (911_382_323, 1_972_663_139)
WINDOW = 32
SKETCH = 64
#: Longer texts are worked on in pieces of so many characters, and so many spans at a time.
LONG_TEXT = 1 << 20
#: Characters of edited texts that wait to be handed on.
HELD_CHARS = 1 << 20
_LOWEST = -(1 << 63)


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` (below 2**62) modulo the prime, in place where possible."""
    p, s = np.uint64(PRIME), np.uint64(31)
    x = (x & p) + (x >> s)
    x = (x & p) + (x >> s)
    x[x >= p] -= p
    return x


class _Powers:
    """Powers of a base and of its inverse, grown by doubling."""

    def __init__(self, base: int):
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
        self.bases = (base % PRIME, pow(base, -1, PRIME))

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) <= n:
            size = len(self.tables[0])
            self.tables = [np.concatenate([t, _reduced(t * np.uint64(pow(b, size, PRIME)))]) for t, b in zip(self.tables, self.bases, strict=True)]
        return self.tables


_POWERS = [_Powers(b) for b in BASES]


class PrefixHash:
    """Prefix arrays of a text; positions count code points."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.text, self.size = text, len(codes)
        self.prefix, self.inverse = [], []
        self.distinct: np.ndarray | None = None
        for powers in _POWERS:
            up, down = powers.upto(self.size)
            sums = np.zeros(self.size + 1, np.uint64)
            np.cumsum(_reduced(codes * up[: self.size]), out=sums[1:])
            self.prefix.append(_reduced(sums))
            self.inverse.append(down)

    def spans(self, starts: np.ndarray | int, ends: np.ndarray | int) -> np.ndarray:
        """62-bit hashes of the spans, the same for equal spans of any texts."""
        out = np.uint64(0)
        starts, ends = np.atleast_1d(starts), np.atleast_1d(ends)
        for prefix, inverse in zip(self.prefix, self.inverse, strict=True):
            part = _reduced((prefix[ends] + np.uint64(PRIME) - prefix[starts]) * inverse[starts])
            out = (out << np.uint64(31)) | part
        return out

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of ``width`` characters, in order."""
        out = np.uint64(0)
        for prefix, inverse in zip(self.prefix, self.inverse, strict=True):
            part = _reduced((prefix[width:] + np.uint64(PRIME) - prefix[:-width]) * inverse[: self.size - width + 1])
            out = (out << np.uint64(31)) | part
        return out

    def equal(self, at: int, other: PrefixHash, there: int, length: int) -> bool:
        """Whether the spans of ``length`` at the two places are the same."""
        return at + length <= self.size and there + length <= other.size and self.spans(at, at + length)[0] == other.spans(there, there + length)[0]

    def common_extension(self, at: int, other: PrefixHash, there: int) -> int:
        """Length of the longest common run from the two places, by binary search."""
        low, high = 0, min(self.size - at, other.size - there)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(at, other, there, middle) else (low, middle - 1)
        return low

    def fingerprint(self, window: int = WINDOW, sketch: int = SKETCH) -> np.ndarray:
        """The whole text's hash, then the sorted sketch; an empty text has the hash alone."""
        whole = self.spans(0, self.size)
        if not self.size:
            return whole
        return np.concatenate([whole, self.distinct_spans(window)[:sketch]])

    def distinct_spans(self, window: int = WINDOW) -> np.ndarray:
        """Mixed hashes of the distinct spans of ``window`` characters, sorted; of a shorter text, of the whole one."""
        if self.size == 0:
            return np.zeros(0, np.uint64)
        if self.distinct is None:
            x = _mixed(self.windows(window) if self.size >= window else self.spans(0, self.size))
            x.sort()
            self.distinct = x[np.concatenate([[True], x[1:] != x[:-1]])]
        return self.distinct

    def spans_between(self, low: int, high: int) -> np.ndarray:
        """The distinct spans whose mixed hashes are at least ``low`` and below ``high``."""
        mine = self.distinct_spans()
        return mine[np.searchsorted(mine, np.uint64(low)) : len(mine) if high >> 64 else np.searchsorted(mine, np.uint64(high))]

    def share(self, other: PrefixHash | PiecewiseHash) -> float:
        """From 0 to 1: the share of the two texts' distinct spans that both have; 1 for equal texts."""
        if isinstance(other, PiecewiseHash):
            return other.share(self)
        if self.size == other.size and self.common_extension(0, other, 0) == self.size:
            return 1.0
        mine, its = self.distinct_spans(), other.distinct_spans()
        if not len(mine) or not len(its):
            return 0.0
        few, many = (mine, its) if len(mine) <= len(its) else (its, mine)
        both = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
        return both / (len(mine) + len(its) - both)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class PiecewiseHash:
    """As ``PrefixHash``, for a long text: the same values from prefix arrays of a piece at a time."""

    def __init__(self, text: str):
        self.text, self.size = text, len(text)

    def whole(self) -> np.ndarray:
        """The hash of the whole text, put together from those of its pieces."""
        totals = [0] * len(BASES)
        for at in range(0, self.size, LONG_TEXT):
            piece = PrefixHash(self.text[at : at + LONG_TEXT])
            for k, base in enumerate(BASES):
                totals[k] = (totals[k] + int(piece.prefix[k][-1]) * pow(base, at, PRIME)) % PRIME
        out = 0
        for total in totals:
            out = (out << 31) | total
        return np.array([out], np.uint64)

    def pieces(self, window: int = WINDOW) -> Iterator[np.ndarray]:
        """Mixed hashes of all spans, piece after piece."""
        for at in range(0, self.size - window + 1, LONG_TEXT):
            yield _mixed(PrefixHash(self.text[at : at + LONG_TEXT + window - 1]).windows(window))

    def fingerprint(self, window: int = WINDOW, sketch: int = SKETCH) -> np.ndarray:
        least = np.zeros(0, np.uint64)
        for spans in self.pieces(window):
            least = np.unique(np.concatenate([least, np.unique(spans)[:sketch]]))[:sketch]
        return np.concatenate([self.whole(), least])

    def spans_between(self, low: int, high: int) -> np.ndarray:
        found = [np.zeros(0, np.uint64)]
        for spans in self.pieces():
            some = spans[spans >= np.uint64(low)]
            found.append(np.unique(some if high >> 64 else some[some < np.uint64(high)]))
        return np.unique(np.concatenate(found))

    def common_extension(self, at: int, other: PrefixHash | PiecewiseHash, there: int) -> int:
        """Length of the longest common run from the two places: piece after piece, and by binary search in the first that differs."""
        done = 0
        while n := min(LONG_TEXT, self.size - at - done, other.size - there - done):
            mine, its = (PrefixHash(h.text[k + done : k + done + n]) for h, k in ((self, at), (other, there)))
            got = mine.common_extension(0, its, 0)
            done += got
            if got < n:
                break
        return done

    def share(self, other: PrefixHash | PiecewiseHash) -> float:
        if self.size == other.size and self.common_extension(0, other, 0) == self.size:
            return 1.0
        if not other.size:
            return 0.0
        # Spans of one range of hashes at a time.
        ranges, both, all_ = -(-max(self.size, other.size) // LONG_TEXT), 0, 0
        for k in range(ranges):
            low, high = (k << 64) // ranges, ((k + 1) << 64) // ranges
            mine, its = self.spans_between(low, high), other.spans_between(low, high)
            same = len(np.intersect1d(mine, its, assume_unique=True))
            both, all_ = both + same, all_ + len(mine) + len(its) - same
        return both / all_


def hashed_text(text: str) -> PrefixHash | PiecewiseHash:
    return PrefixHash(text) if len(text) <= LONG_TEXT else PiecewiseHash(text)


def likeness(a: np.ndarray, b: np.ndarray, sketch: int = SKETCH) -> float:
    """From 0 to 1: the share of spans in common, estimated; 1 for equal texts."""
    if a[0] == b[0] and len(a) == len(b):
        return 1.0
    if len(a) == 1 or len(b) == 1:
        return 0.0
    least = np.union1d(a[1:], b[1:])[:sketch]
    return float(np.isin(least, a[1:], assume_unique=True)[np.isin(least, b[1:], assume_unique=True)].sum() / len(least))


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u8").tobytes().hex()


def bucket_of(key: Column, splits: list[int]) -> Column:
    """How many of the sorted ``splits`` are at most ``key``: two short scans of literal lists."""
    if not splits:
        return F.lit(0)
    step = max(1, int(len(splits) ** 0.5))
    parts = [splits[i : i + step] for i in range(0, len(splits), step)]
    coarse = F.size(F.filter(F.array(*[F.lit(p[0]) for p in parts]), lambda x: x <= key))
    fine = F.get(F.array(*[F.array(*[F.lit(x) for x in p]) for p in parts]), coarse - 1)
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + F.size(F.filter(fine, lambda x: x <= key)))


def by_order(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows in ascending order of ids, each bucket of ids in a partition of its own and in order.

    The last row of a bucket is a copy, with ``halo`` 1, of the next bucket's
    first row (after the last bucket, the first's).  Null ids come first; rows
    of one id are in the order of their texts.  The driver holds one split and
    one first id per shuffle partition.
    """
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.approxQuantile("key", [k / parts for k in range(1, parts)], 0.1 / parts) if parts > 1 else []
    splits = sorted({int(c) for c in cuts})
    rows = rows.withColumn("bucket", bucket_of(F.col("key"), splits))
    firsts = sorted((b, k) for b, k in rows.groupBy("bucket").agg(F.min("key")).collect())
    if not firsts:
        return rows.withColumn("halo", F.lit(0))
    before = spark.createDataFrame([(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)], "key long, bucket int")
    halo = rows.drop("bucket").join(F.broadcast(before), "key").groupBy("key", "bucket").agg(F.min("text").alias("text"))
    halo = halo.select("key", "text", "bucket", F.lit(1).alias("halo"))
    return rows.withColumn("halo", F.lit(0)).unionByName(halo).repartitionById(parts, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "halo", "key", "text")


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last ``n_chars // 2`` characters replaced by as
    many of the next document's first ones.  Returns ``(id, n_chars, edited,
    fingerprint, edited_fingerprint, near_edited, near_next, common_prefix)``;
    ``near_edited`` and ``near_next`` are exact shares of distinct spans that
    both texts have; ``common_prefix`` is the longest common extension of the
    starts of a text and its edited one.
    Null texts are empty, an only document is its own next one, repeated rows
    follow one another, and an empty table gives no rows.  A long text takes
    memory for its characters and a piece of its arrays.
    """
    kind = pa.schema([(id_col, pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_prefix", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, waiting = None, [], 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

        for batch in batches:
            for key, text, bucket, halo in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashed = hashed_text(text)
                mark = hashed.fingerprint()
                if held and held[0] == bucket and not held[1]:
                    _, _, k, mine, its_hash, its_mark = held
                    half = len(mine) // 2
                    edited = mine[: len(mine) - half] + text[:half]
                    changed = hashed_text(edited)
                    its_edit = changed.fingerprint()
                    out.append((None if k == _LOWEST else k, len(mine), edited, as_text(its_mark), as_text(its_edit), its_hash.share(changed), its_hash.share(hashed), its_hash.common_extension(0, changed, 0)))
                    waiting += len(edited)
                    if len(out) >= 128 or waiting >= HELD_CHARS:
                        yield flush()
                        waiting = 0
                held = (bucket, halo, key, text, hashed, mark)
        if out:
            yield flush()

    schema = f"`{id_col}` bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix bigint"
    return by_order(small_batches(df), id_col, text_col).select("key", "text", "bucket", "halo").mapInArrow(run, schema)
