"""SimHash near-duplicates by shared bytes at the same positions.

Two fingerprints of eight bytes that differ in at most three bits agree in at
least five bytes.  The inverted index posts each distinct fingerprint under
sets of (position, byte), so that any pair with five matching bytes meets in
one posting list: the fourteen sets of four positions whose numbers have an
exclusive or of zero hold every set of five positions exactly once.  Within a
list the matching bytes of a pair are tallied, pairs of fewer than five are
dropped, and the bits of the rest are counted.  (Lists of single bytes would
each hold a 256th of the corpus.)

A list gives only a spanning forest of its links, so large groups of near
copies give no more rows than they have members.  Lists that are long are
posted again under five positions each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import steps
from .common import materialise, small_batches
from .components import components

BITS, LEAST_BYTES = 3, 5
FOURS = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
FIVES = list(combinations(range(8), 5))
#: A list of more fingerprints than this is posted under five positions.
LONG_LIST = 4096
#: Links of a long list that are held at a time, but for those of one probe.
MOST_HITS = 1 << 20
_ONE = np.uint64(1)


def shingle_hashes(raw: bytes, size: int = 3) -> list[int]:
    """XXH64 with seed 42 of each run of ``size`` words of the text in ASCII lower case."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()
    text = b" ".join(words)
    if len(words) <= size:
        return [xxh64_intdigest(text, 42)] if words else []
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends[: len(words) - size])]
    return [xxh64_intdigest(text[a:b], 42) for a, b in zip(starts, ends[size - 1 :], strict=True)]


def simhash(raw: bytes, size: int = 3) -> int:
    """A bit is set if it is in over half of the shingles' hashes; zero without words."""
    hashes = shingle_hashes(raw, size)
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, fp)`` of every whole text; ``fp`` is the fingerprint as a signed long.  Null texts have no words."""
    kind = pa.schema([(id_col, pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 1):
                found = np.array([simhash((t or "").encode(), size) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], schema=kind)

    return small_batches(df).select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"`{id_col}` bigint, fp bigint")


def _posting(number: int, positions: tuple[int, ...], fp: Column) -> Column:
    """A list's key: the number of its position set above the bytes at those positions."""
    key = F.lit(number).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)))
    return key


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _linked(x: np.ndarray) -> np.ndarray:
    """Which differences have enough zero bytes and few enough bits."""
    zero = sum((x >> np.uint64(8 * k)) & np.uint64(255) == 0 for k in range(8))
    return (zero >= LEAST_BYTES) & (_popcount(x) <= BITS)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member that each of ``n`` members reaches over the links ``a``-``b``."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]


def list_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of one list, each with the least member that it reaches over links within the list.

    Short lists compare all members in blocks; long ones look each member's
    neighbours up: all members share five bytes, so three bytes' bits may flip.
    """
    n, left, right = len(fps), [], []
    if n <= LONG_LIST:
        for at in range(0, n, 256):
            i, j = np.nonzero(_linked(fps[at : at + 256, None] ^ fps[None, :]))
            keep = i + at < j
            left.append(i[keep] + at)
            right.append(j[keep])
    else:
        fps = np.sort(fps)
        free = np.bitwise_or.reduce(fps ^ fps[0])
        flips = [_ONE << np.uint64(k) for k in range(64) if free >> np.uint64(k) & _ONE]
        for k in range(1, BITS + 1):
            for some in combinations(flips, k):
                other = fps ^ np.bitwise_or.reduce(np.array(some, np.uint64))
                place = np.minimum(np.searchsorted(fps, other), n - 1)
                hit = np.flatnonzero((fps[place] == other) & (fps < other))
                left.append(hit)
                right.append(place[hit])
                if sum(map(len, left)) > MOST_HITS:
                    # A spanning forest of the hits so far stands for them all.
                    root = _forest(n, np.concatenate(left), np.concatenate(right))
                    left = [np.flatnonzero(root != np.arange(n))]
                    right = [root[left[0]]]
    root = _forest(n, np.concatenate(left), np.concatenate(right)) if left else np.arange(n)
    joined = np.flatnonzero(root != np.arange(n))
    return fps[joined], fps[root[joined]]


def _list_edges(lists: DataFrame) -> DataFrame:
    """Links of all lists ``(key, fp)``; every list is in one partition, sorted."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        held_key = None

        def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=kind)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if held_key is not None and keys[0] != held_key:
                if sum(map(len, held)) > 1:
                    yield edges(*list_links(np.unique(np.concatenate(held))))
                held = []
            last = int(cuts[-1]) if len(cuts) else 0
            first = int(cuts[0]) if len(cuts) else 0
            if held and len(cuts):
                whole = np.unique(np.concatenate([*held, fps[:first]]))
                if len(whole) > 1:
                    yield edges(*list_links(whole))
                held, start = [], first
            else:
                start = 0
            bounds = np.concatenate([[start], cuts[cuts > start]])
            sizes = np.diff(bounds)
            twos = bounds[:-1][sizes == 2]
            hit = twos[_linked(fps[twos] ^ fps[twos + 1])] if len(twos) else twos
            if len(hit):
                yield edges(fps[hit], fps[hit + 1])
            for at, n in zip(bounds[:-1][sizes > 2], sizes[sizes > 2], strict=True):
                yield edges(*list_links(np.unique(fps[at : at + n])))
            held.append(fps[last:].copy())
            held_key = keys[-1]
        if sum(map(len, held)) > 1:
            yield edges(*list_links(np.unique(np.concatenate(held))))

    return lists.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a bigint, b bigint")


def links(fps: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints ``fp`` that have the same components as all links of three bits."""
    fp = F.col("fp")
    posted = fps.select("fp", F.posexplode(F.array(*[_posting(n, s, fp) for n, s in enumerate(FOURS)])).alias("number", "key"))
    long = posted.groupBy("key").count().where(F.col("count") > LONG_LIST).select("key")
    short = posted.select("key", "fp").join(long, "key", "left_anti")
    fives = posted.join(long, "key", "left_semi")
    within = [F.array(*[_posting(k, f, fp) for k, f in enumerate(FIVES) if set(s) <= set(f)]) for s in FOURS]
    deeper = fives.select("fp", F.explode(F.get(F.array(*within), F.col("number"))).alias("key")).distinct().select("key", "fp")
    return _list_edges(short).union(_list_edges(deeper)).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, fingerprint, component_id)`` of every document.

    ``component_id`` is the smallest id that can be reached over links of at
    most three differing bits.  Texts without words (null, empty, white space)
    have fingerprint zero and link like any others; repeated rows stay
    repeated; a null id never is a component's id unless all of its ids are
    null; an empty table gives no rows.
    """
    marked = materialise(fingerprints(df, id_col, text_col, size), "fingerprints")
    nodes = materialise(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    roots = components(links(nodes.select("fp")))
    grown = nodes.join(roots, nodes["fp"] == roots["node"], "inner").select("fp", "root", "least")
    groups = grown.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = grown.join(groups, "root").select("fp", "component_id")
    # Written, so that the last join has plain exchanges on both sides and a fingerprint of many copies can be split.
    table = materialise(nodes.join(placed, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "groups")
    return marked.join(table, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 80, words: int = 5) -> DataFrame:
    """The rows of ``df`` without those that are near copies of a document with a smaller id.

    Near copies are linked by fingerprints, and, as few pairs of a similarity
    near ``percent`` are within three bits, by the exact join over shingles of
    ``words`` words; a group is what both kinds of links connect.  Rows that
    repeat the kept id stay; so do rows without id.
    """
    from .ngram_join import jaccard_components

    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("doc_id IS NOT NULL")
    alike = [found.where("component_id <> doc_id").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")) for found in (near_duplicates(docs, size=size), jaccard_components(docs, percent=percent, size=words))]
    roots = components(materialise(alike[0].union(alike[1]).distinct(), "alike"))
    away = roots.where("node <> root").select(F.col("node").alias("simhash_away")).distinct()
    return df.join(away, F.col(f"`{id_col}`").cast("long") == F.col("simhash_away"), "left_anti")
