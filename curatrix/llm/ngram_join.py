"""Documents whose sets of word n-grams are alike: a self-join by T-occurrence search.

Two sets with a Jaccard similarity of s or more share at least T = ceil(s * n)
grams, n being the size of either.  Of a document's inverted lists, any T - 1
can be left unread without losing a partner; the longest are, so what is read
are the lists of its rarest grams (DivideSkip with all long lists skipped).
Every document is posted under those grams only, and lists with the same
members are read once.

First each document goes with its whole set to one list, the longest it is in,
where it is a query against the members before it: its short lists are merged,
members that occur in fewer than T less the number of long lists are dropped,
the others are probed in the long lists by binary search, and the exact overlap
decides.  Merging is done by numpy's stable sort, which merges runs that are
sorted already, in place of a heap of Python objects.

Then the lists that still hold several components are read once more, with
small bitmaps in place of sets.  A bit is the parity of the grams that fall on
it, so that bits which differ never outnumber the grams which differ: pairs of
unlike components that may reach T are told apart from those that cannot, and
only the former are probed with their sets.  So a large group of near copies
gives few pairs, and no pair that may link is passed over.

"Rarest" needs an order of all grams, and any one order gives the same links.
Here grams of the lower part of the hash range come first, by the number of
documents that have them, then the others; grams that a large share of all
documents has come last and are never counted or listed unless a document has
too few others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import steps
from .common import materialise, small_batches
from .components import components

SIZE, PERCENT = 4, 85
#: Documents are listed by their grams of hashes below this share of the range, as long as they have enough of them.
LOWER = 0.3
#: A gram is common if this part of all documents, or this part of all grams' places, has it.
COMMON_DOCS, MOST_COMMON = 200, 1_000_000
#: A slice of a batch tells of grams that so many of its documents have.
TELL = 8
#: Bytes of sets, or members with their bitmaps, that one task holds of a list; longer lists are cut into blocks.
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 4096
#: A bitmap has twice as many bits as the set has grams, within these bounds.
LEAST_BITS, MOST_BITS = 256, 8192
#: Words of bitmaps that are compared at a time.
COMPARE_WORDS = 4 << 20
#: Weight of merging against probing (DivideSkip's constant).
MU = 0.01
#: Bits of the filter that spares the texts of documents which are in no list.
FILTER_BITS = 1 << 23
_NO_ID = (1 << 63) - 1
_UPPER, _COMMON = 1 << 61, 1 << 62


def gram_set(raw: bytes, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams, A-Z in lower case.

    Fewer words than ``size`` are one gram; without words there is none.
    """
    from xxhash import xxh3_64_intdigest

    words = raw.lower().split()
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    if not size:
        return hashes
    found = hashes[: len(words) - size + 1] + np.uint64(size)
    for k in range(1, size):
        found = (found ^ (found >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(words) - size + 1 + k]
    return np.unique(found ^ (found >> np.uint64(32)))


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Grams that a set of ``n`` shares at least with any set it links with."""
    return -(-percent * n // 100)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return small_batches(df).select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _per_text(df: DataFrame, work, kind: pa.Schema, names: str, size: int, chosen=None) -> DataFrame:
    """``work(docs, sets)`` of slices of the texts, as rows; of those only that ``chosen`` takes, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch if chosen is None else batch.filter(chosen(batch)), 1):
                sets = [gram_set((t or "").encode(), size) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_pydict(work(part.column(0), sets), schema=kind)

    return df.mapInArrow(run, names)


def _marks(texts: DataFrame, size: int) -> DataFrame:
    """For every text its number of grams and a 128-bit key of their set; and grams of many texts of a slice, with a count."""
    from xxhash import xxh3_128_digest

    kind = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("gram", pa.int64()), ("count", pa.int64())])

    def work(docs: pa.Array, sets: list[np.ndarray]) -> dict:
        grams, counts = np.unique(np.concatenate(sets), return_counts=True)
        told = counts >= TELL
        more, none = int(told.sum()), [None]
        return {
            "doc": docs.to_pylist() + none * more, "n": [len(s) for s in sets] + none * more, "key": [xxh3_128_digest(s.tobytes()) for s in sets] + none * more,
            "gram": none * len(sets) + grams[told].view(np.int64).tolist(), "count": none * len(sets) + counts[told].tolist(),
        }

    return _per_text(texts, work, kind, "doc bigint, n bigint, key binary, gram bigint, count bigint", size)


def _postings(texts: DataFrame, common: np.ndarray, percent: int, size: int) -> DataFrame:
    """``(doc, gram, kind)``: grams by which a text may be listed.

    Kind 0: to be ordered by count; kinds -1 and -2: upper and common grams,
    the smallest hashes first, where there are too few of the kinds before.  A
    row without a gram tells the number of grams of kind 0.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(common)
    border = np.uint64(int(LOWER * 2**64))
    kind = pa.schema([("doc", pa.int64()), ("gram", pa.int64()), ("kind", pa.int64())])

    def work(docs: pa.Array, sets: list[np.ndarray]) -> dict:
        known = shared.value
        doc, gram, kinds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        heads, counts = [], []
        for d, s in zip(docs.to_pylist(), sets, strict=True):
            n = len(s)
            if 100 * n < percent * (n + 1):  # no other set can be near enough
                continue
            place = np.searchsorted(known, s)
            often = known[np.minimum(place, len(known) - 1)] == s if len(known) else np.zeros(n, bool)
            lower = ~often & (s < border)
            most = n - least_overlap(n, percent) + 1
            upper = s[~often & ~lower][: max(0, most - int(lower.sum()))]
            last = s[often][: max(0, most - int(lower.sum()) - len(upper))]
            found = np.concatenate([s[lower], upper, last]).view(np.int64)
            doc.append(np.full(len(found), d, np.int64))
            gram.append(found)
            kinds.append(np.repeat(np.array([0, -1, -2]), [int(lower.sum()), len(upper), len(last)]))
            heads.append(d)
            counts.append(int(lower.sum()))
        n = sum(map(len, gram))
        return {"doc": np.concatenate([*doc, np.array(heads, np.int64)]), "gram": pa.array(np.concatenate([*gram, np.zeros(len(heads), np.int64)]), mask=np.arange(n + len(heads)) >= n), "kind": np.concatenate([*kinds, np.array(counts, np.int64)])}

    return _per_text(texts, work, kind, "doc bigint, gram bigint, kind bigint", size)


def _listed(texts: DataFrame, nodes: DataFrame, common: np.ndarray, percent: int, size: int) -> DataFrame:
    """``(gram, doc, n)``: every document under the grams of its short lists."""
    posts = _postings(texts, common, percent, size)
    # Grams of the last kinds are not counted, so they and the rows without a gram are dealt by document.
    salt = F.when(F.col("gram").isNull() | (F.col("kind") < 0), F.col("doc")).otherwise(0)
    counted = posts.withColumn("salt", salt).withColumn("docs", F.count("*").over(Window.partitionBy("gram", "salt"))).where((F.col("docs") > 1) | F.col("gram").isNull() | (F.col("kind") < 0))
    weight = F.when(F.col("kind") == -1, _UPPER).when(F.col("kind") == -2, _COMMON).otherwise(F.col("docs"))
    kept = materialise(counted.select("doc", "gram", weight.alias("weight"), F.when(F.col("gram").isNull(), F.col("kind")).alias("lower")), "grams")
    each = kept.groupBy("doc").agg(F.sort_array(F.collect_set(F.when(F.col("gram").isNotNull(), F.struct("weight", "gram")))).alias("grams"), F.max("lower").alias("lower"))
    # Grams of a single document come first and need no list.
    alone = F.col("lower") - F.size(F.filter("grams", lambda g: g["weight"] < _UPPER))
    most = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    take = F.when(F.col("versions"), F.size("grams")).otherwise(F.greatest(most - alone, F.lit(0))).cast("int")
    return each.join(nodes.where("first"), "doc").select(F.explode(F.slice("grams", F.lit(1), take)["gram"]).alias("gram"), "doc", "n")


def _block_links(members: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links between members (sorted sets), enough of them to connect all that link."""
    root = np.arange(len(members))
    sizes = np.array([len(m) for m in members])
    grams = np.concatenate(members)
    owner = np.repeat(np.arange(len(members), dtype=np.int32), sizes)
    order = np.argsort(grams, kind="stable")
    owner = owner[order]
    heads = np.flatnonzero(np.r_[True, np.diff(grams[order]) != 0])
    number = np.empty(len(grams), np.int64)
    number[order] = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(grams)]))
    ends = np.r_[heads[1:], len(grams)]
    at = np.r_[0, np.cumsum(sizes)]

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for q in range(1, len(members)):
        n = int(sizes[q])
        lists = number[at[q] : at[q + 1]]
        lengths = ends[lists] - heads[lists]
        lists = lists[np.argsort(lengths, kind="stable")]
        least = least_overlap(n, percent)
        longest = int(lengths.max())
        skip = min(least - 1, int(least / (MU * math.log2(longest + 1) + 1)))
        short, long = lists[: n - skip], lists[n - skip :]
        short = short[ends[short] - heads[short] > 1]
        merged = np.sort(np.concatenate([owner[heads[k] : ends[k]] for k in short]), kind="stable") if len(short) else owner[:0]
        merged = merged[: np.searchsorted(merged, q)]
        cuts = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]]) if len(merged) else np.zeros(0, np.int64)
        seen, some = np.diff(np.r_[cuts, len(merged)]), merged[cuts]
        near = (seen >= least - skip) & (np.maximum(sizes[some], n) * percent <= 100 * np.minimum(sizes[some], n))
        some, seen = some[near], seen[near]
        mine = find(q)
        apart = np.array([find(int(k)) != mine for k in some], bool)
        some, seen = some[apart], seen[apart]
        for k in long if len(some) else ():
            held = owner[heads[k] : ends[k]]
            place = np.minimum(np.searchsorted(held, some), len(held) - 1)
            seen += held[place] == some
        for k in some[100 * seen >= percent * (sizes[some] + n - seen)]:
            a, b = find(int(k)), find(q)
            if a != b:
                root[max(a, b)] = min(a, b)
                yield int(k), q


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each value of the first column, which follow each other, without it."""
    key, held = None, []
    for batch in batches:
        for first, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if first != key and held:
                yield held
                held = []
            key = first
            held.append(tuple(rest))
    if held:
        yield held


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(met: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` in each ``part`` of rows ``(part, doc, grams)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _grouped(batches):
            if len(held) > 1:
                found = list(_block_links([np.frombuffer(g, np.uint64) for _, g in held], percent))
                yield pa.RecordBatch.from_pydict({"a": [held[i][0] for i, _ in found], "b": [held[j][0] for _, j in found]}, schema=_PAIR)

    return small_batches(met).repartition("part").sortWithinPartitions("part", "doc").select("part", "doc", "grams").mapInArrow(run, "a bigint, b bigint")


def bitmap(grams: np.ndarray) -> bytes:
    """Parities of the grams that fall on each of a power of two of bits."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (2 * len(grams)).bit_length()))
    return np.packbits(np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def may_link(sizes: np.ndarray, bits: list[bytes], side: np.ndarray, root: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of members of unlike roots that their bitmaps do not rule out, and how many bits differ.

    ``side``: 0 for members that are compared with all others, else only members of unlike sides are.
    """
    lengths = np.array([len(b) for b in bits])
    for length in np.unique(lengths):
        # Sets that can link differ by less than a factor of two, so their bitmaps are of the same or the next size, which is folded.
        own, next_ = np.flatnonzero(lengths == length), np.flatnonzero(lengths == 2 * length)
        here = np.frombuffer(b"".join(bits[k] for k in own), np.uint64).reshape(len(own), -1)
        there = np.frombuffer(b"".join(bits[k] for k in next_), np.uint64).reshape(len(next_), 2, here.shape[1])
        every, words = np.concatenate([own, next_]), np.concatenate([here, there[:, 0] ^ there[:, 1]])
        step = max(1, COMPARE_WORDS // words.size)
        for at in range(0, len(own), step):
            left = own[at : at + step, None]
            total = sizes[left] + sizes[every]
            most = total - 2 * -(-percent * total // (100 + percent))
            able = (root[left] != root[every]) & ((left < every) | (lengths[every] != length)) & ((side[left] == 0) | (side[left] != side[every]))
            i, j = np.nonzero(able & (np.abs(sizes[left] - sizes[every]) <= most))
            apart = np.bitwise_count(here[at : at + step][i] ^ words[j]).sum(axis=1, dtype=np.int64) if len(i) else np.zeros(0, np.int64)
            near = apart <= most[i, j]
            yield own[at + i[near]], every[j[near]], apart[near]


def _candidates(met: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs ``(a, b)`` of rows ``(part, doc, side, root, n, bits)`` that may link; with ``nearest`` the nearest of each two components of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _grouped(batches):
            docs, side, root, sizes = (np.array([row[k] for row in held], np.int64) for k in range(4))
            known = np.zeros((0, 5), np.int64)
            for i, j, apart in may_link(sizes, [row[4] for row in held], side, root, percent):
                low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
                found = np.stack([low, high, apart * 1_000_000 // (sizes[i] + sizes[j]), docs[i], docs[j]], axis=1)
                if nearest:
                    known = np.concatenate([known, found])
                    known = known[np.lexsort(known.T[::-1])]
                    known = known[np.r_[True, (known[1:, :2] != known[:-1, :2]).any(axis=1)]] if len(known) else known
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 3]), pa.array(found[:, 4])], schema=_PAIR)
            yield pa.RecordBatch.from_arrays([pa.array(known[:, 3].copy()), pa.array(known[:, 4].copy())], schema=_PAIR)

    chosen = small_batches(met).select("part", "doc", "side", "root", "n", "bits")
    found = chosen.repartition("part").sortWithinPartitions("part", "doc").mapInArrow(run, "a bigint, b bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _probed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link: the grams of one set are looked up in the other by binary search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for g, h in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(g, np.uint64), np.frombuffer(h, np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                same = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=_PAIR).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("doc").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("doc").alias("b"), F.col("grams").alias("grams_b"))
    return small_batches(pairs).join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(run, "a bigint, b bigint").distinct()


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows ``(part, doc, side, root)`` of the lists that hold several components: every two blocks of a list that may hold a link.

    A block holds members of one large component, or whole small components; two blocks of the same component are not compared.
    """
    rooted = members.join(roots, members["doc"] == roots["node"], "left").select("list", "doc", F.coalesce("root", "doc").alias("root"))
    each = rooted.groupBy("list", "root").agg(F.count("*").alias("of_root"))
    mixed = each.groupBy("list").agg(F.count("*").alias("roots"), F.sum("of_root").alias("total")).where("roots > 1").select("list", "total")
    big = F.col("of_root") > BLOCK_ROWS
    spread = lambda by, total: F.pmod(F.xxhash64(by), F.ceil(F.col(total) / BLOCK_ROWS))
    sized = each.join(mixed, "list")
    cut = rooted.join(sized, ["list", "root"]).select("list", "doc", "root", F.when(big, F.col("root")).alias("only"), F.when(big, spread("doc", "of_root")).otherwise(spread("root", "total")).alias("number"))
    cut = materialise(cut.withColumn("block", F.xxhash64("list", "only", "number")), "blocks")
    blocks = cut.select("list", "only", "block").distinct()
    pairs = blocks.join(blocks.select("list", F.col("only").alias("only2"), F.col("block").alias("block2")), "list").where((F.col("block") < F.col("block2")) & ~F.coalesce(F.col("only") == F.col("only2"), F.lit(False)) | (F.col("block") == F.col("block2")) & F.col("only").isNull())
    pairs = pairs.select("list", "block", "block2", F.xxhash64("list", "block", "block2").alias("part"))
    sides = pairs.select("list", "block", "part", F.when(F.col("block") == F.col("block2"), 0).otherwise(1).alias("side")).union(pairs.where("block < block2").select("list", "block2", "part", F.lit(2)))
    return cut.join(sides, ["list", "block"]).select("part", "doc", "side", "root")


def _sets(texts: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """``(doc, n, grams, bits)`` of the texts of members.

    A filter of bounded size leaves out most other texts before they are worked on; what it lets pass by chance goes by a join.
    """
    spark = texts.sparkSession
    place = F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS))
    words = members.select("doc").distinct().select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
    known = np.zeros(FILTER_BITS // 64, np.int64)
    for word, bits in words.collect():
        known[word] = bits
    shared = spark.sparkContext.broadcast(known)
    kind = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("grams", pa.binary()), ("bits", pa.binary())])

    def chosen(batch: pa.RecordBatch) -> pa.Array:
        at = batch.column(2).to_numpy()
        return pa.array((shared.value[at >> 6] >> (at & 63)) & 1 == 1)

    def packed(docs: pa.Array, sets: list[np.ndarray]) -> dict:
        return {"doc": docs, "n": [len(s) for s in sets], "grams": [s.tobytes() for s in sets], "bits": [bitmap(s) for s in sets]}

    found = _per_text(texts.withColumn("place", place), packed, kind, "doc bigint, n bigint, grams binary, bits binary", size, chosen)
    return found.join(members.select("doc").distinct(), "doc", "left_semi")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, size: int = SIZE) -> DataFrame:
    """``(id, n_shingles, component_id)`` of every row.

    Documents link when ``100 * intersection >= percent * union`` of their sets
    of shingles of ``size`` words; ``component_id`` is the smallest id reachable.
    Texts without words (null, empty, white space) link with nothing, except
    rows of their own id: rows of one id are one document, whatever their texts,
    and so are all rows without an id, whose component is the smallest id they
    reach, else null.  Repeated rows stay repeated, an empty table gives no
    rows, other columns are not looked at.
    """
    texts = _texts(df, id_col, text_col)
    marks = materialise(_marks(texts, size), "marks")
    rows = marks.where("n IS NOT NULL").select("doc", "n", "key")
    total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    bound = max(2 * TELL, total[0] // COMMON_DOCS, total[1] // MOST_COMMON)
    # At most total[1] / bound <= MOST_COMMON of them.
    told = marks.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("count").alias("docs")).where(F.col("docs") > bound).select("gram")
    common = np.sort(np.array([r[0] for r in told.collect()], np.int64).view(np.uint64))

    classes = materialise(rows.where("n > 0").groupBy("key", "n").agg(F.min("doc").alias("least")), "classes")
    placed = materialise(rows.where("n > 0").join(classes, ["key", "n"]).select("doc", "n", "least"), "placed")
    nodes = placed.groupBy("doc").agg(F.max("n").alias("n"), (F.min("least") < F.max("least")).alias("versions"), F.max(F.col("doc") == F.col("least")).alias("first"))

    listed = materialise(_listed(texts, nodes, common, percent, size), "listed")
    hashed = [F.bit_xor(F.xxhash64("doc", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    lists = listed.groupBy("gram").agg(F.count("*").alias("held"), F.sum("n").alias("total"), *hashed).where("held > 1")
    lists = lists.groupBy("held", "total", "x1", "x2").agg(F.min("gram").alias("gram"))
    members = materialise(listed.join(lists.select("gram", "held"), "gram").select(F.col("gram").alias("list"), "doc", "n", "held"), "members")

    sets = materialise(_sets(texts, members, size), "sets")
    home = members.groupBy("doc").agg(F.max(F.struct("held", "list"))["list"].alias("list"), F.max("n").alias("n"))
    blocks = home.groupBy("list").agg(F.ceil(F.sum("n") * 8 / BLOCK_BYTES).alias("blocks"), F.count("*").alias("met")).where("met > 1")
    alone = home.join(blocks, "list").select(F.xxhash64("list", F.pmod(F.xxhash64("doc"), F.col("blocks"))).alias("part"), "doc")
    links = materialise(_links(alone.join(sets.select("doc", "grams"), "doc"), percent).distinct(), "links")
    # Rows of one id are one document.
    links = links.union(placed.join(nodes.where("versions").select("doc"), "doc", "left_semi").select(F.col("doc").alias("a"), F.col("least").alias("b")))
    tested = None
    for nearest in (True, False):
        met = _mixed(members.select("list", "doc"), components(links)).join(sets.select("doc", "n", "bits"), "doc")
        pairs = _candidates(met, percent, nearest)
        pairs = materialise(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        links, tested = links.union(materialise(_probed(pairs, sets.select("doc", "grams"), percent), "links")), pairs
    roots = materialise(components(links), "roots")
    groups = materialise(classes.join(roots, classes["least"] == roots["node"], "left").select("key", "n", F.coalesce("root", "least").alias("component_id")), "groups")
    found = rows.where("n > 0").join(groups, ["key", "n"]).select("doc", "n", "component_id")
    # Texts without words have the component of their id's other rows, if there are any.
    bare = rows.where("n = 0").join(found.groupBy("doc").agg(F.min("component_id").alias("component_id")), "doc", "left").select("doc", "n", F.coalesce("component_id", "doc").alias("component_id"))
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return found.union(bare).select(real("doc").alias(id_col), F.col("n").alias("n_shingles"), real("component_id").alias("component_id"))
