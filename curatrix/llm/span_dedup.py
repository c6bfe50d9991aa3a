"""Repeated byte strings across documents, decided by suffix arrays.

A byte goes if it is covered by a ``LENGTH``-byte string that also starts in a
document with a smaller id.

* Documents are copied to numbered files of the shared folder; all later steps
  exchange packed arrays between files and buckets of hashes.
* Every string of ``LENGTH`` bytes holds the least-hashed ``GRAM``-byte gram
  among its own (its anchor), wherever it occurs, and with it ``HALF`` bytes
  before or after.  Each file sends the hashes of these longer strings, once
  each however many of its texts have them, to the buckets of their range,
  which tell the files those that more than one text has.  A gram that is in
  many texts is so split by what surrounds it.
* The file cuts the context out around an anchor with such a hash: all strings
  that it can be the anchor of.  Distinct contexts meet in the anchor's bucket.
* The bucket sorts the suffixes of the contexts that share a half with another:
  a suffix array over symbols of ``PACK`` bytes, from which the order of the
  suffixes between them is induced.  Neighbours in this order that have
  ``LENGTH`` bytes in common are the repeats, and each takes the least document
  id of its run.
* The files turn these ids into removed spans.

Copies of one text in a file count as one text of the least id, so a large
group of copies sends one text from each file.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import numbered as numbered_rows
from .chunks import release
from .common import child_uri, materialise, open_store, shared_dir, small_batches
from .suffix_array import suffix_array

LENGTH, GRAM, PACK = 50, 16, 8
#: Bytes before an anchor that a string of it may begin with, and a context's size.
BACK = LENGTH - GRAM
CONTEXT = LENGTH + BACK
WINDOW_GRAMS = LENGTH - GRAM + 1
#: Bytes on one side of its anchor that every string has at least.
HALF = BACK // 2
#: Contexts that one suffix array covers, but for a larger group of one anchor.
ARRAY_CONTEXTS = 6000
ROW_GROUP = 512
#: A later task holds the hashes and shared contexts of one file, which take a few times its text at most.
FILE_BYTES = 16 << 20
#: Tasks for the files at most, for each shuffle partition.
FILE_TASKS = 8
NO_ID = np.iinfo(np.int64).max
_FACTOR = 0x9E3779B97F4A7C15
_STEPS = tuple(np.uint64(pow(_FACTOR, k, 1 << 64)) for k in range(3, 3 + len(range(0, HALF - 8, 8)) + 1))
_MIX = (np.uint64(_FACTOR), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _pack(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    for a in arrays:
        np.save(out, a, allow_pickle=False)
    return zstandard.ZstdCompressor(level=1).compress(out.getvalue())


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    source, out = io.BytesIO(raw), []
    while source.tell() < len(raw):
        out.append(np.load(source, allow_pickle=False))
    return out


def _slide(a: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` over every window of ``width`` items."""
    known, out = 1, a
    while 2 * known <= width:
        out = least(out[:-known], out[known:])
        known *= 2
    return least(out[: len(out) - (width - known)], out[width - known :]) if known < width else out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def anchors(raw: np.ndarray) -> np.ndarray:
    """Places of the grams whose hash is least in some string of ``LENGTH`` bytes."""
    if len(raw) < LENGTH:
        return np.zeros(0, np.int64)
    h, known, factor = raw.astype(np.uint64) + np.uint64(1), 1, _FACTOR
    while known < GRAM:
        h = h[:-known] * np.uint64(factor) + h[known:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        known *= 2
    # Equal hashes only make more anchors, so half of the bits will do.
    mixed = (_mixed(h) >> np.uint64(32)).astype(np.uint32)
    least = _slide(mixed, WINDOW_GRAMS, np.minimum)
    edge = np.zeros(WINDOW_GRAMS - 1, np.uint32)
    return np.flatnonzero(_slide(np.concatenate([edge, least, edge]), WINDOW_GRAMS, np.maximum) == mixed)


def _gaps(at: np.ndarray) -> bytes:
    """Sorted places as bytes; no two neighbours are ``LENGTH`` apart, but for the first, which its window holds."""
    return np.diff(at, prepend=0).astype(np.uint8).tobytes()


def _places(gaps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(gaps, np.uint8), dtype=np.int64)


def _eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place, as numbers; a view of a contiguous array of bytes."""
    return np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))


def gram_hashes(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each gram."""
    eights = _eights(raw)
    return _mixed(eights[at] * _MIX[0] + _mixed(eights[at + 8] * _MIX[2]))


def half_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit hashes of each gram with ``HALF`` bytes before and of each with ``HALF`` after; zero where the text has not so many."""
    grams, eights, halves = gram_hashes(raw, at), _eights(raw), []
    before = int(np.searchsorted(at, HALF))
    after = int(np.searchsorted(at, len(raw) - GRAM - HALF, side="right"))
    for some, first in ((slice(before, None), -HALF), (slice(0, after), GRAM)):
        start = at[some] + first
        h = grams[some].copy()
        # The last of the overlapping words ends where the half does.
        for k, factor in zip((*range(0, HALF - 8, 8), HALF - 8), _STEPS, strict=True):
            h += eights[start + k] * factor
        found = np.zeros(len(at), np.uint64)
        found[some] = np.maximum(_mixed(h) >> np.uint64(16), np.uint64(1))
        halves.append(found)
    return halves[0], halves[1]


def _row_hashes(rows: np.ndarray, count: int = 2) -> np.ndarray:
    """64-bit hashes of each row of bytes, ``count`` of them."""
    width = -(-rows.shape[1] // 8)
    factors = np.array([[pow(f, k, 1 << 64) for k in range(1, width + 1)] for f in (_FACTOR, 0xD6E8FEB86659FD93)[:count]], np.uint64)
    out = np.zeros((len(rows), count), np.uint64)
    for at in range(0, len(rows), 8192):
        some = rows[at : at + 8192]
        padded = np.zeros((len(some), 8 * width), np.uint8)
        padded[:, : rows.shape[1]] = some
        words = padded.view(np.uint64)
        words = (words ^ (words >> np.uint64(32))) * _MIX[1]
        words ^= words >> np.uint64(29)
        for k in range(count):
            out[at : at + 8192, k] = (words * factors[k]).sum(axis=1, dtype=np.uint64)
    return out


def _merged(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of bytes the number of its content; for each content its first row and the least id of its rows."""
    marks = _row_hashes(rows)
    order = np.argsort(marks[:, 0], kind="stable")
    one, two = marks[order, 0], marks[order, 1]
    if ((one[1:] == one[:-1]) & (two[1:] != two[:-1])).any():
        order = np.lexsort((marks[:, 1], marks[:, 0]))
        one, two = marks[order, 0], marks[order, 1]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return names, order[starts], np.minimum.reduceat(ids[order], starts)


def _repeated(marks: np.ndarray) -> np.ndarray:
    """Which values are there more than once."""
    order = np.argsort(marks, kind="stable")
    same = marks[order][1:] == marks[order][:-1]
    out = np.zeros(len(marks), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


class _File:
    """One numbered copy of some documents."""

    def __init__(self, uri: str):
        store, path = open_store(uri)
        self.source = store.open_input_file(path)
        self.table = pq.ParquetFile(self.source)

    def __enter__(self) -> _File:
        return self

    def __exit__(self, *_) -> None:
        self.source.close()

    def texts(self) -> Iterator[tuple[int, bytes, bytes]]:
        """``(id, text, gaps)`` of every row, a row group at a time; ``gaps`` are those between its anchors."""
        for k in range(self.table.num_row_groups):
            group = self.table.read_row_group(k)
            yield from zip(*(group.column(c).to_pylist() for c in range(3)), strict=True)

    def distinct(self) -> tuple[list[int], list[int]]:
        """For each row the first row of the same text, and for that row the least id of all of them."""
        seen: dict[bytes, int] = {}
        rows, least = [], []
        from xxhash import xxh3_128_digest

        for n, (i, text, _) in enumerate(self.texts()):
            first = seen.setdefault(xxh3_128_digest(text), n)
            rows.append(first)
            least.append(i)
            least[first] = min(least[first], i)
        return rows, least


def copy_documents(df: DataFrame, folder: str, id_col: str, text_col: str) -> DataFrame:
    """The URIs of copies of all rows, with the places of their anchors, in files of about ``FILE_BYTES`` of text; null ids become the greatest."""
    kind = pa.schema([("id", pa.int64()), ("text", pa.binary()), ("gaps", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        writer = stream = None
        uri, size = "", 0

        def done() -> pa.RecordBatch:
            writer.close()
            stream.close()
            return pa.RecordBatch.from_pydict({"uri": [uri]})

        for batch in batches:
            for at in range(0, batch.num_rows, ROW_GROUP):
                part = batch.slice(at, ROW_GROUP)
                if writer is None:
                    uri, size = child_uri(folder, f"{uuid.uuid4().hex}.docs"), 0
                    store, path = open_store(uri)
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    stream = store.open_output_stream(path, compression=None)
                    writer = pq.ParquetWriter(stream, kind, compression="zstd", use_dictionary=False)
                text = part.column(1).cast(pa.binary())
                gaps = pa.array([_gaps(anchors(np.frombuffer(t, np.uint8))) for t in text.to_pylist()], pa.binary())
                writer.write_batch(pa.RecordBatch.from_arrays([part.column(0), text, gaps], schema=kind))
                size += pc.sum(pc.binary_length(text)).as_py() or 0
                if size >= FILE_BYTES:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()
        release()

    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return materialise(rows.mapInArrow(run, "uri string"), "copied")


_ROWS = "target int, origin int, body binary"
_KIND = pa.schema([("target", pa.int32()), ("origin", pa.int32()), ("body", pa.binary())])


#: Bytes and rows of packed arrays that go back to Spark at a time.
SENT_BYTES, SENT_ROWS = 1 << 20, 256


def _step(make: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, int, bytes]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What ``make`` gives, ``(target, origin, body)`` each, as batches."""

    def batch(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], f.type) for k, f in enumerate(_KIND)], schema=_KIND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        held, size = [], 0
        for row in make(batches):
            held.append(row)
            size += len(row[2])
            if size >= SENT_BYTES or len(held) >= SENT_ROWS:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)
        held = []
        release()

    return run


def _by_target(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Rows sorted by target, gathered for each target."""
    at, held = None, []
    for batch in batches:
        for target, origin, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if target != at and held:
                yield at, held
                held = []
            at = target
            held.append((origin, body))
    if held:
        yield at, held


def _sent(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartitionById(parts, F.col("target") % parts).sortWithinPartitions("target", "origin")


def _numbered(files: DataFrame) -> DataFrame:
    """``(number, uri)``: the files' places in the order of their names."""
    return numbered_rows(files, "uri", name="number").select(F.col("number").cast("int").alias("number"), "uri")


def _half_rows(files: DataFrame, buckets: int) -> DataFrame:
    """The half hashes of each file's distinct texts, and whether two of its texts have them, for the buckets of their ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        for batch in batches:
            for number, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = [np.zeros(0, np.uint64)]
                with _File(uri) as file:
                    first, _ = file.distinct()
                    for n, (_, text, gaps) in enumerate(file.texts()):
                        if first[n] == n and gaps:
                            own = np.sort(np.concatenate(half_hashes(np.frombuffer(text, np.uint8), _places(gaps))))
                            keys.append(own[(own > 0) & np.concatenate([[True], own[1:] != own[:-1]])])
                keys = np.sort(np.concatenate(keys))
                # A text has each of its keys once, so a repeated key is in two texts.
                new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
                starts = np.flatnonzero(new)
                twice = np.diff(np.append(starts, len(keys))) > 1
                keys = keys[new]
                cuts = np.searchsorted((keys >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
                for k in range(buckets):
                    a, b = cuts[k], cuts[k + 1]
                    if a < b:
                        steps = np.diff(keys[a:b])
                        small = steps.astype(np.uint32) if not len(steps) or steps.max() < 1 << 32 else steps
                        yield (k, number, _pack(keys[a : a + 1], small, np.packbits(twice[a:b])))

    return files.mapInArrow(_step(run), _ROWS)


def _shared_rows(rows: DataFrame) -> DataFrame:
    """Back to each file, those of its half hashes that another text has as well, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        for bucket, bodies in _by_target(batches):
            keys, twice = [], []
            for _, body in bodies:
                first, steps, bits = _unpack(body)
                keys.append(np.concatenate([first, first + np.cumsum(steps, dtype=np.uint64)]))
                twice.append(np.unpackbits(bits, count=len(keys[-1])).astype(bool))
            order = np.argsort(np.concatenate(keys), kind="stable")
            ordered = np.concatenate(keys)[order]
            same = np.concatenate([[False], ordered[1:] == ordered[:-1], [False]])
            shared = np.empty(len(order), bool)
            shared[order] = same[1:] | same[:-1]
            shared |= np.concatenate(twice)
            at = 0
            for (origin, _), own in zip(bodies, keys, strict=True):
                kept = own[shared[at : at + len(own)]]
                at += len(own)
                if len(kept):
                    yield (origin, bucket, _pack(kept))

    return rows.mapInArrow(_step(run), _ROWS)


def _among(keys: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Which of the keys are among the sorted ``shared`` ones."""
    return shared[np.minimum(np.searchsorted(shared, keys), len(shared) - 1)] == keys


def _valid(at: np.ndarray, length: int) -> np.ndarray:
    """Which of the ``WINDOW_GRAMS`` strings of each context lie within the text."""
    starts = at[:, None] - BACK + np.arange(WINDOW_GRAMS)
    return (starts >= 0) & (starts + LENGTH <= length)


def _contexts(file: _File, shared: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each distinct text with shared halves: row, length, hashes and places of their anchors, and contexts, in order of rows."""
    if not len(shared):
        return
    first, _ = file.distinct()
    reach = np.arange(-BACK, LENGTH)
    for n, (_, text, gaps) in enumerate(file.texts()):
        if first[n] == n and gaps:
            raw, at = np.frombuffer(text, np.uint8), _places(gaps)
            left, right = half_hashes(raw, at)
            keep = _among(left, shared) | _among(right, shared)
            if keep.any():
                at = at[keep]
                padded = np.zeros(len(raw) + BACK + LENGTH, np.uint8)
                padded[BACK : BACK + len(raw)] = raw
                yield n, len(raw), gram_hashes(raw, at), at, padded[at[:, None] + reach + BACK]


def _context_rows(shared: DataFrame, buckets: int) -> DataFrame:
    """Each file's distinct contexts with the least id that has them, for the anchors' buckets; and its places, which one bucket passes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        for number, bodies in _by_target(batches):
            uri = next(b for origin, b in bodies if origin < 0)
            keys = np.concatenate([np.zeros(0, np.uint64), *(_unpack(b)[0] for origin, b in bodies if origin >= 0)])
            name = np.frombuffer(uri, np.uint8)
            with _File(uri.decode()) as file:
                _, ids = file.distinct()
                parts = [(h, c, np.full(len(h), ids[n]), np.packbits(_valid(at, length), axis=1), np.full(len(h), n, np.uint32), at.astype(np.uint32)) for n, length, h, at, c in _contexts(file, keys)]
            if not parts:
                none = np.zeros(0, np.uint32)
                yield (number % buckets, number, b"p" + _pack(none, none, none, np.zeros(0, np.int64), name))
                continue
            h, rows, own, bits, ns, places = (np.concatenate([p[k] for p in parts]) for k in range(6))
            names, keep, least = _merged(np.concatenate([rows, bits], axis=1), own)
            yield (number % buckets, number, b"p" + _pack(ns, places, names.astype(np.uint32), least, name))
            bucket = h[keep] % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            for k in range(buckets):
                some = order[cuts[k] : cuts[k + 1]]
                if len(some):
                    mine = keep[some]
                    yield (k, number, b"c" + _pack(some.astype(np.uint32), h[mine], rows[mine], bits[mine], least[some]))

    return shared.mapInArrow(_step(run), _ROWS)


def least_ids(h: np.ndarray, rows: np.ndarray, valid: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every string of the distinct contexts, the least id of the contexts that have it.

    ``rows`` are contexts of ``CONTEXT`` bytes in order of their anchors ``h``;
    only contexts of one anchor can share strings.
    """
    out = np.repeat(ids[:, None], WINDOW_GRAMS, axis=1)
    if len(rows) < 2:
        return out
    first = np.concatenate([[True], h[1:] != h[:-1]])
    group = np.cumsum(first) - 1
    # Halves hold their gram, so equal ones have the same anchor.
    alike = _repeated(_row_hashes(rows[:, BACK - HALF : BACK + GRAM], 1)[:, 0]) | _repeated(_row_hashes(rows[:, BACK : BACK + GRAM + HALF], 1)[:, 0])
    some = np.flatnonzero(alike)
    cuts = np.flatnonzero(np.concatenate([[True], group[some][1:] != group[some][:-1]])) if len(some) else []
    at = 0
    while at < len(some):
        k = int(np.searchsorted(cuts, at + ARRAY_CONTEXTS, side="right")) - 1
        end = int(cuts[k]) if cuts[k] > at else int(cuts[k + 1]) if k + 1 < len(cuts) else len(some)
        if len(some) - at <= ARRAY_CONTEXTS:
            end = len(some)
        part = some[at:end]
        out[part] = _array_ids(rows[part], valid[part], ids[part], out[part])
        at = end
    return out


def _array_ids(rows: np.ndarray, valid: np.ndarray, ids: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The part of ``least_ids`` that one suffix array covers.

    The array is over symbols of ``PACK`` bytes, the first one the highest, so
    it orders the suffixes that begin with a symbol as their bytes do.  Those
    that begin between symbols are ordered by the bytes up to the next symbol
    and the rank of the suffix there.
    """
    width = -(-CONTEXT // PACK)
    padded = np.zeros((len(rows), width * PACK), np.uint8)
    padded[:, :CONTEXT] = rows
    symbols = padded.view(f">u{PACK}").astype(np.uint64)
    rank = np.empty(symbols.size, np.int64)
    rank[np.array(suffix_array(symbols.ravel()))] = np.arange(symbols.size)
    rank = rank.reshape(-1, width)
    strings = np.lib.stride_tricks.sliding_window_view(rows, LENGTH, axis=1)
    for residue in range(PACK):
        places = np.arange(residue, WINDOW_GRAMS, PACK)
        context, k = np.nonzero(valid[:, places])
        if len(context) < 2:
            continue
        begin, lead = places[k], np.zeros(len(context), np.int64)
        for byte in range(-residue % PACK):
            lead = lead << 8 | rows[context, begin + byte]
        order = np.argsort(rank[context, -(-begin // PACK)], kind="stable")
        order = order[np.argsort(lead[order], kind="stable")]
        context, begin = context[order], begin[order]
        new = np.ones(len(context), bool)
        for at in range(1, len(context), 16384):
            c, j = context[at - 1 : at + 16384], begin[at - 1 : at + 16384]
            some = strings[c, j]
            new[at : at + 16384] = (some[1:] != some[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        least = np.minimum.reduceat(ids[context], starts)[np.cumsum(new) - 1]
        out[context, begin] = np.minimum(out[context, begin], least)
    return out


def _decided_rows(contexts: DataFrame) -> DataFrame:
    """Back to each file, the ids of its contexts' strings that are less than its own: context, mask of strings, id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        for bucket, bodies in _by_target(batches):
            parts = []
            for origin, body in bodies:
                if body[:1] == b"p":
                    yield (origin, -1, body)
                else:
                    parts.append((origin, *_unpack(body[1:])))
            if not parts:
                continue
            number, h, rows, bits, ids = (np.concatenate([p[k] for p in parts]) for k in range(1, 6))
            origin = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
            names, keep, least = _merged(np.concatenate([rows, bits], axis=1), ids)
            order = np.argsort(h[keep], kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            names, keep, least = place[names], keep[order], least[order]
            valid = np.unpackbits(bits[keep], axis=1, count=WINDOW_GRAMS).astype(bool)
            found = least_ids(h[keep], rows[keep], valid, least)
            found[~valid] = NO_ID
            earlier = found.min(axis=1)[names] < ids
            for f in np.unique(origin):
                some = np.flatnonzero((origin == f) & earlier)
                table = found[names[some]]
                table[table >= ids[some, None]] = NO_ID
                told: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                left = np.flatnonzero((table < NO_ID).any(axis=1))
                while len(left):
                    # Most contexts have all their strings from one document: one entry each.
                    value = table[left].min(axis=1)
                    hit = table[left] == value[:, None]
                    told.append((number[some][left], np.packbits(hit, axis=1), value))
                    table[left] = np.where(hit, NO_ID, table[left])
                    left = left[(table[left] < NO_ID).any(axis=1)]
                if told:
                    yield (int(f), bucket, b"d" + _pack(*(np.concatenate([t[k] for t in told]) for k in range(3))))

    return contexts.mapInArrow(_step(run), _ROWS)


def _removed(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that strings at ``starts`` cover."""
    starts = np.sort(starts)
    gap = np.flatnonzero(np.diff(starts) > LENGTH)
    return np.concatenate([starts[:1], starts[gap + 1]]), np.concatenate([starts[gap] + LENGTH, starts[-1:] + LENGTH])


class _Decisions:
    """What the buckets told of one file's contexts."""

    def __init__(self, bodies: list[bytes]):
        places = next(b for b in bodies if b[:1] == b"p")
        self.rows, self.at, self.names, self.least, uri = _unpack(places[1:])
        self.uri = uri.tobytes().decode()
        told = [_unpack(b[1:]) for b in bodies if b[:1] == b"d"]
        name, bits, less = (np.concatenate([t[k] for t in told]) for k in range(3)) if told else (np.zeros(0, np.uint32), np.zeros((0, 5), np.uint8), np.zeros(0, np.int64))
        order = np.argsort(name, kind="stable")
        self.told, self.bits, self.less = name[order], bits[order], less[order]

    def starts(self, row: int, doc: int, length: int) -> np.ndarray:
        """Where strings of the text of ``row`` begin that a document before ``doc`` has."""
        a, b = np.searchsorted(self.rows, [row, row + 1])
        at, names = self.at[a:b].astype(np.int64), self.names[a:b]
        own = self.least[names] < doc
        r, j = np.nonzero(_valid(at[own], length))
        out = [at[own][r] - BACK + j]
        first, last = np.searchsorted(self.told, names), np.searchsorted(self.told, names, side="right")
        sizes = last - first
        if sizes.sum():
            which = np.repeat(np.arange(len(names)), sizes)
            entry = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
            less = self.less[entry] < doc
            r, j = np.nonzero(np.unpackbits(self.bits[entry[less]], axis=1, count=WINDOW_GRAMS))
            out.append(at[which[less]][r] - BACK + j)
        return np.concatenate(out)


def _final_rows(rows: DataFrame, id_col: str, schema: str) -> DataFrame:
    kind = pa.schema([(id_col, pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        for _, bodies in _by_target(batches):
            decided = _Decisions([b for _, b in bodies])
            with _File(decided.uri) as file:
                first, least = file.distinct()
                out: list[tuple] = []
                for n, (i, text, _) in enumerate(file.texts()):
                    length, none = len(text), np.zeros(0, np.int64)
                    starts, ends = none, none
                    if length >= LENGTH and i > least[first[n]]:
                        starts, ends = np.array([0]), np.array([length])
                    elif length >= LENGTH and len(found := decided.starts(first[n], i, length)):
                        starts, ends = _removed(found)
                    keep = [text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), length], strict=True)]
                    out.append((None if i == NO_ID else i, length, starts.tolist(), ends.tolist(), b"".join(keep)))
                    if len(out) == 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kind, strict=True)], schema=kind)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kind, strict=True)], schema=kind)
        release()

    return rows.mapInArrow(run, schema)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, starts, ends, kept)`` of every document: the removed spans and the remaining bytes.

    Strings are judged on the input, not on what is left.  Null texts are
    empty; texts below ``LENGTH`` bytes lose nothing; rows of one id never
    remove from each other; a null id is greater than all others; an empty
    table gives no rows; other columns are left alone.
    """
    spark: SparkSession = df.sparkSession
    schema = f"`{id_col}` bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"
    copied = copy_documents(small_batches(df), shared_dir(spark, "copies"), id_col, text_col)
    n = copied.count()
    if not n:
        return spark.createDataFrame([], schema)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A bucket gets about as much as a file sends; a task takes one file after the other.
    buckets, parts = max(parts, n), min(n, FILE_TASKS * parts)
    numbered = materialise(_numbered(copied), "numbered")
    every = numbered.select(F.col("number").alias("target"), F.lit(-1).alias("origin"), F.col("uri").cast("binary").alias("body"))
    shared = _shared_rows(_sent(_half_rows(numbered.repartitionById(parts, F.col("number") % parts).select("number", "uri"), buckets), buckets)).union(every)
    contexts = _context_rows(_sent(shared, parts), buckets)
    return _final_rows(_sent(_decided_rows(_sent(contexts, buckets)), parts), id_col, schema)
