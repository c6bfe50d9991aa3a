"""Token ids in seekable files.

A file is a run of independent zstandard frames, each with its own content
checksum, then a skippable frame that lists the file's documents, then the
seek table of the seekable zstandard format (compressed size, decompressed
size and low 32 bits of XXH64 of each frame, in a skippable frame at the end).
A reader fetches the tail, and then decompresses only the frames that hold the
documents asked for.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import ChunkMemory, joined, release, steps
from .common import child_uri, open_store, small_batches

# Fixed values of the file format.
SEEK_TABLE_MAGIC = 0x184D2A5E
INDEX_MAGIC = 0x184D2A50
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 1 << 18
#: Text that is encoded at a time, and what a worker remembers of words in each of two generations.
STEP_BYTES, MEMORY_BYTES = 4 << 20, 32 << 20


class TokenFileWriter:
    """Writes one file to a binary stream; ``close`` adds the index and the seek table."""

    def __init__(self, stream, level: int = 1):
        import xxhash
        import zstandard

        self.stream, self.pending, self.size = stream, [], 0
        self.table: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.checksum = lambda b: xxhash.xxh64_intdigest(b) & 0xFFFFFFFF

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """One document's ids, as little-endian unsigned 32-bit integers."""
        self.docs.append((doc_id or 0, doc_id is None, len(ids) // 4))
        self.pending.append(ids)
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            whole = b"".join(self.pending)
            cut = len(whole) - len(whole) % FRAME_BYTES
            for at in range(0, cut, FRAME_BYTES):
                self._frame(whole[at : at + FRAME_BYTES])
            self.pending, self.size = [whole[cut:]], len(whole) - cut

    def _frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.stream.write(packed)
        self.table.append((len(packed), len(raw), self.checksum(raw)))

    def close(self) -> None:
        if self.size:
            self._frame(b"".join(self.pending))
        docs = np.array(self.docs, np.int64).reshape(-1, 3)
        index = self.compressor.compress(docs.tobytes())
        self.stream.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.table.append((len(index) + 8, 0, self.checksum(index)))
        entries = b"".join(struct.pack("<III", *t) for t in self.table)
        self.stream.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, FOOTER_MAGIC))


class TokenFile:
    """Random access to a file's documents; wrong magic numbers and checksums raise ``ValueError``."""

    def __init__(self, source):
        import xxhash
        import zstandard

        self.source = source
        self.checksum = lambda b: xxhash.xxh64_intdigest(b) & 0xFFFFFFFF
        self.decompressor = zstandard.ZstdDecompressor()
        size = source.size()
        count, _, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(self._read(size - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.places, self.ends, self.sums = np.cumsum(table[:, 0]) - table[:, 0], np.cumsum(table[:, 1]), table[:, 2]
        self.sizes, self.frame_bytes = table[:, 0], table[:, 1]
        index = self._read(int(self.places[-1]) + 8, int(self.sizes[-1]) - 8)
        if self.checksum(index) != self.sums[-1]:
            raise ValueError("the document index is damaged")
        docs = np.frombuffer(self.decompressor.decompress(index), "<i8").reshape(-1, 3)
        self.doc_ids = [None if missing else int(i) for i, missing, _ in docs]
        self.counts = docs[:, 2]
        self.starts = np.cumsum(self.counts) - self.counts
        self.held: tuple[int, bytes] = (-1, b"")

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _frame(self, k: int) -> bytes:
        if self.held[0] != k:
            raw = self.decompressor.decompress(self._read(int(self.places[k]), int(self.sizes[k])))
            if self.checksum(raw) != self.sums[k]:
                raise ValueError(f"frame {k} is damaged")
            self.held = (k, raw)
        return self.held[1]

    def ids(self, doc: int) -> bytes:
        """The bytes of the file's document number ``doc``; only its frames are decompressed."""
        at, end = 4 * int(self.starts[doc]), 4 * int(self.starts[doc] + self.counts[doc])
        out = []
        while at < end:
            k = int(np.searchsorted(self.ends, at, side="right"))
            first = int(self.ends[k] - self.frame_bytes[k])
            out.append(self._frame(k)[at - first : end - first])
            at = int(self.ends[k])
        return b"".join(out)


#: Bytes by kind: white space, ASCII letters, ASCII marks; the apostrophe and the bar can join letters to one unit.
_OTHER, _WHITE, _LETTER, _MARK = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = _WHITE
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[[k for k in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)) if chr(k) not in "'|"]] = _MARK


class WordTokenizer:
    """The library's ids, asked for once for each distinct piece of a word.

    The tokenizer drops white space and never joins across it, nor from letters
    to marks, so a text's ids are those of its pieces one after the other.
    Raises ``ValueError`` for a tokenizer of any other kind.
    """

    #: Letters in a row are one unit for the tokenizer.
    PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._check(json.loads(spec))
        self.library = Tokenizer.from_str(spec)
        ends = [i for t, i in self.library.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]
        self.ends = np.zeros(max(ends, default=0) + 1, bool)
        self.ends[ends] = True
        self.memory = ChunkMemory(self._learn, MEMORY_BYTES)

    @staticmethod
    def _check(spec: dict) -> None:
        """Refuse tokenizers whose ids of a text are not those of its words, or that cut words elsewhere."""
        normal, cut, model = (spec.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
        kinds = [n.get("type") for n in normal.get("normalizers", [])]
        cuts = [c.get("type") for c in cut.get("pretokenizers", [])]
        pattern = (cut.get("pretokenizers") or [{}])[0]
        fits = (
            kinds == ["NFC", "Replace", "Lowercase"] and cuts == ["Split", "ByteLevel"] and model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>"
            and pattern.get("behavior") == "Removed" and pattern.get("invert") is True and "[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in pattern.get("pattern", {}).get("Regex", "")
            and cut["pretokenizers"][1].get("add_prefix_space") is False and not model.get("dropout") and not spec.get("truncation") and not spec.get("padding")
            and not any(set(" \t\n\v\f\r") & set(t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in spec.get("added_tokens", []))
        )
        if not fits:
            raise ValueError("the tokenizer must be a lower-casing BPE of words that drops white space")

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; a null text is empty."""
        raw, bounds = joined(texts)
        raw, kinds = self._lower(raw), _KINDS[raw]
        before, after = kinds[:-1], kinds[1:]
        marks = np.zeros(len(raw), bool)
        marks[1:] = (before != after) & ((before == _WHITE) | (after == _WHITE) | (before + after == _LETTER + _MARK) & (before > 0) & (after > 0))
        marks[bounds[:-1][bounds[:-1] < len(raw)]] = True
        cuts = np.flatnonzero(marks)
        ids, ends = self.memory.gather(raw, cuts)
        places = ends[np.searchsorted(cuts, bounds)] if len(cuts) else np.zeros(len(bounds), np.int64)
        whole = ids.tobytes()
        return [whole[a:b] for a, b in itertools.pairwise(places.tolist())]

    @staticmethod
    def _lower(raw: np.ndarray) -> np.ndarray:
        """In ASCII lower case, as the tokenizer makes it anyway, so that fewer pieces are distinct.

        A letter stays as it is before a character that it may compose with,
        and all do where there may be special tokens, whose case counts.
        """
        if len(raw) > 1 and ((raw[:-1] == 60) & (raw[1:] == 124)).any():
            return raw
        high = (raw >= 65) & (raw <= 90)
        high[:-1] &= raw[1:] < 128
        return raw + (high * np.uint8(32))

    def _learn(self, unknown: list[bytes]) -> list[bytes]:
        """Ask for letters in a row all at once, as one text; for what is not so plain one by one."""
        known: dict[bytes, bytes] = {}
        plain, odd = [], []
        for w in unknown:
            if w.isalpha() or self.PLAIN.fullmatch(w):
                plain.append(w)
            elif w.isspace():
                known[w] = b""
            else:
                odd.append(w)
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            ids = np.array(self.library.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            cuts = 4 * np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)]) + 4
            if len(cuts) != len(some):
                odd += some
                continue
            raw = ids.tobytes()
            known.update(zip(some, [raw[a:b] for a, b in itertools.pairwise([0, *cuts.tolist()])], strict=True))
        for at in range(0, len(odd), 2000):
            some = odd[at : at + 2000]
            for w, found in zip(some, self.library.encode_batch_fast([w.decode() for w in some], add_special_tokens=False), strict=True):
                known[w] = np.array(found.ids, "<u4").tobytes()
        return [known[w] for w in unknown]


@functools.lru_cache(maxsize=2)
def _tokenizer(spec: str) -> WordTokenizer:
    return WordTokenizer(spec)


def write_tokens(df: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> list[tuple[int, str, int, int]]:
    """Write every whole text's ids, ``end_id`` after each, in ascending order of ids.

    Returns one ``(number, uri, documents, tokens)`` per file, in order; their
    count is the number of range partitions.  Null texts are empty, null ids
    come first, rows of the same id follow each other in the order of their
    texts.  File names are new for each attempt of a task, and only a finished
    task's file is listed, so lost executors leave no half files behind in the
    listing.  An empty table gives no files.
    """
    spec = open(tokenizer_path, encoding="utf-8").read()  # noqa: SIM115
    if len(spec) > 10_000_000:
        raise ValueError("the tokenizer file is larger than 10 MB")
    kind = pa.schema([("number", pa.int64()), ("uri", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        tokenizer, number = _tokenizer(spec), TaskContext.get().partitionId()
        uri = child_uri(folder, f"ids-{number:06d}-{uuid.uuid4().hex}.zst")
        writer = stream = None
        for batch in batches:
            for part in steps(batch, 1, STEP_BYTES, 4096):
                if writer is None:
                    store, path = open_store(uri)
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    stream = store.open_output_stream(path, compression=None)
                    writer = TokenFileWriter(stream)
                for i, ids in zip(part.column(0).to_pylist(), tokenizer.encode(part.column(1)), strict=True):
                    writer.add(i, ids + end)
        # What is known of words stays for the worker's next task.
        release()
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"number": [number], "uri": [uri], "documents": [len(writer.docs)], "tokens": [sum(d[2] for d in writer.docs)]}, schema=kind)

    rows = small_batches(df).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).repartitionByRange("id").sortWithinPartitions("id", "text")
    listed = rows.mapInArrow(run, "number bigint, uri string, documents bigint, tokens bigint").collect()
    return sorted(map(tuple, listed))


def read_tokens(spark: SparkSession, files: list[tuple[int, str, int, int]], id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids)`` of every document in the listed files.

    ``start`` counts the ids of all documents before it; ``ids`` are bytes,
    four for each id.
    """
    starts = np.cumsum([0] + [f[3] for f in files])
    kind = pa.schema([(id_col, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, path = open_store(uri)
                with store.open_input_file(path) as source:
                    file = TokenFile(source)
                    for at in range(0, len(file.doc_ids), 256):
                        some = range(at, min(at + 256, len(file.doc_ids)))
                        yield pa.RecordBatch.from_arrays([pa.array([file.doc_ids[k] for k in some], pa.int64()), pa.array(first + file.starts[at : at + 256]), pa.array(file.counts[at : at + 256].copy()), pa.array([file.ids(k) for k in some], pa.binary())], schema=kind)

    listed = spark.createDataFrame([(f[1], int(s)) for f, s in zip(files, starts, strict=False)], "uri string, first bigint")
    if len(files) > 1:
        listed = listed.repartition(len(files))
    return listed.mapInArrow(run, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids binary")
