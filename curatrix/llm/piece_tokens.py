"""SentencePiece encoding and decoding that keeps byte offsets.

The text is normalised by the longest prefix that the model's compiled
character map knows, and every normalised byte records the source byte it came
from.  BPE merges run over the normalised characters, and each piece is then
projected through that alignment to a span of bytes of the original text.

No merge crosses a line feed or goes from a word to the space after it where no
piece of the vocabulary does, so the normalised text is cut there, each distinct
chunk of a batch is merged once, and its pieces' ids and offsets are gathered
back to all its places.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkMemory, joined, steps
from .common import small_batches

SPACE = "▁"


class CharacterMap:
    """Longest-prefix lookup in a compiled character map.

    The map is a double-array trie (little-endian 32-bit units), preceded by
    its length in bytes and followed by zero-terminated replacements.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.replacements = blob[4 + size :]

    def longest(self, key: bytes, at: int) -> tuple[int, bytes] | None:
        """``(bytes matched, replacement)`` of the longest entry that starts at ``at``."""
        units = self.units

        def step(u: int) -> int:
            return (u >> 10) << ((u & 0x200) >> 6)

        found, place = None, step(units[0])
        for i in range(at, len(key)):
            place ^= key[i]
            if place >= len(units):
                break
            unit = units[place]
            if unit & 0x800000FF != key[i]:
                break
            place ^= step(unit)
            if unit & 0x100:
                found = (i + 1 - at, units[place] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1] : end]


class PieceModel:
    """A BPE model with byte fallback, read from its serialised form.

    Raises ``ValueError`` for unigram models, user-defined pieces and models
    without byte fallback, none of which this operator encodes.
    """

    def __init__(self, blob: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(blob)
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("the model must be BPE with byte fallback")
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.scores, self.ids, self.byte_ids = {}, {}, [0] * 256
        #: Bytes of normalised text that each id stands for, a space being one.
        self.widths = np.ones(len(model.pieces), np.int64)
        pairs: set[str] = set()
        for i, p in enumerate(model.pieces):
            if p.type == 1:
                self.scores[p.piece], self.ids[p.piece] = p.score, i
                self.widths[i] = len(p.piece.replace(SPACE, " ").encode())
                pairs.update(map("".join, itertools.pairwise(p.piece)))
            elif p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        plain = model.trainer_spec.treat_whitespace_as_suffix is False and not spec.remove_extra_whitespaces
        self.spelled = [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(SPACE, " ").encode() if p.type == 1 and plain else b"\xff" for p in model.pieces]
        self.decimal = list(map(str, range(len(model.pieces))))
        self.starts = [p.type == 1 and p.piece[0] == SPACE for p in model.pieces]
        inside = {c for pair in pairs for c in pair}
        self.line_cuts = "\n" not in inside
        self.word_cuts = not any(b == SPACE and a != SPACE for a, b in pairs)
        #: Whether the library normalises a chunk to itself, so that it can merge many in one call.
        self.bulk = not self.map and self.prefix and self.escape and not self.squeeze and not self.suffix and self.line_cuts and self.word_cuts
        self.memory = ChunkMemory(self._learn)

    # Normalisation

    def normalise(self, text: str, escape: bool | None = None) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the source byte; ``escape``: spaces become ``SPACE``."""
        return self._mapped(text, self.escape if escape is None else escape)

    def _mapped(self, text: str, escape: bool) -> tuple[str, np.ndarray]:
        source, space = text.encode(), SPACE.encode() if escape else b" "
        out, places, at = bytearray(), [], 0

        def head(i: int) -> tuple[int, bytes]:
            if self.map and (found := self.map.longest(source, i)):
                return found
            n = 1 if source[i] < 0x80 else 2 if source[i] < 0xE0 else 3 if source[i] < 0xF0 else 4
            return n, source[i : i + n]

        def put(piece: bytes, i: int) -> None:
            out.extend(piece)
            places.extend([i] * len(piece))

        while self.squeeze and at < len(source) and (h := head(at))[1] == b" ":
            at += h[0]
        if at == len(source):
            return "", np.zeros(1, np.int64)
        if self.prefix and not self.suffix:
            put(space, at)
        after_space = self.squeeze
        while at < len(source):
            n, piece = head(at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                if piece == source[at : at + n] and b" " not in piece:
                    out.extend(piece)
                    places.extend(range(at, at + n))
                else:
                    for k in piece:
                        put(space if k == 32 else bytes([k]), at)
                after_space = piece.endswith(b" ")
            at += n
            after_space = after_space and self.squeeze
        while self.squeeze and out.endswith(space):
            at = places[len(out) - len(space)]
            del out[-len(space) :], places[-len(space) :]
        if self.prefix and self.suffix:
            put(space, at)
        return out.decode(), np.array([*places, at], np.int64)

    # Merging

    def _merged(self, chunk: str) -> list[str]:
        """The chunk's pieces: always the best-scored adjacent pair first, leftmost of equals."""
        parts, scores = list(chunk), self.scores
        if len(parts) <= 48:
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    score = scores.get(parts[i] + parts[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if best is None:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            return parts
        right, left = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]
        queue = [(-scores[p], i, p) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in scores]
        heapq.heapify(queue)
        while queue:
            _, i, joined = heapq.heappop(queue)
            j = right[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, ""
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (p := parts[a] + parts[b]) in scores:
                    heapq.heappush(queue, (-scores[p], a, p))
        return [p for p in parts if p]

    def own_ids(self, chunk: str) -> list[int]:
        """The ids of a normalised chunk by the model's own merges; characters without a piece become bytes."""
        ids: list[int] = []
        for piece in self._merged(chunk):
            i = self.ids.get(piece)
            ids.extend([i] if i is not None else (self.byte_ids[b] for b in piece.encode()))
        return ids

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """For each chunk its pieces as int32 triples: id, first and end byte within the chunk.

        Where the library normalises a chunk to itself it merges them, in one
        call; a line feed, itself never part of a longer piece, keeps it from
        putting a space before a chunk that has none.
        """
        texts = [c.decode() for c in chunks]
        if self.bulk:
            spaced = [t[0] == " " and len(t) > 1 for t in texts]
            listed = self.library.encode([t[1:] if s else "\n" + t for t, s in zip(texts, spaced, strict=True)], num_threads=1)
            listed = [ids if s else ids[2:] for ids, s in zip(listed, spaced, strict=True)]
        else:
            listed = [self.own_ids(t.replace(" ", SPACE) if self.escape else t) for t in texts]
        ids = np.fromiter(itertools.chain.from_iterable(listed), np.int32)
        cuts = np.cumsum([0, *map(len, listed)])
        ends = np.concatenate([[0], np.cumsum(self.widths[ids])])
        table = np.empty((len(ids), 3), np.int32)
        table[:, 0] = ids
        first = np.repeat(ends[cuts[:-1]], np.diff(cuts))
        table[:, 1], table[:, 2] = ends[:-1] - first, ends[1:] - first
        for k, t in enumerate(texts):
            if SPACE in t:
                table[cuts[k] : cuts[k + 1], 1:] = self._places(t, listed[k])
        raw = table.tobytes()
        return [raw[a:b] for a, b in itertools.pairwise((12 * cuts).tolist())]

    def _places(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """First and end byte of each id in a chunk where ``SPACE`` itself occurs, which is wider than a space."""
        raw, at, out = text.encode(), 0, []
        for i in ids:
            begin = at
            for k in self.spelled[i] if self.widths[i] > 1 or self.starts[i] else b"?":
                at += 3 if k == 32 and raw[at] != 32 else 1
            out.append((begin, at))
        return out

    def cuts(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the chunks of the normalised texts between ``bounds`` begin."""
        marks = np.zeros(len(raw), bool)
        before, after = raw[:-1], raw[1:]
        if self.word_cuts:
            # A byte 0x81 may end SPACE, which merges with a space after it.
            marks[1:] |= (after == 32) & (before != 32) & (before != 0x81)
        if self.line_cuts:
            marks[1:] |= (after == 10) | (before == 10)
        marks[bounds[:-1][bounds[:-1] < len(raw)]] = True
        return np.flatnonzero(marks)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, begins, ends, bounds)``: all texts' ids and source bytes, one text after the other; null is empty."""
        if self.map is None and not self.squeeze and not self.suffix:
            # Normalised is as it is, after the space in front of a text that is not empty.
            front = " " if self.prefix else ""
            texts = pc.fill_null(texts, "")
            raw, bounds = joined(pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(front, texts, "")))
            shift, places = len(front), None
        else:
            normal = [self.normalise(t or "", False) for t in texts.to_pylist()]
            raw, bounds = joined(pa.array([n for n, _ in normal], pa.string()))
            shift, places = 0, [p for _, p in normal]
        cuts = self.cuts(raw, bounds)
        found, ends = self.memory.gather(raw, cuts)
        table = found.view(np.int32).reshape(-1, 3)
        ends = ends // 12
        places_of = ends[np.searchsorted(cuts, bounds)] if len(cuts) else np.zeros(len(bounds), np.int64)
        base = np.repeat(cuts, np.diff(ends)) - np.repeat(bounds[:-1], np.diff(places_of))
        begin, end = (np.maximum(table[:, k] + base - shift, 0) for k in (1, 2))
        if places is not None:
            for k, (a, b) in enumerate(itertools.pairwise(places_of.tolist())):
                begin[a:b], end[a:b] = places[k][begin[a:b]], places[k][end[a:b]]
        return table[:, 0], begin, end, places_of

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; ids that spell no valid UTF-8 go through the library."""
        if not len(ids):
            return ""
        try:
            text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode()
        except (UnicodeDecodeError, IndexError):
            return self.library.decode(ids.tolist())
        return text[1:] if self.prefix and text[0] == " " and self.starts[ids[0]] else text


@functools.lru_cache(maxsize=2)
def _model(blob: bytes) -> PieceModel:
    return PieceModel(blob)


#: What ``encode_pieces`` can return of a text, besides its id.
OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32())), "begins": ("array<int>", pa.list_(pa.int32())), "ends": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()),
    "n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string()), "n_spanned": ("bigint", pa.int64()),
}
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256", "n_spanned")


def encode_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", outputs: Sequence[str] = ("ids", "begins", "ends", "decoded")) -> DataFrame:
    """Encode every whole text: its id and the chosen ``outputs``.

    ``begins`` and ``ends`` are byte offsets into the original text in UTF-8,
    ``decoded`` is the text of the ids.  ``DIGESTS`` are taken of these in the
    worker, so that long lists need not travel: the number of ids, SHA-256 of
    the decimal ids joined by commas and of the decoded text, and the byte at
    which the last span ends.  Null texts count as empty and give empty lists
    and an empty decoded text; repeated rows stay repeated; other columns are
    not carried, so none can clash.  The model file is read on the driver and
    its bytes (below 10 MB, checked) go along with the task, so executors need
    no file of their own.
    """
    blob = open(model_path, "rb").read()  # noqa: SIM115
    if len(blob) > 10_000_000:
        raise ValueError("the model file is larger than 10 MB")
    kind = pa.schema([(id_col, pa.int64()), *((o, OUTPUTS[o][1]) for o in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The system's allocator keeps less of what is freed than Arrow's own.
        pa.set_memory_pool(pa.system_memory_pool())
        model = _model(blob)
        for batch in batches:
            for part in steps(batch, 1):
                ids, begins, ends, bounds = model.encode(part.column(1))
                pairs = list(itertools.pairwise(bounds.tolist()))
                text = [model.decode(ids[a:b]) for a, b in pairs] if {"decoded", "decoded_sha256"} & set(outputs) else []

                def make(output: str, ids=ids, begins=begins, ends=ends, bounds=bounds, pairs=pairs, text=text) -> pa.Array:
                    if output in ("ids", "begins", "ends"):
                        return pa.ListArray.from_arrays(bounds.astype(np.int32), {"ids": ids, "begins": begins, "ends": ends}[output].astype(np.int32))
                    if output == "n_tokens":
                        return pa.array(np.diff(bounds))
                    if output == "n_spanned":
                        return pa.array([int(ends[b - 1]) if b > a else 0 for a, b in pairs], pa.int64())
                    if output == "ids_sha256":
                        return pa.array([hashlib.sha256(",".join(map(model.decimal.__getitem__, ids[a:b].tolist())).encode()).hexdigest() for a, b in pairs], pa.string())
                    return pa.array(text if output == "decoded" else [hashlib.sha256(t.encode()).hexdigest() for t in text], pa.string())

                yield pa.RecordBatch.from_arrays([part.column(0), *map(make, outputs)], schema=kind)
        model.memory.forget()

    schema = f"`{id_col}` bigint, {', '.join(f'{o} {OUTPUTS[o][0]}' for o in outputs)}"
    return small_batches(df).select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def piece_digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digests of every text's ids, spans and decoded text."""
    return encode_pieces(df, model_path, id_col, text_col, DIGESTS)
