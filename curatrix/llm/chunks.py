"""Chunks of a batch of texts, each distinct one worked on once.

Arrow hashes the chunks of a batch, so that per-chunk work in Python is done
for the distinct ones only, and what was found travels back to all places by
one gather.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that one step of a batch holds, in bytes; a longer text is a step of its own.
STEP_BYTES = 1 << 20
STEP_ROWS = 512
#: Bytes in each of the two generations of what a worker remembers, with what Python adds to each entry.
MEMORY_BYTES = 12 << 20
ENTRY_BYTES = 180
#: Longer chunks are not remembered.
LONGEST = 256


def steps(batch: pa.RecordBatch, column: int, most: int | None = None, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with at most ``most`` bytes (``STEP_BYTES``) of text in ``column`` and ``rows`` rows (``STEP_ROWS``), or a single row."""
    most, rows = most or STEP_BYTES, rows or STEP_ROWS
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + most, side="right"))))
        yield batch.slice(at, end - at)
        at = end


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins and the last ends; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    raw = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]] if len(bounds) else raw[:0], bounds - bounds[0]


def release() -> None:
    """Give memory that Python and Arrow no longer use back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


class ChunkMemory:
    """What is known of chunks, in two generations of bounded size."""

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], most: int | None = None):
        self.learn, self.most = learn, MEMORY_BYTES if most is None else most
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    def values(self, keys: list[bytes]) -> list[bytes]:
        """The value of each of the distinct keys; those of unknown ones are asked for in one call."""
        out = list(map(self.young.get, keys))
        missing = [i for i, v in enumerate(out) if v is None]
        if not missing:
            return out
        names = [keys[i] for i in missing]
        found = list(map(self.old.get, names))
        if unknown := [k for k, v in zip(names, found, strict=True) if v is None]:
            learnt = iter(self.learn(unknown))
            found = [next(learnt) if v is None else v for v in found]
        for i, v in zip(missing, found, strict=True):
            out[i] = v
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0
        new = {k: v for k, v in zip(names, found, strict=True) if len(k) <= LONGEST}
        self.young.update(new)
        self.size += ENTRY_BYTES * len(new) + sum(map(len, new)) + sum(map(len, new.values()))
        return out

    def forget(self) -> None:
        """Leave nothing in a worker that waits for its next task."""
        self.young, self.old, self.size = {}, {}, 0
        release()

    def gather(self, raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all chunks of ``raw`` that begin at ``cuts``, one after the other, and the bounds of each chunk's."""
        if not len(cuts):
            return np.zeros(0, np.uint8), np.zeros(1, np.int64)
        bounds = pa.py_buffer(np.append(cuts, len(raw)).astype(np.int64))
        coded = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, bounds, pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        values = pa.array(self.values(coded.dictionary.to_pylist()), pa.large_binary())
        return joined(values.take(coded.indices))
