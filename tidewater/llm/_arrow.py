"""Arrow helpers for operators that work on batches of texts inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once by a task; bounds its memory whatever the number of rows in a batch.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of at most ``rows`` rows with about ``most`` bytes of text each (one row at least); nulls
    become empty texts."""
    at = batch.schema.get_field_index(text)
    column = batch.column(at)
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = size[first - 1] if first else 0
        last = min(first + rows, max(first + 1, int(np.searchsorted(size, before + most, "right"))))
        own = column.slice(first, last - first).cast(pa.large_string())
        if own.null_count:
            own = pa.array([x or "" for x in own.to_pylist()], pa.large_string())
        raw, offs = text_bytes(own)  # an array of its own: some kernels mistake the offsets of a slice
        own = pa.LargeStringArray.from_buffers(len(own), pa.py_buffer(offs), pa.py_buffer(raw))
        yield batch.slice(first, last - first).set_column(at, text, own)
        first = last
    give_back()


def give_back() -> None:
    """Return this worker's free memory to the system. Spark keeps workers from task to task; else each would hold the
    most that any of its tasks took, beside the memory of the executor itself."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string column without nulls, and where each text begins (one more at the end)."""
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def white(raw: np.ndarray) -> np.ndarray:
    """Which bytes are one of space, \\t \\n \\v \\f \\r."""
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word (run of bytes that aren't white space), and how many words each text has."""
    solid = ~white(raw)
    edge = np.zeros(len(raw) + 1, bool)
    edge[offs] = True  # a text's end ends a word
    before = np.empty(len(raw), bool)
    if len(raw):
        before[0] = False
        before[1:] = solid[:-1]
        before[edge[:-1]] = False
    begins = np.flatnonzero(solid & ~before)
    after = np.zeros(len(raw), bool)
    if len(raw):
        after[:-1] = solid[1:]
        after[edge[1:]] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return begins, ends, np.diff(np.searchsorted(begins, offs))


def strings(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The pieces raw[begins[i]:ends[i]], which ascend and don't overlap, as a large_binary array."""
    lengths = ends - begins
    offs = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(lengths, out=offs[1:])
    if not len(begins):
        return pa.array([], pa.large_binary())
    step = np.zeros(len(raw) + 1, np.int8)
    step[begins] += 1
    step[ends] -= 1
    kept = raw[np.cumsum(step[:-1], dtype=np.int8).view(bool)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offs), pa.py_buffer(kept)])


def ascending(values: np.ndarray) -> np.ndarray:
    """The distinct values in order."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values
