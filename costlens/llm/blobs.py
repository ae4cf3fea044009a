"""Packed arrays in shuffle rows.

Counting distinct keys of a corpus by rows costs about 40 bytes a key in a shuffle. Here a task sorts its block's
distinct keys and sends each reducer one row that holds its slice of them as packed arrays, at six to nine bytes a key;
the reducer answers with totals in the order of the question, about a byte a key. Rows are (kind, target, origin, and
four binary columns); ``repartitionById`` takes a row to the partition that ``target`` names.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "kind int, target int, origin int, a binary, b binary, c binary, d binary"
NAMES = ["kind", "target", "origin", "a", "b", "c", "d"]
KINDS = [pa.int32()] * 3 + [pa.binary()] * 4


#: Rows of a batch of texts that are worked on at once.
ROWS = 500


def lean(function: Callable) -> Callable:
    """A function of batches that gives a worker's free memory back to the machine when its task ends; workers are reused,
    and what one task's arrays took would else add to the next one's."""

    @functools.wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            libc = ctypes.CDLL(None)
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return run


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


#: Numbers of so many bytes as one or two fields of bytes that a processor moves at once; two of them overlap.
FIELDS = {w: [(0, n)] if w == n else [(0, n), (w - n, n)] for w, n in zip(range(1, 9), (1, 2, 2, 4, 4, 4, 4, 8))}
LAYOUT = {w: np.dtype({"names": [f"at{a}" for a, _ in f], "formats": [f"<u{n}" for _, n in f], "offsets": [a for a, _ in f], "itemsize": w}) for w, f in FIELDS.items()}


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers at the least whole number of bytes."""
    data = np.ascontiguousarray(values, "<u8")
    width = (int(data.max()).bit_length() + 7) // 8 if len(data) else 0
    out = np.empty(len(data) if width else 0, LAYOUT[width or 1])
    if width:
        for a, _ in FIELDS[width]:
            out[f"at{a}"] = data >> np.uint64(8 * a) if a else data
    return bytes([width]) + len(data).to_bytes(8, "little") + out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    if not width:
        return np.zeros(n, np.uint64)
    rows = np.frombuffer(data, LAYOUT[width], n, 9)
    out = rows["at0"].astype("<u8")
    for a, _ in FIELDS[width][1:]:
        out |= rows[f"at{a}"].astype("<u8") << np.uint64(8 * a)
    return out


def steps(ascending: np.ndarray) -> bytes:
    """An ascending array, as differences."""
    return packed(np.diff(ascending, prepend=ascending[:1] * 0))


def unstepped(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], names=NAMES) if rows else pa.RecordBatch.from_arrays([pa.array([], t) for t in KINDS], names=NAMES)


def to_target(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartitionById(parts, F.col("target"))


def bucket_of(key: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Bucket of keys of so many bits, ascending with the key."""
    return ((key >> np.uint64(bits - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def slices(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, start, stop) of each run in an ascending array."""
    cut = np.flatnonzero(np.diff(bucket)) + 1
    edge = np.concatenate([[0], cut, [len(bucket)]]).tolist() if len(bucket) else [0]
    return [(int(bucket[a]), a, b) for a, b in zip(edge, edge[1:])]
