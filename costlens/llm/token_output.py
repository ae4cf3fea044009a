"""Operator 9: token ids in patched frame-of-reference blocks.

A shard is a run of documents in ascending id order. Its file is a sequence of frames; each frame holds whole documents
of about a million ids: a header, the documents' ids and lengths, the starts of the blocks, then the blocks. A block
holds up to 128 ids as offsets from its minimum, packed at a width that a given share of them fit; the others are
stored in an exception list. Frames are rows of a Parquet table (a binary column), so that any store that Spark can
write, and its commit protocol, serve for them; a lost task writes its shard again.

Nulls: a null text is empty, a null doc_id is kept and sorts first. Rows with equal doc_id follow each other, ordered
by text. A text of more ids than a frame has a frame of its own. Other columns are ignored. An empty table gives an empty file set and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import BatchEncoder, default_vocabulary
from .common import shared_dir, table, text_or_empty

BLOCK_IDS = 128
FRAME_IDS = 1_000_000
#: Share of a block's ids that its width must fit.
PERCENTILE = 0.9
MAGIC = b"PFR1"
FRAME_SCHEMA = "shard int, frame int, ids_before long, n_docs long, n_ids long, payload binary"


def pack_frame(doc_ids: np.ndarray, absent: np.ndarray, lengths: np.ndarray, ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The bytes of one frame."""
    n = len(ids)
    n_blocks = -(-n // BLOCK_IDS)
    padded = np.empty(n_blocks * BLOCK_IDS, np.uint64)
    padded[:n] = ids
    padded[n:] = ids[-1] if n else 0
    grid = padded.reshape(n_blocks, BLOCK_IDS)
    low = grid.min(1) if n_blocks else np.zeros(0, np.uint64)
    rest = grid - low[:, None]
    bits = np.ceil(np.log2(rest.astype(np.float64) + 1)).astype(np.int64)
    width = np.sort(bits, 1)[:, min(BLOCK_IDS - 1, int(percentile * BLOCK_IDS))] if n_blocks else np.zeros(0, np.int64)
    odd = bits > width[:, None]
    packed: list[bytes] = [b""] * n_blocks
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        values = np.where(odd[rows], np.uint64(0), rest[rows])
        words = np.zeros((len(rows), 2 * w), np.uint64)
        for i in range(BLOCK_IDS if w else 0):
            at, shift = divmod(i * w, 64)
            words[:, at] |= values[:, i] << np.uint64(shift)
            if shift + w > 64:
                words[:, at + 1] |= values[:, i] >> np.uint64(64 - shift)
        for r, data in zip(rows.tolist(), words.astype("<u8")):
            packed[r] = data.tobytes()
    n_odd = odd.sum(1)
    row, column = np.nonzero(odd)
    places, values = column.astype(np.uint8).tobytes(), rest[row, column].astype("<u4").tobytes()
    done = np.concatenate([[0], np.cumsum(n_odd)]).tolist()
    head = np.empty(n_blocks, np.dtype([("low", "<u4"), ("width", "u1"), ("n_odd", "u1")]))
    head["low"], head["width"], head["n_odd"] = low, width, n_odd
    heads = head.tobytes()
    blocks = [heads[6 * i : 6 * i + 6] + packed[i] + places[a:b] + values[4 * a : 4 * b] for i, (a, b) in enumerate(zip(done, done[1:]))]
    starts = np.cumsum([0] + [len(b) for b in blocks]).astype("<u4")
    header = MAGIC + np.array([len(lengths), n, n_blocks], "<u8").tobytes()
    return b"".join([header, doc_ids.astype("<i8").tobytes(), absent.astype(np.uint8).tobytes(), lengths.astype("<u8").tobytes(), starts.tobytes(), *blocks])


class Frame:
    """Reads a frame; ``ids(a, b)`` touches only the blocks that hold the range."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a frame")
        n_docs, self.n_ids, self.n_blocks = np.frombuffer(data, "<u8", 3, 4).tolist()
        at = 28
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        self.absent = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        self.lengths = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        at += 17 * n_docs
        self.starts = np.frombuffer(data, "<u4", self.n_blocks + 1, at).astype(np.int64) + at + 4 * (self.n_blocks + 1)
        self.bytes = np.frombuffer(data, np.uint8)

    def ids(self, a: int = 0, b: int | None = None) -> np.ndarray:
        b = self.n_ids if b is None else b
        if a >= b:
            return np.zeros(0, np.uint32)
        first, last = a // BLOCK_IDS, -(-b // BLOCK_IDS)
        at = self.starts[first:last]
        head = np.ascontiguousarray(self.bytes[at[:, None] + np.arange(6)]).view(np.dtype([("low", "<u4"), ("width", "u1"), ("n_odd", "u1")]))[:, 0]
        grid = np.empty((last - first, BLOCK_IDS), np.uint64)
        for w in np.unique(head["width"]).tolist():
            rows = np.flatnonzero(head["width"] == w)
            if not w:
                grid[rows] = 0
                continue
            words = np.ascontiguousarray(self.bytes[at[rows, None] + 6 + np.arange(16 * w)]).view("<u8")
            mask = np.uint64((1 << w) - 1)
            for i in range(BLOCK_IDS):
                k, shift = divmod(i * w, 64)
                value = words[:, k] >> np.uint64(shift)
                if shift + w > 64:
                    value = value | words[:, k + 1] << np.uint64(64 - shift)
                grid[rows, i] = value & mask
        n_odd = head["n_odd"].astype(np.int64)
        row = np.repeat(np.arange(last - first), n_odd)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        place = at[row] + 6 + 16 * head["width"][row].astype(np.int64)
        value = np.ascontiguousarray(self.bytes[(place + n_odd[row] + 4 * rank)[:, None] + np.arange(4)]).view("<u4")[:, 0] if len(row) else np.zeros(0, np.uint32)
        grid[row, self.bytes[place + rank]] = value
        grid += head["low"].astype(np.uint64)[:, None]
        return grid.reshape(-1)[a - first * BLOCK_IDS : b - first * BLOCK_IDS].astype(np.uint32)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> None:
    """Writes the ids of ``docs`` (doc_id, text), each document's closed by ``end_id``, to ``path``."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = BatchEncoder.of(vocabulary), TaskContext.get().partitionId()
        waiting: list[tuple[int | None, np.ndarray]] = []
        size = frame = before = 0

        def flush() -> pa.RecordBatch:
            nonlocal waiting, size, frame, before
            names = np.array([d or 0 for d, _ in waiting], np.int64)
            payload = pack_frame(names, np.array([d is None for d, _ in waiting]), np.array([len(x) for _, x in waiting]), np.concatenate([x for _, x in waiting]))
            out = pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([frame], pa.int32()), pa.array([before], pa.int64()), pa.array([len(waiting)], pa.int64()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())], names=["shard", "frame", "ids_before", "n_docs", "n_ids", "payload"])
            waiting, frame, before, size = [], frame + 1, before + size, 0
            return out

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(names), 500):
                for name, ids in zip(names[at : at + 500], encoder.encode(texts.slice(at, 500).to_pylist())):
                    waiting.append((name, np.append(ids, np.uint32(end_id))))
                    size += len(ids) + 1
                    if size >= FRAME_IDS:
                        yield flush()
        if waiting:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(shard, FRAME_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of a file set: doc_id, start, n_tokens, ids_crc32.

    Only the shards' totals, one number for each partition that wrote, come to the driver.
    """
    frames = spark.read.schema(FRAME_SCHEMA).parquet(path)
    totals = {r["shard"]: r["n"] for r in frames.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    base, done = {}, 0
    for k in sorted(totals):
        base[k] = done
        done += totals[k]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                frame = Frame(payload.as_buffer())
                ids = frame.ids().astype("<u4")
                ends = np.cumsum(frame.lengths)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - frame.lengths).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(frame.doc_ids, mask=frame.absent), pa.array(base[shard] + before + ends - frame.lengths), pa.array(frame.lengths), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return frames.select("shard", "ids_before", "payload").mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, default_vocabulary())
    return read_tokens(spark, path)
