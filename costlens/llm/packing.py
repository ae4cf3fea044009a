"""Operator 6: bound-certified best-fit packing.

Documents become pieces of at most ``capacity`` tokens; full pieces are sequences of their own. The others are dealt to
partitions of bounded size and packed by best-fit decreasing. Dual feasible functions give each partition a lower bound
of its number of sequences. A partition that meets its bound is certified and keeps its sequences, but for its loosest
one; the others keep only full sequences. What is released is dealt anew, to fewer partitions, and packed again,
until one partition holds it all or the rounds end. A round that does not lower the count is not taken.

Nulls: a null text is empty (only the end id); a null doc_id is kept. Repeated rows are documents of their own. A very long
text is encoded as one row and gives as many pieces as it takes; of pieces of equal size any may go first, so that plans
may differ in order but not in number. Other columns are ignored. An empty table gives no rows.
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
from .common import cut, table, text_or_empty

CAPACITY = 1024
END_ID = 2
#: Pieces that one task packs, about.
PIECES_PER_PARTITION = 100_000
ROUNDS = 8


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that ``sizes`` need at least, by two families of dual feasible functions."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(object)
    x = np.arange(capacity + 1)
    best = -(-int((count * x).sum()) // capacity)
    number, total = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * x)])
    for cutoff in range(1, capacity // 2 + 1):  # x > C - cutoff counts as C, x < cutoff as 0
        value = (number[-1] - number[capacity - cutoff + 1]) * capacity + total[capacity - cutoff + 1] - total[cutoff]
        best = max(best, -(-int(value) // capacity))
    for k in range(1, 40):  # x where (k + 1) x / C is whole stays, else floor((k + 1) x / C) / k
        whole, part = (x * (k + 1)) % capacity == 0, x * (k + 1) // capacity
        value = (count * np.where(whole, k * x, part * capacity)).sum()
        best = max(best, -(-int(value) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, and the bins' fill."""
    order = np.argsort(-sizes, kind="stable")
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fill = 0, []
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1  # the least room that is enough
            b = room[free].pop()
            if not room[free]:
                mask &= ~(1 << free)
        else:
            free, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        free -= size
        if free:
            room[free].append(b)
            mask |= 1 << free
    return bins, offsets, np.array(fill, np.int64)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents: item (unique), doc_id, piece, start, length, ids_crc32, ids (little-endian, two bytes an id
    where the vocabulary allows it, else four)."""

    def cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder.of(vocabulary)
        narrow = "<u2" if max(encoder.tokenizer.get_vocab_size(), end_id) <= 65536 else "<u4"
        item = TaskContext.get().partitionId() << 40
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(names), 500):
                rows: list[tuple] = []
                for name, ids in zip(names[at : at + 500], encoder.encode(texts.slice(at, 500).to_pylist())):
                    ids = np.append(ids, np.uint32(end_id))
                    first = len(ids) % capacity or capacity
                    for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                        part = ids[start : start + (capacity if k else first)]
                        rows.append((item, name, k, start, len(part), zlib.crc32(part.astype("<u4")), part.astype(narrow).tobytes()))
                        item += 1
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["item", "doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(cutter, "item long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def plan(items: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """Adds to ``items`` (item, length, others): sequence_id, offset, and the certificate of the partition that packed it
    last: bins, the sequences that it took, and bound, those that no packing of its pieces can do without."""
    names = items.columns
    whole = items.where(F.col("length") >= capacity).select(*names, (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("bins"), F.lit(1).cast("long").alias("bound"))
    loose, done = items.where(F.col("length") < capacity), [whole]
    count, bins = loose.count(), None

    def packer(number: int):
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
            if not rows:
                return
            # the same rows in the same order whatever order they came in, so that a task that runs again agrees
            rows = rows.sort_by("item")
            sizes = rows.column("length").to_numpy()
            at, offset, fill = best_fit_decreasing(sizes, capacity)
            bound = lower_bound(sizes, capacity)
            certified = len(fill) == bound
            kept = fill == capacity
            if certified:
                kept[:] = True
                kept[np.argmin(fill)] = fill.min() == capacity
            name = (number << 56) + (TaskContext.get().partitionId() << 32) + at
            yield from rows.append_column("sequence_id", pa.array(name)).append_column("offset", pa.array(offset)).append_column("bins", pa.array(np.full(len(at), len(fill)))).append_column("bound", pa.array(np.full(len(at), bound))).append_column("kept", pa.array(kept[at])).to_batches()

        return pack

    for number in range(1, rounds + 1):
        if not count:
            break
        parts = max(1, -(-count // per_partition)) if number == 1 else max(1, min(parts // 2, -(-count // per_partition)))
        schema = loose.select(*names).schema.add("sequence_id", "long").add("offset", "long").add("bins", "long").add("bound", "long").add("kept", "boolean")
        dealt = loose.select(*names).repartition(parts, F.xxhash64("item", F.lit(number)))
        packed = cut(dealt.mapInArrow(packer(number), schema), "packed")
        open_ = packed.where(~F.col("kept"))
        count, got = open_.agg(F.count("*"), F.count_distinct("sequence_id")).first()
        taken = packed.agg(F.count_distinct("sequence_id")).first()[0]
        if bins is not None and taken > bins:
            break
        if number > 1:
            done.pop()
        done += [packed.where("kept").drop("kept"), open_.drop("kept")]
        loose, bins = open_, got
        if parts == 1:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> tuple[DataFrame, DataFrame]:
    """The plan of all pieces, and the pieces' ids by item; ``sequences`` brings them together."""
    made = cut(pieces(docs, vocabulary, capacity, end_id), "pieces")
    return plan(made.drop("ids"), capacity), made.select("item", "ids")


def sequences(planned: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each sequence: its ids, and the documents' places in it. A sequence holds at most its capacity."""
    part = F.struct("offset", "length", "doc_id", "piece", "start", "ids")
    grouped = planned.join(ids, "item").groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda s, p: F.concat(s, p["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"))


def digest(planned: DataFrame) -> DataFrame:
    return planned.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bins", "bound")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents"), default_vocabulary())[0])
