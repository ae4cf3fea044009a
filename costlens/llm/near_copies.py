r"""Near duplicates of the pipeline: SimHash links (``simhash``: fingerprints at 2 or fewer differing bits), and documents
whose sets of five-word shingles have Jaccard similarity 0.8 at least. Components go over both.

The second kind is what SimHash does not see: texts of similarity 0.8 differ in about ten of 64 bits, and a radius wide
enough for nearly all of them leaves parts too short to tell fingerprints apart. That join is exact, by prefixes (see
``set_join``): in one order of all shingles, two such sets share one of their first n - ceil(0.8 n) + 1. The order is by hash; shingles of very
many documents go last, as a table of ``CELLS`` counts over all documents tells (its size is fixed; shingles that share a
cell with others are only taken for more frequent than they are). Tasks return what they find as links of a spanning
forest of their similar sets, never as pairs.

Words are as in ``simhash``, known by 64-bit hashes; a text of fewer words than a shingle has one, its whole sequence.
Texts of equal sets (by a 64-bit hash) count once. A very long text is one set. Nulls, repeated rows, ties, an empty table
and clashing column names: as in ``simhash.one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blobs, set_join, simhash
from .common import blocks, chosen_rows, cleaned, cut, drop, lower_words, text_or_empty
from .components import components
from .set_join import ROW, TOP, UNDER, row_batch, taken, unpack
from .word_hash import ascending, mixed, pieces, text_words

SHINGLE = 5
#: Counts of shingles, and counts that go in one row of a shuffle.
CELLS, RANGE = 1 << 22, 1 << 16
#: A cell is frequent above this many times the mean and this count; from there on classes are powers of two.
OVER, LEAST = 2, 4
FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(SHINGLE)], np.uint64)


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    for a, b in pieces(data):
        h, counts = text_words(data[a:b], lower=True)
        n = max(0, len(h) - SHINGLE + 1)
        rolled = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            rolled += h[k : k + n] * FACTORS[k]
        rolled, end = mixed(rolled), 0
        for count in counts.tolist():
            start, end = end, end + count
            if count >= SHINGLE:
                yield ascending(rolled[start : end - SHINGLE + 1])
            else:
                yield mixed(np.array([(h[start:end] * FACTORS[:count]).sum(dtype=np.uint64)]) + np.uint64(count + 1))


def name_of(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes())


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, row, of the text's set the name s, and the text's SimHash fingerprint fp."""

    @blobs.lean
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blobs.small(batches):
            texts = b.column(2).to_pylist()
            names = np.array([name_of(found) for found in shingle_sets(texts)], np.uint64).view(np.int64)
            prints = [simhash.fingerprint(lower_words(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.int64()), pa.array(prints, pa.int64())], names=["doc_id", "row", "s", "fp"])

    return docs.select("doc_id", "row", "text").mapInArrow(measure, "doc_id long, row long, s long, fp long")


def cell_of(found: np.ndarray) -> np.ndarray:
    return (found & np.uint64(CELLS - 1)).astype(np.int64)


def frequent(docs: DataFrame, parts: int) -> bytes:
    """For each cell a byte: zero, or how much more often than others its shingles are found, as a power of two."""

    @blobs.lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(CELLS, np.int64)
        for b in blobs.small(batches):
            found = list(shingle_sets(b.column(0).to_pylist()))
            np.add.at(times, cell_of(np.concatenate(found)), 1)
        for k in range(0, CELLS, RANGE):
            if times[k : k + RANGE].any():
                yield row_batch([(0, k // RANGE, 0, blobs.packed(times[k : k + RANGE]))])

    @blobs.lean
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for target, data in zip(b.column(1).to_pylist(), b.column(3)):
                sums[target] = sums.get(target, 0) + blobs.unpacked(data.as_buffer())
        yield row_batch([(0, k, 0, blobs.packed(v)) for k, v in sums.items()])

    rows = docs.select("text").mapInArrow(count, ROW).repartitionById(min(parts, CELLS // RANGE), F.pmod("target", F.lit(min(parts, CELLS // RANGE))).cast("int")).mapInArrow(add, ROW)
    total = np.zeros(CELLS, np.uint64)
    with cleaned(docs.sparkSession):
        rows = rows.select("target", "data").collect()  # CELLS counts, whatever the input
    for r in rows:
        total[r["target"] * RANGE : (r["target"] + 1) * RANGE] = blobs.unpacked(bytes(r["data"]))
    most = max(LEAST, OVER * int(total.sum()) / CELLS)
    return np.ceil(np.log2(np.maximum(total.astype(float) / most, 1))).astype(np.uint8).tobytes()


class Order:
    """Shingles of a set in the one order of all."""

    def __init__(self, table: bytes):
        self.late = np.frombuffer(table, np.uint8)

    def of(self, found: np.ndarray) -> np.ndarray:
        late = self.late[cell_of(found)]
        return found[np.argsort(late, kind="stable")] if late.any() else found


def _posts(table, parts: int):
    @blobs.lean
    def posts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(table.value)
        for b in blobs.small(batches):
            columns: dict[str, list] = {k: [] for k in ("cell", "prev", "name", "lead", "second", "bits", "size")}
            for found in shingle_sets(b.column(0).to_pylist()):
                n = len(found)
                length = n - -(-TOP * n // UNDER) + 1
                if n < UNDER - 1:
                    continue
                own = order.of(found)[:length]
                columns["cell"].append(mixed(own) >> np.uint64(16))  # sets meet at low hashes, so buckets must not go by them
                columns["prev"].append(np.append(np.uint64(0), own[:-1] >> np.uint64(24)))
                columns["size"].append((n, length))
                columns["lead"].append(own[0] >> np.uint64(24))
                columns["second"].append(own[1] >> np.uint64(24) if length > 1 else 0)
                columns["name"].append(name_of(found))
                columns["bits"].append(np.bitwise_xor.reduce(np.left_shift(np.uint64(1), mixed(found) >> np.uint64(58))))
            if not columns["size"]:
                continue
            n, length = np.array(columns["size"], np.int64).T
            each = lambda v: np.repeat(np.array(v, np.uint64), length)
            zero = np.zeros(length.sum(), np.uint64)
            rows = {k: np.concatenate(columns[k]) for k in ("cell", "prev")} | {"name": each(columns["name"]), "size": each(n)} | {k: each(columns[k]) for k in ("lead", "second", "bits")}
            rows["place"] = (np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)).astype(np.uint64)
            rows |= dict.fromkeys(("item", "none", "doc", "line", "side"), zero)
            yield row_batch([(0, k, 0, set_join.sent_posts(taken(rows, x))) for k, x in set_join.by_bucket(rows["cell"], parts)])

    return posts


def _sets(table, parts: int):
    @blobs.lean
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(table.value)
        for b in batches:
            for found, told in zip(shingle_sets(b.column(0).to_pylist()), b.column(1).to_pylist()):
                rows = set_join.read_alive(told)
                yield row_batch(set_join.sent_sets(rows, np.zeros(len(rows["cell"]), np.int64), order.of(found), np.array([len(found)]), parts))

    return sets


@blobs.lean
def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = [unpack(data.as_buffer()) for b in batches for data in b.column(3)]
    if not found:
        return
    v = set_join.Verifier(found)
    names, label = v.rows["name"].view(np.int64), v.labels()
    linked = label != np.arange(len(label))
    yield pa.RecordBatch.from_arrays([pa.array(names[linked]), pa.array(names[label[linked]])], names=["a", "b"])


def same_print(names: DataFrame) -> DataFrame:
    """Links (a, b) that join the sets whose fingerprints are of one SimHash component, each to the least of them."""
    members = names.join(simhash.groups(names).select("fp", "component"), "fp").select("component", "s").distinct()
    least = members.groupBy("component").agg(F.min("s").alias("b"))
    return members.join(least, "component").where("s <> b").select(F.col("s").alias("a"), "b")


def similar(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Links (a, b) of a forest over the similar sets; ``docs``: doc_id, row, text; ``names``: ``signed``."""
    spark, parts = docs.sparkSession, blocks(docs)
    table = spark.sparkContext.broadcast(frequent(docs, parts))
    tables: list[DataFrame] = []

    def keep(frame: DataFrame, name: str) -> DataFrame:
        tables.append(cut(frame, name))
        return tables[-1]

    told = set_join.alive(docs.select("text").mapInArrow(_posts(table, parts), ROW), parts, keep, by_name=True)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    where = names.join(told.withColumnRenamed("block", "s"), "s").groupBy("s").agg(best, F.first("told").alias("told")).select(F.col("best.doc_id").alias("doc"), F.col("best.row").alias("row"), "told")
    texts = docs.alias("t").join(where.alias("w"), F.col("t.doc_id").eqNullSafe(F.col("w.doc")) & (F.col("t.row") == F.col("w.row"))).select("t.text", "w.told")
    sets = texts.mapInArrow(_sets(table, parts), ROW).repartitionById(parts, F.col("target").cast("int"))
    links = cut(sets.mapInArrow(_link, "a long, b long"), "near")
    for done in tables:
        drop(done)
    return links


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of near duplicates: that of least doc_id, of equal ones that of least text hash."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("row"), text_or_empty().alias("text"))
    names = cut(signed(named), "sets")
    links = same_print(names).unionByName(similar(named, names))
    known = components(links).select(F.col("vertex").alias("s"), "component")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    chosen = names.join(known, "s", "left").groupBy(F.coalesce("component", "s").alias("c")).agg(best).select("best.*")
    return chosen_rows(docs, chosen)
