r"""Operator 7: SimHash near duplicates by the generalised pigeonhole principle.

Fingerprints are grouped first, so that copies cost one row. The 64 bits are cut into parts of correlated bits; part i
gets a threshold t_i (-1: not probed) with sum(t_i) = radius - parts + 1, so that fingerprints within ``radius`` bits
agree within t_i bits on some part i. Parts and thresholds come from dynamic programming over estimated candidate counts:
how many pairs agree on a part is counted over all fingerprints, so that what correlation does to a part is in its cost;
how many more differ there in one bit follows from the frequencies of its bits. Buckets of one probe are small for random fingerprints;
those above ``BUCKET`` are resolved without pairs: two fingerprints are within 2 bits just if their sets {itself and its
64 one-bit neighbours} meet, so they are linked through those neighbours, 65 rows for each fingerprint.

Words are ``[^\x20\x09-\x0D]+`` after lower-casing A-Z; a document of fewer words than a shingle has one shingle, its
whole sequence, and one without words the fingerprint zero, linked like any other.

Nulls: a null text has no words, a null doc_id is kept, links like any other row and is never the least of a component
that has another id. Repeated rows are rows of their own, of which ``one_of_each`` keeps one; ties go to the least text
hash. A very long text is one fingerprint, made in pieces. Other columns are kept by ``one_of_each``, whatever their names,
and ignored by the query. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen_rows, cut, lower_words, table, text_or_empty, unused
from .components import components

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
#: Fingerprints of one bucket that are compared pair by pair.
BUCKET = 128
#: Cost of a row in the shuffle, in candidate pairs.
ROW_COST = 20


def fingerprint(listed: list[bytes], shingle: int = SHINGLE) -> int:
    """Bits set in over half the shingles' hashes, as a signed 64-bit number."""
    if not listed:
        return 0
    joined = b" ".join(listed)
    n = max(1, len(listed) - shingle + 1)
    if n == 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, listed), np.int64, len(listed))
        stops = np.cumsum(sizes + 1) - 1
        starts = (stops - sizes)[:n].tolist()
        hash_of = xxhash.xxh64_intdigest
        hashes = [hash_of(joined[a:b], SEED) for a, b in zip(starts, stops[shingle - 1 :].tolist())]
    count = np.zeros(BITS, np.int64)
    data = np.array(hashes, ">u8").view(np.uint8).reshape(n, 8)
    for at in range(0, n, 50_000):
        count += np.unpackbits(data[at : at + 50_000], axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n).view(">i8")[0])


def with_fingerprint(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``fp``, the fingerprint of column ``text``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(lower_words(t), shingle) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=[*keep, "fp"])

    return docs.select(*keep, text_or_empty().alias(unused("text", keep))).mapInArrow(measure, docs.select(*keep).schema.add("fp", "long"))


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each two bits how many have both: 64 x 64 numbers from each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy()).astype(np.float32)
            n, both = n + len(bits), both + bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS)), pa.array(np.full(BITS, n)), pa.array(list(both.astype(np.int64)))], names=["bit", "n", "both"])

    summed = [F.sum(F.col("both")[i]).alias(f"b{i}") for i in range(BITS)]
    rows = prints.select("fp").mapInArrow(count, "bit long, n long, both array<long>").groupBy("bit").agg(F.sum("n").alias("n"), *summed).orderBy("bit").collect()
    if not rows:
        return 0, np.zeros((BITS, BITS))
    return int(rows[0]["n"]), np.array([[r[f"b{i}"] for i in range(BITS)] for r in rows], float)


def bits_of(prints: np.ndarray) -> np.ndarray:
    """Bit k of column k, the lowest first."""
    return np.unpackbits(prints.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def parts_of(n: int, both: np.ndarray, number: int) -> list[list[int]]:
    """Bits in ``number`` parts of nearly equal size, each grown from a free bit by the most correlated ones."""
    if not n:
        return [list(range(k, BITS, number)) for k in range(number)]
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs((both / n - np.outer(p, p)) / np.outer(spread, spread))
    free, out = set(range(BITS)), []
    for k in range(number):
        part = [max(sorted(free), key=lambda b: tie[b, sorted(free)].sum())]
        free.discard(part[0])
        while len(part) < (BITS + k) // number and free:
            best = max(sorted(free), key=lambda b: tie[b, part].sum())
            part.append(best)
            free.discard(best)
        out.append(sorted(part))
    out[-1] = sorted(out[-1] + list(free))
    return out


def agreeing(prints: DataFrame, parts: list[list[int]]) -> list[float]:
    """Pairs of fingerprints that have the same value of each part, counted over all."""
    values = F.array(*(F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_masked(part))).alias("key")) for k, part in enumerate(parts)))
    times = prints.select(F.explode(values).alias("v")).groupBy("v.part", "v.key").agg(F.count("*").cast("double").alias("n"))
    found = {r["part"]: r["pairs"] for r in times.groupBy("part").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect()}
    return [found.get(k, 0.0) for k in range(len(parts))]


def predicted(n: int, p: np.ndarray, part: list[int], most: int, same: float | None = None) -> list[float]:
    """Cost of probing ``part`` with thresholds -1, 0, .., most: rows, and pairs that agree within the threshold. ``same``
    pairs agree on it; the others are as many more as if bits were set with their own frequencies."""
    differ = 2 * p[part] * (1 - p[part])
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for q in differ:  # chance of differing in k bits of the part
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    if same is not None:
        chance *= same / max(1e-300, n * n / 2 * chance[0])
    out, rows = [0.0], 1.0
    for t in range(most + 1):
        if t:
            rows *= (len(part) - t + 1) / t
        out.append(n * n / 2 * float(chance[: t + 1].sum()) + ROW_COST * n * (1 + rows * (t > 0)))
    return out


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (-1 at least) of least summed cost with the given sum, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (c, ts) in best.items():
            for t in range(-1, len(cost) - 1):
                new = (c + cost[t + 1], [*ts, t])
                if done + t not in step or new < step[done + t]:
                    step[done + t] = new
        best = step
    return best[total]


def scheme(n: int, both: np.ndarray, radius: int = RADIUS, count=None) -> list[tuple[list[int], int]]:
    """Parts to probe and their thresholds; ``count`` gives the agreeing pairs of a list of parts."""
    p = np.diag(both) / max(n, 1)
    choices = [parts_of(n, both, number) for number in range(radius, radius + 4)]
    same = iter(count([part for parts in choices for part in parts]) if count else [])
    options = []
    for parts in choices:
        cost, ts = allocate([predicted(n, p, part, min(1, radius), next(same, None)) for part in parts], radius - len(parts) + 1)
        options.append((cost, len(parts), [(part, t) for part, t in zip(parts, ts) if t >= 0]))
    return min(options, key=lambda o: o[:2])[2]


def _masked(part: list[int]) -> int:
    value = sum(1 << b for b in part)
    return value - (1 << 64) if value >> 63 else value


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def probes(prints: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """Rows (part, key, fp, own): own value of the part for each fingerprint, and for threshold 1 its one-bit variants."""
    rows = []
    for k, (part, t) in enumerate(parts):
        own = F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_masked(part))).alias("key"), F.lit(True).alias("own"))
        rows.append(own)
        if t == 1:
            rows += [F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_masked(part))).bitwiseXOR(F.lit(_signed(1 << b))).alias("key"), F.lit(False).alias("own")) for b in part]
    return prints.select("fp", F.explode(F.array(*rows)).alias("p")).select("p.*", "fp")


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join just those within ``radius`` bits, directly or through
    vertices that are not fingerprints of the table; ``prints``: fp, distinct."""
    if radius != 2:
        raise ValueError("the way around hot buckets is for radius 2")
    n, both = bit_statistics(prints)
    if n < 2:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    rows = cut(probes(prints, scheme(n, both, radius, lambda parts: agreeing(prints, parts))), "probes")
    counts = rows.groupBy("part", "key").agg(F.count("*").alias("n"))
    cold = rows.join(counts.where((F.col("n") > 1) & (F.col("n") <= bucket)), ["part", "key"])
    hot = rows.join(counts.where(F.col("n") > bucket), ["part", "key"]).select("fp").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values, cuts = lists.flatten().to_numpy(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            a, b = [], []
            sizes = np.diff(cuts)
            for size in np.unique(sizes).tolist():  # buckets of one size at once
                at = cuts[:-1][sizes == size]
                i, j = np.triu_indices(size, 1)
                step = max(1, 2_000_000 // len(i))
                for k in range(0, len(at), step):
                    grid = values[at[k : k + step, None] + np.arange(size)]
                    x, y = grid[:, i].ravel(), grid[:, j].ravel()
                    near = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
                    near &= x != y
                    a.append(x[near])
                    b.append(y[near])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in (a, b)], names=["a", "b"])

    found = cold.groupBy("part", "key").agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(verify, "a long, b long")
    around = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(BITS)))
    near = hot.select(F.col("fp").alias("a"), F.explode(around).alias("hub"))
    # of the neighbours only those that two fingerprints share link anything; each links its fingerprints to the least
    least = near.groupBy("hub").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    through = near.join(least, "hub").where("a <> b").select("a", "b")
    return found.unionByName(through).distinct()


def grouped(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Columns ``keep`` (doc_id among them) and fp of each row of ``docs``; and ``groups`` of these."""
    rows = cut(with_fingerprint(docs, keep, shingle), "fingerprints")
    return rows, groups(rows)


def groups(rows: DataFrame) -> DataFrame:
    """Of each fingerprint of ``rows`` (fp, doc_id) its component, a fingerprint, and the least doc_id that the component
    reaches."""
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = cut(components(links(prints.select("fp"))), "components")
    members = found.withColumnRenamed("vertex", "fp").join(prints, "fp")
    ids = members.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = members.join(ids, "component").select("fp", "component", "component_id")
    known = prints.join(linked, "fp", "left")
    return known.select("fp", F.coalesce("component", "fp").alias("component"), F.coalesce("component_id", "least").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each component: that of least doc_id, of equal ones that of least text hash."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("row"), "text")
    rows, known = grouped(named, ["doc_id", "row"], shingle)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    chosen = rows.join(known, "fp").groupBy("component").agg(best).select("best.*")
    return chosen_rows(docs, chosen)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, known = grouped(docs, ["doc_id"])
    out = rows.join(known, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
