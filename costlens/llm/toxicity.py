"""Operator 12: toxicity by the nearest labelled examples.

Examples are at most ``LABELLED`` labelled rows, chosen by a hash; labels of held-out rows (crc32 of doc_id mod 5 is 0) are
never read. Terms are words and beginnings of words (``lexicon.terms``) that the examples' toxic texts hold more often than
chance allows: a count ``ASSOCIATED`` standard deviations above what the term's rate would give. All documents are
vectors of these terms' TF-IDF, with document frequencies counted over the whole corpus.

Cosines are exact. Examples with the same vector are one entry of an inverted index, whose entries are in blocks; for each
term and block the index has the greatest weight, and a query reads a block only if the sum of these bounds reaches the
``NEAREST``-th cosine found so far. The nearest entries vote, each with its examples' labels, weighted by distance. Votes
of the examples themselves, each without its own label, are calibrated by isotonic regression. A text without any term
meets no example by cosine; its neighbours are the examples without terms.

Nulls: a null text is empty; a row without doc_id is held out, a label without doc_id or value teaches nothing. Repeated rows
are scored each by itself and teach once for each label; of rows with the same doc_id the greatest text teaches. Texts of
any length are read whole. Ties in cosine fall to the earlier entry, by terms. Without labels every score is 0. An empty
table has no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blobs, lexicon
from .common import cut, drop, table, text_or_empty

#: Labelled rows that teach, at most.
LABELLED = 20_000
#: Toxic examples that hold a term at least, and how far their count is above chance, in standard deviations.
LEAST, ASSOCIATED = 3, 5.0
#: Entries that vote; what is added to a distance; weight of the examples' overall rate in a vote.
NEAREST, NEAR, PRIOR = 15, 0.05, 1.0
#: Entries of a block, and blocks that are read at once.
BLOCK, WAVE = 64, 8
#: Words or vectors that a task remembers.
REMEMBERED = 100_000
#: Share of the vote itself in a score, so that equal calibrated rates keep the order of their votes.
ORDER = 0.01
NEIGHBOURS = "array<struct<doc_id:bigint,cosine:double,n:bigint,n_toxic:bigint>>"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def examples_of(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, bad and text of at most ``limit`` labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("bad")).where("doc_id IS NOT NULL AND bad IS NOT NULL")
    known = known.where(~held_out()).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "bad").limit(limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return rows.groupBy("doc_id", "bad").agg(F.max("text").alias("text"))


def vocabulary(taught: DataFrame) -> list[str]:
    """Terms of toxic texts, from rows (bad, text); sorted."""
    counts = taught.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")).first()
    if not counts["n"] or not counts["bad"]:
        return []
    rate = counts["bad"] / counts["n"]
    held = lexicon.counted(taught)
    holders = F.col("bad") + F.col("others")
    above = F.col("bad") - holders * rate
    found = held.where((F.col("bad") >= LEAST) & (above >= ASSOCIATED * F.sqrt(holders * (rate * (1 - rate)))) & (above > 0))
    return sorted(r["term"] for r in found.select("term").collect())  # of at most ``LABELLED`` texts


def term_counter(terms: list[str]) -> Callable[[str], list[tuple[int, int]]]:
    """(term, count) of a text, ascending."""
    number = {t: i for i, t in enumerate(terms)}
    heads = {t.rstrip()[: lexicon.BEGINNINGS[0]] for t in terms}
    memory: dict[str, tuple[int, ...]] = {}
    head = lexicon.BEGINNINGS[0]

    def count(text: str) -> list[tuple[int, int]]:
        words = Counter(w for w in lexicon.WORD.findall(text.lower()) if w[:head] in heads)
        if len(memory) > REMEMBERED:
            memory.clear()
        found: Counter[int] = Counter()
        for word, n in words.items():
            if word not in memory:
                memory[word] = tuple(number[t] for t in lexicon.terms(word) if t in number)
            for t in memory[word]:
                found[t] += n
        return sorted(found.items())

    return count


def counted_terms(rows: DataFrame, terms: list[str]) -> DataFrame:
    """``rows`` with arrays terms and counts in place of the last column, text."""
    kept = rows.drop("text")
    names = [*kept.columns, "terms", "counts"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    @blobs.lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = term_counter(terms)
        for batch in blobs.small(batches):
            found = [counter(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [pa.array([[p[k] for p in f] for f in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=names)

    return rows.select(*kept.columns, "text").mapInArrow(count, f"{schema}, terms array<int>, counts array<int>")


@dataclass
class Index:
    """Entries in blocks, their postings by term, and each term's greatest weight in each block that has it."""

    idf: np.ndarray
    entries: list[tuple[int, int, int]]  #: examples, toxic ones, least doc_id
    nothing: tuple[int, int]  #: examples without terms, toxic ones
    every: tuple[int, int]  #: all examples, toxic ones
    first: np.ndarray  #: of each term: where its cells begin; one more at the end
    block: np.ndarray  #: of each cell
    most: np.ndarray
    start: np.ndarray  #: of each cell: where its postings begin; one more at the end
    entry: np.ndarray  #: of each posting
    weight: np.ndarray
    place: dict[bytes, int]  #: of a vector, among the entries

    @classmethod
    def of(cls, rows: list[tuple], idf: np.ndarray) -> Index:
        """``rows``: terms, counts, examples, toxic ones, least doc_id; vectors are distinct."""
        nothing = next(((n, bad) for terms, _, n, bad, _ in rows if not terms), (0, 0))
        made = [(weights(np.array(t, np.int64), np.array(c), idf), np.array(t, np.int64), vector_key(t, c), (n, bad, doc)) for t, c, n, bad, doc in rows if t]
        # texts that share their weightiest terms are in the same blocks
        made.sort(key=lambda m: ([int(m[1][i]) for i in np.lexsort((m[1], -m[0]))], m[2]))
        sizes = [len(m[1]) for m in made]
        term = np.concatenate([m[1] for m in made] or [np.zeros(0, np.int64)])
        weight = np.concatenate([m[0] for m in made] or [np.zeros(0)])
        entry = np.repeat(np.arange(len(made)), sizes)
        by = np.lexsort((entry, term))
        term, weight, entry = term[by], weight[by], entry[by]
        cell = term * (len(made) // BLOCK + 1) + entry // BLOCK
        start = np.flatnonzero(np.diff(cell, prepend=-1))
        most = np.maximum.reduceat(weight, start) if len(start) else np.zeros(0)
        first = np.searchsorted(term[start], np.arange(len(idf) + 1))
        every = (sum(r[2] for r in rows), sum(r[3] for r in rows))
        return cls(idf, [m[3] for m in made], nothing, every, first, entry[start] // BLOCK, most, np.append(start, len(entry)), entry, weight, {m[2]: i for i, m in enumerate(made)})

    def nearest(self, terms: np.ndarray, w: np.ndarray, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` entries of greatest cosine and these, in order; equal ones by place. Cosines above 0 only."""
        cells = spans(self.first[terms], self.first[terms + 1])
        of = np.repeat(w, self.first[terms + 1] - self.first[terms])
        bound = np.bincount(self.block[cells], of * self.most[cells], minlength=len(self.entries) // BLOCK + 1)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found, cosine = np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(order), WAVE):
            if len(found) == k and bound[order[at]] < cosine[-1] - 1e-9:
                break  # no entry of the blocks that are left reaches the k-th
            wave = np.zeros(len(bound), bool)
            wave[order[at : at + WAVE]] = True
            here = wave[self.block[cells]]
            a, b = self.start[cells[here]], self.start[cells[here] + 1]
            postings = spans(a, b)
            ids, of_id = np.unique(self.entry[postings], return_inverse=True)
            scores = np.bincount(of_id, np.repeat(of[here], b - a) * self.weight[postings])
            found, cosine = np.append(found, ids), np.append(cosine, np.minimum(scores, 1.0))
            best = np.lexsort((found, -cosine))[:k]
            found, cosine = found[best], cosine[best]
        return found, cosine

    def vote(self, terms: list[int], counts: list[int], own: int | None = None) -> tuple[float, list[tuple]]:
        """The vote, and its evidence. ``own``: the label (0, 1) of an example that is not to vote for itself."""
        total, toxic = self.every
        rate = (toxic - (own or 0)) / max(1, total - (own is not None))
        if not terms:
            n, bad = self.nothing
            return (bad - (own or 0) + PRIOR * rate) / (n - (own is not None) + PRIOR), []
        t = np.array(terms, np.int64)
        found, cosine = self.nearest(t, weights(t, np.array(counts), self.idf))
        me = self.place.get(vector_key(terms, counts)) if own is not None else None
        over = under = 0.0
        for i, c in zip(found.tolist(), cosine.tolist()):
            n, bad, _ = self.entries[i]
            w = 1 / (1 - c + NEAR)
            over += w * (bad - (own or 0) * (i == me))
            under += w * (n - (i == me))
        seen = [(self.entries[i][2], c, *self.entries[i][:2]) for i, c in zip(found.tolist(), cosine.tolist())]
        return (over + PRIOR * rate) / (under + PRIOR), seen


def vector_key(terms: list[int], counts: list[int]) -> bytes:
    return np.array([terms, counts], "<i4").tobytes()


def weights(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * idf[terms]
    return w / math.sqrt(float(w @ w))


def spans(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one after another."""
    size = stop - start
    if not size.sum():
        return np.zeros(0, np.int64)
    return np.repeat(stop - np.cumsum(size), size) + np.arange(size.sum())


def isotonic(votes: np.ndarray, bad: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (vote, rate) of the non-decreasing rates that fit best; ``n`` examples have the vote, ``bad`` of them toxic."""
    pools: list[list[float]] = []
    for i in np.argsort(votes, kind="stable"):
        pools.append([votes[i] * n[i], bad[i], n[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def votes_of(rows: DataFrame, index: Index) -> DataFrame:
    """vote and neighbours of rows with terms and counts, in place of these."""
    kept = rows.drop("terms", "counts")
    names = [*kept.columns, "vote", "neighbours"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("n", pa.int64()), ("n_toxic", pa.int64())]))

    @blobs.lean
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, tuple[float, list]] = {}
        for batch in batches:
            found = []
            for terms, counts in zip(*(batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))):
                key = vector_key(terms, counts)
                if key not in memory:
                    if len(memory) > REMEMBERED // 10:
                        memory.clear()
                    vote, seen = index.vote(terms, counts)
                    memory[key] = vote, [dict(zip(("doc_id", "cosine", "n", "n_toxic"), s)) for s in seen]
                found.append(memory[key])
            columns = [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=names)

    return rows.select(*kept.columns, "terms", "counts").mapInArrow(judge, f"{schema}, vote double, neighbours {NEIGHBOURS}")


def own_votes(entries: DataFrame, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Calibration knots, from each example's vote without its own label. ``entries``: terms, counts, n, bad."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for terms, counts, n, bad in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(index.vote(terms, counts, own)[0], own * m, m) for own, m in ((0, n - bad), (1, bad)) if m]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.float64(), pa.int64(), pa.int64()))], names=["vote", "bad", "n"])

    spread = entries.select("terms", "counts", "n", "bad").repartition(entries.sparkSession.sparkContext.defaultParallelism)
    rows = spread.mapInArrow(judge, "vote double, bad long, n long").groupBy("vote").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).orderBy("vote").collect()
    return isotonic(np.array([r["vote"] for r in rows]), np.array([r["bad"] for r in rows], float), np.array([r["n"] for r in rows], float))


def scored(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted, vote and neighbours of each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    taught = cut(examples_of(rows, labels, limit), "taught")
    terms = vocabulary(taught)
    vectors = cut(counted_terms(rows, terms), "vectors")
    same = counted_terms(taught.select("doc_id", "bad", "text"), terms).groupBy("terms", "counts")
    entries = cut(same.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"), F.min("doc_id").alias("doc_id")), "entries")
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()  # of the vocabulary
    idf = np.full(len(terms), 0.0)
    n = vectors.count()
    for r in held:
        idf[r["term"]] = math.log((1 + n) / (1 + r["n"])) + 1
    index = Index.of([(r["terms"], r["counts"], r["n"], r["bad"], r["doc_id"]) for r in entries.collect()], idf)
    knots, rates = own_votes(entries, index)
    drop(taught)
    drop(entries)
    if len(knots) > 1:
        at = F.array(*map(F.lit, knots.tolist()))
        above = F.least(F.greatest(F.size(F.filter(at, lambda x: x <= F.col("vote"))), F.lit(1)), F.lit(len(knots) - 1))
        rate = F.array(*map(F.lit, rates.tolist()))
        x0, x1, y0, y1 = F.element_at(at, above), F.element_at(at, above + 1), F.element_at(rate, above), F.element_at(rate, above + 1)
        part = F.least(F.greatest((F.col("vote") - x0) / (x1 - x0), F.lit(0.0)), F.lit(1.0))
        fitted = y0 + part * (y1 - y0)
    else:
        fitted = F.col("vote")
    score = F.least(F.lit(1 - ORDER) * fitted + F.lit(ORDER) * F.col("vote"), F.lit(1.0))
    found = votes_of(vectors, index).withColumn("score", score)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "vote", "neighbours")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
