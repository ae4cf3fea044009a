r"""Operator 5: benchmark decontamination by latent semantic retrieval.

Texts are lower-cased and split into words at blanks and ASCII punctuation. One pass over all documents keeps, of each
text, the places of words that the benchmark has. Windows of ``WINDOW`` words, ``STRIDE`` apart, are passages; items
are cut into parts likewise, since no passage is like the whole of a longer item, and a part stands for its item. A
distributed randomised SVD of the passages' TF-IDF matrix (the benchmark's items are rows of it too) gives a latent
space; passage and part are candidates if the cosine of their projections reaches ``COSINE``. A candidate is a match if
the longest common subsequence of words, in a stretch around the passage, covers ``SURE`` of the item, or ``PARAPHRASE``
of it and half of its answer (column ``answer``, else its last sentence).

The benchmark is the stated query set: it is taken in blocks of about ``ITEMS`` parts, so that what tasks are sent has a
bound. What comes to the driver is a matrix of its words by the rank.

Nulls: null texts and items are empty and match nothing; a null doc_id is kept. Rows are told apart by doc_id and text.
Repeated rows give one match; of equal matches of an item the longest subsequence is told. A very long text has as many
passages as it takes. Other columns are kept by ``clean``, whatever their names, and ignored by the query. Empty tables
give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, keyed, table, text_or_empty
from .word_hash import ascending, hash_words, pieces

WINDOW, STRIDE = 64, 32
RANK, EXTRA = 128, 8
COSINE = 0.4
SURE, PARAPHRASE, ANSWER = 0.75, 0.55, 0.5
ITEMS = 500
CHUNK = 64
#: Documents of a batch, and passages of the sparse matrix, that are worked on at once: so few passages share their words,
#: and a block of them is small enough for the processor's cache.
SLICE, BLOCK = 400, 128
BLANKS = bytes(32 if chr(b) in " \t\n\r\x0b\x0c!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))


def plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(BLANKS)


def words(text: str) -> list[bytes]:
    return plain(text).split()


@dataclass
class Items:
    """A block of the benchmark: its words by number, and of each item its words and where its answer begins."""

    ids: list[int]
    number: dict[bytes, int]
    lists: list[np.ndarray]
    answers: list[np.ndarray]
    #: Item and first word of each part.
    part_of: np.ndarray
    part_at: np.ndarray

    @classmethod
    def of(cls, rows: list) -> "Items":
        number: dict[bytes, int] = {}
        ids, lists, answers = [], [], []
        for row in rows:
            listed = words(row["text"] or "")
            if not listed:
                continue
            answer = row["answer"] if "answer" in row else None
            if answer is None:
                answer = re.split(r"(?<=[.!?])\s+", row["text"].strip())[-1]
            ids.append(row["item_id"])
            lists.append(np.array([number.setdefault(w, len(number)) for w in listed], np.int32))
            answers.append(np.array([number.setdefault(w, len(number)) for w in words(answer) or listed], np.int32))
        parts = [(i, at) for i, listed in enumerate(lists) for at in range(0, max(1, len(listed) - WINDOW + STRIDE), STRIDE)]
        part_of, part_at = np.array(parts, np.int64).reshape(-1, 2).T
        return cls(ids, number, lists, answers, part_of, part_at)

    def part(self, k: int) -> np.ndarray:
        return self.lists[self.part_of[k]][self.part_at[k] : self.part_at[k] + WINDOW]


def hits(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, row (hash of the text), n_words, and the numbers and places of the words that items have."""
    named = hash_words(b"\n".join(items.number))[0]
    order = np.argsort(named)
    sorted_ = named[order]
    first_bits = np.zeros(1 << 16, bool)  # most words of a text fail this look-up and need no search
    first_bits[sorted_ >> np.uint64(48)] = True

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [plain(t) for t in b.column(2).to_pylist()]
            sizes, found, places = [], [], []
            for i, j in pieces(texts):
                h, start, _ = hash_words(b"\n".join(texts[i:j]))
                ends = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts[i:j]]))
                begins = np.concatenate([[0], ends[:-1]])
                at = np.flatnonzero(first_bits[h >> np.uint64(48)])
                k = np.minimum(np.searchsorted(sorted_, h[at]), len(sorted_) - 1)
                ok = sorted_[k] == h[at]
                at, code = at[ok], order[k[ok]].astype(np.int32)
                doc = np.searchsorted(ends, at, side="right")
                place = (at - begins[doc]).astype(np.int32)
                cuts = np.searchsorted(doc, np.arange(j - i + 1)).tolist()
                sizes += (ends - begins).tolist()
                found += [code[x:y].tobytes() for x, y in zip(cuts, cuts[1:])]
                places += [place[x:y].tobytes() for x, y in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.binary()), pa.array(places, pa.binary())], names=["doc_id", "row", "n_words", "words", "places"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("row"), text_or_empty().alias("text"))
    return rows.mapInArrow(find, "doc_id long, row long, n_words long, words binary, places binary")


@dataclass
class Passages:
    """Passages of a batch: document, first word, and per entry the passage, word and number of times."""

    doc: np.ndarray
    start: np.ndarray
    entry: np.ndarray
    word: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, b: pa.RecordBatch, names: int) -> "Passages":
        sizes = b.column(0).to_numpy()
        found = [np.frombuffer(x.as_buffer(), np.int32) for x in b.column(1)]
        places = [np.frombuffer(x.as_buffer(), np.int32) for x in b.column(2)]
        doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
        word, place = np.concatenate(found).astype(np.int64), np.concatenate(places).astype(np.int64)
        last = np.maximum(0, -(-(sizes - WINDOW) // STRIDE))  # number of a document's last passage
        first = np.cumsum(last + 1) - last - 1
        k = place // STRIDE  # a word is in the passage that begins last at or before it, and in the one before
        one, two = np.minimum(k, last[doc]), k - 1
        again = (two >= 0) & (two < one) & (place < two * STRIDE + WINDOW)
        entry = np.concatenate([first[doc] + one, (first[doc] + two)[again]])
        code, times = np.unique(entry * names + np.concatenate([word, word[again]]), return_counts=True)
        entry, word = np.divmod(code, names)
        used, entry = np.unique(entry, return_inverse=True)  # passages without a word of the items drop out
        doc_of = np.searchsorted(first, used, side="right") - 1
        return cls(doc_of, (used - first[doc_of]) * STRIDE, entry, word, times)

    def rows(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """TF-IDF entries with each passage's row of length 1, the rows' starts, and the rows' former lengths."""
        value = (1 + np.log(self.times)) * weight[self.word]
        starts = np.flatnonzero(np.diff(self.entry, prepend=-1))
        norm = np.sqrt(np.add.reduceat(value * value, starts)) if len(starts) else np.zeros(0)
        return (value / np.repeat(norm, np.diff(np.append(starts, len(value))))).astype(np.float32), starts, norm

    def blocks(self, value: np.ndarray, starts: np.ndarray, names: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The sparse rows by ``BLOCK``: the first one's number, the words that these have, and their columns, dense."""
        edges, index = np.append(starts, len(value)), np.empty(names, np.int64)
        for a in range(0, len(starts), BLOCK):
            b = min(a + BLOCK, len(starts))
            part = slice(edges[a], edges[b])
            seen = np.zeros(names, bool)
            seen[self.word[part]] = True
            used = np.flatnonzero(seen)
            index[used] = np.arange(len(used))
            dense = np.zeros((b - a, len(used)), np.float32)
            dense[self.entry[part] - a, index[self.word[part]]] = value[part]
            yield a, used, dense


def summed(found: DataFrame, add, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all batches of matrices of ``shape``: added up by tasks, then by chunks of their rows."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.float64)
        any_ = False
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                any_ = True
                add(b.slice(at, SLICE), total)
        if any_:
            for k in range(0, shape[0], CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([k // CHUNK], pa.int32()), pa.array([total[k : k + CHUNK].tobytes()], pa.binary())], names=["chunk", "sums"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(1)):
                got[k] = got.get(k, 0) + np.frombuffer(data.as_buffer(), np.float64)
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array([v.tobytes() for v in got.values()], pa.binary())], names=["chunk", "sums"])

    chunks = -(-shape[0] // CHUNK)
    parts = found.select("n_words", "words", "places").mapInArrow(part, "chunk int, sums binary")
    rows = parts.repartitionById(min(chunks, 64), F.pmod(F.col("chunk"), F.lit(min(chunks, 64))).cast("int")).mapInArrow(whole, "chunk int, sums binary")
    out = np.zeros(shape)
    for r in rows.collect():
        data = np.frombuffer(bytes(r["sums"]), np.float64).reshape(-1, shape[1])
        out[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(data)] = data
    return out


def weights(found: DataFrame, items: Items) -> np.ndarray:
    """Inverse document frequency of each word over all passages."""
    names = len(items.number)

    def count(b: pa.RecordBatch, total: np.ndarray) -> None:
        sizes = b.column(0).to_numpy()
        windows = -(-sizes // WINDOW) + (sizes == 0)
        first = np.cumsum(windows) - windows
        for i, (found_, places) in enumerate(zip(b.column(1), b.column(2))):
            word, place = (np.frombuffer(x.as_buffer(), np.int32).astype(np.int64) for x in (found_, places))
            total[:names, 0] += np.bincount(ascending((first[i] + place // WINDOW) * names + word) % names, minlength=names) if len(word) else 0
        total[names, 0] += windows.sum()

    got = summed(found, count, (names + 1, 1))[:, 0]
    frequency, n = got[:-1], max(1.0, got[-1])
    return np.log((n + 1) / (frequency + 1)) + 1e-3


def item_rows(items: Items, weight: np.ndarray) -> np.ndarray:
    """Rows of the TF-IDF matrix of the items' parts, each of length 1."""
    out = np.zeros((len(items.part_of), len(weight)))
    for i in range(len(out)):
        word, times = np.unique(items.part(i), return_counts=True)
        out[i, word] = (1 + np.log(times)) * weight[word]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def latent_space(found: DataFrame, items: Items, weight: np.ndarray, rows: np.ndarray, rank: int = RANK, seed: int = 11) -> np.ndarray:
    """Right singular vectors (words by rank) by a randomised SVD, in one pass over the passages."""
    names = len(weight)
    size = min(rank + EXTRA, names)
    omega = np.random.default_rng(seed).standard_normal((names, size)).astype(np.float32)

    def power(b: pa.RecordBatch, total: np.ndarray) -> None:
        p = Passages.of(b, names)
        value, starts, _ = p.rows(weight)
        for _, used, dense in p.blocks(value, starts, names):
            total[used] += dense.T @ (dense @ omega[used])

    range_ = summed(found, power, (names, size))
    # the items' rows weigh as much as all passages
    own = rows.T @ (rows @ omega)
    sketch = range_ + max(1.0, np.linalg.norm(range_) / max(1e-9, np.linalg.norm(own))) * own
    # G = A'A is symmetric: its leading eigenvectors, A's right singular vectors, follow from G omega alone (Nystroem)
    shift = 1e-7 * np.linalg.norm(sketch)
    sketch = sketch + shift * omega
    core = omega.T.astype(np.float64) @ sketch
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > 1e-12 * value.max()
    basis, _, _ = np.linalg.svd(sketch @ (vector[:, good] / np.sqrt(value[good])), full_matrices=False)
    return basis[:, :size]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of the table as bits of one number."""
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        x = row & where.get(w, 0)
        row = ((row + x) | (row - x)) & full
    return len(a) - row.bit_count()


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row, item_id, cosine (latent), lcs, item_words, answer_lcs, answer_words of each match."""
    columns = [F.col("item_id"), F.col("text").cast("string")] + [F.col("answer").cast("string")] * ("answer" in benchmark.columns)
    bench = benchmark.select(*columns).where("item_id IS NOT NULL")
    size = F.greatest(F.lit(1), F.ceil((F.size(F.split(text_or_empty(), r"[\s!-/:-@\[-`{-~]+")) - WINDOW) / STRIDE) + 1)
    blocks = max(1, -(-int(bench.agg(F.sum(size)).first()[0] or 0) // ITEMS))
    schema = "doc_id long, row long, item_id long, cosine double, lcs int, item_words int, answer_lcs int, answer_words int"
    out = None
    for k in range(blocks):
        items = Items.of([r.asDict() for r in bench.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()])
        if items.ids:
            found = _matches(docs, items, schema)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.struct("lcs", "answer_lcs", "cosine", "item_words", "answer_words")
    return out.groupBy("doc_id", "row", "item_id").agg(F.max(best).alias("m")).select("doc_id", "row", "item_id", "m.cosine", "m.lcs", "m.item_words", "m.answer_lcs", "m.answer_words")


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; a row of zeros stays."""
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def candidates(cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages and parts whose latent cosine is enough."""
    return np.nonzero(cosine >= COSINE)


def _matches(docs: DataFrame, items: Items, schema: str) -> DataFrame:
    found = cut(hits(docs, items), "hits")
    weight = weights(found, items)
    rows = item_rows(items, weight)
    space = latent_space(found, items, weight, rows)
    latent = unit(rows @ space).astype(np.float32)
    space, names = space.astype(np.float32), len(weight)
    member = np.zeros((len(items.ids), names), bool)
    for k, listed in enumerate(items.lists):
        member[k, listed] = True

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(at, SLICE) for x in batches for at in range(0, x.num_rows, SLICE)):
            p = Passages.of(b.select(["n_words", "words", "places"]), names)
            value, starts, _ = p.rows(weight)
            passage, item, cosine = [], [], []
            for at, used, dense in p.blocks(value, starts, names):
                near = unit(dense @ space[used]) @ latent.T
                i, j = candidates(near)
                passage.append(i + at)
                item.append(j)
                cosine.append(np.clip(near[i, j], -1, 1))
            out = []
            texts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for i, j, c in zip(*(np.concatenate(x).tolist() for x in (passage, item, cosine))) if passage else ():
                d, start = int(p.doc[i]), int(p.start[i])
                if d not in texts:
                    texts[d] = tuple(np.frombuffer(b.column(k)[d].as_buffer(), np.int32) for k in (3, 4))
                ahead, j = int(items.part_at[j]), int(items.part_of[j])
                listed, answer = items.lists[j], items.answers[j]
                code, place = texts[d]
                # as far as the item could reach that has the part, or half its words, in the passage
                lo, hi = np.searchsorted(place, [start - ahead - len(listed) // 2, start + max(WINDOW, len(listed) - ahead) + len(listed) // 2])
                near_by = code[lo:hi]
                own = near_by[member[j, near_by]]  # no other word is in a common subsequence
                if len(own) < PARAPHRASE * len(listed):
                    continue
                lcs = common_subsequence(listed, own)
                if lcs < PARAPHRASE * len(listed):
                    continue
                ans = common_subsequence(answer, near_by)
                if lcs >= SURE * len(listed) or ans >= ANSWER * len(answer):
                    out.append((d, items.ids[j], c, lcs, len(listed), ans, len(answer)))
            if out:
                d, *rest_ = zip(*out)
                at_doc = pa.array(d)
                kinds = [pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([b.column(0).take(at_doc), b.column(1).take(at_doc), *(pa.array(c, t) for c, t in zip(rest_, kinds))], names=["doc_id", "row", "item_id", "cosine", "lcs", "item_words", "answer_lcs", "answer_words"])

    return found.select("doc_id", "row", "n_words", "words", "places").mapInArrow(search, schema)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that match an item."""
    bad = matches(docs, benchmark).select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "row").distinct()
    return keyed(docs).join(bad, ["none", "doc", "row"], "left_anti").select("d.*")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")
