r"""Operator 8: language-model scores by a weighted backoff automaton.

N-grams of the training documents up to order 3 are counted over the whole corpus. Smoothed, they are an automaton: a
state for each history that training has seen, of two words, one, or none (the root), arcs for its seen successors, and a
failure arc to the state of the history without its first word, which carries the rest of the mass. The chance of a word
w after a history h is (c(h w) + K P(w | h')) / (c(h) + K), with h' without the first word and K the distinct n-grams of
that order for each distinct one of the order below, over all training documents; the root's is add-one, unknown words
included. A text is scored by one traversal from left to right that carries the state and adds log-probabilities; long
texts are traversed in ``SEGMENT``s, each from the state that the words before it lead to.

No task holds the whole model. Documents are read once into slabs; a slab asks for the counts of its own n-grams only (see
``blobs``), builds the part of the automaton that its texts can reach, and scores them. Words are known by 64-bit hashes,
longer n-grams by 56 bits.

Words are ``[^\x20\x09-\x0D]+`` after lower-casing A-Z; one end token closes a text. Documents whose crc32(doc_id as
text) mod 7 is 2 are held out of training.

Nulls: a null text is empty (only the end token); a null doc_id is kept and held out. Repeated rows are documents of
their own; ties do not arise. A very long text is a slab of its own. Other columns are ignored, whatever their names.
Without training documents the model gives every token the same probability. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blobs
from .common import blocks, cut, cut_by, table, text_or_empty
from .set_join import ROW, pack, row_batch, unpack, unzigzag, zigzag
from .word_hash import mixed, text_words

FOLDS, HELD_OUT = 7, 2
ORDER = 3
#: Bytes of text in a slab; a longer text is one by itself. Tokens of a document that are traversed in a row.
SLAB, SEGMENT = 3_000_000, 256
#: Hashes of marks that are no words, since words hold no blanks.
END, BEGIN = (np.uint64(xxhash.xxh64_intdigest(name)) for name in (b" end", b" begin"))
#: Bits of an n-gram's hash.
BITS = 56
SLABS = "block long, hash binary, words binary, docs binary"
TOTAL = -1


@blobs.lean
def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, held, texts, size, block = [], [], [], 0, TaskContext.get().partitionId() << 32

    def made() -> pa.RecordBatch:
        hashes, counts = text_words(texts, lower=True)
        hashes = np.insert(hashes, np.cumsum(counts), END)
        known, word = np.unique(np.append(hashes, BEGIN), return_inverse=True)
        none = np.array([i is None for i in ids], np.uint64)
        docs = [none, zigzag(np.array([i or 0 for i in ids], np.int64)), np.array(held, np.uint64), counts + 1]
        data = [block, blobs.steps(known), blobs.packed(word[:-1]), pack(docs)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(data, [pa.int64()] + [pa.binary()] * 3)], names=["block", "hash", "words", "docs"])

    for b in batches:
        for i, t, h in zip(*(b.column(k).to_pylist() for k in range(3))):
            t = t.encode("utf-8", "surrogatepass")
            if texts and size + len(t) > SLAB:
                yield made()
                ids, held, texts, size, block = [], [], [], 0, block + 1
            ids.append(i)
            held.append(h)
            texts.append(t)
            size += len(t) + 1
    if texts:
        yield made()


class Slab:
    """The tokens of a slab, and its distinct n-grams of each order up to ``order``.

    For n-grams of k words: ``gram[k]`` has the n-gram that ends at each token (-1 where the text has not begun yet; the
    begin mark counts as a word), ``first[k]`` the n-gram of k - 1 words that it starts with, ``last[k]`` its last word,
    ``rest[k]`` the n-gram without its first word, ``key[k]`` its hash.
    """

    def __init__(self, data: dict, order: int):
        self.block = data["block"]
        self.hash = blobs.unstepped(data["hash"])
        self.word = blobs.unpacked(data["words"]).astype(np.int64)
        none, doc, held, sizes = unpack(data["docs"])
        self.none, self.doc, self.held, self.sizes = none.astype(bool), unzigzag(doc), held.astype(bool), sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.end, self.begin = (int(np.searchsorted(self.hash, h)) for h in (END, BEGIN))
        self.train = np.repeat(~self.held, self.sizes)
        place = np.arange(len(self.word)) - np.repeat(self.starts, self.sizes)
        v = len(self.hash)
        self.gram, self.key = {1: self.word}, {1: self.hash}
        self.first, self.last, self.rest = {}, {}, {}
        for k in range(2, order + 1):
            before = np.empty_like(self.word)
            before[1:] = self.gram[k - 1][:-1]
            if k == 2:
                before[self.starts] = self.begin
            at = np.flatnonzero(place >= k - 2)
            code, one, of = np.unique(before[at] * v + self.word[at], return_index=True, return_inverse=True)
            self.gram[k] = np.full(len(self.word), -1)
            self.gram[k][at] = of
            self.first[k], self.last[k] = np.divmod(code, v)
            self.rest[k] = self.gram[k - 1][at[one]]
            self.key[k] = mixed(self.key[k - 1][self.first[k]] * np.uint64(0x9E3779B97F4A7C15) + self.hash[self.last[k]]) >> np.uint64(64 - BITS)

    def questions(self, k: int, parts: int) -> list[tuple]:
        """Rows that ask for the totals of the n-grams of k words."""
        gram = self.gram[k]
        own = np.bincount(gram[self.train & (gram >= 0)], minlength=len(self.key[k]))
        order = np.argsort(self.key[k], kind="stable")
        key = self.key[k][order]
        bucket = blobs.bucket_of(key, 64 if k == 1 else BITS, parts)
        return [(k, b, self.block, pack([np.diff(key[i:j], prepend=np.uint64(0)), own[order[i:j]]])) for b, i, j in blobs.slices(bucket)]

    def totals(self, k: int, answers: list[dict]) -> np.ndarray:
        """Counts of the n-grams of k words over all training documents."""
        found = [blobs.unpacked(a["data"]) for a in sorted((a for a in answers if a["kind"] == k), key=lambda a: a["origin"])]
        out = np.zeros(len(self.key[k]), np.int64)
        if found:
            out[np.argsort(self.key[k], kind="stable")] = np.concatenate(found)
        return out


class Automaton:
    """States are numbers, 0 the root. ``arcs`` are ascending codes state * vocabulary + word with their ``weights`` and
    the states that they lead to; ``fail`` and ``loss`` are each state's failure arc. The root has an arc for every word:
    ``root`` its weights, ``after`` where they lead."""

    def __init__(self, vocabulary: int, arcs: np.ndarray, weights: np.ndarray, leads: np.ndarray, fail: np.ndarray, loss: np.ndarray, root: np.ndarray, after: np.ndarray):
        self.vocabulary, self.arcs, self.weights, self.leads = vocabulary, arcs, weights, leads
        self.fail, self.loss, self.root, self.after = fail, loss, root, after

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of ``word`` from ``state``, and the next state: failure arcs are followed until one has an arc."""
        gain, to = np.zeros(len(word)), np.empty(len(word), np.int64)
        todo = np.arange(len(word))
        while len(todo):
            own, w = state[todo], word[todo]
            at_root = own == 0
            here = todo[at_root]
            gain[here] += self.root[w[at_root]]
            to[here] = self.after[w[at_root]]
            todo, own, w = todo[~at_root], own[~at_root], w[~at_root]
            code = own * self.vocabulary + w
            at = np.minimum(np.searchsorted(self.arcs, code), max(0, len(self.arcs) - 1))
            seen = self.arcs[at] == code if len(self.arcs) else np.zeros(len(code), bool)
            here = todo[seen]
            gain[here] += self.weights[at[seen]]
            to[here] = self.leads[at[seen]]
            todo, own = todo[~seen], own[~seen]
            gain[todo] += self.loss[own]
            state = state.copy()
            state[todo] = self.fail[own]
        return gain, to

    def scores(self, word: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begin: int, order: int) -> np.ndarray:
        """Of each document. Segments are traversed in step; one that does not begin a document first passes the order - 1
        words before it, of which alone its state depends, without adding them."""
        pieces = -(-sizes // SEGMENT)
        doc = np.repeat(np.arange(len(sizes)), pieces)
        at = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
        stop = np.minimum(at + SEGMENT, sizes[doc])
        warm = np.minimum(at, order - 1)
        by = np.argsort(-(stop - at + warm), kind="stable")
        doc, at, stop, warm = doc[by], at[by], stop[by], warm[by]
        length, start = stop - at + warm, starts[doc] + at - warm
        # a segment near its document's start knows the begin mark, another starts at the root
        state = np.where(at - warm == 0, begin, 0)
        total, active, k = np.zeros(len(doc)), len(doc), 0
        while active:
            gain, state = self.step(state[:active], word[start[:active] + k])
            total[:active] += np.where(k >= warm[:active], gain, 0.0)
            k += 1
            active = int(np.searchsorted(-length[:active], -k, side="left"))
        return np.bincount(doc, weights=total, minlength=len(sizes))


def _each(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[Slab, dict]]:
    for b in batches:
        for k in range(b.num_rows):
            data = b.slice(k, 1).to_pylist()[0]
            yield Slab(data, order), data


def _ask(orders: list[int], parts: int):
    @blobs.lean
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, _ in _each(batches, max(orders)):
            for k in orders:
                yield row_batch(slab.questions(k, parts))

    return ask


@blobs.lean
def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals in the order of the questions; and for each order this bucket's distinct n-grams and their count."""
    asked: dict[int, list] = {}
    for b in batches:
        for k, bucket, block, data in zip(*(b.column(c).to_pylist() for c in range(3)), b.column(3)):
            asked.setdefault(k, []).append((bucket, block, *unpack(data.as_buffer())))
    for k, rows in asked.items():
        key = np.concatenate([np.cumsum(steps, dtype=np.uint64) for _, _, steps, _ in rows])
        own = np.concatenate([n for *_, n in rows]).astype(np.int64)
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]) != 0)
        sums = np.add.reduceat(own[order], new)
        total = np.empty(len(key), np.int64)
        total[order] = np.repeat(sums, np.diff(np.append(new, len(key))))
        i, out = 0, [(k, TOTAL, rows[0][0], pack([np.array([(sums > 0).sum(), sums.sum()])]))]
        for bucket, block, steps, _ in rows:
            out.append((k, block, bucket, blobs.packed(total[i : i + len(steps)])))
            i += len(steps)
        yield row_batch(out)


def automaton(slab: Slab, count: dict[int, np.ndarray], known: dict[int, tuple[int, int]]) -> tuple[Automaton, int]:
    """The part of the automaton that the slab's texts can reach, and the state after the begin mark. ``known`` has, by
    order, the corpus's distinct n-grams and their count."""
    order, v = max(count), len(slab.hash)
    single = (count[1] + 1) / (known[1][1] + known[1][0] + 1)
    history = {1: count[1].copy()}
    history[1][slab.begin] = count[1][slab.end]
    history |= {k: count[k] for k in range(2, order)}
    # states of the histories that training has seen; 0 stands for those that it has not
    number, states = {}, 1
    for k in range(1, order):
        ends = (slab.last[k] if k > 1 else np.arange(v)) == slab.end
        seen = (history[k] > 0) & ~ends
        number[k] = np.where(seen, states + np.cumsum(seen) - 1, 0)
        states += int(seen.sum())
    fail, loss = np.zeros(states, np.int64), np.zeros(states)
    arcs, weights, leads = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
    chance = {1: single}
    for k in range(2, order + 1):
        most = known[k][0] / max(1, known[k - 1][0]) or 1.0
        own = history[k - 1]
        chance[k] = (count[k] + most * chance[k - 1][slab.rest[k]]) / (own[slab.first[k]] + most)
        at = np.flatnonzero(count[k] > 0)
        arcs.append(number[k - 1][slab.first[k][at]] * v + slab.last[k][at])
        weights.append(np.log10(chance[k][at]))
        leads.append(number[k][at] if k < order else number[k - 1][slab.rest[k][at]])
        s = np.flatnonzero(number[k - 1])
        loss[number[k - 1][s]] = np.log10(most / (own[s] + most))
        if k > 2:
            fail[number[k - 1][s]] = number[k - 2][slab.rest[k - 1][s]]
    after = number[1] if order > 1 else np.zeros(v, np.int64)
    by = np.argsort(np.concatenate(arcs), kind="stable")
    made = Automaton(v, np.concatenate(arcs)[by], np.concatenate(weights)[by], np.concatenate(leads)[by], fail, loss, np.log10(single), after)
    return made, int(after[slab.begin])


def _score(known: dict[int, tuple[int, int]], order: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    @blobs.lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, data in _each(batches, order):
            count = {k: slab.totals(k, data["answers"]) for k in range(1, order + 1)}
            made, begin = automaton(slab, count, known)
            scores = made.scores(slab.word, slab.starts, slab.sizes, begin, order)
            base = np.add.reduceat(made.root[slab.word], slab.starts)
            n_known = np.add.reduceat((count[1] > 0)[slab.word].astype(np.int64), slab.starts)
            columns = [pa.array(slab.doc, pa.int64(), mask=slab.none), pa.array(slab.held), pa.array(slab.sizes), pa.array(n_known), pa.array(np.full(len(scores), known[1][1])), pa.array(base), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return score


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    parts = blocks(rows)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))
    slabs = cut_by(rows.select("doc_id", "text", held).mapInArrow(_slabs, SLABS), "block", parts, "slabs")

    def totals(orders: list[int]) -> DataFrame:
        return cut(slabs.mapInArrow(_ask(orders, parts), ROW).repartitionById(parts, F.col("target").cast("int")).mapInArrow(_answer, ROW), "ngrams")

    # one after another, so that the questions of one order at a time are in the shuffle
    tables = [totals([1, 2][:order]), *(totals([k]) for k in range(3, order + 1))]
    known = {k: (0, 0) for k in range(1, order + 1)}
    for t in tables:
        for r in t.where(F.col("target") == TOTAL).select("kind", "data").collect():  # a row for each bucket
            found, times = (int(x) for x in unpack(bytes(r["data"]))[0])
            known[r["kind"]] = (known[r["kind"]][0] + found, known[r["kind"]][1] + times)
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    answers = every.where(F.col("target") != TOTAL).groupBy(F.col("target").alias("block")).agg(F.collect_list(F.struct("kind", "origin", "data")).alias("answers"))
    met = slabs.join(answers.hint("shuffle_hash"), "block")
    return met.mapInArrow(_score(known, order), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: see ``scored``."""
    return scored(table(spark, sf_dir, "documents"))
