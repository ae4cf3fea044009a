"""Operator 3: edit-aware token counts.

Each document keeps a segment tree over its pre-tokens: a leaf knows its characters and its ids, an inner node the sums
below it. ``kept_trees`` encodes the texts once and gives the trees as a table, leaves as packed columns beside the text;
``edited`` applies edits to that table, whenever they come, and gives counts and the new trees, without encoding any text
as a whole. An edit re-encodes the leaves it touches, two leaves before them and as many after them as it takes to meet
an old border again; then the paths above the changed leaves get new sums. Pre-tokens are found left to right without
looking back, so that from a border that old and new text share, the old leaves hold.

Nulls: a null text is empty, a null doc_id is kept. Edits are (start, stop, replacement), in characters of the text,
and must not overlap; edits of a doc_id hold for all its rows, and those of no document are ignored. Texts with characters outside the encoder's sure ones are one leaf and are encoded anew as a
whole. Repeated rows are documents of their own; edits that
start at one place are ties, which overlap and so must not occur. Other columns are ignored, whatever their names. A very long text is one
row of the table. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blobs import packed, small, unpacked
from .bpe import BatchEncoder, default_vocabulary
from .common import cut, table, text_or_empty

Edit = tuple[int, int, str]
#: Personal data that the query's edits redact: e-mail addresses and long numbers.
REDACTED = re.compile(r"(?P<mail>[\w.+-]+@[\w-]+(?:\.[\w-]+)+)|(?P<number>\+?\d[\d -]{7,}\d)")


def redactions(text: str) -> list[Edit]:
    return [(m.start(), m.end(), f"<{m.lastgroup}>") for m in REDACTED.finditer(text)]


class TokenTree:
    """The tree of one text. ``chars`` and ``tokens`` are sums in heap order: node i has children 2 i and 2 i + 1."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray):
        self.text, self.n = text, max(1, len(chars))
        self.width = 1 << (self.n - 1).bit_length()
        self.starts = np.concatenate([[0], np.cumsum(chars)])
        self.chars, self.tokens = self._sums(chars), self._sums(tokens)
        self.changed: dict[int, str] = {}  # texts of leaves that edits made
        self.reencoded = 0

    def _sums(self, leaf: np.ndarray) -> list[int]:
        out = np.zeros(2 * self.width, np.int64)
        out[self.width : self.width + len(leaf)] = leaf
        level = self.width
        while level > 1:
            out[level // 2 : level] = out[level : 2 * level : 2] + out[level + 1 : 2 * level : 2]
            level //= 2
        return out.tolist()

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and the leaf's start; past the end, the last leaf with characters."""
        char = max(0, min(char, self.chars[1] - 1))
        node, done = 1, 0
        while node < self.width:
            node *= 2
            if done + self.chars[node] <= char:
                done += self.chars[node]
                node += 1
        return node - self.width, done

    def leaf_text(self, leaf: int) -> str:
        return self.changed[leaf] if leaf in self.changed else self.text[self.starts[leaf] : self.starts[leaf + 1]]

    def _put(self, leaf: int, text: str, tokens: int) -> None:
        self.changed[leaf] = text
        more = (len(text) - self.chars[self.width + leaf], tokens - self.tokens[self.width + leaf])
        node = self.width + leaf
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2

    def _beside(self, leaf: int, step: int, count: int) -> int:
        """The leaf ``count`` non-empty leaves before or after, or the last there is."""
        at = leaf
        while count and 0 <= at + step < self.n:
            at += step
            count -= self.chars[self.width + at] > 0
        return at

    def edit(self, start: int, stop: int, new: str, encoder: BatchEncoder) -> bool:
        """Replaces characters start to stop of the present text; false if that needs the whole text encoded anew."""
        if not self.chars[1]:
            first, begin, last = 0, 0, 0
        else:
            first = self._beside(self.leaf_at(start - 1)[0], -1, 2)
            begin, last = self._start(first), self.leaf_at(stop)[0]
        reach = 4
        while True:
            right = self._beside(last, 1, reach)
            leaves = [i for i in range(first, right + 1)]
            old = [self.leaf_text(i) if self.chars[1] or i in self.changed else "" for i in leaves]
            whole = "".join(old)
            text = whole[: start - begin] + new + whole[stop - begin :]
            if text and not encoder.sure(text):
                return False
            chars, tokens = encoder.leaves([text])[0]
            self.reencoded += len(text)
            ends = np.cumsum(chars)
            if right >= self.n - 1:
                keep, leaf_stop = len(chars), right + 1
                break
            shift = len(new) - (stop - start)
            borders = {stop_ + shift: i for i, stop_ in zip(leaves[1:], np.cumsum([len(t) for t in old])[:-1].tolist()) if stop_ >= stop - begin}
            met = next((k for k in range(len(ends) - 2) if int(ends[k]) in borders), None)
            if met is not None:
                keep, leaf_stop = met + 1, borders[int(ends[met])]
                break
            reach *= 2
        size = int(ends[keep - 1]) if keep else 0
        for i in range(first + 1, leaf_stop):
            if self.chars[self.width + i]:
                self._put(i, "", 0)
        self._put(first, text[:size], int(tokens[:keep].sum()))
        return True

    def _start(self, leaf: int) -> int:
        node, done = self.width + leaf, 0
        while node > 1:
            if node % 2:
                done += self.chars[node - 1]
            node //= 2
        return done

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the present leaves; one that edits joined has several pre-tokens."""
        chars, tokens = (np.array(x[self.width : self.width + self.n], np.int64) for x in (self.chars, self.tokens))
        return chars[chars > 0], tokens[chars > 0]

    def present(self) -> str:
        return "".join(self.leaf_text(i) for i in range(self.n)) if self.chars[1] else ""


def applied(text: str, edits: list[Edit]) -> str:
    for start, stop, new in sorted(edits, reverse=True):
        text = text[:start] + new + text[stop:]
    return text


Leaves = tuple[np.ndarray, np.ndarray]


def recount(text: str, leaves: Leaves | None, before: int, edits: list[Edit], encoder: BatchEncoder) -> tuple[str, Leaves | None, int, int]:
    """The text and the leaves after the edits, its tokens, and characters encoded again. ``before`` are its tokens before."""
    if not edits:
        return text, leaves, before, 0
    if leaves is not None:
        tree = TokenTree(text, *leaves)
        if all(tree.edit(start, stop, new, encoder) for start, stop, new in sorted(edits, reverse=True)):  # from the end, so that offsets hold
            return tree.present(), tree.leaves(), tree.total, tree.reencoded
    whole = applied(text, edits)
    return whole, encoder.leaves([whole])[0], len(encoder.encode([whole])[0]), len(whole)


TREES = "doc_id long, text string, n_tokens long, chars binary, tokens binary"
COUNTS = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_leaves", "reencoded_chars"]


def _columns(trees: list[Leaves | None]) -> list[pa.Array]:
    return [pa.array([None if t is None else packed(t[k]) for t in trees], pa.binary()) for k in (0, 1)]


def kept_trees(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, text, n_tokens and the leaves (chars, tokens: packed, null for a text that is one leaf) of each row."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder.of(vocabulary)
        for b in small(batches):
            texts = b.column(1).to_pylist()
            trees = encoder.leaves(texts)
            counts = [len(encoder.encode([t])[0]) if tree is None else int(tree[1].sum()) for t, tree in zip(texts, trees)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(counts, pa.int64()), *_columns(trees)], names=["doc_id", "text", "n_tokens", "chars", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(build, TREES)


def _edited(trees: DataFrame, vocabulary: str, edits_of: Callable[[str], list[Edit]] | None, whole: bool) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder.of(vocabulary)
        for b in small(batches):
            rows, texts, after = [], [], []
            listed = b.column(5).to_pylist() if edits_of is None else [None] * b.num_rows
            for text, before, chars, tokens, given in zip(*(b.column(k).to_pylist() for k in range(1, 5)), listed):
                leaves = None if chars is None else (unpacked(chars).astype(np.int64), unpacked(tokens).astype(np.int64))
                edits = edits_of(text) if edits_of else [(e["start"], e["stop"], e["replacement"] or "") for e in given or []]
                n = 1 if leaves is None else len(leaves[0])
                text, leaves, total, again = recount(text, leaves, before, edits, encoder)
                rows.append((before, len(edits), total, n, again))
                texts.append(text)
                after.append(leaves)
            counts = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 5
            more = [pa.array(texts, pa.string()), *_columns(after)] if whole else []
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, *more], names=[*COUNTS, *["text", "chars", "tokens"][: len(more)]])

    schema = ", ".join(f"{c} long" for c in COUNTS) + ", text string, chars binary, tokens binary" * whole
    return trees.mapInArrow(count, schema)


def edited(trees: DataFrame, edits: DataFrame, vocabulary: str) -> DataFrame:
    """Counts of each row of ``trees`` after ``edits`` (doc_id, start, stop, replacement), with its new text and leaves."""
    listed = edits.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.collect_list(F.struct("start", "stop", "replacement")).alias("edits"))
    met = trees.join(listed, "doc_id", "left").select("doc_id", "text", "n_tokens", "chars", "tokens", "edits")
    return _edited(met, vocabulary, None, True)


def edited_counts(docs: DataFrame, vocabulary: str, edits_of: Callable[[str], list[Edit]] = redactions) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_after, n_leaves, reencoded_chars of each row of ``docs`` (doc_id, text): its tree
    is kept in a table, from which edits that follow from the text are counted."""
    return _edited(cut(kept_trees(docs, vocabulary), "trees"), vocabulary, edits_of, False)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``, with redactions as edits."""
    return edited_counts(table(spark, sf_dir, "documents"), default_vocabulary())
