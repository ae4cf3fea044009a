r"""Operator 1: exact set-similarity join of lines.

A line is the set of its words ``[^\x20\x09-\x0D]+``; a line matches another at Jaccard 0.8 or more. A line is removed
if an earlier one (smaller doc_id, or the same and a smaller line number) matches it, judged on the input. Lines without
words stay.

Documents are read once into slabs: the words of a slab as a table of 64-bit hashes, its lines as distinct sets of places
in that table. Slabs ask how often each of their words occurs (see ``blobs``), which gives the order by rarity. A set of n
words posts its n - ceil(0.8 n) + 1 rarest, without those that occur once; ``set_join`` has the filters by length, place
and parities and the verification on all words of both sets. A task returns, for each set, how many others match it and
the earliest of their lines; pairs are never rows. Equal sets are one set, found by a hash of 64 bits and their size.

Nulls: a null text has one empty line; a null doc_id is kept and comes first, and such rows are spread like others. Rows
with equal doc_id, repeated rows too, are at one place in the order: their lines compare by line number. A very long text
is a slab of its own. Columns other than doc_id and text have no effect, whatever their names; ``apply`` keeps them. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blobs, set_join
from .common import blocks, cut, cut_by, drop, table, text_or_empty
from .set_join import ROW, TOP, UNDER, Rows, pack, row_batch, taken, unpack, unzigzag, zigzag
from .word_hash import ascending, line_words, mixed, numbered

#: Bytes of text in a slab; a longer text is one by itself.
SLAB = 3_000_000
SLABS = "block long, hash binary, sets binary, docs binary"
SALT = np.uint64(0x9E3779B97F4A7C15)
REMOVALS = "doc_id long, row long, n_lines int, removed array<int>, match_doc array<long>, match_line array<int>, class_id long, n_links long"


def sums(hashes: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Names of sets: sums of their words' mixed hashes; ``at`` are the words' places in ``hashes``, which are mixed once."""
    return np.add.reduceat(mixed(hashes + SALT)[at], starts) if len(starts) else np.zeros(0, np.uint64)


def _slab(block: int, none: list[bool], doc: np.ndarray, row: np.ndarray, texts: list[bytes]) -> tuple:
    word, sizes, counts = line_words(texts)
    hashes, at = numbered(word)
    n = max(1, len(hashes))
    line, at = np.divmod(ascending(np.repeat(np.arange(len(sizes)), sizes) * n + at), n)
    starts = np.flatnonzero(np.diff(line, prepend=-1))
    size, own = np.diff(np.append(starts, len(line))), line[starts]
    _, chosen, of = np.unique(sums(hashes, at, starts) + size.astype(np.uint64), return_index=True, return_inverse=True)
    n = size[chosen]
    places = at[np.repeat(starts[chosen], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    first = np.cumsum(counts) - counts
    holder = np.repeat(np.arange(len(counts)), counts)[own]
    docs = [np.array(none, np.uint64), zigzag(doc), row.view(np.uint64), counts, np.bincount(holder, minlength=len(counts)), own - first[holder], of]
    return block, blobs.steps(hashes), pack([n, places]), pack(docs)


@blobs.lean
def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, rows, texts, size, block = [], [], [], 0, TaskContext.get().partitionId() << 32

    def made() -> pa.RecordBatch:
        none = [i is None for i in ids]
        found = _slab(block, none, np.array([i or 0 for i in ids], np.int64), np.array(rows, np.int64), texts)
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(found, [pa.int64()] + [pa.binary()] * 3)], names=["block", "hash", "sets", "docs"])

    for b in batches:
        for i, r, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
            if texts and size + len(t) > SLAB:
                yield made()
                ids, rows, texts, size, block = [], [], [], 0, block + 1
            ids.append(i)
            rows.append(r)
            texts.append(t)
            size += len(t) + 1
    if texts:
        yield made()


class Slab:
    """A slab as read back."""

    def __init__(self, data: dict):
        self.block = data["block"]
        self.hash = blobs.unstepped(data["hash"])
        size, place = unpack(data["sets"])
        self.size, self.word = size.view(np.int64), place.view(np.int64)
        self.start = np.cumsum(self.size) - self.size
        if "docs" in data:
            none, doc, self.row, *rest = unpack(data["docs"])
            self.none, self.doc, self.row = none.astype(bool), unzigzag(doc), self.row.view(np.int64)
            self.n_lines, with_words, self.line, self.set = (x.view(np.int64) for x in rest)
            self.holder = np.repeat(np.arange(len(with_words)), with_words)

    def names(self) -> np.ndarray:
        return sums(self.hash, self.word, self.start)

    def firsts(self) -> tuple[Rows, np.ndarray]:
        """Place of each set's first line, and its lines."""
        order = np.lexsort((self.line, self.doc[self.holder], ~self.none[self.holder], self.set))
        order = order[np.diff(self.set[order], prepend=-1) != 0]
        where = self.holder[order]
        rows = {"none": self.none[where].astype(np.uint64), "doc": zigzag(self.doc[where]), "line": self.line[order].astype(np.uint64)}
        return rows, np.bincount(self.set, minlength=len(self.size))

    def order(self, totals: list[dict]) -> None:
        """Takes the totals of all words, which come by bucket; then ``words`` knows the order by rarity."""
        answers = [blobs.unpacked(t["data"]) for t in sorted(totals, key=lambda t: t["origin"])]
        self.total = np.concatenate(answers) if answers else np.zeros(0, np.uint64)
        # by total and hash, which ascends
        self.by_rank = np.argsort(self.total, kind="stable")
        self.rank = np.empty(len(self.by_rank), np.int64)
        self.rank[self.by_rank] = np.arange(len(self.by_rank))

    def words(self, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of words of ``sets``, set by set and ascending, and the index in ``sets`` of each."""
        n = self.size[sets]
        own = np.repeat(np.arange(len(sets)), n)
        wide = max(1, len(self.hash))
        at = self.word[np.repeat(self.start[sets], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        own, rank = np.divmod(np.sort(own * wide + self.rank[at]), wide)
        return rank, own


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Slab, dict]]:
    for b in batches:
        for k in range(b.num_rows):
            data = {name: c[k].as_buffer() if pa.types.is_binary(c.type) else c[k].as_py() for name, c in zip(b.schema.names, b.columns)}
            yield Slab(data), data


def _ask(parts: int):
    @blobs.lean
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, _ in _each(batches):
            times = np.bincount(slab.word, minlength=len(slab.hash))
            yield row_batch([(0, b, slab.block, pack([np.diff(slab.hash[i:j], prepend=np.uint64(0)), times[i:j]])) for b, i, j in blobs.slices(blobs.bucket_of(slab.hash, 64, parts))])

    return ask


@blobs.lean
def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    asked = [(bucket, block, *unpack(data.as_buffer())) for b in batches for bucket, block, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3))]
    if not asked:
        return
    _, at = numbered(np.concatenate([np.cumsum(k, dtype=np.uint64) for _, _, k, _ in asked]))
    total = np.bincount(at, weights=np.concatenate([n for *_, n in asked]).astype(np.float64)).astype(np.int64)
    i, out = 0, []
    for bucket, block, keys, _ in asked:
        out.append((0, block, bucket, blobs.packed(total[at[i : i + len(keys)]])))
        i += len(keys)
    yield row_batch(out)


def _posts(parts: int):
    @blobs.lean
    def posts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, data in _each(batches):
            slab.order(data["totals"])
            first, _ = slab.firsts()
            rank, own = slab.words(np.arange(len(slab.size)))
            place = np.arange(len(rank)) - slab.start[own]
            size = slab.size[own]
            single = np.searchsorted(slab.total[slab.by_rank], np.uint64(1), side="right")
            at = np.flatnonzero((size > UNDER - 2) & (place < size - -(-TOP * size // UNDER) + 1) & (rank >= single))
            item, place, size = own[at], place[at], size[at]
            key, prev = (slab.hash[slab.by_rank[rank[np.maximum(x, 0)]]] for x in (at, at - 1))
            bits = np.bitwise_xor.reduceat(set_join.parities(slab.hash)[slab.word], slab.start) if len(slab.size) else slab.hash
            rows = {"cell": key >> np.uint64(16), "name": slab.names()[item], "prev": np.where(place > 0, prev >> np.uint64(24), np.uint64(0)), "bits": bits[item], "size": size.astype(np.uint64), "place": place.astype(np.uint64), "item": item.astype(np.uint64)} | dict.fromkeys(("lead", "second", "side"), np.zeros(len(at), np.uint64)) | {k: v[item] for k, v in first.items()}
            yield row_batch([(0, b, slab.block, set_join.sent_posts(x)) for b, x in set_join.buckets(rows, parts)])

    return posts


def _sets(parts: int):
    @blobs.lean
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, data in _each(batches):
            slab.order(data["totals"])
            rows = set_join.read_alive(data["told"])
            items, at = np.unique(rows["item"].astype(np.int64), return_inverse=True)
            rank, _ = slab.words(items)
            words, n = slab.hash[slab.by_rank][rank], slab.size[items]
            yield row_batch(set_join.sent_sets(rows, at, words, n, parts))

    return sets


OWN, LINKS = 1, 2
PLACE = ("none", "doc", "line")


def _verify(parts: int):
    """For each set of the bucket's posts: similar ones and the first of their lines."""

    @blobs.lean
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [unpack(data.as_buffer()) for b in batches for data in b.column(3)]
        if not found:
            return
        v = set_join.Verifier(found)
        rows = v.rows
        by_place = np.lexsort((rows["line"], unzigzag(rows["doc"]), rows["none"] == 0))
        rank = np.empty(len(by_place), np.int64)
        rank[by_place] = np.arange(len(by_place))
        least, links = np.full(len(rank), len(rank)), np.zeros(len(rank), np.int64)
        for i, j in v.similar():
            for x, y in ((i, j), (j, i)):
                np.minimum.at(least, x, rank[y])
                links += np.bincount(x, minlength=len(links))
        at = np.flatnonzero(links)
        first = by_place[least[at]]
        out = {"name": rows["name"][at], "size": rows["size"][at], "links": links[at].astype(np.uint64)} | {k: rows[k][first] for k in PLACE}
        yield row_batch([(LINKS, b, 0, pack([out[k][x] for k in ("name", "size", *PLACE, "links")])) for b, x in set_join.by_bucket(out["name"] >> np.uint64(16), parts)])

    return verify


def _register(parts: int):
    @blobs.lean
    def register(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, _ in _each(batches):
            first, copies = slab.firsts()
            rows = {"name": slab.names(), "size": slab.size, "copies": copies, "item": np.arange(len(copies))} | first
            yield row_batch([(OWN, b, slab.block, pack([rows[k][x] for k in ("name", "size", *PLACE, "copies", "item")])) for b, x in set_join.by_bucket(rows["name"] >> np.uint64(16), parts)])

    return register


@blobs.lean
def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each slab: its sets that have several lines or links, with the first line of all and the links."""
    blocks_, found = [], []
    for b in batches:
        for kind, origin, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3)):
            x = unpack(data.as_buffer())
            n = len(x[0])
            blocks_.append(np.full(n, origin if kind == OWN else -1))
            found.append([*x[:5], *(x[5:] if kind == OWN else [np.zeros(n, np.uint64)] * 2), x[5] if kind == LINKS else np.zeros(n, np.uint64)])
    if not found:
        return
    block = np.concatenate(blocks_)
    name, size, none, doc, line, copies, item, links = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((line, unzigzag(doc), none == 0, size, name))
    new = np.flatnonzero((np.diff(name[order], prepend=~name[order[:1]]) != 0) | (np.diff(size[order], prepend=~size[order[:1]]) != 0))
    group = np.empty(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(order))))
    copies, links = (np.bincount(group, weights=x.astype(np.float64)).astype(np.int64) for x in (copies, links))
    first = order[new][group]
    known = np.flatnonzero((block >= 0) & ((copies > 1) | (links > 0))[group])
    known = known[np.argsort(block[known], kind="stable")]
    out = [item, none[first], doc[first], line[first], links[group]]
    yield row_batch([(0, b, 0, pack([x[known[i:j]] for x in out])) for b, i, j in blobs.slices(block[known])])


@blobs.lean
def _removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for slab, data in _each(batches):
        m = len(slab.size)
        none, doc, line, links = np.ones(m, bool), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
        known = np.zeros(m, bool)
        for t in data["known"] or []:
            item, *x = unpack(t)
            item = item.astype(np.int64)
            none[item], doc[item], line[item], links[item], known[item] = x[0], unzigzag(x[1]), x[2], x[3], True
        own, s, at = slab.line, slab.set, slab.holder
        own_none, own_doc = slab.none[at], slab.doc[at]
        same = (none[s] == own_none) & (own_none | (doc[s] == own_doc))
        before = (none[s] & ~own_none) | ((none[s] == own_none) & ~own_none & (doc[s] < own_doc))
        gone = known[s] & (before | (same & (line[s] < own)))
        n = len(slab.n_lines)
        _, pick = np.unique(at * max(1, m) + s, return_index=True)
        n_links = np.bincount(at[pick], weights=links[s[pick]], minlength=n).astype(np.int64)
        g = np.flatnonzero(gone)
        per_doc = np.bincount(at[g], minlength=n)
        ends = np.concatenate([[0], np.cumsum(per_doc)])
        # the class: the first document that any of the lines matches
        low, to_none = slab.doc.copy(), slab.none.copy()
        np.minimum.at(low, at[g], np.where(none[s[g]], low[at[g]], doc[s[g]]))
        np.logical_or.at(to_none, at[g], none[s[g]])
        lists = lambda v, t, mask=None: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t, mask=mask))
        columns = [pa.array(slab.doc, pa.int64(), mask=slab.none), pa.array(slab.row), pa.array(slab.n_lines, pa.int32()), lists(own[g], pa.int32()), lists(doc[s[g]], pa.int64(), none[s[g]]), lists(line[s[g]], pa.int32()), pa.array(low, pa.int64(), mask=to_none), pa.array(n_links)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "n_lines", "removed", "match_doc", "match_line", "class_id", "n_links"])


def removals(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, row (a hash of its text), n_lines, removed (ascending line
    numbers), match_doc and match_line (the earliest line that matches each of them), class_id (the doc_id of the earliest
    document with a line that matches one of its lines, itself included) and n_links (other sets of words that match one
    of its lines' sets, summed over its distinct ones)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    parts = blocks(rows)
    rows = rows.select("doc_id", F.xxhash64("text").alias("row"), "text")
    slabs = cut_by(rows.mapInArrow(_slabs, SLABS), "block", parts, "slabs")
    asked = slabs.select("block", "hash", "sets").mapInArrow(_ask(parts), ROW).repartitionById(parts, F.col("target").cast("int"))
    rarity = cut(asked.mapInArrow(_answer, ROW), "rarity")
    totals = rarity.groupBy(F.col("target").alias("block")).agg(F.collect_list(F.struct("origin", "data")).alias("totals"))
    known = slabs.join(totals.hint("shuffle_hash"), "block")
    tables: list[DataFrame] = [rarity]

    def keep(frame: DataFrame, name: str) -> DataFrame:
        tables.append(cut(frame, name))
        return tables[-1]

    told = set_join.alive(known.mapInArrow(_posts(parts), ROW), parts, keep)
    sets = known.select("block", "hash", "sets", "totals").join(told.hint("shuffle_hash"), "block").mapInArrow(_sets(parts), ROW)
    links = cut(sets.repartitionById(parts, F.col("target").cast("int")).mapInArrow(_verify(parts), ROW), "links")
    for done in tables:
        drop(done)
    owned = slabs.mapInArrow(_register(parts), ROW).unionByName(links).repartitionById(parts, F.col("target").cast("int")).mapInArrow(_own, ROW)
    answers = owned.groupBy(F.col("target").alias("block")).agg(F.collect_list("data").alias("known"))
    return slabs.join(answers.hint("shuffle_hash"), "block", "left").mapInArrow(_removals, REMOVALS)


def apply(docs: DataFrame) -> DataFrame:
    """``docs`` with column text less the removed lines; a text that loses nothing stays as it is, null too."""
    gone = removals(docs).where(F.size("removed") > 0).select(F.col("doc_id").alias("doc"), "row", "removed").dropDuplicates(["doc", "row"])
    whole = docs.select(F.struct("*").alias("d")).alias("x")
    text = F.coalesce(F.col("d.text").cast("string"), F.lit(""))
    on = F.col("d.doc_id").cast("long").eqNullSafe(F.col("g.doc")) & (F.xxhash64(text) == F.col("g.row"))
    joined = whole.join(gone.alias("g"), on, "left")
    kept = F.array_join(F.filter(F.split("d.text", "\n"), lambda line, i: ~F.array_contains("g.removed", i)), "\n")
    out = joined.select("d", F.when(F.col("g.removed").isNotNull(), kept).otherwise(F.col("d.text")).alias("text"))
    return out.select(*(F.col("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: see ``removals``; the lists are joined by commas, and a match is ``doc_id:line``."""
    out = removals(table(spark, sf_dir, "documents"))
    matched = F.transform(F.arrays_zip("match_doc", "match_line"), lambda m: F.concat(m["match_doc"].cast("string"), F.lit(":"), m["match_line"].cast("string")))
    joined = lambda c: F.array_join(c, ",", "")
    counts = (F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"))
    return out.select("doc_id", *counts, "class_id", "n_links", joined(F.col("removed").cast("array<string>")).alias("removed"), joined(matched).alias("matches"))
