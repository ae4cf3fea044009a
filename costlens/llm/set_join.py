r"""What the exact joins of sets share: posts of prefixes, the filters that drop pairs, and verification on whole sets.

A set is an array of 64-bit word hashes in one order of all words. Two sets of Jaccard similarity 0.8 or more share a word
that is in both prefixes; they meet once, at the first word that they share. A post says that a set has a word at a place
of its prefix. Posts travel in packed slices; what a task returns is the posts that have a possible partner (*alive*), so
results grow with the posts and not with the pairs. Only alive posts have their sets' words sent after them, and each task
then verifies the pairs of its words and adds them up for each set.

Words shared by very many sets: a task holds at most ``HELD`` posts; words with more than ``LIMIT`` of them leave it and
are met in cells, pairs of pieces of at most about ``LIMIT`` posts, each of which is a task's small share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blobs
from .word_hash import mixed, numbered, order_of

#: Jaccard similarity, as a fraction.
TOP, UNDER = 4, 5
#: Posts of a word that are compared in one cell, and posts that a task holds before it looks for such words.
LIMIT, HELD = 16_000, 3_000_000
#: Pairs that are looked at in one array operation.
PAIRS = 500_000
#: Rounds in which ``Verifier.labels`` takes one pair of each row before it takes all that are left.
LEADS = 6
#: cell: the word, 48 bits; name: the set; prev: 40 bits of the word before; lead, second: of the set's first two words,
#: or zero; bits: parities of the set's words in 64 groups; item and block: where its words are; none, doc, line: where it
#: is first; side: see ``_spread``.
POST = ("cell", "name", "prev", "lead", "second", "bits", "size", "place", "item", "none", "doc", "line", "side", "block")
ALIVE, HOT = 1, 2
Rows = dict[str, np.ndarray]


def zigzag(x: np.ndarray) -> np.ndarray:
    return ((x << 1) ^ (x >> 63)).view(np.uint64)


def unzigzag(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(1)) ^ (np.uint64(0) - (x & np.uint64(1)))).view(np.int64)


def pack(arrays: list[np.ndarray]) -> bytes:
    return b"".join(blobs.packed(x) for x in arrays)


def unpack(data: bytes) -> list[np.ndarray]:
    view, out, at = memoryview(data), [], 0
    while at < len(view):
        size = 9 + view[at] * int.from_bytes(view[at + 1 : at + 9], "little")
        out.append(blobs.unpacked(view[at : at + size]))
        at += size
    return out


def joined(parts: list[Rows], names: tuple[str, ...]) -> Rows:
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.uint64) for k in names}


def taken(rows: Rows, at: np.ndarray) -> Rows:
    return {k: v[at] for k, v in rows.items()}


def row_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (kind, target, origin, data)."""
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=["kind", "target", "origin", "data"])


ROW = "kind int, target long, origin long, data binary"


def by_bucket(cell: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, indices ascending by cell) of 48-bit cells."""
    order = order_of(cell)
    return [(b, order[i:j]) for b, i, j in blobs.slices(blobs.bucket_of(cell[order], 48, parts))]


def buckets(rows: Rows, parts: int) -> Iterator[tuple[int, Rows]]:
    """(bucket, its rows ascending by cell): rows are put in order once, and a bucket's are a piece of them."""
    rows = taken(rows, order_of(rows["cell"]))
    for b, i, j in blobs.slices(blobs.bucket_of(rows["cell"], 48, parts)):
        yield b, {k: v[i:j] for k, v in rows.items()}


def sent_posts(rows: Rows) -> bytes:
    """Posts of one block, ascending by cell."""
    return pack([np.diff(rows["cell"], prepend=rows["cell"][:1] * 0), *(rows[k] for k in POST[1:-1])])


def read_posts(data: bytes, block: int | None) -> Rows:
    """Posts of a block; where a set's own name says where its words are, ``block`` is None."""
    found = unpack(data)
    rows = dict(zip(POST[:-1], [np.cumsum(found[0], dtype=np.uint64), *found[1:]]))
    return rows | {"block": rows["name"] if block is None else np.full(len(found[0]), block, np.int64).view(np.uint64)}


def parities(words: np.ndarray) -> np.ndarray:
    """The bit of each word's group; a set's bits are their exclusive or."""
    return np.left_shift(np.uint64(1), mixed(words) >> np.uint64(58))


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Words that sets of n and m share at least."""
    return -(-TOP * (n + m) // (TOP + UNDER))


def distinct(rows: Rows) -> Rows:
    """Posts of cells that have several, by cell and size; of one set's posts in a cell and side only the first."""
    at = order_of(rows["cell"])
    cell = rows["cell"][at]
    same = cell[1:] == cell[:-1]
    at = at[np.append(same, False) | np.append(False, same)] if len(at) else at
    if not len(at):
        return taken(rows, at)
    cell, size, name = (rows[k][at] for k in ("cell", "size", "name"))
    group = np.cumsum(np.diff(cell, prepend=cell[:1]) != 0).astype(np.uint64)
    rank = (group * (size.max() + np.uint64(1)) + size) * np.uint64(3) + rows["side"][at]
    # by rank and name: one sort by what of both fits in a number, unless names that differ agree there
    order = np.argsort(rank << np.uint64(24) | name >> np.uint64(40)) if rank.max() < 1 << 40 else None
    if order is not None:
        r, x = rank[order], name[order]
        if ((r[1:] == r[:-1]) & (x[1:] != x[:-1]) & (x[1:] >> np.uint64(40) == x[:-1] >> np.uint64(40))).any():
            order = None
    if order is None:
        order = np.lexsort((name, rank))
    rank, name = rank[order], name[order]
    order = at[order]
    new = np.ones(len(order), bool)
    new[1:] = (rank[1:] != rank[:-1]) | (name[1:] != name[:-1])
    if not new.all():  # of copies, the first by place
        again = np.flatnonzero(~new | np.append(~new[1:], False))
        at, run = order[again], np.cumsum(new)[again]
        order[again] = at[np.lexsort((rows["line"][at], unzigzag(rows["doc"][at]), rows["none"][at] == 0, run))]
    return taken(rows, order[new])


def possible(rows: Rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one cell (see ``distinct``) that lengths, places, parities and the words before allow to be similar
    sets whose first shared word this is."""
    n = len(rows["cell"])
    if not n:
        return
    group = np.cumsum(np.diff(rows["cell"], prepend=rows["cell"][:1]) != 0).astype(np.int64)
    size, place, side = (rows[k].astype(np.int64) for k in ("size", "place", "side"))
    wide = int(size.max()) + 1
    low = np.searchsorted(group * wide + size, group * wide - (-TOP * size // UNDER))
    reach = np.arange(n) - low
    ends = np.cumsum(reach)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
        r = reach[at:stop]
        j = np.repeat(np.arange(at, stop), r)
        i = low[j] + np.arange(len(j)) - np.repeat(np.cumsum(r) - r, r)
        need = needed(size[i], size[j])
        ok = np.minimum(size[i] - place[i], size[j] - place[j]) >= need
        i, j, need = i[ok], j[ok], need[ok]
        ok = np.bitwise_count(rows["bits"][i] ^ rows["bits"][j]) <= size[i] + size[j] - 2 * need
        i, j = i[ok], j[ok]
        # a pair that shares an earlier word has met there
        ok = (place[i] == 0) | (place[j] == 0) | (rows["prev"][i] != rows["prev"][j])
        for a, x in enumerate(("lead", "second")):
            for b, y in enumerate(("lead", "second")):
                ok &= (rows[x][i] != rows[y][j]) | (rows[x][i] == 0) | (place[i] <= a) | (place[j] <= b)
        ok &= ((side[i] == 0) | (side[i] != side[j])) & ((rows["name"][i] != rows["name"][j]) | (size[i] != size[j]))
        if ok.any():
            yield i[ok], j[ok]
        at = stop


def alive_rows(rows: Rows) -> list[tuple]:
    """A row for each block: which of its posts have possible partners."""
    rows = distinct(rows)
    has = np.zeros(len(rows["cell"]), bool)
    for i, j in possible(rows):
        has[i] = has[j] = True
    rows = taken(rows, has)
    order = np.argsort(rows["block"], kind="stable")
    rows = taken(rows, order)
    return [(ALIVE, b, 0, pack([rows[k][i:j] for k in ("cell", "name", "place", "item", "none", "doc", "line", "side")])) for b, i, j in blobs.slices(rows["block"].view(np.int64))]


def _meet(limit: int, held_most: int, by_name: bool):
    @blobs.lean
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Rows] = []
        count, hot = 0, np.zeros(0, np.uint64)

        def leave() -> list[tuple]:
            """Takes the posts of frequent words out of what is held."""
            nonlocal held, count, hot
            rows = joined(held, POST)
            cells = np.sort(rows["cell"])
            often = cells[limit:] == cells[:-limit] if len(cells) > limit else np.zeros(0, bool)
            hot = np.union1d(hot, cells[limit:][often])
            if not len(hot):
                held, count = [rows], len(cells)
                return []
            out = np.isin(rows["cell"], hot)
            held = [taken(rows, ~out)]
            count, rows = len(held[0]["cell"]), taken(rows, out)
            rows = taken(rows, np.argsort(rows["cell"], kind="stable"))
            pieces = [(c, x, min(x + limit, j)) for c, i, j in blobs.slices(rows["cell"].view(np.int64)) for x in range(i, j, limit)]
            return [(HOT, c, j - i, pack([rows[k][i:j] for k in POST])) for c, i, j in pieces]

        for b in batches:
            for origin, data in zip(b.column(2).to_pylist(), b.column(3)):
                held.append(read_posts(data.as_buffer(), None if by_name else origin))
                count += len(held[-1]["cell"])
                if count > held_most:
                    yield row_batch(leave())
        if held:
            out = leave()
            yield row_batch(out + alive_rows(held[0]))

    return meet


def _spread(limit: int):
    """Pieces of a frequent word's posts go to the cells of every pair of pieces. Copies of a set are in one piece."""

    @blobs.lean
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cell, data, total in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                rows = dict(zip(POST, unpack(data.as_buffer())))
                pieces = -(-total // limit)
                piece = (mixed(rows["name"]) % np.uint64(pieces)).astype(np.int64)
                for x in np.unique(piece).tolist():
                    own = taken(rows, piece == x)
                    for y in range(pieces):
                        low, high = min(x, y), max(x, y)
                        name = int(mixed(np.array([cell, low, high], np.uint64) + np.uint64(1)) @ np.array([3, 5, 7], np.uint64)) % (1 << 48)
                        own["cell"] = np.full(len(own["name"]), name, np.uint64)
                        own["side"] = np.full(len(own["name"]), 0 if low == high else 1 + (x > y), np.uint64)
                        yield row_batch([(HOT, name, 0, pack([own[k] for k in POST]))])

    return spread


@blobs.lean
def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by cell."""
    held: list[Rows] = []
    last = None
    for b in batches:
        for cell, data in zip(b.column(1).to_pylist(), b.column(3)):
            if cell != last and held:
                yield row_batch(alive_rows(joined(held, POST)))
                held = []
            last = cell
            held.append(dict(zip(POST, unpack(data.as_buffer()))))
    if held:
        yield row_batch(alive_rows(joined(held, POST)))


def alive(posts: DataFrame, parts: int, keep, by_name: bool = False) -> DataFrame:
    """block (or name), told (its packed alive posts): ``posts`` are rows of ``sent_posts`` by bucket; ``keep`` writes a
    table and gives it back."""
    met = keep(posts.repartitionById(parts, F.col("target").cast("int")).mapInArrow(_meet(LIMIT, HELD, by_name), ROW), "met")
    hot = met.where(F.col("kind") == HOT)
    found = met.where(F.col("kind") == ALIVE)
    if not hot.isEmpty():
        totals = hot.groupBy("target").agg(F.sum("origin").alias("total"))
        cells = hot.select("target", "data").join(totals, "target").select("target", "data", "total").mapInArrow(_spread(LIMIT), ROW)
        cells = cells.repartition(4 * parts, "target").sortWithinPartitions("target").mapInArrow(_cells, ROW)
        found = found.unionByName(keep(cells, "cells"))
    return found.groupBy(F.col("target").alias("block")).agg(F.collect_list("data").alias("told"))


TOLD = ("cell", "name", "place", "item", "none", "doc", "line", "side")


def read_alive(told: list[bytes]) -> Rows:
    return joined([dict(zip(TOLD, unpack(t))) for t in told], TOLD)


def sent_sets(rows: Rows, of: np.ndarray, words: np.ndarray, size: np.ndarray, parts: int) -> list[tuple]:
    """Rows by bucket that carry alive posts and, once each, their sets; ``of`` is each post's set, ``words`` come in order
    one set after another."""
    out, start = [], np.cumsum(size) - size
    for b, at in by_bucket(rows["cell"], parts):
        part = taken(rows, at)
        used, own = np.unique(of[at], return_inverse=True)
        n = size[used]
        sent = words[np.repeat(start[used], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        out.append((0, b, 0, pack([*(part[k] for k in TOLD), own, n, sent >> np.uint64(16)])))
    return out


class Verifier:
    """Sets of a bucket's alive posts, by cell and size; ``similar`` yields their similar pairs."""

    def __init__(self, found: list[list[np.ndarray]]):
        names = (*TOLD, "set")
        rows = joined([dict(zip(names, f)) for f in found], names)
        size, words = (np.concatenate([f[k] for f in found]) for k in (len(names), len(names) + 1))
        size = size.astype(np.int64)
        before = np.cumsum([0] + [len(f[len(names)]) for f in found])[:-1]
        of = rows["set"].astype(np.int64) + np.repeat(before, [len(f[0]) for f in found])
        start = np.cumsum(size) - size
        kinds, self.word = numbered(words)
        bits = np.bitwise_xor.reduceat(parities(kinds)[self.word], start) if len(size) else words
        place = rows["place"].astype(np.int64)
        none = np.zeros(len(of), np.uint64)
        first, second = (words[start[of] + np.minimum(k, size[of] - 1)] for k in (0, 1))
        rows |= {"set": of.astype(np.uint64), "size": size[of].astype(np.uint64), "bits": bits[of], "prev": words[np.maximum(start[of] + place - 1, 0)], "lead": first, "second": np.where(size[of] > 1, second, none)}
        self.rows = distinct(rows)
        self.n, self.set = len(self.rows["cell"]), self.rows["set"].astype(np.int64)
        self.start, self.size = start[self.set], size[self.set]
        self.kinds = max(1, len(kinds))
        self.table = np.sort(np.repeat(np.arange(len(size)), size) * self.kinds + self.word)

    def checked(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs are similar and have their post's word as the first that they share."""
        ok, at = np.zeros(len(i), bool), 0
        ends = np.cumsum(self.size[i])
        while at < len(i):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
            x, y = i[at:stop], j[at:stop]
            n = self.size[x]
            first = np.cumsum(n) - n
            ask = np.repeat(self.set[y], n) * self.kinds + self.word[np.repeat(self.start[x], n) + np.arange(n.sum()) - np.repeat(first, n)]
            hit = self.table[np.minimum(np.searchsorted(self.table, ask), len(self.table) - 1)] == ask
            both = np.add.reduceat(hit, first, dtype=np.int64)
            place = self.rows["place"].astype(np.int64)[x]
            before = np.cumsum(hit)
            met = hit[first + place] & (before[first + place] - hit[first + place] == before[first] - hit[first])
            ok[at:stop] = met & (UNDER * both >= TOP * (n + self.size[y] - both))
            at = stop
        return ok

    def similar(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i, j in possible(self.rows):
            ok = self.checked(i, j)
            if ok.any():
                yield i[ok], j[ok]

    def labels(self) -> np.ndarray:
        """The least row of each row's component of similar pairs. Pairs that are in one component already are not
        verified, so a large group of copies takes few rounds and not all its pairs."""
        label = np.arange(self.n)
        for i, j in possible(self.rows):
            for turn in range(LEADS + 1):
                apart = label[i] != label[j]
                i, j = i[apart], j[apart]
                if not len(i):
                    break
                if turn < LEADS:  # of each row one pair
                    _, at = np.unique(j, return_index=True)
                else:
                    at = np.arange(len(i))
                ok = self.checked(i[at], j[at])
                label = merged(label, i[at][ok], j[at][ok])
                left = np.ones(len(i), bool)
                left[at] = False
                i, j = i[left], j[left]
        return label


def merged(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Components after links between rows: labels are least rows."""
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            return label
        label = new
