r"""Operator 2: removal of repeated byte strings by a hash-compared suffix sort.

Every byte of a text (UTF-8) is removed that a string of ``LENGTH`` bytes covers which also starts earlier: in a
document of smaller doc_id, or in the same one at an earlier byte. Strings never cross documents and are judged on the
input.

1. Copies of whole texts: of each text the least doc_id stays as it is judged below; the others lose all (if long
   enough), and take no part in what follows.
2. Anchors: of each string of ``LENGTH`` bytes the ``GRAM``-byte gram of least hash, the leftmost of equals, is its
   anchor. Equal strings have equal anchors at equal offsets, and neighbours share theirs, so that about one byte in 35
   is an anchor. Blocks of documents ask how often their anchors' hashes occur in the corpus (see ``blobs``).
3. Strings around anchors that occur once are unique. The others, as one stretch of bytes for each anchor, meet the
   equal anchors of all documents; equal stretches of one block go as one, the least, and the others are known to repeat.
4. There the suffixes of the stretches at each offset are merge-sorted, but for those whose string's hash is unique. A
   comparison takes prefix polynomial hashes and finds the common extension by binary search. Neighbours in the order
   whose common extension is a whole string are equal, which is verified byte by byte; where hashes collide, the offset
   goes by its bytes. Of equal strings all but the earliest repeat.

Nulls: a null text is empty, a null doc_id is kept and comes first. Rows of equal doc_id count as one document: they are
earlier or later by start alone, so that repeated rows fare alike. A very long text goes through its tasks in pieces, but is
one row. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blobs
from .common import blocks, cut, table, text_or_empty

LENGTH, GRAM = 100, 32
#: Offsets of a string's anchor; strings around one anchor; bytes of a stretch.
SPAN = LENGTH - GRAM + 1
STRETCH = SPAN - 1 + LENGTH
#: Strings whose anchors are found at once, and suffixes that are sorted at once.
PIECE, SORTED = 500_000, 300_000
ASK, COPY, ANSWER, MEET, REPEAT, DOCUMENT = range(1, 7)
BASE = 0x9E3779B97F4A7C15 | 1
LEAST = -(2**63)
PLACE = np.dtype([("key", "<i8"), ("start", "<i8"), ("doc", "<i4"), ("low", "<i2"), ("high", "<i2")])
MASK = ~np.uint64(127)


def powers(n: int, base: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))]))


_tables: list[np.ndarray] = []


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place and hash of each anchor in ``data``, texts that end at ``ends`` one after another, and the first and last
    start of the strings that have it. A text is cut where it is long; an anchor may come twice, with other strings."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    if not _tables or len(_tables[0]) <= len(data):
        _tables[:] = [powers(max(len(data), 2 * PIECE), BASE), powers(max(len(data), 2 * PIECE), pow(BASE, -1, 2**64))]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _tables[0][: len(data)], out=sums[1:])
    grams = (sums[GRAM:] - sums[:-GRAM]) * _tables[1][: len(data) - GRAM + 1]
    grams ^= grams >> np.uint64(33)
    grams *= np.uint64(0xFF51AFD7ED558CCD)
    grams ^= grams >> np.uint64(29)
    n = len(grams)
    blocks = -(-n // SPAN) + 1
    key = np.full(blocks * SPAN, np.uint64(2**64 - 1))
    key[:n] = grams & MASK
    grid = key.reshape(blocks, SPAN)
    grid |= np.arange(SPAN, dtype=np.uint64)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(len(data) - LENGTH + 1)
    sizes = np.diff(ends, prepend=0)
    start = start[start + LENGTH <= np.repeat(ends, sizes)[: len(start)]]
    left, right = behind[start], ahead[start + SPAN - 1]
    best = np.where(left & MASK <= right & MASK, start // SPAN * SPAN + (left & np.uint64(127)).astype(np.int64), (start + SPAN - 1) // SPAN * SPAN + (right & np.uint64(127)).astype(np.int64))
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(best) != 0) | (np.diff(start) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    # least hashes crowd at the low end: mixed again, so that they spread over the buckets
    value = grams[best[first]] * np.uint64(0xD6E8FEB86659FD93)
    value = (value ^ value >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return best[first], value ^ value >> np.uint64(32), start[first], start[last]


class Block:
    """A block's documents in order, and the anchors of those that are not copies."""

    def __init__(self, copies: set):
        self.copies = copies
        self.keys: list[int] = []
        self.rows: list[int] = []
        self.parts: list[tuple] = []
        self.data: list[np.ndarray] = []
        self.waiting: list[tuple[int, int, np.ndarray]] = []
        self.size = 0

    def add(self, doc_id: int | None, row: int, text: str, keep: bool) -> None:
        number = len(self.keys)
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        self.keys.append(LEAST if doc_id is None else doc_id)
        self.rows.append(row)
        self.data.append(data if keep else data[:0])
        if (doc_id, row) in self.copies:
            return
        for at in range(0, len(data) - LENGTH + 1, PIECE):
            part = data[at : at + PIECE + LENGTH - 1]
            self.waiting.append((number, at, part))
            self.size += len(part)
            if self.size >= PIECE:
                self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        docs, offsets, parts = zip(*self.waiting)
        ends = np.cumsum([len(p) for p in parts])
        place, value, first, last = anchors(np.concatenate(parts), ends)
        which = np.searchsorted(ends, first, side="right")
        back = np.concatenate([[0], ends])[which] - np.array(offsets)[which]
        self.parts.append((np.array(docs, np.int64)[which], place - back, value, first - back, last - back))
        self.waiting, self.size = [], 0

    def finish(self) -> None:
        self.flush()
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.doc, self.place, self.value, self.first, self.last = (np.concatenate(c) for c in zip(*(self.parts or [empty])))
        self.parts = []
        self.distinct, self.inverse, self.count = np.unique(self.value, return_inverse=True, return_counts=True)


def _read(batches: Iterator[pa.RecordBatch], keep: bool) -> tuple[Block, list]:
    """Copies and answers come first, then documents by doc_id and row."""
    copies: set = set()
    block, answers = Block(copies), []
    for b in batches:
        kind = b.column(0).to_numpy()
        docs = int(np.searchsorted(kind, DOCUMENT))
        head = b.slice(0, docs)
        for k, a, c, doc_id, row in zip(*(head.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
            if k == COPY:
                copies.add((doc_id, row))
            else:
                answers.append((k, a, c))
        for at in range(docs, b.num_rows, 256):
            part = b.slice(at, 256)
            for doc_id, row, text in zip(*(part.column(i).to_pylist() for i in (4, 5, 6))):
                block.add(doc_id, row, text, keep)
    return block, answers


def _ask(parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, _ = _read(batches, False)
        block.finish()
        for b, i, j in blobs.slices(blobs.bucket_of(block.distinct, 64, parts)):
            yield blobs.batch([(ASK, b, TaskContext.get().partitionId(), blobs.steps(block.distinct[i:j]), blobs.packed(np.minimum(block.count[i:j], 2)), None, None)])

    return ask


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    asked = [(row[2], blobs.unstepped(row[3]), blobs.unpacked(row[4])) for b in batches for row in zip(*(c.to_pylist() for c in b.columns))]
    if not asked:
        return
    _, at = np.unique(np.concatenate([k for _, k, _ in asked]), return_inverse=True)
    again = np.bincount(at, weights=np.concatenate([n for _, _, n in asked]).astype(np.float64))[at] > 1
    i = 0
    for block, keys, _ in asked:
        yield blobs.batch([(ANSWER, block, TaskContext.get().partitionId(), np.packbits(again[i : i + len(keys)]).tobytes(), len(keys).to_bytes(8, "little"), None, None)])
        i += len(keys)


def _meet(parts: int):
    """Stretches around anchors that occur again, to their buckets; the block's own repeats, back to it."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, answers = _read(batches, True)
        block.finish()
        if not len(block.value):
            return
        again = np.concatenate([np.unpackbits(np.frombuffer(a, np.uint8), count=int.from_bytes(c, "little")) for _, a, c in answers]).astype(bool)
        pick = np.flatnonzero(again[block.inverse])
        pick = pick[np.lexsort((block.place[pick], np.array(block.keys)[block.doc[pick]], block.value[pick]))]
        me = TaskContext.get().partitionId()
        bucket = blobs.bucket_of(block.value[pick], 64, parts)
        for b, i, j in blobs.slices(bucket):
            at = pick[i:j]
            places = np.zeros(len(at), PLACE)
            places["doc"], places["key"] = block.doc[at], np.array(block.keys)[block.doc[at]]
            places["start"] = block.place[at] - (SPAN - 1)
            places["low"], places["high"] = block.first[at] - places["start"], block.last[at] - places["start"]
            bytes_ = np.zeros((len(at), STRETCH), np.uint8)
            for k, (d, s, lo, hi) in enumerate(zip(places["doc"].tolist(), places["start"].tolist(), places["low"].tolist(), places["high"].tolist())):
                bytes_[k, lo : hi + LENGTH] = block.data[d][s + lo : s + hi + LENGTH]
            value = block.value[at]
            repeats = equal_rows(value, bytes_, places)
            if repeats.any():
                yield blobs.batch([(REPEAT, me, b, *spans(places[repeats], None), None, None)])
            left = ~repeats
            yield blobs.batch([(MEET, b, me, blobs.steps(value[left]), bytes_[left].tobytes(), places[left].tobytes(), None)])

    return meet


def equal_rows(value: np.ndarray, bytes_: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Rows (by hash, then place) that hold just what an earlier place holds."""
    power = powers(STRETCH - 1, BASE)
    name = ((bytes_.astype(np.uint64) + np.uint64(1)) * power).sum(1, dtype=np.uint64) + (places["low"].astype(np.uint64) << np.uint64(32)) + places["high"].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.lexsort((np.arange(len(value)), name, value))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(value[order]) != 0) | (np.diff(name[order]) != 0)
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    same = (bytes_[order] == bytes_[first]).all(1) & (places["low"][order] == places["low"][first]) & (places["high"][order] == places["high"][first])
    later = (places["key"][order] > places["key"][first]) | ((places["key"][order] == places["key"][first]) & (places["start"][order] > places["start"][first]))
    out = np.zeros(len(order), bool)
    out[order] = same & later & ~new
    return out


def spans(places: np.ndarray, repeat: np.ndarray | None) -> tuple[bytes, bytes]:
    """(document, start, stop) of repeated bytes as two columns; ``repeat`` says which strings (rows, offsets) repeat,
    None: all that the places have."""
    if repeat is None:
        row, low, high = np.arange(len(places)), places["low"].astype(np.int64), places["high"].astype(np.int64)
    else:
        edge = np.diff(np.pad(repeat.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(edge == 1)
        high = np.nonzero(edge == -1)[1] - 1
    start = places["start"][row] + low
    return blobs.packed(places["doc"][row].astype(np.uint64)), blobs.packed(start.astype(np.uint64)) + blobs.packed((high - low).astype(np.uint64))


class Stretches:
    """Stretches with equal anchors, and their suffixes' order. Rows are grouped by hash, in a group by place."""

    def __init__(self, bytes_: np.ndarray):
        self.bytes = bytes_
        power = powers(STRETCH - 1, BASE)
        self.sums = np.zeros((len(bytes_), STRETCH + 1), np.uint64)
        np.cumsum((bytes_.astype(np.uint64) + np.uint64(1)) * power, axis=1, out=self.sums[:, 1:])

    def extension(self, x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Common bytes of rows x and y from offset ``at``, up to LENGTH: by binary search on prefix hashes."""
        sx, sy = self.sums[x, at], self.sums[y, at]
        low = np.zeros(len(x), np.int64)
        whole = self.sums[x, at + LENGTH] - sx == self.sums[y, at + LENGTH] - sy
        low[whole] = LENGTH
        open_ = np.flatnonzero(~whole)
        x, y, at, sx, sy = x[open_], y[open_], at[open_], sx[open_], sy[open_]
        lo, hi = np.zeros(len(open_), np.int64), np.full(len(open_), LENGTH)  # equal on lo bytes, unequal on hi
        for _ in range(LENGTH.bit_length()):
            mid = (lo + hi) >> 1
            equal = self.sums[x, at + mid] - sx == self.sums[y, at + mid] - sy
            lo, hi = np.where(equal, mid, lo), np.where(equal, hi, mid)
        low[open_] = lo
        return low

    def compare(self, x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
        """-1, 0, 1 as the string of row x at an offset is before, equal to or after that of row y."""
        common = self.extension(x, y, at)
        out = np.zeros(len(x), np.int8)
        differ = np.flatnonzero(common < LENGTH)
        p = at[differ] + common[differ]
        out[differ] = np.where(self.bytes[x[differ], p] < self.bytes[y[differ], p], -1, 1)
        return out

    def sort(self, row: np.ndarray, at: np.ndarray, seg: np.ndarray) -> np.ndarray:
        """Merge sort of suffixes (row, offset) inside segments, stable; all segments and runs of a level at once."""
        row = row.copy()
        starts = np.flatnonzero(np.diff(seg, prepend=-1))
        sizes = np.diff(np.append(starts, len(seg)))
        start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        width = 1
        while width < (sizes.max() if len(sizes) else 0):
            el = np.flatnonzero(size > width)
            local = el - start[el]
            run = local // width
            other = start[el] + (run ^ 1) * width
            stop = np.minimum(other + width, start[el] + size[el])
            other = np.minimum(other, stop)
            right = (run & 1).astype(bool)
            lo, hi = other.copy(), stop.copy()  # the first of the other run that comes after this element
            while True:
                act = np.flatnonzero(lo < hi)
                if not len(act):
                    break
                mid = (lo[act] + hi[act]) >> 1
                c = self.compare(row[el[act]], row[mid], at[el[act]])
                before = np.where(right[act], c >= 0, c > 0)  # equal ones of a left run stay before
                lo[act] = np.where(before, mid + 1, lo[act])
                hi[act] = np.where(before, hi[act], mid)
            to = start[el] + (run & ~1) * width + local % width + (lo - other)
            merged = row.copy()
            merged[to] = row[el]
            row = merged
            width *= 2
        return row

    def repeated(self, row: np.ndarray, at: np.ndarray, seg: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and offsets of strings that an earlier place has too. Elements come by segment, then place.

        A string whose hash occurs once in its segment equals no other and is left out. The others are sorted, and
        repeats are read off the order: neighbours whose common extension is a whole string are equal, and of these the
        first is the earliest, since the sort is stable. Equality of neighbours is verified byte by byte.
        """
        name = self.sums[row, at + LENGTH] - self.sums[row, at] + seg.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        name = (name ^ name >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(name, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = np.diff(name[order]) != 0
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        el = np.sort(order[np.repeat(size > 1, size)])
        in_order, p, s_ = self.sort(row[el], at[el], seg[el]), at[el], seg[el]
        linked = np.zeros(len(el), bool)
        if len(el) > 1:
            linked[1:] = (s_[1:] == s_[:-1]) & (self.extension(in_order[:-1], in_order[1:], p[1:]) == LENGTH)
        strings = np.lib.stride_tricks.sliding_window_view(self.bytes, LENGTH, axis=1)
        wrong, pairs = np.zeros(len(el), bool), np.flatnonzero(linked)
        for k in range(0, len(pairs), 50_000):
            e = pairs[k : k + 50_000]
            wrong[e] = (strings[in_order[e], p[e]] != strings[in_order[e - 1], p[e]]).any(1)
        head = np.maximum.accumulate(np.where(linked, 0, np.arange(len(el)))) if len(el) else el
        doubtful = np.unique(s_[wrong])
        good = linked & ~np.isin(s_, doubtful)
        later_rows, first_rows, later_at = in_order[good], in_order[head[good]], p[good]
        for s in doubtful.tolist():  # hashes collided: these offsets go by their bytes
            own = np.flatnonzero(seg == s)
            earliest: dict[bytes, int] = {}
            heads = np.array([earliest.setdefault(self.bytes[row[i], at[i] : at[i] + LENGTH].tobytes(), i) for i in own.tolist()])
            later_rows, first_rows, later_at = (np.concatenate(x) for x in ((later_rows, row[own]), (first_rows, row[heads]), (later_at, at[own])))
        f, r = places[first_rows], places[later_rows]
        later = (r["key"] > f["key"]) | ((r["key"] == f["key"]) & (r["start"] > f["start"]))
        return later_rows[later], later_at[later]


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    value, data, place, origin = [], [], [], []
    me = TaskContext.get().partitionId()
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            value.append(blobs.unstepped(row[3]))
            data.append(np.frombuffer(row[4], np.uint8).reshape(-1, STRETCH))
            place.append(np.frombuffer(row[5], PLACE))
            origin.append(np.full(len(place[-1]), row[2]))
    if not value:
        return
    value, place, origin = np.concatenate(value), np.concatenate(place), np.concatenate(origin)
    base = np.cumsum([0] + [len(d) for d in data])
    order = np.lexsort((place["start"], place["key"], value))
    value = value[order]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(value) != 0]))
    sizes = np.diff(np.append(starts, len(value)))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    done = np.cumsum(sizes)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + SORTED // SPAN)))
        pick = np.concatenate([order[s : s + n] for s, n in zip(starts[at:stop].tolist(), sizes[at:stop].tolist())])
        group = np.repeat(np.arange(stop - at), sizes[at:stop])
        which = np.searchsorted(base, pick, side="right") - 1
        rows = np.stack([data[w][p] for w, p in zip(which.tolist(), (pick - base[which]).tolist())])
        places, origins = place[pick], origin[pick]
        stretches = Stretches(rows)
        repeat = np.zeros((len(pick), SPAN), bool)
        step = max(1, SORTED // len(pick))
        for low in range(0, SPAN, step):  # offsets at a time, so that a large group stays in memory
            offset = np.arange(low, min(low + step, SPAN))
            has = (places["low"][:, None] <= offset) & (offset <= places["high"][:, None])
            row, column = np.nonzero(has)
            order_ = np.lexsort((row, column, group[row]))
            row, column = row[order_], column[order_]
            seg = group[row] * SPAN + column
            r, a = stretches.repeated(row, offset[column], seg, places)
            repeat[r, a] = True
        any_ = repeat.any(1)
        for o in np.unique(origins[any_]).tolist():
            mine = any_ & (origins == o)
            yield blobs.batch([(REPEAT, o, me, *spans(places[mine], repeat[mine]), None, None)])
        at = stop


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    copies: set = set()
    found: list[np.ndarray] = []
    spans_of: np.ndarray | None = None
    number, before, last = 0, None, None
    for b in batches:
        docs = int(np.searchsorted(b.column(0).to_numpy(), DOCUMENT))
        head = b.slice(0, docs)
        for k, a, c, doc_id, row in zip(*(head.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
            if k == COPY:
                copies.add((doc_id, row))
            else:
                cut_ = 9 + c[0] * int.from_bytes(c[1:9], "little")
                start = blobs.unpacked(c[:cut_]).astype(np.int64)
                found.append(np.stack([blobs.unpacked(a).astype(np.int64), start, start + blobs.unpacked(c[cut_:]).astype(np.int64) + LENGTH], 1))
        if docs == b.num_rows:
            continue
        if spans_of is None:
            spans_of = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            spans_of = spans_of[np.lexsort((spans_of[:, 1], spans_of[:, 0]))]
        out = []
        for doc_id, row, text in zip(*(b.column(i).slice(docs).to_pylist() for i in (4, 5, 6))):
            data = text.encode("utf-8", "surrogatepass")
            lo, hi = np.searchsorted(spans_of[:, 0], [number, number + 1])
            mine = spans_of[lo:hi, 1:]
            if (doc_id, row) in copies:
                mine = np.array([[0, len(data)]]) if len(data) >= LENGTH else mine
            elif before == (doc_id, row):
                mine = last  # a repeated row
            before, last = (doc_id, row), mine
            number += 1
            kept, at, n_spans = [], 0, 0
            reach = -1
            for start, stop in mine.tolist():
                if start > reach:
                    n_spans += 1
                    kept.append(data[max(at, 0) : start])
                if stop > reach:
                    reach = at = stop
            kept.append(data[at:])
            rest = b"".join(kept)
            out.append((doc_id, len(data), len(data) - len(rest), n_spans, hashlib.sha256(rest).hexdigest(), rest))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string(), pa.binary()])], names=names)


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of each row of ``docs``."""
    none = F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    parts = blocks(rows)
    target = F.pmod(F.xxhash64("doc_id", "row"), F.lit(parts)).cast("int").alias("target")
    rows = rows.withColumn("row", F.xxhash64("text"))
    names = cut(rows.where(F.octet_length("text") >= LENGTH).select("doc_id", "row", F.sha2("text", 256).alias("sha")), "names")
    first = names.groupBy("sha").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(LEAST)).alias("k"))).alias("first"), F.count_distinct(F.coalesce("doc_id", F.lit(LEAST))).alias("n")).where("n > 1")
    copies = cut(names.join(first, "sha").where(F.coalesce("doc_id", F.lit(LEAST)) > F.col("first.k")).select(F.lit(COPY).alias("kind"), F.lit(0).alias("origin"), none.cast("binary").alias("a"), none.cast("binary").alias("b"), "doc_id", "row", none.cast("string").alias("text"), target), "copies")
    documents = rows.select(F.lit(DOCUMENT).alias("kind"), F.lit(0).alias("origin"), none.cast("binary").alias("a"), none.cast("binary").alias("b"), "doc_id", "row", "text", target)

    def with_documents(*more: DataFrame) -> DataFrame:
        out = copies
        for m in more:
            out = out.unionByName(m.select("kind", "origin", "a", "b", none.cast("long").alias("doc_id"), none.cast("long").alias("row"), none.cast("string").alias("text"), "target"))
        met = out.unionByName(documents).repartitionById(parts, F.col("target"))
        return met.sortWithinPartitions("kind", "origin", "doc_id", "row").drop("target")

    asked = blobs.to_target(with_documents().mapInArrow(_ask(parts), blobs.SCHEMA), parts)
    answers = cut(asked.mapInArrow(_answer, blobs.SCHEMA), "answers")
    met = cut(with_documents(answers).mapInArrow(_meet(parts), blobs.SCHEMA), "stretches")
    sorted_ = cut(blobs.to_target(met.where(F.col("kind") == MEET), parts).mapInArrow(_sort, blobs.SCHEMA), "repeats")
    repeats = sorted_.unionByName(met.where(F.col("kind") == REPEAT))
    return with_documents(repeats).mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).drop("kept")
