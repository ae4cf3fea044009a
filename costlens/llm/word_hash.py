r"""Words of whole batches as 64-bit hashes, by array operations.

A word's hash is a polynomial of its bytes modulo 2**64, mixed; words of more than ``LONG`` bytes are hashed by XXH64. No
Python object is made for a word. Different words of a corpus of n distinct ones get equal hashes with a chance of about
n * n / 2**65.
"""

from __future__ import annotations

import numpy as np
import xxhash

LONG = 64
#: Bytes handled at once, so that the arrays stay in a core's cache.
PIECE = 250_000
BASE = 0xD1342543DE82EF95
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_tables: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _tables or len(_tables[0]) <= n:
        size = max(2 * PIECE, n + 1)
        _tables[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(b))])) for b in (BASE, pow(BASE, -1, 2**64))]
    return _tables


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def hash_words(data: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and start of each word of ``data``, and the bytes as an array. Words are parted by ASCII white space."""
    code = np.frombuffer(data, np.uint8)
    if lower:
        code = LOWER[code]
    n = len(code)
    edge = np.empty(n + 1, bool)
    word = ~SPACE[code]
    edge[:n] = word
    edge[n] = False
    edge[1:] ^= word
    at = np.flatnonzero(edge)
    start, stop = at[::2], at[1::2]
    power, inverse = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    h = mixed((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))
    for i in np.flatnonzero(stop - start > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(code[start[i] : stop[i]].tobytes())
    return h, start, code


def ascending(x: np.ndarray) -> np.ndarray:
    """Distinct values by a sort; for integers ``np.unique`` alone goes by a hash table, many times slower."""
    x = np.sort(x)
    if not len(x):
        return x
    new = np.empty(len(x), bool)
    new[0] = True
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def order_of(x: np.ndarray) -> np.ndarray:
    """Places of unsigned numbers in ascending order. Numbers that carry their place in their low bits are sorted, which is
    several times faster than ``argsort``; where different ones agree in all other bits, it is that after all."""
    if not len(x):
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << (len(x) - 1).bit_length()) - 1)
    high = x << np.uint64(64 - int(x.max()).bit_length() & 63)
    order = (np.sort(high & ~mask | np.arange(len(x), dtype=np.uint64)) & mask).view(np.int64)
    found = x[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(x)


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct unsigned numbers, ascending, and the place of each number of ``x`` among them."""
    order = order_of(x)
    found = x[order]
    new = np.ones(len(x), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    at = np.empty(len(x), np.int64)
    at[order] = np.cumsum(new) - 1
    return found[new], at


def pieces(texts: list[bytes]):
    """Runs of texts of about ``PIECE`` bytes in all: (first, stop)."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and size < PIECE:
            size += len(texts[stop]) + 1
            stop += 1
        yield at, stop
        at = stop


def text_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``texts`` one after another, and how many each text has."""
    found, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in pieces(texts):
        h, start, _ = hash_words(b"\n".join(texts[a:b]), lower)
        ends = np.cumsum([len(t) + 1 for t in texts[a:b]])
        counts.append(np.diff(np.searchsorted(start, ends), prepend=0))
        found.append(h)
    return np.concatenate(found), np.concatenate(counts)


def line_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words, words of each line, and lines of each text; lines are parted by line feeds."""
    found, sizes, lines = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in pieces(texts):
        h, start, code = hash_words(b"\n".join(texts[a:b]))
        breaks = np.append(np.flatnonzero(code == 10), len(code))
        sizes.append(np.diff(np.searchsorted(start, breaks), prepend=0))
        ends = np.cumsum([len(t) + 1 for t in texts[a:b]]) - 1
        lines.append(np.diff(np.searchsorted(breaks, ends, side="right"), prepend=0))
        found.append(h)
    return np.concatenate(found), np.concatenate(sizes), np.concatenate(lines)
