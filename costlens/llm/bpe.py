"""Byte-level BPE over batches of texts with the ``tokenizers`` library.

Byte-level BPE never merges across pre-tokens, so a text's ids are the ids of its pre-tokens in order. The pre-token
borders of a whole batch are found with array operations, and each distinct pre-token is encoded once for each worker
by the ``tokenizers`` library; later ones are looked up. Texts with characters whose class could depend on the version
of the Unicode tables, or with the vocabulary's special string, go through ``Tokenizer.encode`` whole, so the ids are
the library's own in every case.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import xxhash

#: Pre-tokens that a worker remembers. Beyond it, the memory starts anew; results do not depend on it.
CACHE_ENTRIES = 3_000_000
#: Pre-tokens longer than this get a key by XXH64, shorter ones by a polynomial modulo 2**64.
LONG = 64
#: Code points handled at once.
BLOCK = 1_000_000

#: ASCII characters that send a text through the library whole.
CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")

LETTER, NUMBER, SPACE, OTHER, UNSURE = range(5)


def default_vocabulary() -> str:
    """Path of the public 50k byte-level vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _classes() -> np.ndarray:
    """Class of each code point below U+0530 and of general punctuation; all others are unsure."""
    import unicodedata

    table = np.full(0x110000, UNSURE, np.uint8)
    for cp in chain(range(0x20, 0x7F), range(0xA1, 0x530), range(0x2010, 0x2028), range(0x2030, 0x205F), range(0x20A0, 0x20B0)):
        kind = unicodedata.category(chr(cp))
        if kind != "Cn":
            table[cp] = {"L": LETTER, "N": NUMBER, "Z": SPACE}.get(kind[0], OTHER)
    table[[9, 10, 13]] = SPACE
    return table


class BatchEncoder:
    """Ids or counts of texts. ``path`` names a byte-level ``tokenizers`` file; workers keep one encoder per path."""

    _kept: dict[tuple, "BatchEncoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes = _classes()
        self._forget()

    @classmethod
    def of(cls, path: str) -> "BatchEncoder":
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def borders(self, code: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Starts of pre-tokens in the concatenated texts ``code``; ``ends`` are the texts' ends (none empty)."""
        kind = self.classes[code]
        n = len(code)
        first = np.zeros(n + 1, bool)
        first[0] = True
        first[ends] = True
        before, space = np.empty(n, np.uint8), kind == SPACE
        before[0], before[1:] = UNSURE, kind[:-1]
        blank = np.zeros(n, bool)
        blank[1:] = code[:-1] == 32
        blank[first[:-1]] = False
        start = first[:-1] | ((kind != before) & ~blank)
        start[space & ~first[:-1]] = False
        start |= space & (before != SPACE)
        last = np.zeros(n, bool)  # the last white space before something else starts a pre-token
        last[:-1] = space[:-1] & ~space[1:]
        last[ends - 1] = False
        start |= last
        quotes = np.flatnonzero(start & (code == 39))
        if len(quotes):
            end_of = ends[np.searchsorted(ends, quotes, side="right")]
            padded = np.concatenate([code, np.zeros(3, code.dtype)])
            one, two = padded[quotes + 1], padded[quotes + 2]
            one = np.where(quotes + 1 < end_of, one, 0)
            two = np.where(quotes + 2 < end_of, two, 0)
            long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
            short = np.isin(one, (115, 116, 109, 100))
            for hit, width in ((short, 2), (long, 3)):
                at = quotes[hit]
                start[at + 1] = False
                after = at + width
                after = after[after < n]
                start[after] = True
        return np.flatnonzero(start)

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens by the library, one after another, and how many each has."""
        ids, sizes = [], []
        for at in range(0, len(pieces), 4096):
            part = pieces[at : at + 4096]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(got.ids, np.uint32))
            sizes.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _known(self, key: np.ndarray, whole: str, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each distinct pre-token stand in ``flat``, and how many there are."""
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        new = np.flatnonzero(self.keys[at] != key)
        if len(new):
            if len(self.keys) + len(new) > CACHE_ENTRIES:
                self._forget()
                return self._known(key, whole, starts, ends)
            ids, sizes = self._learn([whole[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            where = np.searchsorted(self.keys, key[new])
            self.keys = np.insert(self.keys, where, key[new])
            self.at = np.insert(self.at, where, len(self.flat) + np.cumsum(sizes) - sizes)
            self.size = np.insert(self.size, where, sizes)
            self.flat = np.concatenate([self.flat, ids])
            at = np.searchsorted(self.keys, key)
        return self.at[at], self.size[at]

    def _forget(self) -> None:
        # the highest key is a guard, so that the arrays are never empty
        self.keys, self.at, self.size = np.array([2**64 - 1], np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def sure(self, text: str) -> bool:
        if any(s in text for s in self.special):
            return False
        if text.isascii():
            return CONTROL.search(text) is None
        return not (self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)] == UNSURE).any()

    def _split(self, texts: list[str]):
        """Start, end and key of each pre-token of texts (each sure and not empty), and each text's end."""
        whole = "".join(texts)
        code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) for t in texts])
        starts = self.borders(code, ends)
        stops = np.append(starts[1:], len(code))
        power, inverse = _powers(len(code))
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code.astype(np.uint64) + np.uint64(0x9E37)) * power[: len(code)], out=sums[1:])
        key = (sums[stops] - sums[starts]) * inverse[starts]
        for i in np.flatnonzero(stops - starts > LONG).tolist():
            key[i] = xxhash.xxh64_intdigest(whole[starts[i] : stops[i]].encode())
        return whole, starts, stops, key, ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One uint32 array of ids for each text."""
        out: list = [None] * len(texts)
        for block in self._blocks(texts, out):
            whole, starts, stops, key, ends = self._split([texts[i] for i in block])
            distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            at, size = self._known(distinct, whole, starts[first], stops[first])
            sizes = size[inverse]
            done = np.concatenate([[0], np.cumsum(sizes)])
            ids = self.flat[np.repeat(at[inverse] - done[:-1], sizes) + np.arange(done[-1])]
            cuts = done[np.searchsorted(starts, np.concatenate([[0], ends]))].tolist()
            for i, a, b in zip(block, cuts, cuts[1:]):
                out[i] = ids[a:b]
        return out

    def _blocks(self, texts: list[str], out: list):
        """Indexes of sure texts in blocks; the others get their ids here."""
        block, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                out[i] = np.zeros(0, np.uint32)
            elif not self.sure(text):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                block.append(i)
                size += len(text)
            if size >= BLOCK:
                yield block
                block, size = [], 0
        if block:
            yield block

    def leaves(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Characters and number of ids of each text's pre-tokens; None for a text that is not sure."""
        out: list = [None] * len(texts)
        none = np.zeros(0, np.int64)
        sure = [i for i, t in enumerate(texts) if t and self.sure(t)]
        for i, text in enumerate(texts):
            if not text:
                out[i] = (none, none)
        at = 0
        while at < len(sure):
            stop, size = at, 0
            while stop < len(sure) and size < BLOCK:
                size += len(texts[sure[stop]])
                stop += 1
            whole, starts, stops, key, ends = self._split([texts[i] for i in sure[at:stop]])
            distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            sizes = self._known(distinct, whole, starts[first], stops[first])[1][inverse]
            chars, cuts = stops - starts, np.searchsorted(starts, np.concatenate([[0], ends])).tolist()
            for i, a, b in zip(sure[at:stop], cuts, cuts[1:]):
                out[i] = (chars[a:b], sizes[a:b])
            at = stop
        return out


_table: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, up to n at least."""
    if not _table or len(_table[0]) <= n:
        base, size = 0xD1342543DE82EF95, max(2 * BLOCK, n + 1)
        _table[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(b))])) for b in (base, pow(base, -1, 2**64))]
    return _table[0], _table[1]
