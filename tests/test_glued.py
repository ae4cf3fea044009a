"""Scans of glued names: one automaton against a pattern for each chunk."""

from __future__ import annotations

import random
import re
import time
import unicodedata

from costlens.functions.automaton import Automaton, folded
from costlens.functions.masks import Terms, placeholder
from costlens.operators.audit import Coverer


def plain(name: str, listed: list[str], terms: Terms, without_hits: bool = True) -> tuple:
    """Whether protected chunks and known classes explain a name: explained, hits, sequence, first offset that fails,
    masked name. Chunks come the longest first and must not overlap; classes are tried at each place left to right."""
    chunks = [re.compile(re.escape(c), re.IGNORECASE) for c in sorted(set(listed), key=lambda c: (-len(c), c))]
    classes = [(k, re.compile(p)) for k, p in terms.scan_patterns()]
    name = unicodedata.normalize("NFKC", name)
    covered, hits = bytearray(len(name)), []
    for chunk in chunks:
        for m in chunk.finditer(name):
            if not any(covered[m.start() : m.end()]):
                covered[m.start() : m.end()] = b"\1" * len(m[0])
                hits.append({"Chunk": chunk.pattern, "start": m.start(), "end": m.end()})
    if not hits and not without_hits:
        return False, hits, [], -1, None
    at, sequence = 0, []
    while at < len(name):
        if covered[at] or name[at].isspace():
            at += 1
            continue
        found = [(m.end(), -rank) for rank, (_, p) in enumerate(classes) if (m := p.match(name, at))]
        if not found:
            return False, hits, sequence, at, None
        end, rank = max(found)
        sequence.append({"class": classes[-rank][0], "start": at, "end": end})
        covered[at:end] = b"\1" * (end - at)
        at = end
    pieces, done = [], 0
    for s in sequence:
        pieces += [name[done : s["start"]], placeholder(s["class"])]
        done = s["end"]
    return True, hits, sequence, -1, "".join(pieces) + name[done:]


def test_scan():
    terms = Terms.of(["vm"], ["prod"], ["weu"])
    scan = Coverer(["pay", "payroll"], terms).cover
    assert scan("payrollPAY")[0] and [h["start"] for h in scan("payrollPAY")[1]] == [0, 7]
    assert scan("payrollprod")[0] is False and scan("payrollprod")[3] == 7
    ok, _, sequence, offset, masked = scan("prod payroll 12")
    assert (ok, offset, masked) == (True, -1, "⟂ENV⟂ payroll ⟂NUM⟂") and [s["class"] for s in sequence] == ["ENV", "NUM"]
    assert Coverer(["pay"], terms, without_hits=False).cover("zzz") == (False, [], [], -1, None)
    assert Coverer(["payroll"], terms).cover("ＰＡＹＲＯＬＬ")[1] == [{"Chunk": "payroll", "start": 0, "end": 7}]


def test_equals_a_pattern_for_each_chunk():
    rnd = random.Random(9)
    for _ in range(60):
        letters = rnd.choice(["ab", "abk", "abis"])
        chunks = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 5))) for _ in range(rnd.randint(0, 12))]
        word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4)))
        terms = Terms.of([word(), "pre-" + word(), word() + "2"], [word(), word()], [word()])
        for without_hits in (True, False):
            coverer = Coverer(chunks, terms, without_hits)
            for _ in range(60):
                pieces = [*chunks, *terms.everything(), "-", " ", "7", "12", "é", "İ", "ı", "K", "ſ", "ﬁ", "0a1b2c3d4e5f60718293a4b5c6d7e8f9", "12345678-1234-1234-1234-123456789abc"]
                name = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9)))
                name = "".join(c.upper() if rnd.random() < 0.3 and len(c.upper()) == 1 else c for c in name)
                assert coverer.cover(name) == plain(name, chunks, terms, without_hits), (name, chunks, terms)


def test_all_occurrences():
    rnd = random.Random(2)
    for _ in range(200):
        words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 8))]
        text = folded("".join(rnd.choice("abAB") for _ in range(30)))
        want = {(i, k, k + len(w)) for i, w in enumerate(words) for k in range(31 - len(w)) if text[k : k + len(w)] == w}
        assert set(Automaton(words).find(text)) == want


def test_is_faster_than_a_pattern_for_each_chunk():
    rnd = random.Random(4)
    chunks = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(500)]
    terms, names = Terms.of(["vm"], ["prod"], ["weu"]), ["".join(rnd.choice(chunks) for _ in range(3)) for _ in range(60)]
    coverer, began = Coverer(chunks, terms), time.perf_counter()
    found = [coverer.cover(n) for n in names]
    fast, began = time.perf_counter() - began, time.perf_counter()
    assert found == [plain(n, chunks, terms) for n in names]
    assert time.perf_counter() - began > 3 * fast
