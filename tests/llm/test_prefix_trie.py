"""Operator 13 against a plain version: long paths, hot conversations, ties, nulls."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from costlens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, listed in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + listed[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, listed in built.items():
        for d in range(len(listed) + 1):
            members[tuple(listed[:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[c] for c in children[k]) if children[k] else 1
        saved[k] = sum(saved[c] for c in children[k]) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
        ends = ",".join(str(c) for c in sorted(members[k]) if len(built[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def got(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return Counter(tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(frame).collect())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 7)


def test_equals_plain(spark, small):
    rnd, rows = random.Random(3), []
    for c in [*range(0, 40), *range(100, 300), *range(1501, 1560), -7, -100, -101]:  # 1500 is absent: some have no turn left
        for k in range(rnd.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rnd.choice([None, k, k]), rnd.choice(["user", None, "assistant"]), rnd.choice([None, "", "a", "bé"]), "x", 1))
    rows += [(100, k, "user", rnd.choice("ab"), "x", 1) for k in range(300)]  # a third of all rows, and a long path
    rows += [(None, 1, "user", "left out", "x", 1)]
    assert got(spark, rows) == plain(rows)


def test_copies_end_at_one_node(spark, small):
    rows = [(c, t, "user", f"text {t}", "x", 1) for c in range(100, 160) for t in range(3)]
    assert got(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert not got(spark, [])
    assert not got(spark, [(None, 1, "user", "x", "x", 1)])


def test_one_long_text(spark):
    rows = [(200, 1, "user", "é" * 1_000_000, "x", 1), (201, 1, "user", "é" * 1_000_000, "x", 1)]
    assert got(spark, rows) == plain(rows)
