"""The pipeline's near-dedup stage against brute force over all pairs."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from costlens.llm import near_copies, set_join


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def brute(rows):
    sets, group = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}
    for a in sets:
        for b in sets:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    return sorted(set(group.values()))


@pytest.mark.parametrize("limit, held, least, leads", [(16_000, 3_000_000, 4, 6), (3, 30, 1, 1)])
def test_stage_finds_all_near_copies(spark, sf_dir, limit, held, least, leads, monkeypatch):
    monkeypatch.setattr(set_join, "LIMIT", limit)
    monkeypatch.setattr(set_join, "HELD", held)
    monkeypatch.setattr(set_join, "LEADS", leads)
    monkeypatch.setattr(near_copies, "LEAST", least)
    random.seed(8)
    say = lambda n: [random.choice("abcdefghijklmnopqrstuvwxyz") + str(random.randint(0, 99)) for _ in range(n)]
    rows, passage = [(0, None), (1, ""), (2, "Two words"), (3, "two WORDS"), (4, "two others")], say(60)
    for k in range(60):
        first = say(random.randint(20, 300))
        rows.append((10 * k + 10, " ".join(first)))
        for c in range(k % 4):  # copies with more and more words replaced
            near = list(first)
            for at in random.sample(range(len(near)), 1 + c * len(near) // 80):
                near[at] = "x"
            rows.append((10 * k + 11 + c, " ".join(near)))
    rows += [(1000 + k, " ".join(say(20) + passage + say(20))) for k in range(15)]  # a common passage
    base = say(120)
    rows += [(2000 + k, " ".join([*base[: 5 * k], "y", *base[5 * k + 1 :]])) for k in range(20)]  # a large group
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert len(want) < len(rows) - 60
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()) == want


def test_stage_takes_nulls_and_repeated_rows(spark, sf_dir):
    text = "one two three four five six seven eight nine ten"
    frame = spark.createDataFrame([(5, text), (5, text), (None, text), (None, "other")], "doc_id long, text string")
    assert sorted(tuple(r) for r in corpus_pipeline.near_duplicates(spark, frame, sf_dir).collect() if r["doc_id"]) == [(5, text)]
    assert corpus_pipeline.near_duplicates(spark, frame, sf_dir).count() == 2
    assert corpus_pipeline.near_duplicates(spark, frame.limit(0), sf_dir).count() == 0


def test_stage_keeps_clashing_columns(spark, sf_dir):
    rows = [(1, "a b c d e f", "mine", 4, "x"), (2, "A b c d e f", "own", 5, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, s int, none string")
    out = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [rows[0]]


def test_stage_links_by_simhash(spark, sf_dir):
    random.seed(3)
    say = lambda n: " ".join("w" + str(random.randint(0, 10**6)) for _ in range(n))
    chorus = " ".join([say(21)] * 60)  # outweighs the rest in the fingerprint, not in the set of shingles
    first, second = chorus + " " + say(30), chorus + " " + say(30)
    near = second + " one more"  # a near copy of the second alone
    sets = [shingles(t) for t in (first, second, near)]
    same = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    assert not same(sets[0], sets[1]) and not same(sets[0], sets[2]) and same(sets[1], sets[2])
    docs = spark.createDataFrame([(7, first), (3, second), (5, near), (9, say(60))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()) == [3, 9]
