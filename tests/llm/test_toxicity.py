"""Operator 12: the index against all pairs, calibration, held-out accuracy, odd rows."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from costlens.llm import toxicity
from costlens.llm.toxicity import Index

SCHEMA = "doc_id long, text string, score string, terms string"


def random_index(rng, n, terms):
    rows, seen = [], set()
    while len(rows) < n:
        t = sorted(rng.choice(terms, rng.integers(1, 6), replace=False).tolist())
        c = rng.integers(1, 4, len(t)).tolist()
        if (*t, *c) not in seen:
            seen.add((*t, *c))
            rows.append((t, c, int(rng.integers(1, 5)), 0, len(rows)))
    idf = rng.uniform(1, 5, terms)
    return rows, idf, Index.of([*rows, ([], [], 9, 1, 7)], idf)


def test_nearest_equals_all_pairs(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    monkeypatch.setattr(toxicity, "WAVE", 2)
    rows, idf, index = random_index(rng, 400, 60)
    dense = np.zeros((400, 60))
    for t, c, _, _, doc in rows:
        w = (1 + np.log(c)) * idf[t]
        dense[index.place[toxicity.vector_key(t, c)], t] = w / math.sqrt(w @ w)
    for _ in range(200):
        t = np.sort(rng.choice(60, rng.integers(1, 20), replace=False))
        w = rng.uniform(0.1, 1, len(t))
        w /= math.sqrt(w @ w)
        want = np.minimum(dense[:, t] @ w, 1)
        found, cosine = index.nearest(t, w, 10)
        assert np.allclose(cosine, np.sort(want)[::-1][:10]) and np.allclose(want[found], cosine)


def test_blocks_are_passed_over(monkeypatch):
    """The bounds are used: most postings of a query that has an equal entry are never read."""
    rng, read = np.random.default_rng(6), []
    rows, _, index = random_index(rng, 3000, 200)
    plain = toxicity.spans
    monkeypatch.setattr(toxicity, "spans", lambda a, b: read.append(int((b - a).sum())) or plain(a, b))
    monkeypatch.setattr(toxicity, "WAVE", 1)
    index.nearest(np.array([5]), np.array([1.0]), 1)
    whole = int((index.entry[index.start[index.first[5]] : index.start[index.first[6]]]).size)
    assert sum(read[1:]) < whole


def test_isotonic():
    at, rate = toxicity.isotonic(np.array([0.1, 0.4, 0.3, 0.9]), np.array([0.0, 1.0, 2.0, 4.0]), np.array([4.0, 2.0, 2.0, 4.0]))
    assert np.all(np.diff(rate) > 0) and np.all(np.diff(at) > 0) and math.isclose(rate[1], 0.75)


def made(spark, n=900):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 7 == 0
        text = [*rng.choice(words, 40), *(rng.choice(["zzgrr", "yyvile", "xxscum"], 2) if toxic else [])]
        rows.append((i, " ".join(rng.permutation(text)), "s", "t"))
        if i % 2:
            labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_held_out_texts(spark):
    docs, labels, rows = made(spark)
    got = {r["doc_id"]: r for r in toxicity.scored(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    assert sum(r["predicted"] == (i % 7 == 0) for i, r in got.items()) >= 0.98 * len(got)
    evidence = [r for i, r in got.items() if i % 7 == 0 and i % 2 == 0][0]["neighbours"]
    assert evidence and all(e["doc_id"] % 2 == 1 and 0 < e["cosine"] <= 1 for e in evidence)


def test_held_out_labels_teach_nothing(spark):
    from pyspark.sql import functions as F

    docs, labels, _ = made(spark, 300)
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [{r["doc_id"]: r["score"] for r in toxicity.scored(docs, x).collect()} for x in (labels, other)]
    assert scores[0] == scores[1]


def test_odd_rows(spark):
    docs, labels, rows = made(spark, 300)
    odd = [(None, "zzgrr", "s", "t"), (9001, None, "s", "t"), (9002, "", "s", "t"), (9003, "zzgrr " * 200_000, "s", "t"), (9003, "zzgrr " * 200_000, "s", "t")]
    more = labels.unionByName(spark.createDataFrame([(None, 1, 1), (9002, 1, None), (1, 1, 1)], labels.schema))
    got = toxicity.scored(docs.unionByName(spark.createDataFrame(odd, SCHEMA)), more).collect()
    assert len(got) == len(rows) + len(odd)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[9001] == by[9002] and by[9001][0] < 0.5 and len(by[9003]) == 2 and by[9003][0] == by[9003][1] > 0.5


@pytest.mark.parametrize("empty", ["docs", "labels"])
def test_empty_tables(spark, empty):
    docs, labels, rows = made(spark, 30)
    got = toxicity.scored(docs.limit(0) if empty == "docs" else docs, labels.limit(0) if empty == "labels" else labels).collect()
    assert [r["score"] for r in got] == ([] if empty == "docs" else [0.0] * len(rows))
