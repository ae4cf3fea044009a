"""First neighbours in cells against all pairs, and the bounds on what lists all pairs."""

from __future__ import annotations

import random

import pytest

from costlens.operators import audit, entities


def brute(weights, k, least, by_similarity):
    vectors = {}
    for r in weights.collect():
        vectors.setdefault(r["index"], {})[r["gram"]] = r["weight"]
    out = {}
    for i, v in vectors.items():
        near = [(j, s) for j, o in vectors.items() if i != j and (s := sum(w * o.get(g, 0) for g, w in v.items())) >= least]
        near.sort(key=lambda p: (-round(p[1], 9), p[0]) if by_similarity else p[0])
        out |= {(i, j): s for j, s in near[:k]}
    return out


@pytest.mark.parametrize("by_similarity", [False, True])
def test_first_neighbours(spark, monkeypatch, by_similarity):
    monkeypatch.setattr(entities, "CELL", 16)
    rnd = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    names = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4))) + rnd.choice(["", "s", " x"]) for _ in range(150)]
    frame = spark.createDataFrame([(3 * k + 1, n) for k, n in enumerate(names)], "index long, name string")
    weights = entities.gram_weights(frame).persist()
    got = {(r["i"], r["j"]): r["similarity"] for r in entities.first_neighbours(weights, 5, 0.8, by_similarity).collect()}
    want = brute(weights, 5, 0.8, by_similarity)
    if by_similarity:  # which of equally similar names is fifth may differ in the last digits
        of = lambda pairs: {i: sorted(round(s, 6) for (a, _), s in pairs.items() if a == i) for i in {a for a, _ in pairs}}
        assert of(got) == of(want)
    else:
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_like_names_cost_no_pairs(spark, monkeypatch):
    """Of names that are all alike each keeps five neighbours, whatever their number."""
    monkeypatch.setattr(entities, "CELL", 128)
    frame = spark.range(1000).selectExpr("id AS index", "'payroll service of the northern region number ' || id % 7 AS name")
    got = entities.first_neighbours(entities.gram_weights(frame))
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()
    rows = got.groupBy("i").count().collect()
    assert len(rows) == 1000 and {r["count"] for r in rows} == {5}
    assert {r["j"] for r in got.where("i > 200").collect()} <= set(range(200))


def test_bounds(spark):
    weights = entities.gram_weights(spark.range(12).selectExpr("id AS index", "'name number ' || id AS name"))
    with pytest.raises(entities.TooManyNames):
        entities.similar_pairs(weights, most=11)
    assert entities.similar_pairs(weights, 0.1, most=12).count() == entities.similar_pairs(weights, 0.1, most=None).count() > 0
    names = spark.createDataFrame([("/r", "payroll")], "ResourceId string, ResourceName string")
    chunks = spark.createDataFrame([("payroll",), ("ledger",)], "Chunk string")
    with pytest.raises(audit.TooManyCandidates):
        audit.suggested_entities(names, chunks, most=1)
    assert [r["found_in_chunks"] for r in audit.suggested_entities(names, chunks, most=2).collect()] == [["payroll"]]
