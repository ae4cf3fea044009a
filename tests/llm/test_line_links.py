"""Links, classes and matches of line dedup against all pairs; words of very many sets; clashing columns, nulls, repeats."""

from __future__ import annotations

import random

import pytest

from costlens.llm import line_dedup, queries, set_join


def brute(rows):
    lines = [(i is not None, i or 0, k, frozenset(x.split())) for i, t in rows for k, x in enumerate((t or "").split("\n"))]
    sets = {s for *_, s in lines if s}
    near = {s: [x for x in sets if 5 * len(s & x) >= 4 * len(s | x)] for s in sets}
    first = {s: min(x[:3] for x in lines if x[3] == s) for s in sets}
    least = {s: min(first[x] for x in near[s]) for s in sets}
    out = []
    for i, t in rows:
        own = [(k, frozenset(x.split())) for k, x in enumerate((t or "").split("\n"))]
        gone = [(k, least[s]) for k, s in own if s and least[s] < (i is not None, i or 0, k)]
        whole = lambda w: w[1] if w[0] else None
        places = [w for _, w in gone] + [(i is not None, i or 0, 0)]
        cls = min(places, key=lambda w: w[:2])
        out.append((i, len(own), [k for k, _ in gone], [(whole(w), w[2]) for _, w in gone], whole(cls), sum(len(near[s]) - 1 for s in {s for _, s in own if s})))
    return sorted(out, key=repr)


def made(seed=3):
    random.seed(seed)
    word = lambda: "w%d" % min(random.randint(0, 400), random.randint(0, 400))
    base = [[word() for _ in range(random.randint(5, 30))] for _ in range(12)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(random.randint(1, 5)):
            line = list(random.choice(base))
            for _ in range(random.randint(0, 3)):
                line[random.randrange(len(line))] = word()
            random.shuffle(line)
            lines.append(" ".join(line))
        rows.append((i if i % 9 else None, "\n".join(lines)))
    return rows + [(5, rows[5][1]), (5, rows[5][1]), (900, None), (901, ""), (902, "one"), (903, "one\none two\n one")]


@pytest.mark.parametrize("limit, held, slab", [(16_000, 3_000_000, 6_000_000), (8, 20, 900)])
def test_links_and_classes(spark, monkeypatch, limit, held, slab):
    monkeypatch.setattr(set_join, "LIMIT", limit)
    monkeypatch.setattr(set_join, "HELD", held)
    monkeypatch.setattr(line_dedup, "SLAB", slab)
    rows = made()
    got = line_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = [(r["doc_id"], r["n_lines"], list(r["removed"]), list(zip(r["match_doc"], r["match_line"])), r["class_id"], r["n_links"]) for r in got]
    assert sorted(got, key=repr) == brute(rows)


def test_apply_keeps_clashing_columns(spark):
    rows = [(1, "a b c\nd e f", "mine", 7, None), (2, "d e f", "own", 8, "x"), (None, None, "none", 9, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _removed string, row int, g string")
    out = line_dedup.apply(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([rows[0], (2, "", "own", 8, "x"), rows[2]], key=repr)
    assert line_dedup.apply(docs.limit(0)).count() == 0


def test_registered_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op1_line_dedup"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_lines", "n_removed", "class_id", "n_links", "removed", "matches"]
    say = lambda x: ",".join(map(str, x))
    want = {i: (n, len(gone), c, links, say(gone), say(f"{d}:{k}" for d, k in to)) for i, n, gone, to, c, links in brute([tuple(d) for d in docs])}
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == want
