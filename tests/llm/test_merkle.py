"""Operator 11: proofs lead to the root, superblocks of any number of levels, odd rows."""

from __future__ import annotations

import hashlib
from itertools import groupby

import pytest

from costlens.llm import merkle

SCHEMA = "source string, text string, doc_id long, lang string, n_chars long, tag string, place long"


def plain(rows):
    """leaf, subroot, root and siblings of each row, from the contract."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][a : a + 3])) for a in range(0, len(out[-1]), 3)])
        return out

    leaves = [(s, i, sha("".join(map(field, (i, s, lang, n, t))))) for s, t, i, lang, n, *_ in rows]
    leaves.sort(key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    trees = [levels([r[2] for r in g]) for _, g in groupby(leaves, key=lambda r: r[0])]
    top, found = levels([t[-1][0] for t in trees]), []
    at = iter(leaves)
    for s, tree in enumerate(trees):
        for i in range(len(tree[0])):
            proof = []
            for side, k in ((tree, i), (top, s)):
                for level in side[:-1]:
                    proof += [h for j, h in enumerate(level[k // 3 * 3 : k // 3 * 3 + 3]) if j != k % 3]
                    k //= 3
            found.append((next(at)[1], tree[0][i], tree[-1][0], top[-1][0], sha("".join(proof))))
    return sorted(found, key=repr)


def rows_of(n):
    return [(None if i % 11 == 3 else "big" if i % 3 else f"sé{i % 5}", None if i % 7 == 0 else "x\n" * (i % 4), None if i % 13 == 5 else i // 2, "en", i, "clash", i) for i in range(n)]


@pytest.mark.parametrize("levels", [1, 2, 6])
@pytest.mark.parametrize("n", [1, 3, 40, 200])
def test_equals_plain(spark, monkeypatch, levels, n):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "WIDTH", merkle.FANOUT**levels)
    rows = rows_of(n) + rows_of(n)[:2]  # repeated rows
    got = merkle.checked(merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got), key=repr) == plain(rows)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)


def test_changed_text_is_found(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows_of(50), SCHEMA)
    got = merkle.checked(merkle.manifest(docs, F.concat("text", F.lit("!")))).collect()
    assert {r["doc_id"] for r in got if r["verified"]} >= {r[2] for r in rows_of(50) if r[1] is None and r[2] is not None}
    assert sum(not r["verified"] for r in got) == sum(r[1] is not None for r in rows_of(50))


def test_empty_table_and_long_text(spark):
    assert merkle.checked(merkle.manifest(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [("s", "w " * 2_000_000, 1, "en", 4, "t", 0)]
    got = merkle.checked(merkle.manifest(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [(r["doc_id"], r["leaf"]) for r in got] == [x[:2] for x in plain(rows)] and got[0]["root"] == hashlib.sha256(got[0]["leaf"].encode()).hexdigest() or got[0]["root"] == got[0]["leaf"]


def test_fold_needs_the_right_proof():
    nodes = [hashlib.sha256(bytes([i])).digest() for i in range(10)]
    root, proofs = merkle.collapse(nodes, None)
    assert all(merkle.fold(n, p) == root for n, p in zip(nodes, proofs))
    assert merkle.fold(nodes[0], proofs[1]) != root and merkle.fold(nodes[1][::-1], proofs[1]) != root
