"""Support and spreads of chunks against plain counts."""

from __future__ import annotations

import random

from costlens.functions.masks import Terms
from costlens.operators import audit


def test_support_and_spreads(spark):
    rnd, rows = random.Random(3), []
    for k in range(400):
        name = "-".join(rnd.choice(["payroll", "Payroll", "ledger", "core", "x1"]) for _ in range(3))
        rows.append((rnd.choice([None, f"/r/{k % 90}"]), name, 1.5, rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *(f"g{i}" for i in range(40))])))
    frame = spark.createDataFrame(rows, "ResourceId string, ResourceName string, Cost double, SubAccountName string, ResourceGroup string").repartition(5)
    found = audit._support(audit.spans(frame, Terms.of()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap_construct_agg" in plan
    want = {}
    for r, name, cost, account, group in rows:
        for chunk in (c.lower() for c in name.split("-") if len(c) > 2):
            w = want.setdefault(chunk, [set(), set(), set(), 0.0])
            w[0].add(r), w[1].add(account), w[2].add(group)
            w[3] += cost
    got = {r["Chunk"]: (r["SupportNames"], r["SpreadSubAccounts"], r["SpreadResourceGroups"], r["TotalCost"], r["Length"]) for r in found.collect()}
    assert got == {c: (len(w[0]), len(w[1]), len(w[2]), w[3], len(c)) for c, w in want.items()}


def test_numbers_have_no_gaps(spark):
    frame = spark.range(1000).selectExpr("CASE WHEN id % 7 <> 0 THEN 'v' || (id % 333) END AS v").repartition(9)
    got = sorted(r["number"] for r in audit.numbered(frame, "v").collect())
    assert got == list(range(334))
