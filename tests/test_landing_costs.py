"""Landing casts each cell once, in code that the JVM compiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.sources import ingest
from costlens.sources.spec import SPEC


def test_cells_are_cast_once_and_counted(spark):
    texts = [("$1,234.5", 0), ("no cost", 1), (" ", 0), ("\t", 1), (None, 0), ("1\n2", 0), ("9999999", 1)]
    names = [n for n, _, _ in SPEC]
    rows = [tuple(t if n in ("EffectiveCost", "ListCost") else "2024-01-02" if k == "time" else None for n, k, _ in SPEC) for t, _ in texts]
    out = ingest.with_rejects(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)))
    got = [(r["_rejected"], r["EffectiveCost"]) for r in out.collect()]
    assert [g[0] for g in got] == [2 * bad for _, bad in texts]
    assert [g[1] and float(g[1]) for g in got] == [1234.5, None, None, None, None, 12.0, None]
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = ingest.with_rejects(spark.range(1).select(*(F.col("id").cast("string").alias(n) for n in names)))._jdf.queryExecution().analyzed().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("translate(EffectiveCost") == 1


def test_code_is_split_while_a_run_lands(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with ingest.compiled(spark):
        assert int(spark.conf.get(key)) == ingest.COMPILED
    assert spark.conf.get(key) == before
