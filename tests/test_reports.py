"""Quantiles by rank and densities against plain versions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.operators import quantiles, reports


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(8)
    made = {"a": rng.normal(5, 2, 900).tolist(), None: rng.integers(0, 6, 400).astype(float).tolist(), "one": [3.0], "same": [2.0] * 50, "two": [1.0, 4.0], "none": [None, None]}
    return made


@pytest.fixture(scope="module")
def frame(spark, groups):
    rows = [(k, v) for k, listed in groups.items() for v in [*listed, None]]
    return spark.createDataFrame(rows, "by string, x double").repartition(7)


def test_quantiles(spark, frame, groups):
    counts = frame.groupBy("by", F.col("x").alias("value")).agg(F.count("*").alias("n"))
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = quantiles.quantiles(counts, ["by"], shares)
    assert "percentile" not in found._jdf.queryExecution().toString().lower()
    got = {(r["by"], r["share"]): r["quantile"] for r in found.collect()}
    want = {(k, q): np.quantile(listed, q) for k, listed in groups.items() if listed[0] is not None for q in shares}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)


def test_no_task_holds_a_group(spark):
    """One group of many distinct values is spread over the ranges, and a quantile reads one or two of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = spark.range(40_000).select(F.lit("g").alias("by"), F.col("id").cast("double").alias("value"), F.lit(1).cast("long").alias("n"))
        held = []
        whole = quantiles.held
        quantiles.held = lambda f, name: held.append(whole(f, name)) or held[-1]
        try:
            got = quantiles.quantiles(counts, ["by"], [0.5]).first()
        finally:
            quantiles.held = whole
        sizes = [r["count"] for r in held[0].groupBy("range").count().collect()]
        assert got["quantile"] == 19_999.5 and len(sizes) == 4 and max(sizes) < 2 * 40_000 / 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_box_and_violin(frame, groups):
    boxes = {r["by"]: tuple(r)[1:] for r in reports.box(frame, "by", "x").collect()}
    assert boxes.keys() == groups.keys() and boxes["none"] == (None,) * 5
    for k, listed in groups.items():
        if listed[0] is not None:
            assert np.allclose(boxes[k], np.quantile(listed, [0, 0.25, 0.5, 0.75, 1]))
    dense = {}
    for r in reports.violin(frame, "by", "x", 40).collect():
        dense.setdefault(r["by"], {})[r["point"]] = (r["x"], r["density"])
    assert dense.keys() == groups.keys() - {"none"}
    for k, found in dense.items():
        x = np.array(groups[k])
        spread = np.quantile(x, 0.75) - np.quantile(x, 0.25)
        deviation = x.std(ddof=1) if len(x) > 1 else 0.0
        width = 1.059 * (min(deviation, spread / 1.349) if spread else deviation) * len(x) ** -0.2
        if not width:
            assert found == {0: (x[0], 1.0)}
            continue
        places = np.linspace(x.min() - 2 * width, x.max() + 2 * width, 40)
        plain = np.exp(-0.5 * ((places[:, None] - x) / width) ** 2).sum(1) / (math.sqrt(2 * math.pi) * width * len(x))
        assert np.allclose([found[i] for i in range(40)], np.stack([places, plain], 1), atol=1e-6)
