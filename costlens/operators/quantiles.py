"""Exact quantiles by rank: values are counted, the counts sorted over ranges, and only ranges that hold a wanted rank read.

No task holds a group: a group's distinct values lie in as many ranges as they fill, a range knows its count, and the rank
that a quantile asks for is in just one of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import held


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", more: Column | None = None) -> DataFrame:
    """A join by equal keys, null being a value; the result has them once. ``more`` is a further condition."""
    other = right.withColumnsRenamed({k: f"{k}_of_right" for k in keys})
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}_of_right")) for k in keys))
    return left.join(other, on if more is None else on & more, how).drop(*(f"{k}_of_right" for k in keys))


def quantiles(counts: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """keys, share and quantile (between the two nearest values by distance) of ``counts``: keys, value and n, a row for
    each distinct value of a group. Null values count for nothing; a group without others has no rows."""
    some = counts.where(F.col("value").isNotNull()).select(*keys, F.col("value").cast("double").alias("value"), "n")
    ranged = held(some.repartitionByRange(*keys, "value").withColumn("range", F.spark_partition_id()), "ranges")
    # a row for each range of a group
    sizes = ranged.groupBy(*keys, "range").agg(F.sum("n").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("before", before).withColumn("total", F.sum("size").over(Window.partitionBy(*keys)))
    asked = sizes.withColumn("share", F.explode(F.array(*map(F.lit, shares)))).withColumn("place", F.col("share") * (F.col("total") - 1))
    asked = asked.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))))
    asked = asked.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("size")))
    asked = asked.select(*keys, "range", "share", "place", (F.col("rank") - F.col("before")).alias("rank"), (F.col("rank") == F.floor("place")).alias("lower"))
    wanted = asked.select(*keys, "range").distinct()
    read = joined(ranged, wanted, [*keys, "range"], "left_semi")
    upto = F.sum("n").over(Window.partitionBy(*keys, "range").orderBy("value"))
    read = read.withColumn("upto", upto)
    met = joined(asked, read, [*keys, "range"], more=F.col("upto") > F.col("rank"))
    found = met.groupBy(*keys, "share", "place", "lower").agg(F.min("value").alias("value"))
    pick = lambda side: F.max(F.when(F.col("lower") == side, F.col("value")))
    both = found.groupBy(*keys, "share", "place").agg(pick(True).alias("low"), pick(False).alias("high"))
    part = F.col("place") - F.floor("place")
    return both.select(*keys, "share", (F.col("low") + part * (F.coalesce("high", "low") - F.col("low"))).alias("quantile"))


def wide(found: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """One row for each value of ``keys``; a column holds the quantile of the rows that its condition names."""
    return found.groupBy(*keys).agg(*(F.max(F.when(c, F.col("quantile"))).alias(n) for n, c in columns.items()))
