"""What the dashboards show: categories, log-safe columns, histograms, densities, quartiles, extremes of scopes."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import held
from .quantiles import joined, quantiles, wide

SPREAD = {0: 1, 1: 5, 2: 10}


def protect_categories(combined: DataFrame, size_level: int = 0) -> DataFrame:
    """Adds category, log_support, log_cost and scaled_spread to a combined protect set."""
    f, c = F.col("InFrequencySet"), F.col("InCostSet")
    safe = lambda x, least: F.when(F.coalesce(F.col(x), F.lit(0)) > 0, F.col(x).cast("double")).otherwise(F.lit(float(least)))
    category = F.when(f & c, "Both (Freq & Cost)").when(f, "Frequency Only").when(c, "Cost Only").otherwise("Other")
    return combined.withColumns({"category": category, "log_support": safe("SupportNames", 1), "log_cost": safe("TotalCost", 0.01), "scaled_spread": F.col("SpreadSubAccounts") * SPREAD[size_level]})


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    # the last bin is closed
    return F.least(F.floor((x - low) / F.nullif(high - low, F.lit(0.0)) * bins), F.lit(bins - 1))


def _binned(frame: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Rows without nulls in ``columns``, with the bin of each between its least and greatest value, which one pass finds."""
    x = {c: F.col(c).cast("double") for c in columns}
    ends = frame.agg(*(f(v).alias(f"{n}_{c}") for c, v in x.items() for n, f in (("low", F.min), ("high", F.max))))
    known = frame.where(reduce(lambda a, b: a & b, (v.isNotNull() for v in x.values()))).select(*(v.alias(c) for c, v in x.items()))
    part = lambda c: F.coalesce(_bin(F.col(c), F.col(f"low_{c}"), F.col(f"high_{c}"), bins), F.lit(0)).cast("long").alias(c)
    return known.crossJoin(F.broadcast(ends)).select(*map(part, columns))  # one row


def histogram(frame: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts of ``bins`` equal bins between the least and greatest value: bin, n. Empty bins are not listed."""
    return _binned(frame, [column], bins).groupBy(F.col(column).alias("bin")).agg(F.count("*").alias("n"))


def density(frame: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Counts of a grid: x_bin, y_bin, n."""
    return _binned(frame, [x, y], bins).groupBy(F.col(x).alias("x_bin"), F.col(y).alias("y_bin")).agg(F.count("*").alias("n"))


def _quartiles(frame: DataFrame, by: str, column: str) -> DataFrame:
    counts = frame.groupBy(by, F.col(column).cast("double").alias("value")).agg(F.count("*").alias("n"))
    return wide(quantiles(counts, [by], [0.25, 0.5, 0.75]), [by], {"q1": F.col("share") == 0.25, "median": F.col("share") == 0.5, "q3": F.col("share") == 0.75})


def box(frame: DataFrame, by: str, column: str) -> DataFrame:
    """Least, quartiles and greatest of a column by group; null is a group."""
    ends, quarters = frame.groupBy(by).agg(F.min(column).alias("low"), F.max(column).alias("high")), _quartiles(frame, by, column)
    return joined(ends, quarters, [by], "left").select(by, "low", "q1", "median", "q3", "high")


#: Kernels are cut off where they are below 1e-15 of their height.
REACH = 8.5


def violin(frame: DataFrame, by: str, column: str, points: int = 64) -> DataFrame:
    """Density of a column's values by group on ``points`` places: group, point, x, density.

    Normal kernels of Silverman's bandwidth, which takes the lesser of standard deviation and quartiles' distance; places
    go two bandwidths beyond the values. Each distinct value is one weighted kernel, spread over the places it reaches; sums
    are partial before the shuffle. A group of one value has density 1 at it.
    """
    values = frame.where(F.col(column).isNotNull()).groupBy(by, F.col(column).cast("double").alias("value")).agg(F.count("*").alias("n"))
    values = held(values, "values")
    n, x = F.col("n"), F.col("value")
    mean = F.sum(n * x) / F.sum(n)
    ends = values.groupBy(by).agg(F.sum("n").alias("size"), F.min("value").alias("low"), F.max("value").alias("high"), mean.alias("mean"))
    found = quantiles(values, [by], [0.25, 0.75])
    quarters = wide(found, [by], {"q1": F.col("share") == 0.25, "q3": F.col("share") == 0.75})
    ends = joined(ends, quarters, [by]).withColumn("spread", F.col("q3") - F.col("q1"))
    off = joined(values, ends, [by]).groupBy(by).agg(F.sum(n * (x - F.col("mean")) ** 2).alias("squares"))
    whole = joined(ends, off, [by])
    deviation = F.sqrt(F.col("squares") / F.greatest(F.col("size") - 1, F.lit(1)))
    narrow = F.when(F.col("spread") > 0, F.least(deviation, F.col("spread") / 1.349)).otherwise(deviation)
    whole = whole.withColumn("width", 1.059 * narrow * F.col("size") ** -0.2)
    whole = whole.withColumn("first", F.col("low") - 2 * F.col("width")).withColumn("step", (F.col("high") - F.col("low") + 4 * F.col("width")) / (points - 1))
    met = joined(values, whole.select(by, "size", "width", "first", "step"), [by])
    reach = REACH * F.col("width")
    from_ = F.greatest(F.ceil((x - reach - F.col("first")) / F.col("step")), F.lit(0))
    to = F.least(F.floor((x + reach - F.col("first")) / F.col("step")), F.lit(points - 1))
    each = met.where("width > 0").withColumn("point", F.explode(F.sequence(from_, to)))
    gap = (F.col("first") + F.col("point") * F.col("step") - x) / F.col("width")
    kernel = F.exp(-0.5 * gap * gap) / (F.sqrt(F.lit(2 * math.pi)) * F.col("width") * F.col("size"))
    summed = each.groupBy(by, "point").agg(F.sum(n * kernel).alias("density"))
    places = whole.where("width > 0").select(by, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"), (F.col("first") + F.col("point") * F.col("step")).alias("x"))
    dense = joined(places, summed, [by, "point"], "left").select(by, F.col("point").cast("long").alias("point"), "x", F.coalesce("density", F.lit(0.0)).alias("density"))
    single = whole.where("width = 0").select(by, F.lit(0).cast("long").alias("point"), F.col("low").alias("x"), F.lit(1.0).alias("density"))
    return dense.unionByName(single)


def extremes(rollup: DataFrame, scope: str, column: str, n: int = 15, largest: bool = True) -> DataFrame:
    """The ``n`` scopes of one type with the largest or smallest values; ties by scope."""
    rows = rollup.where((F.col("ScopeType") == scope) & F.col(column).isNotNull())
    return rows.orderBy(F.desc(column) if largest else F.asc(column), "ScopeValue").limit(n).select("ScopeType", "ScopeValue", column)


def largest_groups(members: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` groups of most members."""
    return members.groupBy("canonical").agg(F.count("*").alias("members")).orderBy(F.desc("members"), "canonical").limit(n)


def costliest_groups(costs: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` groups of several members that cost most: entity_name, num_members, cost."""
    return costs.where(F.col("num_members") > 0).orderBy(F.desc("cost"), "entity_name").limit(n).select("entity_name", "num_members", "cost")
