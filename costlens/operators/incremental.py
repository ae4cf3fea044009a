"""The resource-day view and its months kept as tables, of which an ingest replaces only the days that it touched."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import ingest, store
from ..sources.spec import PARTITIONS
from . import views

DAYS, MONTHS = "resources_per_day", "resources_per_month"
MONTH = PARTITIONS[:2]


def _replace(rows: DataFrame, path: str, parts: list[str]) -> None:
    dealt = rows.hint("rebalance", *[F.col(c) for c in parts])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def _read(spark: SparkSession, path: str, rows: DataFrame, parts: list[str]) -> DataFrame:
    """A kept table; month and day stay text with their zero."""
    fields = {f.name: f for f in rows.schema}
    schema = rows.select(*(c for c in fields if c not in parts), *parts).schema
    return store.read_table(spark, path, schema)


def touched(costs: DataFrame, days: Iterable[str]) -> DataFrame:
    """Rows of some days (year-month-day); only their folders are read."""
    listed = [d.split("-") for d in sorted(set(days))]
    each = ((F.col("year") == int(y)) & (F.col("month") == m) & F.col("day").isin([x[2] for x in listed if x[:2] == [y, m]]) for y, m in sorted({(y, m) for y, m, _ in listed}))
    return costs.where(reduce(or_, each, F.lit(False)))


def refresh(spark: SparkSession, base: str, tenant: str, days: Iterable[str]) -> None:
    """Brings the kept view up to date after an ingest: computes the days that it touched anew and replaces them, then the
    months that these are in, from days."""
    days = sorted(set(days))
    if not days:
        return
    costs = ingest.read_days(spark, ingest.dataset_path(base, tenant))
    _replace(views.resources_per_day_json(views.resources_per_day(touched(costs, days))), ingest.dataset_path(base, tenant, DAYS), PARTITIONS)
    in_months = reduce(or_, ((F.col("year") == int(y)) & (F.col("month") == m) for y, m in sorted({tuple(d.split("-")[:2]) for d in days})))
    _replace(views.months(per_day(spark, base, tenant).where(in_months)), ingest.dataset_path(base, tenant, MONTHS), MONTH)


def per_day(spark: SparkSession, base: str, tenant: str) -> DataFrame:
    """The kept view: what ``resources_per_day_json`` gives for all days that were refreshed."""
    like = views.resources_per_day_json(views.resources_per_day(spark.createDataFrame([], ingest.SCHEMA)))
    return _read(spark, ingest.dataset_path(base, tenant, DAYS), like, PARTITIONS).select(*like.columns)


def per_month(spark: SparkSession, base: str, tenant: str) -> DataFrame:
    """Months of the kept view: what ``monthly`` gives, with year and month."""
    like = views.months(per_day(spark, base, tenant))
    return _read(spark, ingest.dataset_path(base, tenant, MONTHS), like, MONTH)
