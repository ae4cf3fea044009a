"""Roll-ups of costs: the ordered views over ``costs_raw``, tags by key, the month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_text import tag_string, valid_json

DAY = ["ResourceId", "year", "month", "day"]
METADATA = ["ResourceName", "RegionId", "RegionName", "SubAccountId", "SubAccountName", "ResourceType", "BillingAccountId", "BillingAccountName", "ProviderName"]
SEPARATOR = "|#|"


def day_resource_group(resource_id: Column) -> Column:
    """Case-sensitive, needs what follows the group; no match gives the empty string."""
    return F.regexp_extract(resource_id, ".*/resourcegroups/([^/]+)/.*", 1)


def month_resource_group(resource_id: Column) -> Column:
    """Ignores case; no match gives null."""
    return F.nullif(F.regexp_extract(resource_id, "(?i)/resourceGroups/([^/]+)", 1), F.lit(""))


def resources_per_day(costs: DataFrame) -> DataFrame:
    """One row for each resource, day and metadata tuple, with the day's whole cost.

    A resource that has several tuples on a day repeats its cost. Rows without an id are summed but meet no metadata.
    The scan is read once: tuples and cost come from one grouping by tuple, whose sums are added up by resource-day.
    """
    named = costs.withColumn("ResourceGroup", day_resource_group(F.col("ResourceId")))
    tuples = ["ResourceGroup", *METADATA]
    # costs of 32 decimals leave a sum only six digits before the point
    cost = F.col("EffectiveCost").cast("decimal(38,20)")
    per_tuple = named.groupBy(*DAY, *tuples).agg(F.min("Tags").alias("Tags"), F.sum(cost).alias("cost"))
    by_day = per_tuple.groupBy(*DAY).agg(F.min("Tags").alias("Tags"), F.sum("cost").cast("decimal(38,4)").alias("TotalEffectiveCost"), F.collect_list(F.when(F.col("ResourceId").isNotNull(), F.struct(*tuples))).alias("tuples"))
    # ids that are null meet no metadata: one row, all null
    none = F.array(F.lit(None).cast(by_day.schema["tuples"].dataType.elementType))
    out = by_day.withColumn("t", F.explode(F.when(F.col("ResourceId").isNull(), none).otherwise(F.col("tuples"))))
    return out.select("ResourceId", *(F.col(f"t.{c}").alias(c) for c in tuples), "Tags", "TotalEffectiveCost", "year", "month", "day")


def resources_per_day_json(per_day: DataFrame) -> DataFrame:
    """Tags that are not JSON become null; the others keep their text."""
    return per_day.withColumn("Tags", valid_json(F.col("Tags")))


def resource_daily_aggregated_state(per_day_json: DataFrame) -> DataFrame:
    """Daily snapshots with fingerprints of a resource's state, with and without its id."""

    def fingerprint(first: Column, *rest: str) -> Column:
        others = [F.concat(F.lit(SEPARATOR), F.coalesce(F.col(c), F.lit(""))) for c in rest]
        return F.md5(F.concat(first, *others))

    rows = per_day_json.withColumn("normalized_tags", tag_string(F.col("Tags")))
    shared = ["SubAccountId", "BillingAccountName", "RegionId", "normalized_tags"]
    return rows.select(
        F.make_date("year", F.col("month").cast("int"), F.col("day").cast("int")).alias("SnapshotDate"),
        "ResourceId", "ResourceGroup", "ResourceName", "ResourceType", "SubAccountId", "SubAccountName", "RegionId", "RegionName", "BillingAccountId", "BillingAccountName", "ProviderName", "Tags",
        fingerprint(F.col("ResourceId"), "ResourceGroup", "ResourceName", *shared).alias("state_hash"),
        fingerprint(F.coalesce("ResourceGroup", F.lit("")), "ResourceName", "ResourceType", *shared).alias("full_state_hash"),
    )


def months(per_day: DataFrame) -> DataFrame:
    """Cost of each resource and month, with the tags of the month's last day; year and month come last."""
    last = F.max_by(F.struct("Tags"), F.struct("day", F.coalesce("Tags", F.lit("")))).getField("Tags")
    rows = per_day.groupBy("ResourceId", "year", "month").agg(
        F.max("ResourceName").alias("ResourceName"), F.max("ResourceType").alias("ResourceType"), F.sum("TotalEffectiveCost").cast("decimal(38,4)").alias("Cost"),
        F.max("BillingAccountName").alias("BillingAccountName"), F.max("SubAccountName").alias("SubAccountName"), last.alias("Tags"),
    ).withColumn("ResourceGroup", month_resource_group(F.col("ResourceId")))
    return rows.select(*(c for c in rows.columns if c not in ("year", "month")), "year", "month")


def monthly(per_day: DataFrame, year: int, month: str) -> DataFrame:
    """A month's cost of each resource, with the tags of its last day. Raises nothing if the month is empty."""
    return months(per_day.where((F.col("year") == year) & (F.col("month") == month))).drop("year", "month")


class EmptyMonth(ValueError):
    """The month has no rows."""


def require_rows(frame: DataFrame, what: str) -> DataFrame:
    """For the action layer: ``frame``, or EmptyMonth if it has no rows."""
    if frame.isEmpty():
        raise EmptyMonth(f"no rows for {what}")
    return frame


#: Views in the order in which they build on each other.
VIEWS = [("resources_per_day", "all_costs_view", resources_per_day), ("resources_per_day_json", "resources_per_day", resources_per_day_json), ("resource_daily_aggregated_state", "resources_per_day_json", resource_daily_aggregated_state)]


def create_views(spark: SparkSession, costs: DataFrame) -> list[str]:
    """Registers ``costs`` as all_costs_view and the views over it; returns their names in order."""
    costs.createOrReplaceTempView("all_costs_view")
    for name, source, view in VIEWS:
        view(spark.table(source)).createOrReplaceTempView(name)
    return ["all_costs_view", *(name for name, _, _ in VIEWS)]


def describe(spark: SparkSession, view: str) -> list[dict[str, str]]:
    return [{"column_name": f.name, "column_type": f.dataType.simpleString(), "null": "YES" if f.nullable else "NO"} for f in spark.table(view).schema.fields]


def tags_index(costs: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each tag of a row: columns ``keep``, tag_key, tag_value. Rows without tags give none."""
    from ..functions.json_text import tag_pairs

    return costs.select(*keep, F.explode(tag_pairs(F.col("Tags"))).alias("tag")).select(*keep, F.col("tag.key").alias("tag_key"), F.col("tag.value").alias("tag_value"))
