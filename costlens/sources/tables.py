"""Cost frames from the provided star-schema tables, and the same frames as SQL for the oracle.

``rollup_costs`` has one row for each line item, at a coarse resource grain, so that days hold several rows and several
metadata tuples of a resource. ``named_resources`` has one row for each part, with composed resource names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .spec import SPEC

#: Terms of the queries: alphanumeric, so that the oracle can classify whole tokens.
TECH_TERMS = ["vm", "sql", "aks", "steel", "copper"]
ENV_TERMS = ["prod", "dev", "uat", "qa"]
REG_TERMS = ["weu", "eus", "northeurope"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def rollup_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name, *columns: table(spark, sf_dir, name).select(*columns)
    lines = read("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    joined = (
        lines.join(read("orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    k = (F.col("l_partkey") % 20).alias("k")
    one = _text('{"Key":"flag","Value":"', F.col("l_returnflag"), '"}')
    two = _text('{"Key":"status","Value":"', F.col("l_linestatus"), '"}')
    number = F.col("l_linenumber") % 4
    tags = (
        F.when(F.col("l_linenumber") == 5, None)
        .when(number == 0, _text("[", one, ",", two, "]"))
        .when(number == 1, _text("[", two, ",", one, "]"))
        .when(number == 2, _text("[", one, ',{"Key":"status"},{"Value":"z"}]'))
        .otherwise("not json")
    )
    base = _text("/subscriptions/s", k)
    resource = (
        F.when(k == 19, None)
        .when(k % 5 == 0, _text(base, "/resourceGroups/rg-", k, "/providers/x/", k))
        .when(k % 7 == 0, _text(base, "/resourcegroups/rg-", k))
        .otherwise(_text(base, "/resourcegroups/rg-", k, "/providers/x/", k))
    )
    return joined.select(
        resource.alias("ResourceId"),
        _text("res-", k).alias("ResourceName"),
        F.col("r_regionkey").cast("string").alias("RegionId"),
        F.col("r_name").alias("RegionName"),
        _text("s", k % 4).alias("SubAccountId"),
        _text("sub ", k % 4).alias("SubAccountName"),
        _text("type", k % 3).alias("ResourceType"),
        _text("b", k % 2).alias("BillingAccountId"),
        _text("Billing ", k % 2).alias("BillingAccountName"),
        F.lit("Provider").alias("ProviderName"),
        tags.alias("Tags"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("EffectiveCost"),
        F.year("l_shipdate").cast("long").alias("year"),
        F.date_format("l_shipdate", "MM").alias("month"),
        F.date_format("l_shipdate", "dd").alias("day"),
    )


ROLLUP_SQL = """rollup_costs AS (
  SELECT CASE WHEN k = 19 THEN NULL
              WHEN k % 5 = 0 THEN '/subscriptions/s' || k || '/resourceGroups/rg-' || k || '/providers/x/' || k
              WHEN k % 7 = 0 THEN '/subscriptions/s' || k || '/resourcegroups/rg-' || k
              ELSE '/subscriptions/s' || k || '/resourcegroups/rg-' || k || '/providers/x/' || k END AS ResourceId,
         'res-' || k AS ResourceName, CAST(r_regionkey AS VARCHAR) AS RegionId, r_name AS RegionName,
         's' || (k % 4) AS SubAccountId, 'sub ' || (k % 4) AS SubAccountName, 'type' || (k % 3) AS ResourceType,
         'b' || (k % 2) AS BillingAccountId, 'Billing ' || (k % 2) AS BillingAccountName, 'Provider' AS ProviderName,
         CASE WHEN l_linenumber = 5 THEN NULL
              WHEN l_linenumber % 4 = 0 THEN '[' || one || ',' || two || ']'
              WHEN l_linenumber % 4 = 1 THEN '[' || two || ',' || one || ']'
              WHEN l_linenumber % 4 = 2 THEN '[' || one || ',{"Key":"status"},{"Value":"z"}]'
              ELSE 'not json' END AS Tags,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS EffectiveCost,
         CAST(year(l_shipdate) AS BIGINT) AS year, strftime(l_shipdate, '%m') AS month, strftime(l_shipdate, '%d') AS day
  FROM (SELECT *, l_partkey % 20 AS k, '{"Key":"flag","Value":"' || l_returnflag || '"}' AS one,
               '{"Key":"status","Value":"' || l_linestatus || '"}' AS two FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def named_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ResourceId, ResourceName, ResourceType, Cost, BillingAccountName, SubAccountName, ResourceGroup, Tags."""
    cost = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")).cast("decimal(24,4)").alias("Cost"))
    part = table(spark, sf_dir, "part")
    p, words = F.col("p_partkey"), F.split("p_name", " ")
    env = F.element_at(F.array(*map(F.lit, ["prod", "dev", "uat", "stage"])), (p % 4 + 1).cast("int"))
    region = F.element_at(F.array(*map(F.lit, ["weu", "eus", "apac"])), (p % 3 + 1).cast("int"))
    tech = F.element_at(F.array(*map(F.lit, ["vm", "sql2019", "aks", "app", "sqlx"])), (p % 5 + 1).cast("int"))
    plain = F.concat_ws("-", F.array_join(words, "-"), tech, env, region, p.cast("string"))
    odd = F.when(p % 7 == 0, _text("-", F.lower(F.hex(p * 2654435761)))).otherwise("")
    own = F.concat(F.lit("zx"), F.translate(p.cast("string"), "0123456789", "bcdfghjklm"), F.lit("-"), region)  # no other name has its letters
    name = F.when(p % 97 == 0, None).when(p % 23 == 0, own).when(p % 5 == 0, F.concat(F.array_join(words, ""), env, F.when(p % 10 == 0, F.lit("12")).otherwise(""))).when(p % 11 == 0, F.concat_ws("_", F.upper(words[0]), env, region)).otherwise(F.concat(plain, odd))
    return (
        part.join(cost, p == F.col("l_partkey"))
        .select(
            _text("/r/", p).alias("ResourceId"),
            name.alias("ResourceName"),
            F.when(p % 13 == 0, "Metric alert rule").when(p % 17 == 0, None).otherwise(F.col("p_type")).alias("ResourceType"),
            "Cost",
            F.col("p_brand").alias("BillingAccountName"),
            F.when(F.col("p_size") % 9 == 0, None).otherwise(_text("sub", F.col("p_size") % 8)).alias("SubAccountName"),
            F.when(F.col("p_size") % 7 == 0, None).otherwise(_text("rg", F.col("p_size") % 6)).alias("ResourceGroup"),
            _text('{"team":"t', p % 6, '","size":"', F.col("p_size"), '"}').alias("Tags"),
        )
    )


NAMED_SQL = """named_resources AS (
  SELECT '/r/' || p_partkey AS ResourceId,
         CASE WHEN p_partkey % 97 = 0 THEN NULL
              WHEN p_partkey % 23 = 0 THEN 'zx' || translate(CAST(p_partkey AS VARCHAR), '0123456789', 'bcdfghjklm') || '-' || reg
              WHEN p_partkey % 5 = 0 THEN replace(p_name, ' ', '') || env || CASE WHEN p_partkey % 10 = 0 THEN '12' ELSE '' END
              WHEN p_partkey % 11 = 0 THEN upper(split_part(p_name, ' ', 1)) || '_' || env || '_' || reg
              ELSE replace(p_name, ' ', '-') || '-' || tech || '-' || env || '-' || reg || '-' || p_partkey
                   || CASE WHEN p_partkey % 7 = 0 THEN '-' || lower(to_hex(p_partkey * 2654435761)) ELSE '' END END AS ResourceName,
         CASE WHEN p_partkey % 13 = 0 THEN 'Metric alert rule' WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type END AS ResourceType,
         Cost, p_brand AS BillingAccountName,
         CASE WHEN p_size % 9 = 0 THEN NULL ELSE 'sub' || (p_size % 8) END AS SubAccountName,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'rg' || (p_size % 6) END AS ResourceGroup,
         '{"team":"t' || (p_partkey % 6) || '","size":"' || p_size || '"}' AS Tags
  FROM (SELECT *, ['prod', 'dev', 'uat', 'stage'][p_partkey % 4 + 1] AS env, ['weu', 'eus', 'apac'][p_partkey % 3 + 1] AS reg,
               ['vm', 'sql2019', 'aks', 'app', 'sqlx'][p_partkey % 5 + 1] AS tech FROM part)
  JOIN (SELECT l_partkey, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DECIMAL(24,4)) AS Cost
        FROM lineitem GROUP BY l_partkey) ON p_partkey = l_partkey
)"""


#: Folders of the files of ``order_files``.
FOLDERS = 4


def order_files(spark: SparkSession, sf_dir: str, base: str) -> list[str]:
    """Writes orders as CSV files of costs, in FOLDERS folders by order; gives the folders. Costs are charged on the first
    of the order's month. Of some lines the end is missing, some have a field more, some costs are no numbers. The first
    field is the order's key."""
    key = F.col("o_orderkey")
    cost = F.when(key % 50 == 2, "no cost").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    made = {"time": F.date_format("o_orderdate", "yyyy-MM-01"), "decimal": F.lit("0.5"), "string": F.lit('a, "b"'), "json": F.lit("{}")}
    fields = [F.coalesce({"AvailabilityZone": key.cast("string"), "EffectiveCost": cost, "ResourceId": _text("/s/resourcegroups/g", key % 10, "/x")}.get(n, made[k]), F.lit("")).alias(n) for n, k, _ in SPEC]
    whole = F.to_csv(F.struct(*fields), {"escape": '"'})
    line = F.when(key % 41 == 0, F.substring_index(whole, ",", 3)).when(key % 41 == 1, F.concat(whole, F.lit(",more"))).otherwise(whole)
    lines = table(spark, sf_dir, "orders").select((key % FOLDERS).alias("folder"), line.alias(",".join(n for n, _, _ in SPEC)))
    # one column under the header's text: the lines are written as they are
    options = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.partitionBy("folder").options(**options).csv(base)
    return [f"{base}/folder={k}" for k in range(FOLDERS)]


ORDERS_SQL = """order_costs AS (
  SELECT o_orderkey AS key, o_orderkey % 4 AS folder, o_orderkey % 41 < 2 AS bad, o_orderkey % 50 = 2 AS odd, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, '/s/resourcegroups/g' || (o_orderkey % 10) || '/x' AS resource,
    CASE WHEN o_orderkey % 50 <> 2 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS cost FROM orders
)"""


def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names for the similarity operators, with an index in name order: index, name."""
    from pyspark.sql import Window

    names = table(spark, sf_dir, "part").select(F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("name")).distinct()
    return names.withColumn("index", F.row_number().over(Window.orderBy("name")).cast("long"))


ENTITY_SQL = """entity_names AS (
  SELECT name, row_number() OVER (ORDER BY name) AS index FROM (SELECT DISTINCT lower(p_name || ' ' || p_type) AS name FROM part)
)"""
