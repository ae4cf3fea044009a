"""Entity names: similarity, links, groups, merging of suggestion lists, and what entities cost."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import normalized
from ..sources.store import held, scratch

DUPLICATE, RELATED, CONFIDENT, TOP_K = 0.92, 0.80, 0.95, 5
GRAMS = (3, 5)
#: Names of which all similar pairs are listed, at most; names of a block.
MOST_NAMES, CELL = 5000, 512


def _grams_of(text: Column, n: int) -> Column:
    every = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(F.length(text) >= n, every).otherwise(F.array().cast("array<string>"))


def gram_weights(names: DataFrame, sizes: tuple[int, int] = GRAMS) -> DataFrame:
    """TF-IDF of character grams, each name's vector of length 1: index, gram, weight. ``names``: index, name.

    White space runs count as one blank; idf is smooth, ln((1 + n) / (1 + df)) + 1. Names shorter than the least gram
    have no vector.
    """
    text = F.regexp_replace(F.trim(normalized(F.col("name"))), r"\s\s+", " ")
    grams = F.flatten(F.array(*(_grams_of(F.col("t"), n) for n in range(sizes[0], sizes[1] + 1))))
    tf = names.select("index", text.alias("t")).select("index", F.explode(grams).alias("gram")).groupBy("index", "gram").agg(F.count("*").alias("tf"))
    n = names.count()
    df = tf.groupBy("gram").agg(F.count("*").alias("df"))
    raw = tf.join(df, "gram").withColumn("w", F.col("tf") * (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0))
    norm = raw.groupBy("index").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "index").select("index", "gram", (F.col("w") / F.col("norm")).alias("weight"))


class TooManyNames(ValueError):
    """More names than all pairs of similar ones may be listed for."""


def prefixes(weights: DataFrame, df: DataFrame, least: float) -> DataFrame:
    """index, gram: of each vector, ordered from its rarest gram, those until the rest cannot reach ``least`` any more.
    Similar names share one of these. ``df``: gram, df."""
    w = Window.partitionBy("index").orderBy("df", "gram")
    rest = F.sqrt(F.greatest(F.lit(0.0), 1.0 - F.coalesce(F.sum(F.col("weight") * F.col("weight")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))))
    return weights.join(df, "gram").withColumn("rest", rest).where((F.col("rest") >= least - 1e-9) & (F.col("df") > 1)).select("index", "gram")


def similar_pairs(weights: DataFrame, least: float = RELATED, most: int | None = MOST_NAMES) -> DataFrame:
    """Pairs i < j of cosine ``least`` or more: i, j, similarity. Exact; only pairs that share a gram of their prefixes are
    scored. Lists of like names make a square of pairs, so more than ``most`` names are refused (None: never);
    ``first_neighbours`` has no such bound."""
    if most is not None and (n := weights.select("index").distinct().count()) > most:
        raise TooManyNames(f"{n} names, {most} at most")
    prefix = prefixes(weights, weights.groupBy("gram").agg(F.count("*").alias("df")), least)
    a, b = prefix.withColumnRenamed("index", "i"), prefix.withColumnRenamed("index", "j")
    met = a.join(b, "gram").where("i < j").select("i", "j").distinct()
    left = met.join(weights.select(F.col("index").alias("i"), "gram", F.col("weight").alias("wi")), "i")
    both = left.join(weights.select(F.col("index").alias("j"), "gram", F.col("weight").alias("wj")), ["j", "gram"])
    return both.groupBy("i", "j").agg(F.sum(F.col("wi") * F.col("wj")).alias("similarity")).where(F.col("similarity") >= least)


def first_neighbours(weights: DataFrame, k: int = TOP_K, least: float = RELATED, by_similarity: bool = False) -> DataFrame:
    """i, j, similarity of each name's first ``k`` neighbours of cosine ``least`` or more. Exact, and no table of pairs.

    Names are in blocks by index. A name meets the blocks that hold a gram of its prefix, in cells of two blocks: a cell
    multiplies at most ``CELL`` vectors by as many and gives only each name's first ``k`` there, so like names cost a cell's
    rows and not its pairs. A neighbour among the first ``k`` of all is among the first ``k`` of its cell. Neighbours rank
    by index, or by similarity if ``by_similarity``.
    """
    df = held(weights.groupBy("gram").agg(F.count("*").alias("df")).withColumn("number", F.monotonically_increasing_id()), "grams")
    vectors = weights.join(df.select("gram", "number"), "gram").groupBy("index").agg(F.array_sort(F.collect_list(F.struct("number", "weight"))).alias("v"))
    vectors = held(vectors.select("index", F.col("v.number").alias("grams"), F.col("v.weight").alias("weights")), "vectors")
    block = F.floor(F.col("index") / CELL)
    prefix = held(prefixes(weights, df.select("gram", "df"), least), "prefixes")
    posted = prefix.select("gram", block.alias("to")).distinct()
    meets = prefix.join(posted, "gram").select("index", "to").distinct()
    # both blocks of a cell have the names that meet the other
    ends = meets.select("index", F.greatest(block, "to").alias("a"), F.least(block, "to").alias("b"))

    def meet(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        index = cell["index"].to_numpy()
        order = np.argsort(index)
        index, grams, weight = index[order], [cell["grams"].iloc[i] for i in order], [cell["weights"].iloc[i] for i in order]
        sizes = [len(g) for g in grams]
        _, column = np.unique(np.concatenate(grams), return_inverse=True)
        row, dense = np.repeat(np.arange(len(index)), sizes), index // CELL
        sides = [np.flatnonzero(dense == key[0]), np.flatnonzero(dense == key[1])]
        shared = np.ones(column.max() + 1, bool)
        for side in sides:
            shared &= np.bincount(column[np.isin(row, side)], minlength=len(shared)) > 0
        place, width = np.cumsum(shared) - 1, int(shared.sum())
        ok = shared[column]
        matrix = np.zeros((len(index), width))
        matrix[row[ok], place[column[ok]]] = np.concatenate(weight)[ok]
        found = []
        for x, y in [sides] if key[0] == key[1] else [sides, sides[::-1]]:
            cosine = matrix[x] @ matrix[y].T
            cosine[x[:, None] == y] = 0
            near = cosine >= least
            if by_similarity:
                rank = np.argsort(np.argsort(-np.where(near, cosine, -1), axis=1, kind="stable"), axis=1)
                near &= rank < k
            else:
                near &= np.cumsum(near, axis=1) <= k
            i, j = np.nonzero(near)
            found.append(pd.DataFrame({"i": index[x[i]], "j": index[y[j]], "similarity": cosine[i, j]}))
        return pd.concat(found, ignore_index=True)

    cells = ends.distinct().join(vectors, "index").groupBy("a", "b").applyInPandas(meet, "i long, j long, similarity double")
    order = [F.desc("similarity"), "j"] if by_similarity else ["j"]
    return cells.withColumn("rank", F.row_number().over(Window.partitionBy("i").orderBy(*order))).where(F.col("rank") <= k).drop("rank")


def links(kept: DataFrame) -> DataFrame:
    """Pairs that are among each other's first neighbours, or similar enough and one's: i, j, similarity, link_type."""
    pair = kept.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "similarity")
    counted = pair.groupBy("i", "j").agg(F.max("similarity").alias("similarity"), F.count("*").alias("sides"))
    good = counted.where((F.col("sides") == 2) | (F.col("similarity") >= CONFIDENT))
    return good.select("i", "j", "similarity", F.when(F.col("similarity") >= DUPLICATE, "duplicate").otherwise("related").alias("link_type"))


def components(edges: DataFrame) -> DataFrame:
    """Node and the least node that its edges reach, for every node of ``edges`` (i, j).

    Labels are passed along edges and then through labels, so that long chains take few rounds; each round is
    checkpointed in the session's shared folder.
    """
    spark = edges.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch(spark))
    both = edges.select("i", "j").unionByName(edges.select(F.col("j").alias("i"), F.col("i").alias("j"))).checkpoint()
    labels = both.select(F.col("i").alias("node")).distinct().withColumn("component", F.col("node")).checkpoint()
    while True:
        near = both.join(labels.withColumnRenamed("node", "j"), "j").groupBy(F.col("i").alias("node")).agg(F.min("component").alias("near"))
        met = labels.join(near, "node").select("node", F.least("component", "near").alias("met"), F.col("component").alias("old"))
        through = labels.select(F.col("node").alias("met"), F.col("component").alias("via"))
        step = met.join(through, "met").select("node", F.least("met", "via").alias("component"), "old").checkpoint()
        if step.where("component <> old").isEmpty():
            return step.select("node", "component")
        labels = step.select("node", "component")


def groups(names: DataFrame, edges: DataFrame) -> DataFrame:
    """Members of each component: canonical, entity_name, similarity, link_type.

    The canonical name has the most links, then the greatest mean similarity, then the least name. A member that links
    to it has that link's values, another its own best similarity and ``related``.
    """
    ends = edges.select("i", "j", "similarity", "link_type").unionByName(edges.select(F.col("j").alias("i"), F.col("i").alias("j"), "similarity", "link_type"))
    nodes = ends.groupBy(F.col("i").alias("node")).agg(F.count("*").alias("degree"), F.avg("similarity").alias("mean"), F.max("similarity").alias("best"))
    known = nodes.join(components(edges), "node").join(names.select(F.col("index").alias("node"), "name"), "node")
    order = F.struct(-F.col("degree"), -F.col("mean"), "name")
    canonical = known.groupBy("component").agg(F.min_by(F.struct("node", "name"), order).alias("c"))
    members = known.join(canonical, "component").where("node <> c.node")
    direct = ends.select(F.col("i").alias("node"), F.col("j").alias("to"), F.col("similarity").alias("direct"), "link_type")
    out = members.join(direct, (members["node"] == direct["node"]) & (F.col("c.node") == direct["to"]), "left")
    return out.select(F.col("c.name").alias("canonical"), F.col("name").alias("entity_name"), F.round(F.coalesce("direct", "best"), 3).alias("similarity"), F.coalesce("link_type", F.lit("related")).alias("link_type"))


def merge(statistical: DataFrame, inferred: DataFrame) -> DataFrame:
    """Suggestion lists (entity_name, abbreviations, found_in_chunks) united by name, with where each name came from."""
    sides = statistical.select("entity_name", "abbreviations", "found_in_chunks", F.lit("statistical").alias("s")).unionByName(inferred.select("entity_name", "abbreviations", "found_in_chunks", F.lit("llm_inferred").alias("s")))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast("array<string>")))))).alias(c)
    found = F.array_sort(F.collect_set("s"))
    return sides.groupBy("entity_name").agg(union("abbreviations"), union("found_in_chunks"), F.reverse(found).alias("validation_source"))


def master(merged: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups with the united lists of their members, and the entities of no group."""
    every = members.select("canonical", "entity_name").unionByName(members.select("canonical", F.col("canonical").alias("entity_name"))).distinct()
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    lists = every.join(merged, "entity_name").groupBy("canonical").agg(union("abbreviations"), union("found_in_chunks"))
    listed = members.groupBy("canonical").agg(F.array_sort(F.collect_list(F.struct("entity_name", "similarity", "link_type"))).alias("members"))
    grouped = lists.join(listed, "canonical").select("canonical", "abbreviations", "found_in_chunks", F.lit("pending").alias("status"), "members")
    single = merged.join(every.select("entity_name"), "entity_name", "left_anti")
    return grouped, single.select("entity_name", "abbreviations", "found_in_chunks", F.array_sort("validation_source").alias("validation_source"), F.lit("pending").alias("status"))


def entity_costs(entities: DataFrame, resources: DataFrame) -> DataFrame:
    """Cost of the resources whose names contain any chunk of an entity, once each: entity_name, num_members, cost,
    cost_pct_of_total, cumulative_cost_pct. ``entities``: entity_name, found_in_chunks, num_members.

    Chunks meet the names' parts of their lengths by equality. Costs are added up by name first.
    """
    by_name = resources.where(F.col("ResourceName").isNotNull()).groupBy(F.lower("ResourceName").alias("name")).agg(F.sum("Cost").alias("cost"))
    chunks = entities.select("entity_name", F.explode("found_in_chunks").alias("chunk")).select("entity_name", F.lower("chunk").alias("chunk")).where("chunk <> ''").distinct()
    # every chunk is in a name just if it equals one of the name's parts of its own length
    lengths = sorted(r[0] for r in chunks.select(F.length("chunk")).distinct().collect())
    parts = by_name.select("name", F.explode(F.array(*map(F.lit, lengths or [0])).cast("array<int>")).alias("n")).where((F.col("n") > 0) & (F.length("name") >= F.col("n")))
    posted = parts.select("name", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - F.col("n") + 1), lambda i: F.substring("name", i, F.col("n"))))).alias("chunk"))
    hit = posted.join(chunks, "chunk").select("entity_name", "name").distinct()
    cost = hit.join(by_name, "name").groupBy("entity_name").agg(F.sum("cost").alias("cost"))
    known = entities.where(F.size("found_in_chunks") > 0).select("entity_name", "num_members").join(cost, "entity_name", "left")
    return with_shares(known.withColumn("cost", F.coalesce("cost", F.lit(0))), resources)


def with_shares(costs: DataFrame, resources: DataFrame) -> DataFrame:
    """Adds each entity's share of the total cost in percent, and the running sum from the most costly down.

    The sum runs within ranges of the order and starts from what the ranges before add up to.
    """
    total = resources.agg(F.sum("Cost").cast("double").alias("total"))
    order = [F.desc("cost"), F.asc("entity_name")]
    ranged = costs.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    shared = held(ranged, "entity-costs").crossJoin(F.broadcast(total)).withColumn("cost_pct_of_total", F.col("cost").cast("double") / F.col("total") * 100).drop("total")
    sums = shared.groupBy("range").agg(F.sum("cost_pct_of_total").alias("own"))
    before = F.coalesce(F.sum("own").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    within = F.sum("cost_pct_of_total").over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    starts = sums.select("range", before.alias("before"))  # a row for each range
    return shared.withColumn("within", within).join(F.broadcast(starts), "range").withColumn("cumulative_cost_pct", F.col("before") + F.col("within")).drop("range", "before", "within")


def top_coverage(costs: DataFrame, n: int) -> DataFrame:
    """Share of the total that the ``n`` most costly entities carry: one row."""
    return costs.orderBy(F.desc("cost"), "entity_name").limit(n).agg(F.sum("cost_pct_of_total").alias("coverage_pct"))


def scorecard(members: DataFrame, distinct: DataFrame, costs: DataFrame) -> DataFrame:
    """One row: groups, members, distinct entities, duplicate and related links, consolidation ratio, cost at risk."""
    m = members.agg(F.count_distinct("canonical").alias("num_groups"), F.count("*").alias("num_members"), F.count_if(F.col("link_type") == "duplicate").alias("duplicate_count"), F.count_if(F.col("link_type") == "related").alias("related_count"))
    risk = costs.where("num_members > 0").agg(F.coalesce(F.sum("cost"), F.lit(0)).cast("decimal(38,4)").alias("at_risk_cost"))
    out = m.crossJoin(distinct.agg(F.count("*").alias("num_distinct"))).crossJoin(risk)  # one row each
    total = F.col("num_groups") + F.col("num_distinct")
    return out.withColumn("consolidation_ratio", F.when(total > 0, (F.col("num_members") + F.col("num_groups")) / total).otherwise(0.0))
