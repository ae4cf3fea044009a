"""Connected components over tables, for graphs that no machine holds.

Links are vertices' pairs of any orderable type. Rounds of large-star and small-star steps turn each component into a star
around its least vertex; their number grows as the logarithm of the longest path. A link of a vertex to itself is
dropped, repeated ones count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """Vertex and the least vertex of its component, for every vertex of ``links`` (a, b: any orderable type).

    Alternates large-star and small-star steps: large-star links each vertex's greater neighbours to its least
    neighbour, small-star the lesser ones, until the links are stars.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    before = None
    while True:
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("v <> u").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"), F.col("m").alias("u"))
        edges = cut(small.where("v <> u").distinct(), "links")
        # stars: every vertex has one link, and no centre is a leaf of another; then a round changes nothing
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("v").alias("vertex"), F.col("u").alias("component")).unionByName(edges.select(F.col("u").alias("vertex"), F.col("u").alias("component")).distinct())
        before = now
