"""Connected components of links that stay distributed, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) for every id in links; root is the least id it is linked to by any path.

    Each round first links all larger neighbours of an id to its least neighbour, then all smaller ones; it ends when a
    round changes nothing. A round costs two aggregations and joins over the links, which never grow in number, and
    the number of rounds grows with the logarithm of the longest path. Nulls and links of an id to itself are left out.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs, before = cut(pairs), None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("root")).union(pairs.select("v", "v")).distinct()
        before = tuple(state)
        both = pairs.union(pairs.select("v", "u"))
        # Written, so that the join has a plain exchange on either side: an id with very many links is then split by the engine.
        least = cut(both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("u", "n").alias("m")))
        # v keeps one row for each u that it is larger than
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = cut(large.join(small, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
