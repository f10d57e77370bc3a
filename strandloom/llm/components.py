"""Connected components by alternating large-star and small-star steps; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.shared import few, salted_join, table


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reached) for every node of the edges (u, v); nodes without edges aren't listed."""
    # tables and not checkpoints: these keep estimates of sizes that each step squares
    now = table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while (mark := now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()) != seen and mark[0]:
        seen = mark
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted_join(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        under = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, under, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = table(few(small.union(under.select("u", F.col("m").alias("v"))).distinct(), mark[0]), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
