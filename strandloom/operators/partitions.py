"""Hits of models as soft, hard and merged cluster partitions, and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators import extremes
from strandloom.operators.intervals import overlap_join


def score_cutoff(hits: DataFrame, min_bits: float, max_evalue: float, significance: float = 1.0) -> DataFrame:
    """Hits by E-value where a model has E-values; else by score: at least min_bits, or, if significance is below 1 and
    the model has more than ten hits, at least the upper quantile of an extreme-value fit; a cutoff of 0 means above 0."""
    w = Window.partitionBy("name")
    rows = hits.withColumns({"_e": F.max(F.col("evalue").isNotNull()).over(w), "_n": F.count("*").over(w)})
    if significance < 1:
        cut = gev_cutoffs(hits, significance).withColumnRenamed("cutoff", "_gev")
        rows = rows.join(cut, "name", "left")
    else:
        rows = rows.withColumn("_gev", F.lit(None).cast("double"))
    cutoff = F.when(F.col("_n") > 10, F.greatest(F.coalesce("_gev", F.lit(min_bits)), F.lit(min_bits))).otherwise(F.lit(min_bits))
    keep = F.when(F.col("_e"), F.col("evalue") <= max_evalue).when(cutoff == 0, F.col("bitscore") > 0).otherwise(F.col("bitscore") >= cutoff)
    return rows.where(keep).drop("_e", "_n", "_gev")


def gev_cutoffs(hits: DataFrame, significance: float) -> DataFrame:
    """name, cutoff: the score that the model's extreme-value distribution exceeds with probability `significance`."""
    return extremes.cutoffs(hits.select(F.col("name").alias("key"), F.col("bitscore").alias("x")), significance).withColumnRenamed("key", "name")


def significance_matrix(matrix: DataFrame, p: float) -> DataFrame:
    """i, j, sig: 1 where a cell (i, j, val) reaches its column's cutoff, and on the diagonal."""
    cut = extremes.cutoffs(matrix.select(F.col("j").alias("key"), F.col("val").alias("x")), p).withColumnRenamed("key", "j")
    return matrix.join(cut, "j").select("i", "j", ((F.col("val") >= F.col("cutoff")) | (F.col("i") == F.col("j"))).cast("int").alias("sig"))


def collect_hits(hits: DataFrame, least: int = 2, grey: DataFrame | None = None) -> DataFrame:
    """Hits of models with `least` of them; with a grey list (seqid) a model needs a hit elsewhere."""
    w = Window.partitionBy("name")
    rows = hits.withColumn("_n", F.count("*").over(w)).where(F.col("_n") >= least).drop("_n")
    if grey is None:
        return rows
    marked = rows.join(grey.select("seqid").distinct().withColumn("_g", F.lit(True)), "seqid", "left")
    return marked.withColumn("_ok", F.max(F.col("_g").isNull()).over(w)).where("_ok").drop("_ok", "_g")


def filter_clusters(hits: DataFrame, least: int, merged: DataFrame | None = None) -> DataFrame:
    """Hits of clusters (after the map name -> cluster) with at least `least` hits.

    What has a row for each cluster goes to the hits, which aren't dealt by cluster: one may hold most of them.
    """
    rows = hits if merged is None else hits.join(F.broadcast(merged), "name", "left").withColumn("cluster", F.coalesce("cluster", "name"))
    if merged is None and "cluster" not in rows.columns:
        rows = rows.withColumn("cluster", F.col("name"))
    big = rows.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("cluster")
    return rows.join(F.broadcast(big), "cluster", "left_semi")


def cluster_index(clusters: DataFrame) -> DataFrame:
    """name, idx from 1 in order of (round, index) of names round.index. One row for each cluster."""
    p = F.split("name", r"\.")
    return clusters.select("name").distinct().withColumn("idx", F.dense_rank().over(Window.orderBy(p[0].cast("int"), F.coalesce(p[1].cast("int"), F.lit(0)))))


def unique_hits(hits: DataFrame, cutoff: float) -> DataFrame:
    """Hits that no overlapping hit of the same strand beats: none has a higher score, none of equal score a lesser name.

    A beaten hit still beats others, and equal names of equal score all stay. Rows are told apart by rid.
    """
    over = overlap_join(hits, hits, cutoff)
    better = (F.col("b_bitscore") > F.col("a_bitscore")) | ((F.col("b_bitscore") == F.col("a_bitscore")) & (F.col("b_name") < F.col("a_name")))
    return hits.join(over.where(better).select(F.col("a_rid").alias("rid")).distinct(), "rid", "left_anti")


def cluster_overlap(hits: DataFrame, cutoff: float = 0.51) -> DataFrame:
    """i, j, ol, size, ratio_pct: how many different hits of j the hits of i meet best, by the size of i.

    Each hit of i takes the hit of j with the largest overlap (ties: least rid); different ones are counted.
    """
    w = Window.partitionBy("a_name", "b_name", "a_rid").orderBy(F.desc("pct"), "b_rid")
    best = overlap_join(hits, hits, cutoff).where("a_name <> b_name").withColumn("r", F.row_number().over(w)).where("r = 1")
    ol = best.groupBy(F.col("a_name").alias("i"), F.col("b_name").alias("j")).agg(F.count_distinct("b_rid").alias("ol"))
    size = hits.groupBy(F.col("name").alias("i")).agg(F.count("*").alias("size"))
    return ol.join(size, "i").withColumn("ratio_pct", F.floor((200 * F.col("ol") + F.col("size")) / (2 * F.col("size"))).cast("int"))


def best_partner(overlaps: DataFrame, least_pct: int) -> DataFrame:
    """The partner with the largest ratio of each i (ties: least j), if it reaches the limit."""
    w = Window.partitionBy("i").orderBy(F.desc("ratio_pct"), "j")
    return overlaps.withColumn("r", F.row_number().over(w)).where(f"r = 1 and ratio_pct >= {int(least_pct)}").drop("r")


def merge_map(partners: DataFrame, names: DataFrame) -> DataFrame:
    """name, cluster: partners by falling ratio (ties: i, then j) pull the whole group of i to where j stands by then.

    One row for each cluster comes to the driver (a few thousand by construction: each has its best partner only).
    """
    own = sorted(r["name"] for r in names.select("name").distinct().collect())
    group, members, label = {x: k for k, x in enumerate(own)}, [[x] for x in own], list(own)
    for r in partners.orderBy(F.desc("ratio_pct"), "i", "j").collect():
        old, new = group[r["i"]], group[r["j"]]
        if old != new:
            # the shorter list moves; the name is that of where j stands
            name = label[new]
            short, long = sorted((old, new), key=lambda k: len(members[k]))
            for x in members[short]:
                group[x] = long
            members[long] += members[short]
            members[short], label[long] = [], name
    return names.sparkSession.createDataFrame([(x, label[group[x]]) for x in own], "name string, cluster string")


def oracle_merge(classes: DataFrame) -> DataFrame:
    """name, cluster: clusters of one true class (not 0) become its last name; others stay."""
    w = Window.partitionBy("class")
    return classes.select("name", F.when(F.col("class") == 0, F.col("name")).otherwise(F.max("name").over(w)).alias("cluster"))


def partition_rows(hits: DataFrame, index: DataFrame) -> DataFrame:
    """key, bitscore, evalue, merged, name, idx, to be read in order of idx, then falling score."""
    return hits.join(F.broadcast(index.withColumnRenamed("name", "cluster")), "cluster").select("key", "bitscore", "evalue", F.col("cluster").alias("merged"), "name", "idx")


def hit_types(hits: DataFrame, models: DataFrame, removed: DataFrame) -> DataFrame:
    """rid, type: MODEL if the hit overlaps a model sequence, else BLASTCLUST if a removed near copy, else CMSEARCH."""
    m = overlap_join(hits, models, 0.51, row_id="").select(F.col("a_rid").alias("rid")).distinct().withColumn("m", F.lit(True))
    b = overlap_join(hits, removed, 0.51, row_id="").select(F.col("a_rid").alias("rid")).distinct().withColumn("b", F.lit(True))
    return hits.select("rid").join(m, "rid", "left").join(b, "rid", "left").select("rid", F.when(F.col("m"), "MODEL").when(F.col("b"), "BLASTCLUST").otherwise("CMSEARCH").alias("type"))


def models_without_hit(models: DataFrame, hits: DataFrame) -> DataFrame:
    """Model sequences that no hit overlaps."""
    met = overlap_join(models, hits, 0.51, row_id="").select(F.col("a_rid").alias("rid")).distinct()
    return models.join(met, "rid", "left_anti")


def top_hits(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each cluster with a positive score (ties: least rid)."""
    w = Window.partitionBy("name").orderBy(F.desc("bitscore"), "rid")
    return hits.where("bitscore > 0").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def cluster_stats(hits: DataFrame) -> DataFrame:
    """cluster, seqs, ids_unique, models, best, mean score."""
    return hits.groupBy("cluster").agg(F.count("*").alias("seqs"), F.count_distinct("seqid").alias("ids_unique"), F.count_distinct("name").alias("models"), F.round(F.max("bitscore"), 4).alias("best"), F.round(F.avg("bitscore"), 4).alias("mean_score"))


def found_clusters(partition: DataFrame) -> DataFrame:
    """idx of the clusters of the last round that have rows."""
    rows = partition.select(F.regexp_extract("name", r"^(\d+)\.", 1).cast("int").alias("round"), F.regexp_extract("name", r"\.(\d+)$", 1).cast("int").alias("idx"))
    last = rows.agg(F.max("round").alias("last"))
    return rows.crossJoin(F.broadcast(last)).where("round = last").select("idx").distinct()


def new_hits(hits: DataFrame, known: DataFrame) -> DataFrame:
    """Hits of models that the kept soft partition doesn't have yet."""
    return hits.join(known.select("name").distinct(), "name", "left_anti")


def bed(hits: DataFrame) -> DataFrame:
    """One BED line for each hit: zero-based start, name, score."""
    return hits.select(F.concat_ws("\t", F.col("seqid").cast("string"), (F.col("start") - 1).cast("string"), F.col("stop").cast("string"), "name", F.col("bitscore").cast("string"), "strand").alias("value"))
