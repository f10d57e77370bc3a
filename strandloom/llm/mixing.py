"""Weighted fair queueing of sources. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.shared import WORD, cut, ranged, running


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, weight, target: `share` times all sizes dealt by weight, no target above `most` times its source.

    Sources sorted by code point, null last, take the weights in turn. Filling is solved at once: with sources in the
    order of cap / weight, the water level of each prefix of capped sources is tried. One row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    picked = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", picked).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"_budget": F.sum("source_size").over(everything) * F.lit(float(share)), "_full": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)), "_rest": F.sum("weight").over(after), "_ratio": F.col("_cap") / F.col("weight")})
    # the level if exactly the sources before this one are full; right for the first whose own cap is above it
    rows = rows.withColumn("_level", (F.col("_budget") - F.col("_full")) / F.col("_rest"))
    rows = rows.withColumn("_right", F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_level"))).over(everything))
    level = F.coalesce(F.col("_right._level"), F.max("_ratio").over(everything))
    return rows.withColumn("target", F.least(F.col("_cap"), level * F.col("weight"))).select("source", "source_size", "weight", "target")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 17, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every document with the words that a mix of `share` times all words takes of it.

    Each source's documents are shuffled by the md5 of a seed and doc_id and offered up to `most` times. A copy's virtual finish
    time is its source's running word count divided by the source's weight; all copies are range-sorted by it and the
    queue is cut where the budget is spent. Sources that run out leave their share to the others by weight.
    Null text has no words, a null source is a source of its own (the last), repeated rows count each, an empty table
    gives no rows. Columns: doc_id, source, size, source_size, target, copies, taken, text_hash, and those of `keep`.
    """
    rows = docs.select("doc_id", "source", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_mixed"), F.xxhash64("text").alias("_text"), *keep)
    order = ["source", "_mixed", "_text"]
    dealt = ranged(rows, *order)
    # as many rows as sources
    goals = cut(targets(dealt.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    at = running(dealt, ["source"], order, {"_before": "size"})
    at = at.join(goals, at["source"].eqNullSafe(goals["source"])).drop(goals["source"])

    def place(epoch: Column) -> Column:
        finish = (epoch * F.col("source_size") + F.col("_before") + F.col("size")) / F.col("weight")
        return F.struct(finish.alias("_finish"), F.col("_mixed"), F.col("_text"), epoch.alias("_epoch"))

    turns = at.where("size > 0").select(F.explode(F.array(*[place(F.lit(e)) for e in range(most)])).alias("_place"), "size").select("_place.*", "size")
    queue = ["_finish", "_mixed", "_text", "_epoch"]
    spent = running(ranged(turns, *queue), [], queue, {"_spent": "size"})
    budget = goals.agg(F.coalesce(F.sum("target"), F.lit(0.0)).alias("_budget"))
    # one row: the last place that is served
    last = spent.crossJoin(F.broadcast(budget)).where(F.col("_spent") + F.col("size") / 2 <= F.col("_budget")).agg(F.max(F.struct(*queue)).alias("_last"))
    served = [F.when((F.col("size") > 0) & (place(F.lit(e)) <= F.col("_last")), 1).otherwise(0) for e in range(most)]
    rows = at.crossJoin(F.broadcast(last)).withColumn("copies", sum(served[1:], served[0]))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), F.col("_text").alias("text_hash"), *keep)
