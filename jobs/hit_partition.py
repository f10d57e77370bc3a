"""Keeps the soft and the hard partition of model hits up to date as rounds of clustering add models.

    python -m jobs.hit_partition --hits DIR --out DIR [--config FILE]

Hits of models that earlier runs have taken aren't read into the work again, and rounds before the last taken one aren't
read at all where the folders of --hits are by round. Tables under --out:

    partition   rid, round, name, seqid, start, stop, strand, key, bitscore, best; folders by bucket (of the sequence)
    clusters    name, round, soft, hard, top: how many hits a model has and how many of them are best; folders by round
    marks       name, round: the models taken so far

A hit is best if no overlapping hit of its strand has a higher score, or an equal one and a lesser name; beaten hits
still beat others. Hits only meet on one sequence, so a run rewrites just the buckets of sequences with new hits, and
equals a run over everything. A model belongs to the soft partition if it has min_cluster_size hits, to the hard one if
it has so many best ones. Marks are written last: a run that broke off is done again with the same result, as the
rows of the models that it takes replace what it may have stored of them. Of rows with one rid the least stays; rows
without rid, model, sequence or places give nothing.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.fragment_library import stored
from strandloom.operators import intervals, partitions
from strandloom.session import session, shared_dir

log = logging.getLogger("hit_partition")
CONFIG = Path(__file__).with_suffix(".json")
HIT = ("rid", "round", "name", "seqid", "start", "stop", "strand", "bitscore")
PARTITION = "rid long, round int, name string, seqid string, start long, stop long, strand string, bitscore double, key string, best boolean, bucket int"
CLUSTERS = "name string, soft long, hard long, top double, round int"
MARKS = "name string, round int"


def hits_of(table: DataFrame, config: dict) -> DataFrame:
    """The configured columns with the types of PARTITION."""
    types = dict(x.split() for x in PARTITION.split(", "))
    return table.select(*[F.expr(config["columns"][c]).cast(types[c]).alias(c) for c in HIT]).where("rid is not null and name is not null and seqid is not null and start is not null and stop is not null")


def run(spark: SparkSession, hits: str, out: str, config: dict) -> DataFrame:
    """Takes the hits of new models, and returns the whole partition with soft and hard."""
    marks = stored(spark, f"{out}/marks", MARKS)
    last = marks.agg(F.max("round")).first()[0]
    rows = hits_of(spark.read.parquet(hits), config)
    if last is not None:
        rows = partitions.new_hits(rows.where(F.col("round") >= last), marks)
    rest = [c for c in HIT if c != "rid"]
    rows = rows.groupBy("rid").agg(F.min(F.struct(*rest)).alias("x")).select("rid", *[F.col(f"x.{c}").alias(c) for c in rest])
    shared_dir(spark)
    new = rows.withColumn("bucket", F.pmod(F.hash("seqid"), F.lit(config["buckets"])).cast("int")).checkpoint()
    # one row for each bucket, of which there is a fixed number
    touched = {r["bucket"]: r["count"] for r in new.groupBy("bucket").count().collect()}
    log.info("read %d hits of %d new models in %d of %d buckets from %s", sum(touched.values()), new.select("name").distinct().count(), len(touched), config["buckets"], hits)
    if touched:
        names = new.select("name", "round").distinct()
        old = stored(spark, f"{out}/partition", PARTITION).where(F.col("bucket").isin(list(touched))).join(names.select("name"), "name", "left_anti")
        every = old.select(*HIT, "bucket").unionByName(new.select(*HIT, "bucket"))
        best = partitions.unique_hits(every, config["overlap"]).select("rid", F.lit(True).alias("best"))
        done = every.join(best, "rid", "left").select(*HIT, intervals.make_key().alias("key"), F.coalesce("best", F.lit(False)).alias("best"), "bucket").checkpoint()
        done.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{out}/partition")
        whole = stored(spark, f"{out}/partition", PARTITION)
        # models whose counts may have changed: those with hits in the buckets that were written
        changed = done.select("round").distinct()
        sizes = whole.join(changed, "round", "left_semi").groupBy("name", "round").agg(F.count("*").alias("soft"), F.sum(F.col("best").cast("long")).alias("hard"), F.max("bitscore").alias("top"))
        sizes.select("name", "soft", "hard", "top", "round").hint("rebalance", "round").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("round").parquet(f"{out}/clusters")
        names.coalesce(1).write.mode("append").parquet(f"{out}/marks")
        log.info("wrote %d hits of %d buckets; %d models are taken", done.count(), len(touched), stored(spark, f"{out}/marks", MARKS).select("name").distinct().count())
    sizes = stored(spark, f"{out}/clusters", CLUSTERS)
    least = config["min_cluster_size"]
    whole = stored(spark, f"{out}/partition", PARTITION).join(sizes.select("name", (F.col("soft") >= least).alias("soft"), (F.col("hard") >= least).alias("hard")), "name")
    return whole.withColumn("hard", F.col("hard") & F.col("best"))


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s: %(message)s")
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("hits", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config", default=str(CONFIG))
    a = p.parse_args()
    spark = session()
    try:
        config = json.loads("\n".join(r[0] for r in spark.read.text(a.config).collect()))
        run(spark, a.hits, a.out, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
