"""Keeps a library of sequence fragments up to date with a folder to which files of sequences are added.

    python -m jobs.fragment_library --documents DIR --labels DIR --out DIR [--config FILE]

A file stream takes the files that its checkpoint doesn't know yet, all that are there, and ends. Their sequences are
normalised, cut at long masked runs and into overlapping windows, as the clustering wants them. Tables under --out:

    fragments   seq_idx, key, start, stop, strand, seq, digest, first_key, grey; folders by source and batch
    sequences   seq_idx, length, segments, fragments, source; folders by batch
    progress    the stream's checkpoint

first_key names the first fragment with the same residues, in the library so far or else in the batch (by sequence,
start, key). grey marks fragments of sequences whose label meets the configured condition. A sequence that the library
has isn't taken again; of several under one id in one batch the least text stays. Rows without id or residues give
nothing. A batch that is run again, after a failure, replaces its own folders.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators import seqprep
from strandloom.session import session, shared_dir

log = logging.getLogger("fragment_library")
CONFIG = Path(__file__).with_suffix(".json")
FRAGMENTS = "seq_idx long, key string, start long, stop long, strand string, seq string, digest string, first_key string, grey boolean, source string, batch long"
SEQUENCES = "seq_idx long, length long, segments long, fragments long, source string, batch long"


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at the path; without rows where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def add(batch: DataFrame, number: int, labels: DataFrame, out: str, config: dict) -> None:
    """The batch's sequences that the library doesn't have, as fragments of batch `number`."""
    spark = batch.sparkSession
    rows = batch.select(F.expr(config["id"]).cast("long").alias("seq_idx"), F.expr(config["source"]).cast("string").alias("source"), F.expr(config["sequence"]).alias("seq"))
    # dealt by sequence before they are compared: only there are rows sorted
    rows = rows.where("seq_idx is not null and seq is not null").repartition("seq_idx").groupBy("seq_idx").agg(F.min(F.struct("seq", "source")).alias("x")).select("seq_idx", "x.seq", "x.source")
    before = stored(spark, f"{out}/sequences", SEQUENCES).where(F.col("batch") < number)
    rows = rows.join(before.select("seq_idx"), "seq_idx", "left_anti").withColumn("seq", seqprep.normalize(F.col("seq")))
    grey = labels.where(F.expr(config["grey"])).select(F.expr(config["id"]).cast("long").alias("seq_idx")).distinct().withColumn("grey", F.lit(True))
    # the batch's own sequences once, with what their fragments have from them; both tables come from them
    shared_dir(spark)
    rows = rows.join(grey, "seq_idx", "left").select("seq_idx", "source", F.coalesce("grey", F.lit(False)).alias("grey"), "seq").checkpoint()
    windows = seqprep.cut_fragments(rows, config["window"], config["shift_percent"], config["min_length"]).withColumn("digest", F.md5("seq"))
    first = windows.groupBy("digest").agg(F.min(F.struct("seq_idx", "start", "key")).alias("own"))
    library = stored(spark, f"{out}/fragments", FRAGMENTS).where(F.col("batch") < number).where("key = first_key").select("digest", F.col("key").alias("known"))
    first = first.join(library, "digest", "left").select("digest", F.coalesce("known", "own.key").alias("first_key"))
    made = windows.join(first, "digest")
    made = made.select("seq_idx", "key", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "strand", "seq", "digest", "first_key", "grey", "source", F.lit(number).cast("long").alias("batch"))
    # large sources are split, small ones gathered
    made.hint("rebalance", "source").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "batch").parquet(f"{out}/fragments")
    written = stored(spark, f"{out}/fragments", FRAGMENTS).where(F.col("batch") == number)
    count = written.groupBy("seq_idx").agg(F.count("*").alias("fragments"))
    of = rows.select("seq_idx", "source").join(seqprep.segment_counts(rows.select("seq_idx", "seq")), "seq_idx", "left").join(count, "seq_idx", "left")
    of = of.select("seq_idx", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("length", "segments", "fragments")], "source", F.lit(number).cast("long").alias("batch"))
    of.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/sequences")
    done = stored(spark, f"{out}/sequences", SEQUENCES).where(F.col("batch") == number).agg(F.count("*").alias("n"), F.coalesce(F.sum("fragments"), F.lit(0)).alias("f")).first()
    log.info("batch %d: wrote %d new sequences, %d fragments", number, done["n"], done["f"])


def followed(path: str) -> str:
    """A pattern that fits the path alone: a stream reads a folder or a pattern, and the path may be one file."""
    head, last = path.rstrip("/")[:-1], path.rstrip("/")[-1]
    return path if any(c in path for c in "*?[{") or not last.isalnum() else f"{head}[{last}]"


def run(spark: SparkSession, documents: str, labels: str, out: str, config: dict) -> DataFrame:
    """Takes what is new at `documents`, waits until it is stored, and returns the whole library of fragments."""
    static = spark.read.parquet(documents)
    stream = spark.readStream.schema(static.schema).parquet(followed(documents))
    of = spark.read.parquet(labels)
    query = stream.writeStream.foreachBatch(lambda batch, number: add(batch, number, of, out, config)).option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    taken = sum(p.numInputRows for p in query.recentProgress)
    log.info("read %d rows that passed through %d batches of %s", taken, sum(p.numInputRows > 0 for p in query.recentProgress), documents)
    return stored(spark, f"{out}/fragments", FRAGMENTS)


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s: %(message)s")
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("documents", "labels", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config", default=str(CONFIG))
    a = p.parse_args()
    spark = session()
    try:
        config = json.loads("\n".join(r[0] for r in spark.read.text(a.config).collect()))
        run(spark, a.documents, a.labels, a.out, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
