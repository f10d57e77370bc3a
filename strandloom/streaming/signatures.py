"""An extension: documents that arrive as a stream get signatures, and their bins grow batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators.lsh import minhash_signature
from strandloom.operators.vectors import token_counts


def start(stream: DataFrame, id_: str, text: str, root: str, nhf: int = 16):  # noqa: ANN201
    """A streaming query that appends (id, k, h) of every batch to root/bins, a folder for each batch number.

    A batch that is run again overwrites its own folder, so each id's rows are there once.
    """

    def append(batch: DataFrame, number: int) -> None:
        minhash_signature(token_counts(batch, id_, text), nhf).write.mode("overwrite").parquet(f"{root}/bins/batch={number}")

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start()


def signatures(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/bins").drop("batch")


def event_counts(stream: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """window_start, event_type, n, total of a stream of events, late rows waited for as long as the watermark says."""
    w = stream.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
