"""Contiguous shards of near equal byte size, from global prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.shared import ranged, running


def shard(docs: DataFrame, shards: int = 16, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of docs in ascending doc_id, cut at equal byte targets into `shards` contiguous shards.

    A document weighs its UTF-8 bytes plus one. Per-range totals give global prefix sums; a document belongs to the
    target interval that holds the middle of its bytes, so a shard misses its target by less than one document.
    Null text weighs 1; rows with a null doc_id come last; repeated rows each get a slot; an empty table gives no rows.
    Columns: doc_id, size, text_crc32, law, shard, slot, and those of `keep`; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.col("doc_id").isNull().alias("_null"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.lit(1).cast("long").alias("_one"), *keep)
    order = ["_null", "doc_id", "size", "text_crc32"]
    dealt = ranged(rows, *order)
    at = running(dealt, [], order, {"_before": "size", "_index": "_one"})
    # the whole's size: one row
    whole = dealt.agg(F.coalesce(F.sum("size"), F.lit(1)).alias("_total"))
    at = at.crossJoin(F.broadcast(whole)).withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"((2 * _before + size) * {shards}) div (2 * _total)")).cast("int"))
    # a row for each shard, whose number is fixed
    first = at.groupBy("shard").agg(F.min("_index").alias("_first"))
    return at.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_index") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *keep
    )
