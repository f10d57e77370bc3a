"""Texts in contiguous, sorted ranges of doc_id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.shared import parts


def by_id(docs: DataFrame, lookahead: bool = False) -> DataFrame:
    """bucket, look, doc_id, text: ranges of ascending doc_id, sorted in each partition; rows without doc_id come last.

    Ranges begin at ids that exist, found from the id column alone. With lookahead, the first document of each range is
    also sent to the end of the range before (look = 1), and the very first to the last, so that a task that reads
    its rows in order sees the successor of each of its own.
    """
    n = parts(docs.sparkSession)
    cuts = docs.agg(F.min("doc_id").alias("first"), F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 20_000).alias("at")).first()
    bounds = sorted({cuts["first"], *(cuts["at"] or [])}) if cuts["first"] is not None else []
    held = F.array(*[F.lit(int(b)) for b in bounds]).cast("array<long>")
    doc = F.col("doc_id")
    own = F.when(doc.isNull(), max(len(bounds) - 1, 0)).otherwise(F.size(F.filter(held, lambda b: b <= doc)) - 1).cast("int")
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), own.alias("bucket"))
    if lookahead:
        before = F.when(F.col("bucket") > 0, F.col("bucket") - 1).otherwise(max(len(bounds) - 1, 0))
        is_first = F.coalesce(F.array_contains(held, doc), F.lit(not bounds))
        rows = rows.withColumn("at", F.when(is_first, F.array(F.struct("bucket", F.lit(0).alias("look")), F.struct(before.alias("bucket"), F.lit(1).alias("look")))).otherwise(F.array(F.struct("bucket", F.lit(0).alias("look")))))
        rows = rows.select("doc_id", "text", F.explode("at").alias("at")).select("at.bucket", "at.look", "doc_id", "text")
    else:
        rows = rows.select("bucket", F.lit(0).alias("look"), "doc_id", "text")
    return rows.repartitionByRange(n, "bucket").sortWithinPartitions("bucket", "look", F.col("doc_id").asc_nulls_last(), "text")
