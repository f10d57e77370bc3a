"""A corpus from raw documents: quality, near copies, benchmark passages, source mix, shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.llm import decontaminate, mixing, neardup, quality, sharding, simhash
from strandloom.llm.shared import cut, read, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model, learnt from all labels, scores 0.5 or more.

    Null and empty texts have the labelled wordless documents' rate (0.5 without any, so they stay). Repeated rows and
    rows without doc_id are each judged; extra columns go; without labels everything stays; an empty table gives no rows.
    """
    source = read(spark, sf_dir, "documents")
    model = quality.learn(source, read(spark, sf_dir, "labels"), F.lit(True))
    return quality.keep_good(docs, model)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id, then digest; one row of those with equal id and text.

    Near copies are within the radius of op5, or have five-word shingle sets of Jaccard similarity 0.8 or more. Rows
    are told apart by doc_id and text, so two texts under one doc_id are judged by themselves. Rows without doc_id all
    stay, as nothing tells them apart. Null text is empty; extra columns go; an empty table gives no rows.
    """
    found = neardup.confirmed_near_duplicates(docs)
    lost = cut(found.where("doc_id <> root_id or digest <> root_digest").select(F.col("doc_id").alias("_lost"), F.col("digest").alias("_text")))
    rows = simhash.digested(docs.where("doc_id is not null").select(*COLUMNS))
    kept = rows.join(lost, (F.col("doc_id") == F.col("_lost")) & (F.col("digest") == F.col("_text")), "left_anti")
    same = Window.partitionBy("doc_id", "digest").orderBy("source", "lang", "n_chars")
    single = kept.withColumn("_n", F.row_number().over(same)).where("_n = 1").select(*COLUMNS)
    return single.union(docs.where("doc_id is null").select(*COLUMNS))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those mostly made of such passages go.

    Null texts stay null, empty ones empty. Repeated rows and rows without doc_id are each treated; extra columns go;
    without benchmark items everything stays as it is; an empty table gives no rows.
    """
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def attach(rows: DataFrame, docs: DataFrame, key: dict[str, Column]) -> DataFrame:
    """rows, which have no texts, with the columns of the documents they were made from.

    Both sides are matched by doc_id and `key`, values made of the row, and by their number among equal ones. So texts
    move once, whatever the operator does with the slim rows.
    """
    names = ["doc_id", *key]
    left = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*names).orderBy(*[c for c in rows.columns if c not in names])))
    right = docs.select(*COLUMNS).withColumns(key)
    right = right.withColumn("_n", F.row_number().over(Window.partitionBy(*names).orderBy("lang", "source", "n_chars")))
    left = left.select(*[F.col(c).alias(f"_own_{c}") for c in left.columns])
    fresh = [c for c in rows.columns if c not in names and c not in COLUMNS]
    met = left.join(right, F.expr(" and ".join(f"_own_{c} <=> {c}" for c in [*names, "_n"])))
    return met.select(*COLUMNS, *[c for c in key if c not in COLUMNS], *[F.col(f"_own_{c}").alias(c) for c in fresh])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a row for each time it takes them (twice at most).

    Documents without words weigh nothing and are never taken. A null source is a source of its own. Repeated rows count
    each; rows without doc_id are matched by their source and text; extra columns go; an empty table gives no rows.
    """
    taken = mixing.mix(docs).select("doc_id", "source", "text_hash", "copies").where("copies > 0")
    rows = attach(taken, docs, {"source": F.col("source"), "text_hash": F.xxhash64("text")})
    return rows.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select(*COLUMNS)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot.

    Null text weighs one byte. Rows without doc_id come last; repeated rows each have a slot; extra columns go; an empty
    table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return attach(sharding.shard(docs), docs, {"size": F.octet_length(text).cast("long") + 1, "text_crc32": F.crc32(text)}).drop("grown_shard")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL has no conditional random field, automaton or reachability over bit distances; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = table(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
