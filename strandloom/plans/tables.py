"""The driver's tables as the operators' inputs, in Spark and as SQL of the same content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.operators.vectors import token_counts, token_sets


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts; dealt to all cores where the files are too few or too small to be split that far."""
    t = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cores = spark.sparkContext.defaultParallelism
    return t if len(t.inputFiles()) >= cores else t.repartition(cores)


def doc_features(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(documents(spark, d), "doc_id", "text")


def doc_sets(spark: SparkSession, d: str) -> DataFrame:
    return token_sets(documents(spark, d), "doc_id", "text")


def set_features(features: DataFrame) -> DataFrame:
    """The features as a set, each id's of length one: what min-hash sees is what re-ranking compares."""
    return features.select("id", "f", (1 / F.sqrt(F.count("*").over(Window.partitionBy("id")))).alias("v"))


SET_FEATURES = "sets AS (SELECT id, f, 1 / sqrt(count(*) OVER (PARTITION BY id)) AS v FROM features)"

DOC_FEATURES = """
words AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents),
counts AS (SELECT id, ('0x' || substr(md5(w), 1, 7))::BIGINT + 1 AS f, sum(c) AS c FROM (SELECT id, w, count(*) AS c FROM words GROUP BY id, w) GROUP BY 1, 2),
lengths AS (SELECT id, sqrt(sum(c * c)) AS n FROM counts GROUP BY id),
features AS (SELECT id, f, c / n AS v FROM counts JOIN lengths USING (id))"""


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))


VECTORS = "vectors AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec, label FROM embeddings)"


def hits(spark: SparkSession, d: str) -> DataFrame:
    """Line items as scored intervals: one for each (order, line), on the supplier's axis of days."""
    t = read(spark, d, "lineitem")
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")) + 1
    rows = t.groupBy((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("rid")).agg(
        F.min("l_suppkey").alias("s"), F.min(day).alias("start"), F.min("l_quantity").cast("int").alias("q"), F.min("l_returnflag").alias("flag"), F.min("l_extendedprice").alias("bitscore"), F.min("l_partkey").alias("p")
    )
    rows = rows.select("rid", F.col("s").cast("string").alias("seqid"), "start", (F.col("start") + F.col("q")).alias("stop"), F.when(F.col("flag") == "N", "+").otherwise("-").alias("strand"), "bitscore", F.lit(None).cast("double").alias("evalue"), F.concat(F.lit("1."), (F.col("p") % 20).cast("string")).alias("name"))
    return rows.withColumn("key", F.concat_ws("#", "seqid", F.col("start").cast("string"), F.col("stop").cast("string"), "strand"))


HITS = """
lines AS (SELECT l_orderkey * 8 + l_linenumber AS rid, min(l_suppkey) AS s, min(date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + 1) AS start, min(l_quantity)::INT AS q,
  min(l_returnflag) AS flag, min(l_extendedprice) AS bitscore, min(l_partkey) AS p FROM lineitem GROUP BY 1),
hits AS (SELECT rid, s::VARCHAR AS seqid, start, start + q AS stop, CASE WHEN flag = 'N' THEN '+' ELSE '-' END AS strand, bitscore, '1.' || (p % 20)::VARCHAR AS name,
  s::VARCHAR || '#' || start::VARCHAR || '#' || (start + q)::VARCHAR || '#' || CASE WHEN flag = 'N' THEN '+' ELSE '-' END AS key FROM lines)"""


def overlaps_sql(left: str, right: str, percent: int, strand: bool = True, other: bool = True) -> str:
    """SQL of overlap_join: rows a, b and pct."""
    pct = "(200 * (least(a.stop, b.stop) - greatest(a.start, b.start) + 1) + least(a.stop - a.start + 1, b.stop - b.start + 1)) // (2 * least(a.stop - a.start + 1, b.stop - b.start + 1))"
    more = (" AND a.strand = b.strand" if strand else "") + (" AND a.rid <> b.rid" if other else "")
    return f"SELECT a, b, ({pct})::INT AS pct FROM {left} a JOIN {right} b ON a.seqid = b.seqid AND a.start <= b.stop AND b.start <= a.stop{more} WHERE ({pct}) >= {percent}"


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """Whole document texts as residues: letters a-z by their code modulo 4, anything else N."""
    t = documents(spark, d).select((F.col("doc_id") + 1).cast("int").alias("seq_idx"), F.col("doc_id").cast("string").alias("id"), F.col("source").alias("header"), F.lower("text").alias("t"))
    return t.select("seq_idx", "id", "header", F.translate(F.regexp_replace("t", "[^a-z]", "N"), LETTERS, RESIDUES).alias("seq"))


LETTERS = "abcdefghijklmnopqrstuvwxyz"
RESIDUES = "".join("ACGU"[(ord(c) - 97) % 4] for c in LETTERS)
SEQUENCES = f"sequences AS (SELECT (doc_id + 1)::INT AS seq_idx, doc_id::VARCHAR AS id, translate(regexp_replace(lower(text), '[^a-z]', 'N', 'g'), '{LETTERS}', '{RESIDUES}') AS seq FROM documents)"
