"""Algebra of sparse vectors in long form (id, f, v); zeros aren't stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def add(a: DataFrame, b: DataFrame, x: float = 1.0, y: float = 1.0) -> DataFrame:
    """x * a + y * b by id."""
    rows = a.select("id", "f", (F.col("v") * x).alias("v")).unionByName(b.select("id", "f", (F.col("v") * y).alias("v")))
    return rows.groupBy("id", "f").agg(F.sum("v").alias("v")).where("v <> 0")


def scale(a: DataFrame, x: float) -> DataFrame:
    return a.select("id", "f", (F.col("v") * x).alias("v")).where("v <> 0")


def dot(a: DataFrame, b: DataFrame) -> DataFrame:
    """id, dot of the vectors of equal id."""
    return a.join(b.withColumnRenamed("v", "w"), ["id", "f"]).groupBy("id").agg(F.sum(F.col("v").cast("float").cast("double") * F.col("w").cast("float").cast("double")).alias("dot"))


def norms(a: DataFrame) -> DataFrame:
    return a.groupBy("id").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))


def normalised(a: DataFrame) -> DataFrame:
    return a.join(norms(a), "id").select("id", "f", (F.col("v") / F.nullif(F.col("norm"), F.lit(0.0))).alias("v"))


def trim(a: DataFrame, least: float) -> DataFrame:
    """Without entries closer to zero than `least`."""
    return a.where(F.abs("v") >= least)


def set_values(a: DataFrame, new: DataFrame) -> DataFrame:
    """Entries of `new` in the place of those with equal id and f."""
    return a.join(new.select("id", "f"), ["id", "f"], "left_anti").unionByName(new.select("id", "f", "v")).where("v <> 0")


def slice_features(a: DataFrame, low: int, high: int) -> DataFrame:
    return a.where((F.col("f") >= low) & (F.col("f") < high))


def packed(a: DataFrame) -> DataFrame:
    """id, vec: array of (f, v) in order of f."""
    return a.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("f", "v"))).alias("vec"))


def unpacked(a: DataFrame) -> DataFrame:
    return a.select("id", F.explode("vec").alias("x")).select("id", "x.f", "x.v")


def token_sets(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """id, fs: the different features of token_counts, a row for each text that has any; nothing is shuffled."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]+"), 0))
    f = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("long") + 1)
    return docs.select(F.col(id_).alias("id"), f.alias("fs")).where(F.size("fs") > 0)


def token_counts(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """id, f, v: runs of a-z in lower case, f a positive number from the md5 of the word, v the count over the norm."""
    words = docs.select(F.col(id_).alias("id"), F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]+"), 0)).alias("w"))
    f = F.conv(F.substring(F.md5("w"), 1, 7), 16, 10).cast("long") + 1
    counts = words.select("id", f.alias("f")).groupBy("id", "f").agg(F.count("*").alias("c"))
    norm = F.sqrt(F.sum(F.col("c") * F.col("c")).over(Window.partitionBy("id")))
    # dealt by id from here: what is grouped by id afterwards needs no further exchange
    return counts.select("id", "f", (F.col("c") / norm).alias("v"))
