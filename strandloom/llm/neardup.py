"""Groups of near copies: by simhash, and by whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import setjoin, simhash
from strandloom.llm.components import components
from strandloom.llm.shared import cut, salted_join, table
from strandloom.llm.textbuf import slices


def _described(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, text_digest, fp and what setjoin tells of the set of every row; texts are read once for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                texts = [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]
                fp = np.array([simhash.simhash(t) for t in texts], dtype=np.uint64).view(np.int64)
                own = {"doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"), "text_digest": pa.array([xxhash.xxh3_128_hexdigest(t) for t in texts], pa.string()), "fp": pa.array(fp)}
                yield pa.RecordBatch.from_pydict(own | setjoin.told(setjoin.sets(part.column("text"), k)))

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, text_digest string, fp long, digest string, n long, sketch binary, short binary")


def confirmed_near_duplicates(docs: DataFrame, k: int = simhash.SHINGLE, radius: int = simhash.RADIUS, tile: int = simhash.TILE) -> DataFrame:
    """doc_id, digest, root_id, root_digest of every different (doc_id, text): the least member of its group.

    Members are linked if their simhashes differ in `radius` bits at most, or if their k-word shingle sets have a Jaccard
    similarity of 0.8 or more: the chosen-path join finds these, compares whole sets, and leaves out what simhash has
    joined. Two texts under one doc_id are two members. Rows without doc_id take no part, null text is empty, an empty
    table gives no rows.
    """
    texts = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = cut(_described(texts, k).dropDuplicates(["doc_id", "text_digest"]))
    known = setjoin.classes(rows)
    # nodes: sets by their id, groups of fingerprints by negative numbers
    by_fp = rows.select("fp").distinct()
    roots = components(simhash.links(by_fp, radius, tile))
    of_fp = by_fp.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("of"))
    names = cut(of_fp.select("of").distinct().withColumn("v", -1 - F.monotonically_increasing_id()))
    of_fp = salted_join(of_fp, names, "of").select("fp", "v")
    placed = salted_join(rows.select("doc_id", "text_digest", "fp", "digest"), of_fp, "fp")
    placed = cut(salted_join(placed, known.select("digest", F.col("id").alias("u")), "digest", "left").select("doc_id", F.col("text_digest").alias("digest"), "u", "v"))
    # a set and a group of fingerprints that only meet each other need no edge
    pairs = placed.where("u is not null").select("u", "v").distinct()
    of_u, of_v = (pairs.groupBy(c).agg(F.count("*").alias(f"n_{c}")) for c in ("u", "v"))
    given = table(salted_join(salted_join(pairs, of_v, "v"), of_u, "u").where("n_u > 1 or n_v > 1").select("u", "v"), "given")
    every = components(setjoin.links(known, texts, k, given=given))
    node = F.coalesce("u", "v")
    groups = placed.select("doc_id", "digest", node.alias("node")).join(every, "node", "left").select("doc_id", "digest", F.coalesce("root", "node").alias("group"))
    heads = groups.groupBy("group").agg(F.min(F.struct("doc_id", "digest")).alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    headed = salted_join(groups, heads, "group", "left")
    return headed.select("doc_id", "digest", F.coalesce("head.doc_id", "doc_id").alias("root_id"), F.coalesce("head.digest", "digest").alias("root_digest"))
