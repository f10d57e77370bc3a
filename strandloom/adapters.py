"""Folding, aligning and scanning tools behind small interfaces: a table of their results is enough.

The built-in folder pairs as many bases as possible and the built-in scanner compares windows by shared k-mers; both
stand in for energy models without claiming to be one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Fold = Callable[[str], list[tuple[str, float]]]
#: Pairs that form.
PAIRS = {"AU", "UA", "GC", "CG", "GU", "UG"}


def max_pairing(seq: str, loop: int = 3) -> list[tuple[str, float]]:
    """One nested structure with most base pairs, hairpins of `loop` free bases at least; the energy is minus the pairs."""
    n = len(seq)
    if not n:
        return [("", 0.0)]
    best = [[0] * n for _ in range(n)]
    for gap in range(loop + 1, n):
        for i in range(n - gap):
            j = i + gap
            top = max(best[i + 1][j], best[i][j - 1])
            if seq[i] + seq[j] in PAIRS:
                top = max(top, best[i + 1][j - 1] + 1)
            for k in range(i + 1, j):
                top = max(top, best[i][k] + best[k + 1][j])
            best[i][j] = top
    out = ["."] * n
    todo = [(0, n - 1)]
    while todo:
        i, j = todo.pop()
        if j - i <= loop or not best[i][j]:
            continue
        if best[i][j] == best[i + 1][j]:
            todo.append((i + 1, j))
        elif best[i][j] == best[i][j - 1]:
            todo.append((i, j - 1))
        elif seq[i] + seq[j] in PAIRS and best[i][j] == best[i + 1][j - 1] + 1:
            out[i], out[j] = "(", ")"
            todo.append((i + 1, j - 1))
        else:
            k = next(k for k in range(i + 1, j) if best[i][j] == best[i][k] + best[k + 1][j])
            todo += [(i, k), (k + 1, j)]
    return [("".join(out), -float(best[0][n - 1]))]


def fold_table(sequences: DataFrame, fold: Fold = max_pairing) -> DataFrame:
    """graph_id, struct, energy by any folding function."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(g, s, e) for g, q in zip(f["graph_id"], f["seq"], strict=True) for s, e in fold(q)], columns=["graph_id", "struct", "energy"])

    return sequences.select("graph_id", "seq").mapInPandas(run, "graph_id long, struct string, energy double")


def structures_of(sequences: DataFrame, given: DataFrame, fold: Fold = max_pairing) -> DataFrame:
    """Structures as given (graph_id, struct) where there are some, else folded; fixed structures always win."""
    fixed = given.select("graph_id", "struct").withColumn("energy", F.lit(None).cast("double"))
    return fixed.unionByName(fold_table(sequences.join(fixed.select("graph_id"), "graph_id", "left_anti"), fold))


def without_structure(sequences: DataFrame, structures: DataFrame) -> DataFrame:
    """graph_id of sequences for which no structure was found; they go on the black list, as a graph of one vertex X."""
    return sequences.select("graph_id").join(structures.select("graph_id"), "graph_id", "left_anti")


def scan(models: DataFrame, windows: DataFrame, k: int = 4, least: float = 20.0) -> DataFrame:
    """name, seqid, start, stop, strand, bitscore: windows (seqid, start, stop, strand, seq) that share k-mers with a model
    (name, seq), scored by 100 times the share of the model's k-mers; `least` and more."""

    def grams(c: str):  # noqa: ANN202
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - k + 1, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(k))))

    m = models.select("name", F.explode(grams("seq")).alias("g")).distinct()
    size = m.groupBy("name").agg(F.count("*").alias("n"))
    w = windows.select("seqid", "start", "stop", "strand", F.explode(grams("seq")).alias("g"))
    hit = w.join(m, "g").groupBy("name", "seqid", "start", "stop", "strand").agg(F.count("*").alias("c"))
    return hit.join(size, "name").select("name", "seqid", "start", "stop", "strand", F.round(100 * F.col("c") / F.col("n"), 2).alias("bitscore"), F.lit(None).cast("double").alias("evalue")).where(F.col("bitscore") >= least)
