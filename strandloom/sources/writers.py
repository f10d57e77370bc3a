"""DataFrames as text lines in the known formats, and folders of tables."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fasta_lines(sequences: DataFrame) -> DataFrame:
    """value: `>id header` and the sequence."""
    return sequences.select(F.concat(F.lit(">"), F.trim(F.concat_ws(" ", "id", "header")), F.lit("\n"), "seq").alias("value"))


def wrapped(text: str, width: int):  # noqa: ANN201
    """A column's text in pieces of `width`, as an array."""
    n = F.greatest(F.ceil(F.length(text) / width), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col(text), i * width + 1, F.lit(width)))


def clustal_lines(alignments: DataFrame, width: int = 120) -> DataFrame:
    """aln_id, block, row, value in the order to be written."""
    pad = F.rpad("name", 20, " ")
    return alignments.select("aln_id", "row", pad.alias("n"), F.posexplode(wrapped("gapped", width)).alias("block", "part")).select("aln_id", "block", "row", F.concat("n", "part").alias("value")).orderBy("aln_id", "block", "row")


def stockholm(alignments: DataFrame, consensus: DataFrame | None = None) -> DataFrame:
    """aln_id, value: a whole file with its consensus structure (aln_id, text)."""
    body = alignments.groupBy("aln_id").agg(F.array_sort(F.collect_list(F.struct("row", F.concat(F.rpad("name", 20, " "), F.col("gapped")).alias("l")))).alias("r"))
    lines = F.array_join(F.transform("r", lambda x: x["l"]), "\n")
    if consensus is None:
        return body.select("aln_id", F.concat(F.lit("# STOCKHOLM 1.0\n\n"), lines, F.lit("\n//\n")).alias("value"))
    return body.join(consensus, "aln_id", "left").select("aln_id", F.concat(F.lit("# STOCKHOLM 1.0\n\n"), lines, F.coalesce(F.concat(F.lit("\n"), F.rpad(F.lit("#=GC SS_cons"), 20, " "), F.col("text")), F.lit("")), F.lit("\n//\n")).alias("value"))


def gspan(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """graph_id, value: one `t` block a graph."""
    v = vertices.groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct("vid", F.concat_ws(" ", F.when(F.col("is_view"), "v").otherwise("V"), F.col("vid").cast("string"), "label").alias("l")))).alias("v"))
    e = edges.groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct("src", "dst", F.concat_ws(" ", F.lit("e"), F.col("src").cast("string"), F.col("dst").cast("string"), "label").alias("l")))).alias("e"))
    text = F.array_join(F.concat(F.transform("v", lambda x: x["l"]), F.coalesce(F.transform("e", lambda x: x["l"]), F.array().cast("array<string>"))), "\n")
    return v.join(e, "graph_id", "left").select("graph_id", F.concat(F.lit("t # "), F.col("graph_id").cast("string"), F.lit("\n"), text).alias("value"))


def export_graph(vertices: DataFrame, edges: DataFrame, form: str) -> DataFrame:
    """graph_id, value in dot, gml, gdl, csv, matrix or gspan; another form is an error."""
    if form == "gspan":
        return gspan(vertices, edges)
    quote = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    s = lambda c: F.col(c).cast("string")
    forms = {
        "dot": (F.concat(s("vid"), F.lit(" [label="), quote("label"), F.lit("]")), F.concat(s("src"), F.lit(" -> "), s("dst"), F.lit(" [label="), quote("label"), F.lit("]")), "digraph G {\n", "\n}"),
        "gml": (F.concat(F.lit("node [ id "), s("vid"), F.lit(" label "), quote("label"), F.lit(" ]")), F.concat(F.lit("edge [ source "), s("src"), F.lit(" target "), s("dst"), F.lit(" label "), quote("label"), F.lit(" ]")), "graph [\n", "\n]"),
        "gdl": (F.concat(F.lit('node: { title: "'), s("vid"), F.lit('" label: '), quote("label"), F.lit(" }")), F.concat(F.lit('edge: { sourcename: "'), s("src"), F.lit('" targetname: "'), s("dst"), F.lit('" label: '), quote("label"), F.lit(" }")), "graph: {\n", "\n}"),
        "csv": (F.concat_ws(",", F.lit("v"), s("vid"), "label"), F.concat_ws(",", F.lit("e"), s("src"), s("dst"), "label"), "", ""),
        "matrix": (F.lit(None).cast("string"), F.concat_ws(" ", s("src"), s("dst"), F.lit("1")), "", ""),
    }
    if form not in forms:
        raise ValueError(f"unknown graph format {form}")
    v, e, top, end = forms[form]
    rows = vertices.select("graph_id", F.lit(0).alias("k"), F.col("vid").alias("a"), F.lit(0).alias("b"), v.alias("l")).union(edges.select("graph_id", F.lit(1), "src", "dst", e))
    lines = rows.where("l is not null").groupBy("graph_id").agg(F.array_sort(F.collect_list(F.struct("k", "a", "b", "l"))).alias("r"))
    return lines.select("graph_id", F.concat(F.lit(top), F.array_join(F.transform("r", lambda x: x["l"]), "\n"), F.lit(end)).alias("value"))


def sparse_lines(features: DataFrame) -> DataFrame:
    """id, value: ` f:v` in order of f, values in scientific notation of seven digits."""
    pairs = F.array_sort(F.collect_list(F.struct("f", "v")))
    return features.groupBy("id").agg(F.array_join(F.transform(pairs, lambda x: F.concat(F.lit(" "), x["f"].cast("string"), F.lit(":"), F.format_string("%.7e", x["v"]))), "").alias("value"))


def sparse_binary(features: DataFrame) -> DataFrame:
    """id, value: the binary record of each vector."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "value": [struct.pack("<i", len(v)) + b"".join(struct.pack("<if", x["f"], x["v"]) for x in v) for v in frame["vec"]]})

    packed = features.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("f", "v"))).alias("vec"))
    return packed.mapInPandas(run, "id long, value binary")


def fragment_outputs(fragments: DataFrame) -> dict[str, DataFrame]:
    """Lines of the fragment files: fasta, names, lens, map (value, key, seqid, ... must be there)."""
    v = F.col("value").cast("string")
    return {
        "fasta": fragments.select(F.concat(F.lit(">"), v, F.lit(" "), "key", F.lit("\n"), "seq").alias("value")),
        "names": fragments.select(F.concat_ws(" ", v, "key").alias("value")),
        "lens": fragments.select(F.concat_ws(" ", v, F.length("seq").cast("string")).alias("value")),
        "map": fragments.select(F.concat_ws(" ", v, "key").alias("value")),
    }


def scan_outputs(sequences: DataFrame, segments: DataFrame, locations: DataFrame) -> dict[str, DataFrame]:
    """Lines of the scan files: SEQn records, locations, segments with their status."""
    name = F.concat(F.lit("SEQ"), F.col("seq_idx").cast("string"))
    return {
        "scan": sequences.select(F.concat(F.lit(">"), name, F.lit(" ORIGID "), "id", F.lit(" ORIGHEAD "), "header", F.lit("\n"), "seq").alias("value")),
        "locations": locations.select(F.concat_ws(" ", name, "location").alias("value")),
        "segments": segments.select(F.concat_ws(" ", F.concat_ws("#", name, F.col("abs_start").cast("string"), F.col("abs_end").cast("string")), "status").alias("value")),
    }


def padded_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """value: columns as text, each as wide as its longest value and two more."""
    widths = df.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in names]).first()
    return df.select(F.rtrim(F.concat(*[F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("")), (widths[c] or 0) + 2, " ") for c in names])).alias("value"))


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Each table as Parquet in root/name; Spark's _SUCCESS marks what is complete."""
    for name, t in tables.items():
        t.write.mode("overwrite").parquet(f"{root}/{name}")


def write_text(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)
