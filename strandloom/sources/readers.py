"""Text formats as DataFrames.

Record formats (FASTA, gspan) are split by Spark's line separator, so a large file is read by many tasks. Formats
whose lines depend on those before are small by nature and read a file at a time, lines numbered.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, no, line."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("no", "line"))


def read_fasta(spark: SparkSession, path: str, make_unique: bool = False, keep_repeats: bool = False) -> DataFrame:
    """at, id, header, seq, meta: sequences of several lines; lines `text #TAG` become meta[TAG], joined in order.

    `at` orders the records. An id that comes twice with another sequence is an error, unless make_unique adds _n to
    repeats or keep_repeats lets all stand; with an equal sequence the first one stays.
    """
    raw = spark.read.text(path, lineSep="\n>").withColumn("at", F.monotonically_increasing_id())
    lines = F.split(F.regexp_replace(F.regexp_replace("value", "^>", ""), "\n+$", ""), "\r?\n")
    rows = raw.where(F.trim(F.regexp_replace("value", "^>", "")) != "").select("at", lines.alias("l"))
    tag = r"^(.*?)\s*#(\S+)\s*$"
    body = F.slice("l", F.lit(2), F.size("l"))
    seq = F.regexp_replace(F.array_join(F.filter(body, lambda x: ~x.rlike(tag)), ""), r"\s", "")
    tags = F.transform(F.filter(body, lambda x: x.rlike(tag)), lambda x: F.struct(F.regexp_extract(x, tag, 2).alias("k"), F.regexp_extract(x, tag, 1).alias("v")))
    keys = F.array_distinct(F.transform(tags, lambda t: t["k"]))
    meta = F.map_from_arrays(keys, F.transform(keys, lambda k: F.array_join(F.transform(F.filter(tags, lambda t: t["k"] == k), lambda t: t["v"]), "")))
    head = F.col("l")[0]
    rows = rows.select("at", F.regexp_extract(head, r"^ ?(\S*)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^ ?\S*", "")).alias("header"), seq.alias("seq"), meta.alias("meta"))
    if keep_repeats:
        return rows
    w = Window.partitionBy("id").orderBy("at")
    n = F.row_number().over(w)
    if make_unique:
        return rows.withColumn("n", n).withColumn("id", F.when(F.col("n") > 1, F.concat_ws("_", "id", (F.col("n") - 1).cast("string"))).otherwise(F.col("id"))).drop("n")
    every = Window.partitionBy("id")
    rows = rows.withColumns({"n": n, "first": F.min("seq").over(every), "last": F.max("seq").over(every)})
    clash = F.when(F.col("first") == F.col("last"), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("different sequences under id "), F.col("id"))))
    return rows.withColumn("id", clash).where("n = 1").drop("n", "first", "last")


def read_vienna(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, mfe, mea: the first bracket line of a record is the least-energy structure, one that says MEA the other."""
    fold = r"^\s*([().]+)(\s|$)"
    raw = spark.read.text(path, lineSep="\n>")
    lines = F.filter(F.split(F.regexp_replace("value", "^>", ""), "\r?\n"), lambda x: F.trim(x) != "")
    rows = raw.select(lines.alias("l")).where(F.size("l") > 0)
    body = F.slice("l", F.lit(2), F.size("l"))
    folds = F.filter(body, lambda x: x.rlike(fold))
    plain, mea = F.filter(folds, lambda x: ~x.contains("MEA")), F.filter(folds, lambda x: x.contains("MEA"))
    pick = lambda a: F.regexp_extract(F.get(a, F.lit(0)), fold, 1)
    return rows.select(F.regexp_extract(F.col("l")[0], r"^ ?(\S*)", 1).alias("id"), F.array_join(F.filter(body, lambda x: x.rlike(r"^[A-Za-z]+$")), "").alias("seq"), pick(plain).alias("mfe"), pick(mea).alias("mea"))


def read_gspan(spark: SparkSession, path: str, kind: str = "UNDIRECTED") -> tuple[DataFrame, DataFrame]:
    """vertices and edges of `t` blocks; graph_id orders them. V vertices are no viewpoints; w, s, u lines are passed over.

    Labels that begin with ^ are abstractions and no kernel points; edges with ^ are abstraction-of, with @ part-of.
    UNDIRECTED adds every edge's reverse, DIRECTED a reversed copy of the graph. A missing label is empty. An edge to an unknown vertex is an error.
    """
    from strandloom.operators.graphs import directed_copy, undirected

    raw = spark.read.text(path, lineSep="\nt ").withColumn("graph_id", F.monotonically_increasing_id())
    rows = raw.where(F.trim("value") != "").select("graph_id", F.posexplode(F.split("value", "\r?\n")).alias("no", "line")).where("no > 0").select("graph_id", "no", F.split(F.trim("line"), r"\s+").alias("p"))
    v = rows.where("p[0] in ('v', 'V')").select("graph_id", F.col("p")[1].alias("name"), F.coalesce(F.get("p", F.lit(2)), F.lit("")).alias("label"), (F.col("p")[0] == "v").alias("is_view"), (F.row_number().over(Window.partitionBy("graph_id").orderBy("no")) - 1).alias("vid"))
    hat = F.col("label").startswith("^")
    names = v.select("graph_id", "name", "vid")
    e = rows.where("p[0] = 'e'").select("graph_id", F.col("p")[1].alias("a"), F.col("p")[2].alias("b"), F.coalesce(F.get("p", F.lit(3)), F.lit("")).alias("label"))
    e = e.join(names.select("graph_id", F.col("name").alias("a"), F.col("vid").alias("src")), ["graph_id", "a"], "left").join(names.select("graph_id", F.col("name").alias("b"), F.col("vid").alias("dst")), ["graph_id", "b"], "left")
    missing = F.raise_error(F.concat(F.lit("edge to an unknown vertex: "), "a", F.lit(" "), "b"))
    e = e.withColumn("src", F.when(F.col("src").isNull() | F.col("dst").isNull(), missing.cast("int")).otherwise(F.col("src")))
    v = v.select("graph_id", "vid", "label", (~hat).alias("is_kernel"), "is_view", F.lit(False).alias("is_dead"), hat.alias("is_abs"))
    e = e.select("graph_id", "src", "dst", "label")
    if kind == "UNDIRECTED":
        return v, undirected(e)
    return directed_copy(v, e) if kind == "DIRECTED" else (v, e)


def edge_flags(edges: DataFrame) -> DataFrame:
    return edges.withColumns({"is_absof": F.col("label").startswith("^"), "is_partof": F.col("label").startswith("@")})


def read_sparse_text(spark: SparkSession, path: str) -> DataFrame:
    """id (from 0, empty lines don't count), f, v from lines of feature:value.

    Files are read in splits. A line's number is its place in its split after the lines of the file's earlier splits.
    """
    rows = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.regexp_replace("value", "\r$", "").alias("line"))
    rows = rows.where(F.trim("line") != "")
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("file", "start").agg(F.count("*").alias("n")).select("file", "start", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    at = Window.partitionBy("file", "start").orderBy("no")
    placed = rows.withColumn("no", F.monotonically_increasing_id()).withColumn("no", F.row_number().over(at) - 1)
    rows = placed.join(before, ["file", "start"]).select((F.col("before") + F.col("no")).alias("id"), F.explode(F.split(F.trim("line"), r"\s+")).alias("x"))
    return rows.select("id", F.split("x", ":")[0].cast("long").alias("f"), F.split("x", ":")[1].cast("double").alias("v"))


def read_sparse_binary(spark: SparkSession, path: str) -> DataFrame:
    """id, f, v from records of a number of pairs and that many int32 feature, float32 value; empty ones don't count."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for raw in frame["content"]:
                at, k, out = 0, 0, []
                while at + 4 <= len(raw):
                    (n,) = struct.unpack_from("<i", raw, at)
                    at += 4
                    out += [(k, *struct.unpack_from("<if", raw, at + 8 * i)) for i in range(n)]
                    at, k = at + 8 * n, k + (n > 0)
                yield pd.DataFrame(out, columns=["id", "f", "v"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "id long, f long, v double")


def list_filter(rows: DataFrame, white: DataFrame | None = None, black: DataFrame | None = None) -> DataFrame:
    """Rows whose id is on the white list and off the black one; the black list wins."""
    if white is not None:
        rows = rows.join(white.select("id"), "id", "left_semi")
    if black is not None:
        rows = rows.join(black.select("id"), "id", "left_anti")
    return rows


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """value, key, seqid, start, stop, strand from lines VALUE KEY."""
    from strandloom.operators.intervals import parse_keys

    p = F.split(F.trim("value"), r"\s+")
    return parse_keys(spark.read.text(path).where(F.trim("value") != "").select(p[0].cast("long").alias("value"), p[1].alias("key")))


def read_table(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """White-space separated columns as strings."""
    p = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_partition(spark: SparkSession, path: str) -> DataFrame:
    """The first six columns of a partition, typed; `-` is no E-value."""
    t = read_table(spark, path, ["key", "bitscore", "evalue", "merged", "name", "idx"])
    return t.select("key", F.col("bitscore").cast("double"), F.nullif("evalue", F.lit("-")).cast("double").alias("evalue"), "merged", "name", F.col("idx").cast("int"))


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """name, seqid, start, stop, strand, bitscore, evalue, key from nine-column model hits.

    Lines with # are comments; a start behind the stop means the minus strand. A file whose last line isn't a comment
    was cut off, and none of it counts.
    """
    lines = numbered_lines(spark, path).where(F.trim("line") != "")
    whole = lines.groupBy("file").agg(F.max_by("line", "no").alias("last")).where(F.col("last").startswith("#")).select("file")
    p = F.split(F.trim("line"), r"\s+")
    a, b = p[2].cast("int"), p[3].cast("int")
    rows = lines.join(whole, "file", "left_semi").where(~F.col("line").startswith("#")).select(p[0].alias("name"), p[1].alias("seqid"), F.least(a, b).alias("start"), F.greatest(a, b).alias("stop"), F.when(a > b, "-").otherwise("+").alias("strand"), p[6].cast("double").alias("bitscore"), F.nullif(p[7], F.lit("-")).cast("double").alias("evalue"))
    return rows.withColumn("key", F.concat_ws("#", "seqid", "start", "stop", "strand"))


def _blocks(lines: DataFrame, gaps: bool) -> DataFrame:
    p = F.split(F.trim("line"), r"\s+")
    rows = lines.select("file", "no", p[0].alias("name"), p[1].alias("part"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "part"))), lambda x: x["part"]), "")
    out = rows.groupBy("file", "name").agg(text.alias("gapped"), F.min("no").alias("no"))
    if gaps:
        out = out.withColumn("gapped", F.translate("gapped", "._~", "---"))
    return out.select(F.col("file").alias("aln_id"), (F.row_number().over(Window.partitionBy("file").orderBy("no")) - 1).alias("row"), "name", "gapped")


def read_clustal(spark: SparkSession, path: str, unify_gaps: bool = False) -> DataFrame:
    """aln_id, row, name, gapped: blocks of the same name one after another."""
    lines = numbered_lines(spark, path).where(F.col("line").rlike(r"^\S+\s+\S+") & ~F.col("line").rlike(r"^(CLUSTAL|#)"))
    return _blocks(lines, unify_gaps)


def read_stockholm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows (aln_id, row, name, gapped) and tags (aln_id, tag, text): #=GC and #=GR are joined, other #= tags by newlines. Ends at //."""
    lines = numbered_lines(spark, path)
    stop = lines.where(F.col("line").startswith("//")).groupBy("file").agg(F.min("no").alias("stop"))
    lines = lines.join(stop, "file", "left").where("stop is null or no < stop").drop("stop")
    rows = _blocks(lines.where(F.col("line").rlike(r"^[^#\s]\S*\s+\S+")), False)
    kind = F.regexp_extract("line", r"^#=(GC|GR\s+\S+|G\S)\s+(\S+)\s+(.*)$", 1)
    t = lines.where(F.col("line").rlike("^#=")).select("file", "no", kind.alias("kind"), F.regexp_extract("line", r"^#=(GC|GR\s+\S+|G\S)\s+(\S+)\s+(.*)$", 2).alias("name"), F.regexp_extract("line", r"^#=(GC|GR\s+\S+|G\S)\s+(\S+)\s+(.*)$", 3).alias("text"))
    t = t.groupBy("file", "kind", "name").agg(F.array_sort(F.collect_list(F.struct("no", "text"))).alias("l"))
    parts = F.transform("l", lambda x: x["text"])
    return rows, t.select(F.col("file").alias("aln_id"), F.concat_ws(" ", "kind", "name").alias("tag"), F.when(F.col("kind").rlike("^G[CR]"), F.array_join(parts, "")).otherwise(F.array_join(parts, "\n")).alias("text"))


def read_maf(spark: SparkSession, path: str) -> DataFrame:
    """aln_id, row, name, gapped from `s` lines of the multiple-alignment format."""
    p = F.split(F.trim("line"), r"\s+")
    lines = numbered_lines(spark, path).where(F.col("line").rlike(r"^s\s")).select("file", "no", F.concat_ws(" ", p[1], p[6]).alias("line"))
    return _blocks(lines, False)


def read_pair_archive(spark: SparkSession, path: str) -> DataFrame:
    """no, score, iid, jid, iseq, jseq, start_col, end_col of records `@no Score: n` with alternating lines; bz2 is fine.

    Columns between the outer ~ of either row count as aligned.
    """
    lines = numbered_lines(spark, path)
    head = r"^@(\d+) Score: (-?\d+)"
    is_head = F.col("line").rlike(head)
    rec = F.sum(is_head.cast("int")).over(Window.partitionBy("file").orderBy("no"))
    rows = lines.withColumn("rec", rec).where("rec > 0")
    tops = rows.where(is_head).select("file", "rec", F.regexp_extract("line", head, 1).cast("int").alias("no_"), F.regexp_extract("line", head, 2).cast("int").alias("score"))
    p = F.split(F.trim("line"), r"\s+")
    body = rows.where(F.col("line").rlike(r"^\d+\s+\S+")).withColumn("k", F.row_number().over(Window.partitionBy("file", "rec").orderBy("no")) - 1).select("file", "rec", "k", p[0].cast("long").alias("id"), p[1].alias("s"))
    side = body.groupBy("file", "rec", (F.col("k") % 2).alias("side")).agg(F.min_by("id", "k").alias("id"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "s"))), lambda x: x["s"]), "").alias("s"))
    i = side.where("side = 0").select("file", "rec", F.col("id").alias("iid"), F.col("s").alias("iseq"))
    j = side.where("side = 1").select("file", "rec", F.col("id").alias("jid"), F.col("s").alias("jseq"))
    lead = F.greatest(F.length(F.regexp_extract("iseq", "^(~*)", 1)), F.length(F.regexp_extract("jseq", "^(~*)", 1)))
    trail = F.greatest(F.length(F.regexp_extract("iseq", "(~*)$", 1)), F.length(F.regexp_extract("jseq", "(~*)$", 1)))
    return tops.join(i, ["file", "rec"]).join(j, ["file", "rec"]).select(F.col("no_").alias("no"), "score", "iid", "jid", "iseq", "jseq", (lead + 1).alias("start_col"), (F.length("iseq") - trail).alias("end_col"))


def read_local_hits(spark: SparkSession, path: str) -> DataFrame:
    """score, istart, jstart, istop, jstop of lines HIT score s s e e."""
    p = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.col("value").rlike(r"^\s*HIT\s")).select(p[1].cast("int").alias("score"), p[2].cast("int").alias("istart"), p[3].cast("int").alias("jstart"), p[4].cast("int").alias("istop"), p[5].cast("int").alias("jstop"))


def parse_newick(text: str) -> list[tuple[int, int | None, str, float | None]]:
    """(node, parent, name, length) in preorder; commas and brackets structure, the rest is names and lengths."""
    nodes: list[list] = []
    stack: list[int] = []
    now = None
    label = ""

    def add() -> int:
        nodes.append([len(nodes), stack[-1] if stack else None, "", None])
        return len(nodes) - 1

    def close(k: int | None, label: str) -> None:
        if k is None:
            return
        name, _, size = label.strip().partition(":")
        nodes[k][2], nodes[k][3] = name, float(size) if size else None

    for c in text.strip().rstrip(";") + ";":
        if c == "(":
            stack.append(add())
            now = None
        elif c in ",);":
            if now is None and (label.strip() or not nodes):
                now = add()
            close(now, label)
            now, label = None, ""
            if c == ")":
                now = stack.pop()
        else:
            if now is None:
                now = add()
            label += c
    if stack:
        raise ValueError("brackets of the tree don't match")
    return [tuple(n) for n in nodes]


def read_newick(spark: SparkSession, path: str) -> DataFrame:
    """tree_id, node, parent, name, length; one tree in a file."""
    trees = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("tree_id"), "value")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for t, text in zip(frame["tree_id"], frame["value"], strict=True):
                rows = pd.DataFrame(parse_newick(text), columns=["node", "parent", "name", "length"]).astype({"parent": "Int32"})
                rows.insert(0, "tree_id", t)
                yield rows

    return trees.mapInPandas(run, "tree_id string, node int, parent int, name string, length double")


def read_subset(spark: SparkSession, path: str, center: int, k: int = -1) -> DataFrame:
    """rank, id of the center-th line (from 1) of a file of id lists, the first k (-1: all)."""
    rows = numbered_lines(spark, path).where(F.col("no") == center - 1).select(F.posexplode(F.split(F.trim("line"), r"\s+")).alias("p", "x")).select((F.col("p") + 1).alias("rank"), F.col("x").cast("long").alias("id"))
    return rows if k < 0 else rows.where(F.col("rank") <= k)


def read_class_info(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fragments' classes (id, class, key), signals (class, key) and sizes (n, class, frags, uniq, name) of a folder."""
    frags = read_table(spark, f"{root}/class.hash", ["id", "class", "key"]).withColumns({"id": F.col("id").cast("long"), "class": F.col("class").cast("int")})
    scan = read_table(spark, f"{root}/class.hash.scan", ["class", "key"]).withColumn("class", F.col("class").cast("int"))
    sizes = read_table(spark, f"{root}/class.size", ["n", "class", "frags", "uniq", "name"]).withColumns({c: F.col(c).cast("int") for c in ("n", "class", "frags", "uniq")})
    return frags, scan, sizes


def read_times(spark: SparkSession, path: str) -> DataFrame:
    """file, start, stop, seconds of master time files: date, epoch, date, epoch on four lines."""
    rows = numbered_lines(spark, path).where(F.trim("line") != "")
    at = F.row_number().over(Window.partitionBy("file").orderBy("no"))
    rows = rows.withColumn("k", at).where("k in (2, 4)")
    both = rows.groupBy("file").agg(F.max(F.when(F.col("k") == 2, F.col("line").cast("long"))).alias("start"), F.max(F.when(F.col("k") == 4, F.col("line").cast("long"))).alias("stop"))
    return both.withColumn("seconds", F.col("stop") - F.col("start"))


def read_shapes(spark: SparkSession, path: str, most: int = 0, drop_unshaped: bool = False) -> DataFrame:
    """file, win, win_start, win_end, seq, rank, struct, energy, prob, shapeprob, shape from folding output.

    A line of two numbers opens a window, the next word is its sequence; the first `most` structures stay (0: all).
    drop_unshaped leaves out shape `_`, for use beside a sequence graph. `not found` empties a window.
    """
    rows = numbered_lines(spark, path).where("no > 0")
    opens = F.col("line").rlike(r"^\d+\s+\d+$")
    w = Window.partitionBy("file").orderBy("no")
    rows = rows.withColumn("win", F.sum(opens.cast("int")).over(w)).where("win > 0")
    p = F.split("line", r"\s+")
    info = rows.groupBy("file", "win").agg(F.max(F.when(opens, p[0].cast("int"))).alias("win_start"), F.max(F.when(opens, p[1].cast("int"))).alias("win_end"), F.max(F.when(F.col("line").rlike(r"^[A-Za-z]+$"), F.upper("line"))).alias("seq"), F.max(F.when(F.col("line").rlike(r"^Shape .* not found"), F.col("no"))).alias("void"))
    form = r"^([().]+)\s+\((\S+?)\)\s+(?:\((\S+?)\)\s+)?(?:([0-9.eE+-]+)\s+)?(\S+)$"
    got = lambda i: F.nullif(F.regexp_extract("line", form, i), F.lit(""))
    s = rows.where(F.col("line").rlike(form)).select("file", "win", "no", got(1).alias("struct"), got(2).cast("double").alias("energy"), got(3).cast("double").alias("prob"), got(4).cast("double").alias("shapeprob"), got(5).alias("shape"))
    s = s.join(info, ["file", "win"]).where("void is null or no > void").withColumn("rank", F.row_number().over(Window.partitionBy("file", "win").orderBy("no")))
    if most:
        s = s.where(F.col("rank") <= most)
    if drop_unshaped:
        s = s.where("shape <> '_'")
    return s.select("file", "win", "win_start", "win_end", "seq", "rank", "struct", "energy", "prob", "shapeprob", "shape")


def read_int_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "").select(F.trim("value").cast("long").alias("id"))


def read_string_list(spark: SparkSession, path: str) -> DataFrame:
    """id (from 0), label of all words in order."""
    rows = numbered_lines(spark, path).select("no", F.posexplode(F.split(F.trim("line"), r"\s+")).alias("k", "label")).where("label <> ''")
    return rows.select((F.row_number().over(Window.orderBy("no", "k")) - 1).cast("long").alias("id"), "label")


def reimport(header: Column) -> tuple[Column, Column]:
    """ORIGID and ORIGHEAD of headers that our own output has written, else empty."""
    return F.regexp_extract(header, r"ORIGID (\S+)", 1), F.regexp_extract(header, r"ORIGHEAD (.*)$", 1)
