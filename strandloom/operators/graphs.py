"""Labelled graphs from sequences and structures, and neighbourhood-pair features.

Tables: vertices(graph_id, vid, label, is_kernel, is_view, is_dead, is_abs), edges(graph_id, src, dst, label).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.hashing import MASK, codes, feature_hash

FLAGS = {"is_kernel": True, "is_view": True, "is_dead": False, "is_abs": False}


def with_flags(vertices: DataFrame) -> DataFrame:
    """Missing status columns as a fresh vertex has them."""
    return vertices.withColumns({k: F.lit(v) for k, v in FLAGS.items() if k not in vertices.columns})


def met(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join of two dealt sides. Vertices and edges are exploded from rows of few bytes, so the planner's estimate of
    them is far too low: without the hint it would send whole tables of them through the driver."""
    return left.join(right.hint("merge"), on, how)


def backbone(sequences: DataFrame, lower: bool = False, view_lower: bool = False) -> tuple[DataFrame, DataFrame]:
    """A vertex for each residue (T as U), edges `>` from each to the next. sequences: graph_id, seq.

    lower: labels in lower case (the unstructured copy). view_lower: only lower-case residues are no viewpoints.
    """
    chars = F.filter(F.split("seq", ""), lambda c: c != "")
    v = sequences.select("graph_id", F.posexplode(chars).alias("vid", "r"))
    label = F.translate("r", "Tt", "Uu")
    v = with_flags(v.select("graph_id", "vid", (F.lower(label) if lower else label).alias("label"), (~F.col("r").rlike("[a-z]") if view_lower else F.lit(True)).alias("is_view")))
    n = F.length("seq")
    e = sequences.where(n > 1).select("graph_id", F.explode(F.sequence(F.lit(0), n - 2)).alias("src")).select("graph_id", "src", (F.col("src") + 1).alias("dst"), F.lit(">").alias("label"))
    return v, e


def crop(struct: Column) -> tuple[Column, Column]:
    """First and last place (0-based) of the paired part; the whole if nothing is paired."""
    first = F.instr(struct, "(") - 1
    last = F.length(struct) - F.instr(F.reverse(struct), ")")
    none = first < 0
    return F.when(none, 0).otherwise(first), F.when(none, F.length(struct) - 1).otherwise(last)


def base_pairs(structures: DataFrame) -> DataFrame:
    """graph_id, i, j of matching brackets: brackets of one depth follow one another as open, close. Unbalanced: error."""
    rows = structures.select("graph_id", F.posexplode(F.filter(F.split("struct", ""), lambda c: c != "")).alias("pos", "c")).where(F.col("c").isin("(", ")"))
    w = Window.partitionBy("graph_id").orderBy("pos")
    step = F.when(F.col("c") == "(", 1).otherwise(-1)
    run = F.sum(step).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("depth", run + F.when(F.col("c") == ")", 1).otherwise(0))
    level = Window.partitionBy("graph_id", "depth").orderBy("pos")
    rows = rows.withColumns({"j": F.lead("pos").over(level), "cj": F.lead("c").over(level)})
    bad = (F.col("depth") < 1) | ((F.col("c") == "(") & (F.coalesce("cj", F.lit("(")) != ")"))
    rows = rows.withColumn("pos", F.when(bad, F.raise_error(F.lit("unbalanced structure")).cast("int")).otherwise(F.col("pos")))
    return rows.where("c = '(' or depth < 1").select("graph_id", F.col("pos").alias("i"), "j")


def structure_edges(pairs: DataFrame) -> DataFrame:
    return pairs.select("graph_id", F.col("i").alias("src"), F.col("j").alias("dst"), F.lit("s").alias("label"))


def stacking(pairs: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A vertex P for each pair (i, j) directly inside (i - 1, j + 1), with edges p to the four. sizes: graph_id, n (first free vid)."""
    w = Window.partitionBy("graph_id").orderBy("i")
    outer = pairs.select("graph_id", (F.col("i") + 1).alias("i"), (F.col("j") - 1).alias("j"))
    inner = met(met(pairs, outer, ["graph_id", "i", "j"], "left_semi"), sizes, ["graph_id"]).withColumn("vid", F.col("n") + F.row_number().over(w) - 1)
    v = with_flags(inner.select("graph_id", F.col("vid").cast("int"), F.lit("P").alias("label")))
    ends = F.explode(F.array(F.col("i"), F.col("j"), F.col("i") - 1, F.col("j") + 1)).alias("dst")
    return v, inner.select("graph_id", F.col("vid").cast("int").alias("src"), ends, F.lit("p").alias("label"))


_ABSTRACT = "graph_id long, kind string, vid int, src int, dst int, label string"


def abstract_graph(structures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Loops and stems of a structure as vertices, neighbours joined by `n`; relation vertices tie them to residues.

    Labels AS#S, AS#HL, AS#BL, AS#IL, AS#ML, AS#EL. Each abstract vertex has a relation vertex ^R with an edge ^r to it
    and edges @r to its residues. Abstract and relation vertices are numbered after the residues. One structure is one
    group of rows; structures are short by nature (a window's length).
    """

    def parse(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for gid, s in zip(pdf["graph_id"], pdf["struct"], strict=True):
            partner, stack = {}, []
            for p, c in enumerate(s):
                if c == "(":
                    stack.append(p)
                elif c == ")":
                    if not stack:
                        raise ValueError(f"unbalanced structure in graph {gid}")
                    q = stack.pop()
                    partner[q], partner[p] = p, q
            if stack:
                raise ValueError(f"unbalanced structure in graph {gid}")
            parts: list[tuple[str, list[int]]] = []
            links: list[tuple[int, int]] = []

            def loop(lo: int, hi: int, outer: int | None) -> None:
                """The loop between the closing pair (lo - 1, hi) and its inner pairs."""
                kids, free, p = [], [], lo
                while p < hi:
                    if p in partner:
                        kids.append((p, partner[p]))
                        p = partner[p] + 1
                    else:
                        free.append(p)
                        p += 1
                if outer is None:
                    kind = "EL"
                elif not kids:
                    kind = "HL"
                elif len(kids) > 1:
                    kind = "ML"
                else:
                    kind = "IL" if kids[0][0] > lo and kids[0][1] < hi - 1 else "BL"
                edge = ([] if outer is None else [lo - 1, hi]) + [x for k in kids for x in k]
                own = None
                if outer is not None or free or len(kids) != 1:
                    own = len(parts)
                    parts.append((f"AS#{kind}", sorted(set(free + edge))))
                    if outer is not None:
                        links.append((outer, own))
                for i, j in kids:
                    stem, a, b = [], i, j
                    while partner.get(a) == b and a < b:
                        stem += [a, b]
                        a, b = a + 1, b - 1
                    me = len(parts)
                    parts.append(("AS#S", sorted(stem)))
                    if own is not None:
                        links.append((own, me))
                    loop(a, b + 1, me)

            loop(0, len(s), None)
            n = len(s)
            for k, (label, _) in enumerate(parts):
                out.append((gid, "v", n + k, None, None, label))
            for a, b in links:
                out.append((gid, "e", None, n + a, n + b, "n"))
            for k, (_, residues) in enumerate(parts):
                r = n + len(parts) + k
                out.append((gid, "v", r, None, None, "^R"))
                out.append((gid, "e", None, n + k, r, "^r"))
                out += [(gid, "e", None, r, p, "@r") for p in residues]
        made = pd.DataFrame(out, columns=["graph_id", "kind", "vid", "src", "dst", "label"])
        return made.astype({"vid": "Int32", "src": "Int32", "dst": "Int32"})

    rows = structures.select("graph_id", "struct").mapInPandas(lambda it: (parse(p) for p in it), _ABSTRACT)
    v = with_flags(rows.where("kind = 'v'").select("graph_id", "vid", "label"))
    hat = F.col("label").startswith("^")
    v = v.withColumns({"is_abs": hat, "is_kernel": ~hat})
    return v, rows.where("kind = 'e'").select("graph_id", "src", "dst", "label")


def undirected(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("graph_id", F.col("dst").alias("src"), F.col("src").alias("dst"), "label"))


def directed_copy(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph and a second one with labels r.<label> and all edges turned, numbered behind the first."""
    size = vertices.groupBy("graph_id").agg((F.max("vid") + 1).alias("n"))
    v = met(vertices, size, ["graph_id"]).withColumns({"vid": F.col("vid") + F.col("n"), "label": F.concat(F.lit("r."), "label")}).drop("n")
    e = met(edges, size, ["graph_id"]).select("graph_id", (F.col("dst") + F.col("n")).alias("src"), (F.col("src") + F.col("n")).alias("dst"), "label")
    return vertices.unionByName(v), edges.unionByName(e)


def kill(vertices: DataFrame, labels: list[str]) -> DataFrame:
    return vertices.withColumn("is_dead", F.col("is_dead") | F.col("label").isin(labels))


def alive_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges between vertices that are neither dead nor abstractions."""
    ok = vertices.where("not is_dead and not is_abs").select("graph_id", "vid")
    begun = met(edges, ok.withColumnRenamed("vid", "src"), ["graph_id", "src"], "left_semi")
    return met(begun, ok.withColumnRenamed("vid", "dst"), ["graph_id", "dst"], "left_semi").select("graph_id", "src", "dst", "label")


def check(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that isn't a vertex of their graph; none in a sound graph."""
    v = vertices.select("graph_id", "vid")
    bad_src = met(edges, v.withColumnRenamed("vid", "src"), ["graph_id", "src"], "left_anti").select("graph_id", "src", "dst", "label")
    bad_dst = met(edges, v.withColumnRenamed("vid", "dst"), ["graph_id", "dst"], "left_anti").select("graph_id", "src", "dst", "label")
    return bad_src.union(bad_dst).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("graph_id", F.col("src").alias("vid")).agg(F.count("*").alias("degree"))


def distances(vertices: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """graph_id, src, dst, d of all pairs up to `most` steps apart, by joining the last ring with the edges."""
    seen = vertices.where("is_view and not is_dead and not is_abs").select("graph_id", F.col("vid").alias("src"), F.col("vid").alias("dst"), F.lit(0).alias("d"))
    ring, steps = seen, edges.select("graph_id", F.col("src").alias("dst"), F.col("dst").alias("next")).distinct()
    for d in range(1, most + 1):
        ring = met(ring, steps, ["graph_id", "dst"]).select("graph_id", "src", F.col("next").alias("dst")).distinct()
        ring = met(ring, seen, ["graph_id", "src", "dst"], "left_anti").withColumn("d", F.lit(d))
        seen = seen.unionByName(ring)
    return seen


def sphere(dist: DataFrame, d: int) -> DataFrame:
    return dist.where(F.col("d") == d)


def induced_edges(ball: DataFrame, edges: DataFrame) -> DataFrame:
    """graph_id, root, src, dst, label with both ends in the root's ball (graph_id, root, vid)."""
    a = ball.select("graph_id", "root", F.col("vid").alias("src"))
    b = ball.select("graph_id", "root", F.col("vid").alias("dst"))
    return met(met(edges, a, ["graph_id", "src"]), b, ["graph_id", "root", "dst"]).select("graph_id", "root", "src", "dst", "label")


def shortest_path_union(dist: DataFrame) -> DataFrame:
    """graph_id, src, dst, vid: vertices on any shortest path, where the spheres of both ends meet."""
    x = dist.select("graph_id", "src", F.col("dst").alias("vid"), F.col("d").alias("d1"))
    y = dist.select("graph_id", F.col("src").alias("vid"), "dst", F.col("d").alias("d2"))
    return met(met(x, y, ["graph_id", "vid"]), dist, ["graph_id", "src", "dst"]).where("d1 + d2 = d").select("graph_id", "src", "dst", "vid")


def text_hash(c: Column) -> Column:
    return feature_hash(codes(c))


def plain_texts(vertices: DataFrame, edges: DataFrame, radius: int) -> DataFrame:
    """graph_id, vid, r, plain: what encode_r0 and encode_r1 hash; larger balls have no text."""
    if radius > 1:
        raise ValueError("balls of radius two and more are hashes of hashes, without a text")
    out = vertices.select("graph_id", "vid", F.lit(0).alias("r"), F.col("label").alias("plain"))
    return out.unionByName(_child_texts(vertices, edges)) if radius else out


def encode_r0(vertices: DataFrame) -> DataFrame:
    return vertices.select("graph_id", "vid", F.lit(0).alias("r"), text_hash(F.col("label")).alias("enc"))


def _child_texts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """label : sorted childlabel-edgelabel joined by dots."""
    child = met(edges, vertices.select("graph_id", F.col("vid").alias("dst"), F.col("label").alias("vl")), ["graph_id", "dst"]).select("graph_id", F.col("src").alias("vid"), F.concat_ws("-", "vl", F.col("label")).alias("c"))
    kids = child.groupBy("graph_id", "vid").agg(F.array_join(F.array_sort(F.collect_list("c")), ".").alias("k"))
    text = F.concat(F.col("label"), F.lit(":"), F.coalesce("k", F.lit("")))
    return met(vertices, kids, ["graph_id", "vid"], "left").select("graph_id", "vid", F.lit(1).alias("r"), text.alias("plain"))


def encode_r1(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """The hashes of _child_texts."""
    return _child_texts(vertices, edges).select("graph_id", "vid", "r", text_hash(F.col("plain")).alias("enc"))


def _hash_list(values: list[int]) -> int:
    """feature_hash for pandas groups; tested against the column expression."""
    h = 0xAAAAAAAA
    for i, x in enumerate(values):
        h ^= ((h << 7) ^ x * (h >> 3)) & MASK if i % 2 == 0 else ~(((h << 11) + x) ^ (h >> 5)) & MASK
    return h & 0x7FFFFFFF


# labels and balls recur: a worker hashes them once, up to a limit
@lru_cache(1 << 16)
def _hash_values(values: tuple[int, ...]) -> int:
    return _hash_list(list(values))


@lru_cache(1 << 14)
def _hash_text(s: str) -> int:
    return _hash_list(list(s.encode()))


def encode_rk(vertices: DataFrame, edges: DataFrame, radius: int) -> DataFrame:
    """Encodings of balls of radius two and more: sorted hashes of edges between vertices that are known by their
    distances to all labelled vertices of the ball. A graph is a row with its vertices and edges; graphs are windows, so
    rows are small, and a batch holds many of them."""
    def one(graph: int, vs: list[dict], es: list[dict]) -> Iterator[tuple[int, int, int, int]]:
        label = {x["vid"]: x["label"] for x in vs}
        out = defaultdict(list)
        kind = {}
        for x in es:
            out[x["src"]].append(x["dst"])
            kind[x["src"], x["dst"]] = x["label"]

        def ring(root: int, most: int, inside: set | None = None) -> dict[int, int]:
            found, edge = {root: 0}, [root]
            for d in range(1, most + 1):
                edge = [y for x in edge for y in out[x] if (inside is None or y in inside) and y not in found and not found.update({y: d})]
            return found

        for x in vs:
            root = x["vid"]
            ball = sorted(ring(root, radius))
            inside = set(ball)
            sign = {}
            for i in ball:
                dist = ring(i, 2 * radius, inside)
                sign[i] = _hash_values(tuple(sorted(_hash_text(f"{dist.get(j, -1)}{label[j]}") for j in ball)))
            codes_ = sorted(_hash_values((*sorted((sign[x], sign[y])), _hash_text(kind[x, y]))) for x in ball for y in out[x] if y in inside)
            yield graph, root, radius, _hash_values(tuple(codes_))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [r for g in zip(*[batch.column(c).to_pylist() for c in ("graph_id", "vs", "es")], strict=True) for r in one(g[0], g[1], g[2] or [])]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["graph_id", "vid", "r", "enc"])

    # of edges between two vertices, and of vertices of one number, the order decided: it is fixed here
    v = vertices.groupBy(F.col("graph_id").cast("long").alias("graph_id")).agg(F.array_sort(F.collect_list(F.struct("vid", "label"))).alias("vs"))
    e = edges.groupBy(F.col("graph_id").cast("long").alias("graph_id")).agg(F.array_sort(F.collect_list(F.struct("src", "dst", "label"))).alias("es"))
    return met(v, e, ["graph_id"], "left").select("graph_id", "vs", "es").mapInArrow(run, "graph_id long, vid int, r int, enc long")


def encodings(vertices: DataFrame, edges: DataFrame, radius: int) -> DataFrame:
    """graph_id, vid, r, enc for all radii up to `radius`; the first two stay column expressions."""
    out = encode_r0(vertices)
    if radius >= 1:
        out = out.unionByName(encode_r1(vertices, edges))
    for r in range(2, radius + 1):
        out = out.unionByName(encode_rk(vertices, edges, r))
    return out


def pair_features(vertices: DataFrame, edges: DataFrame, radius: int, distance: int) -> DataFrame:
    """graph_id, rd, selector, n: encodings of vertices at each distance, paired in order, counted by radius and distance."""
    dist = distances(vertices, edges, distance)
    kernel = vertices.where("is_kernel and not is_dead").select("graph_id", "vid")
    enc = met(encodings(vertices, edges, radius), kernel, ["graph_id", "vid"], "left_semi").select("graph_id", "vid", "r", "enc")
    p = met(dist, enc.select("graph_id", F.col("vid").alias("src"), "r", F.col("enc").alias("x")), ["graph_id", "src"])
    p = met(p, enc.select("graph_id", F.col("vid").alias("dst"), "r", F.col("enc").alias("y")), ["graph_id", "dst", "r"])
    key = F.when(F.col("d") == 0, feature_hash(F.array("x"))).otherwise(feature_hash(F.array(F.least("x", "y"), F.greatest("x", "y"))))
    rd = text_hash(F.concat(F.lit("d:"), F.col("d").cast("string"), F.lit(" r:"), F.col("r").cast("string")))
    return p.select("graph_id", rd.alias("rd"), key.alias("selector")).groupBy("graph_id", "rd", "selector").agg(F.count("*").alias("n"))


def feature_map(vertices: DataFrame, edges: DataFrame, radius: int, distance: int) -> DataFrame:
    """f, plain: each feature of vectorise(pair_features(...)) as text, `<d:.. r:..> <one ball> <other ball>`, radius 1 at most.

    Texts are made distinct before they are hashed. Of texts with one hash the least stays.
    """
    kernel = vertices.where("is_kernel and not is_dead").select("graph_id", "vid")
    text = met(plain_texts(vertices, edges, radius), kernel, ["graph_id", "vid"], "left_semi")
    p = met(distances(vertices, edges, distance), text.select("graph_id", F.col("vid").alias("src"), "r", F.col("plain").alias("x")), ["graph_id", "src"])
    p = met(p, text.select("graph_id", F.col("vid").alias("dst"), "r", F.col("plain").alias("y")), ["graph_id", "dst", "r"]).select("d", "r", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    rd = F.concat(F.lit("d:"), F.col("d").cast("string"), F.lit(" r:"), F.col("r").cast("string"))
    p = p.select("d", "x", "y", rd.alias("family"), text_hash(rd).alias("rd"), text_hash(F.col("x")).alias("hx"), text_hash(F.col("y")).alias("hy"))
    key = F.when(F.col("d") == 0, feature_hash(F.array("hx"))).otherwise(feature_hash(F.array(F.least("hx", "hy"), F.greatest("hx", "hy"))))
    p = p.withColumn("selector", key)
    zero = F.lit(0).cast("long")
    f = feature_hash(F.array(F.col("rd"), F.col("selector"), zero, zero, zero))
    return p.select(f.alias("f"), F.concat(F.lit("<"), "family", F.lit("> <"), "x", F.lit("> <"), "y", F.lit(">")).alias("plain")).groupBy("f").agg(F.min("plain").alias("plain"))


def soft_features(vertices: DataFrame, edges: DataFrame, radius: int) -> DataFrame:
    """graph_id, rd, selector, predicate, n: the root's label selects; labels of the ball's vertices are counted."""
    dist = distances(vertices, edges, radius)
    root = vertices.select("graph_id", F.col("vid").alias("src"), text_hash(F.col("label")).alias("selector"))
    ball = vertices.select("graph_id", F.col("vid").alias("dst"), text_hash(F.col("label")).alias("predicate"))
    rd = text_hash(F.concat(F.lit("d:0 r:"), F.col("d").cast("string")))
    return met(met(dist, root, ["graph_id", "src"]), ball, ["graph_id", "dst"]).select("graph_id", rd.alias("rd"), "selector", "predicate").groupBy("graph_id", "rd", "selector", "predicate").agg(F.count("*").alias("n"))


def vectorise(features: DataFrame, normalise: bool = True) -> DataFrame:
    """id, f, v: each (radius, distance) family weighs the same, each selector in it too; equal hashes overwrite (largest stays).

    features: graph_id, rd, selector [, predicate], n.
    """
    soft = "predicate" in features.columns
    pred = F.col("predicate") if soft else F.lit(0).cast("long")
    # dealt once, by graph: families, selectors and predicates are counted where they begin in the order
    rows = features.withColumn("predicate", pred).repartition("graph_id")
    g = Window.partitionBy("graph_id")
    fam = Window.partitionBy("graph_id", "rd")
    sel = Window.partitionBy("graph_id", "rd", "selector")
    first = {"_sel": F.row_number().over(sel.orderBy("predicate")) == 1, "_rd": F.row_number().over(fam.orderBy("selector", "predicate")) == 1}
    rows = rows.withColumns(first).withColumns({"n_rd": F.sum(F.col("_rd").cast("long")).over(g), "n_sel": F.sum(F.col("_sel").cast("long")).over(fam), "n_pred": F.count("*").over(sel)})
    norm = F.sqrt(F.col("n_rd") * F.col("n_sel") * F.col("n_pred") * F.col("n") * F.col("n")) if normalise else F.lit(1.0)
    f = feature_hash(F.array("rd", "selector", "predicate", F.lit(0).cast("long"), F.lit(0).cast("long")))
    return rows.select(F.col("graph_id").alias("id"), f.alias("f"), F.round(F.col("n") / norm, 9).alias("v")).groupBy("id", "f").agg(F.max("v").alias("v"))


def min_kernel(features: DataFrame) -> DataFrame:
    """id, f, v: a feature of value 1 for each of a selector's n occurrences."""
    z = F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("z")
    rows = features.select("graph_id", "rd", "selector", z)
    f = feature_hash(F.array("rd", "selector", F.lit(0).cast("long"), F.lit(0).cast("long"), F.col("z").cast("long")))
    return rows.select(F.col("graph_id").alias("id"), f.alias("f")).distinct().withColumn("v", F.lit(1.0))


def graph_vectors(vertices: DataFrame, edges: DataFrame, radius: int = 2, distance: int = 4) -> DataFrame:
    """id, f, v of labelled graphs by neighbourhood-subgraph pairs."""
    v = with_flags(vertices)
    return vectorise(pair_features(v, alive_edges(v, undirected(edges)), radius, distance))


def abstraction_features(vertices: DataFrame, edges: DataFrame, radius: int = 1, distance: int = 2) -> DataFrame:
    """graph_id, f, v: products of the features around both sides of each relation vertex, summed over the relations."""
    v, both = with_flags(vertices), undirected(edges)
    rel = v.where("is_abs").select("graph_id", F.col("vid").alias("rel"))
    whole = encodings(v, alive_edges(v, both), radius).select("graph_id", "vid", "r", "enc")
    upper = edges.where("label = '^r'").select("graph_id", F.col("src").alias("vid"), F.col("dst").alias("rel"))
    lower = edges.where("label = '@r'").select("graph_id", F.col("src").alias("rel"), F.col("dst").alias("vid"))
    a = met(upper, whole, ["graph_id", "vid"]).groupBy("graph_id", "rel", F.col("enc").alias("x")).agg(F.count("*").alias("nx"))
    p = met(lower, whole, ["graph_id", "vid"]).groupBy("graph_id", "rel", F.col("enc").alias("y")).agg(F.count("*").alias("ny"))
    made = met(met(rel, a, ["graph_id", "rel"]), p, ["graph_id", "rel"]).select("graph_id", feature_hash(F.array("x", "y")).alias("f"), (F.col("nx") * F.col("ny")).cast("double").alias("v"))
    return made.groupBy("graph_id", "f").agg(F.sum("v").alias("v"))
