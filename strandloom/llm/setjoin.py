"""Near copies by the similarity of whole shingle sets: a chosen-path join of min-wise tokens, confirmed exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textbuf as tb
from strandloom.llm.components import components
from strandloom.llm.shared import cut, few, parts, salted_join, table
from strandloom.llm.simhash import word_shingles
from strandloom.llm.textbuf import slices

U = tb.U
#: Min-wise tokens of a set, of 16 bits each to branch by and four to compare, and how many of the latter a pair of at
#: least 0.8 has in common, but for a few in a million.
TOKENS, COMMON = 64, 36
#: Independent trees, and levels after which what is left of a node is compared in blocks.
TREES, DEPTH = 12, 8
#: Members and shingles of a node that is compared exhaustively.
MEMBERS, WEIGHT = 384, 1 << 21
#: A node branches by one token, and one in so many by two: as many ways on the average as 1 / 0.8.
FORK = 4
_FACTORS = tb.mix(np.arange(1, TOKENS + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
_SET = "digest string, n long, sketch binary, short binary"


def sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted different shingle hashes of each text."""
    h, counts = word_shingles(texts, k)
    return [np.unique(x) for x in np.split(h, np.cumsum(counts)[:-1])] if len(texts) else []


def told(own: list[np.ndarray]) -> dict[str, pa.Array]:
    """digest, n, sketch, short of sets: 128 bits, the size, and TOKENS min-wise tokens of 16 and of four bits."""
    n = np.array([len(x) for x in own], dtype=np.int64)
    some = np.flatnonzero(n)
    sketch = np.zeros((len(own), TOKENS), np.uint16)
    if len(some):
        flat, first = np.concatenate([own[i] for i in some]), (np.cumsum(n) - n)[some]
        for i, f in enumerate(_FACTORS):
            sketch[some, i] = (tb.mix(np.minimum.reduceat(flat * f, first)) & U(0xFFFF)).astype(np.uint16)
    short = (sketch[:, ::2] & 15 | (sketch[:, 1::2] & 15) << 4).astype(np.uint8)
    return {"digest": pa.array([xxhash.xxh3_128_hexdigest(x.tobytes()) for x in own], pa.string()), "n": pa.array(n), "sketch": pa.array([x.tobytes() for x in sketch], pa.binary()), "short": pa.array([x.tobytes() for x in short], pa.binary())}


def described(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, and told() of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "text_hash": part.column("text_hash")} | told(sets(part.column("text"), k)))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, f"doc_id long, text_hash long, {_SET}")


def branched(rows: DataFrame) -> DataFrame:
    """node, id, n, group of the children of the nodes' members (node, id, n, group, sketch): one or two for each, by the token that the node chooses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            node = np.asarray(batch.column("node")).view(U)
            sketch = _matrix(batch.column("sketch"))
            h = tb.mix(node ^ U(0xA0761D6478BD642F))
            one = h % U(TOKENS)
            two = (one + U(1) + (h >> U(8)) % U(TOKENS - 1)) % U(TOKENS)
            every, fork = np.arange(len(node)), np.flatnonzero((h >> U(40)) % U(FORK) == 0)
            for at, place in ((every, one), (fork, two[fork])):
                value = sketch[at, place.astype(np.int64)].astype(U)
                child = tb.mix(node[at] + tb.mix(place << U(16) | value))
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *[batch.column(c).take(pa.array(at)) for c in ("id", "n", "group")]], ["node", "id", "n", "group"])

    return rows.select("node", "id", "n", "group", "sketch").mapInArrow(run, "node long, id long, n long, group long")


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(len(col), TOKENS)


def _short(col: pa.Array) -> np.ndarray:
    both = np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(len(col), TOKENS // 2)
    return np.concatenate([both & 15, both >> 4], axis=1)


def leaves(known: DataFrame, trees: range, depth: int, rest: bool) -> DataFrame:
    """leaf, id: nodes to compare exhaustively, from a forest over known (id, n, group, sketch, ...).

    A node whose members belong to one group already is finished. A node of MEMBERS members and WEIGHT shingles at most
    is a leaf. In a larger one whose members are of one group but for as many, these others meet each block of the
    group; otherwise it branches further; what still is too large after `depth` levels becomes leaves for each pair of
    its blocks, which are all its pairs. Without `rest`, every larger node becomes leaves of blocks to which its first
    member is added, so that what resembles the first member is joined to it, and branches too.
    """
    slim = known.select("id", "n", "group", "sketch")
    roots = np.array(list(trees), dtype=U)
    start = F.array(*[F.lit(int(x)) for x in tb.mix(roots * U(0xD1B54A32D192ED03) + U(1)).view(np.int64)])
    rows = branched(slim.withColumn("node", F.explode(start)))
    found = []
    full = F.greatest(F.col("m") / MEMBERS, F.col("w") / WEIGHT)
    block, every = F.pmod(F.xxhash64("id"), "blocks"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    for level in range(1, depth + 1):
        nodes = rows.groupBy("node").agg(F.count("*").alias("m"), F.sum("n").alias("w"), F.min("id").alias("first"), F.min("group").alias("g"), F.max("group").alias("h")).where("g <> h")
        nodes = nodes.select("node", "first", F.ceil(full).cast("long").alias("blocks"))
        # a table and not a checkpoint, which keeps estimates of sizes that each level squares
        met = rows.join(nodes, "node")
        met = table(met if level == 1 else few(met, 2 * n), "nodes")
        found.append(met.where("blocks = 1").select(F.col("node").alias("leaf"), "id"))
        large = met.where("blocks > 1")
        if not rest:
            dealt = large.where("id <> first").select(F.xxhash64("node", block).alias("leaf"), "id")
            heads = large.where("id = first").select("node", F.explode(every).alias("b"), "id")
            found += [dealt, heads.select(F.xxhash64("node", "b").alias("leaf"), "id")]
        else:
            sizes = large.groupBy("node", "group").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
            tops = sizes.groupBy("node").agg(F.max(F.struct("m", "w", "group")).alias("top"), F.sum("m").alias("m"), F.sum("w").alias("w"))
            others = tops.select("node", F.col("top.group").alias("main"), (F.col("m") - F.col("top.m")).alias("m"), (F.col("w") - F.col("top.w")).alias("w")).where(full <= 1).select("node", "main")
            closed = large.join(others, "node", "left")
            met_all = closed.where("main is not null").select("node", "id", F.when(F.col("group") == F.col("main"), F.array(block)).otherwise(every).alias("b"))
            found.append(met_all.select("node", "id", F.explode("b").alias("b")).select(F.xxhash64("node", "b").alias("leaf"), "id"))
            large = closed.where("main is null").select("node", "id", "blocks")
            large = table(large if level == 1 else few(large, 2 * n), "large")
            if level == depth:
                pairs = large.select("node", "id", block.alias("own"), F.explode(every).alias("other"))
                found.append(pairs.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("leaf"), "id"))
        if level == depth or not (n := large.count()):
            break
        rows = branched(large.select("node", "id").join(slim, "id"))
    return reduce(DataFrame.union, found)


def _candidates(sketch: np.ndarray, n: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which members of a leaf may be alike to another, by tokens and sizes, that isn't in their group yet."""
    out = np.zeros(len(n), dtype=bool)
    for i in range(len(n) - 1):
        j = np.flatnonzero((group[i + 1 :] != group[i]) & (5 * np.minimum(n[i + 1 :], n[i]) >= 4 * np.maximum(n[i + 1 :], n[i]))) + i + 1
        if len(j):
            j = j[(sketch[j] == sketch[i]).sum(axis=1) >= COMMON]
            out[j] = True
            out[i] |= len(j) > 0
    return np.flatnonzero(out)


def _by_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each leaf together; leaves follow one another in the batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        leaf = np.asarray(batch.column("leaf"))
        cuts = [0, *(np.flatnonzero(leaf[1:] != leaf[:-1]) + 1).tolist(), len(leaf)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(lo, hi - lo)
            if held and held[0].column("leaf")[0] != part.column("leaf")[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition(parts(rows.sparkSession), "leaf").sortWithinPartitions("leaf", "id")


def asked(members: DataFrame) -> DataFrame:
    """leaf, id of the members of leaves (leaf, id, n, group, short) that have a candidate in their leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_leaf(batches):
            if t.num_rows < 2:
                continue
            t = t.combine_chunks()
            some = _candidates(_short(t.column("short").chunk(0)), np.asarray(t.column("n")), np.asarray(t.column("group")))
            if len(some):
                yield t.take(pa.array(some)).select(["leaf", "id"]).to_batches()[0]

    return _together(members.select("leaf", "id", "n", "group", "short")).mapInArrow(run, "leaf long, id long")


def common(own: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """How many elements each two of the sets have in common: products of a matrix of zeros and ones, `width` elements at a time.

    Elements of one set only don't count but on the diagonal, which is left out.
    """
    m = len(own)
    of = np.repeat(np.arange(m), [len(x) for x in own])
    _, inverse, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    shared = times[inverse] > 1
    at, of = (np.cumsum(times > 1) - 1)[inverse[shared]], of[shared]
    order = np.argsort(at, kind="stable")
    at, of = at[order], of[order]
    out = np.zeros((m, m), np.int64)
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        i, j = np.searchsorted(at, [lo, lo + width])
        x = np.zeros((m, width), np.float32)
        x[of[i:j], at[i:j] - lo] = 1
        out += (x @ x.T).astype(np.int64)
    return out


def linked(members: DataFrame, k: int) -> DataFrame:
    """u, v: links that join, inside each leaf (leaf, id, n, group, text), what chains of alike sets join.

    All pairs of the leaf that aren't in one group are compared by their whole sets. Of links that join what others
    have joined already none is returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # texts become sets as they come
            for batch in batches:
                for lo, hi in slices(batch.column("text")):
                    part = batch.slice(lo, hi - lo)
                    own = sets(part.column("text"), k)
                    ends = np.cumsum([0, *map(len, own)])
                    flat = np.concatenate(own).view(np.int64)
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("leaf", "id", "group")], pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat))], ["leaf", "id", "group", "set"])

        for t in _by_leaf(slim(batches)):
            t = t.combine_chunks()
            group = np.asarray(t.column("group"))
            own = [np.asarray(x.values).view(U) for x in t.column("set")]
            n = np.array([len(x) for x in own])
            both = common(own)
            u, v = np.nonzero(np.triu((100 * both >= 80 * (n[:, None] + n[None, :] - both)) & (group[:, None] != group[None, :]), 1))
            root = {int(g): int(g) for g in group}

            def top(x: int, root: dict[int, int] = root) -> int:
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            found = []
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                p, q = top(int(group[a])), top(int(group[b]))
                if p != q:
                    root[max(p, q)] = min(p, q)
                    found.append((a, b))
            if found:
                a, b = (pa.array(x) for x in zip(*found, strict=True))
                ids = t.column("id").combine_chunks()
                yield pa.RecordBatch.from_arrays([ids.take(a), ids.take(b)], ["u", "v"])

    return _together(members.select("leaf", "id", "group", "text")).mapInArrow(run, "u long, v long")


def classes(rows: DataFrame) -> DataFrame:
    """id, digest, head (doc_id, text_hash of one of its rows), n, sketch, short of each different set that isn't empty."""
    head = F.min_by(F.struct("doc_id", "text_hash"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("head")
    some = rows.where("n > 0").groupBy("digest").agg(head, *[F.first(c).alias(c) for c in ("n", "sketch", "short")])
    return cut(some.select(F.monotonically_increasing_id().alias("id"), "digest", "head", "n", "sketch", "short"))


def links(known: DataFrame, docs: DataFrame, k: int, trees: int = TREES, depth: int = DEPTH, given: DataFrame | None = None) -> DataFrame:
    """u, v: edges between the ids of classes() by which chains of sets with a Jaccard similarity of 0.8 or more are connected.

    `given` edges hold beforehand and are among the result: what they connect isn't compared. The first tree only tells
    groups, so that large groups of near copies are finished before the others begin.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    heads = known.select("id", F.col("head.doc_id").alias("_doc"), F.col("head.text_hash").alias("_hash"))
    every = given

    def grouped() -> DataFrame:
        if every is None:
            return known.select("id", "n", F.col("id").alias("group"), "sketch", "short")
        roots = components(every)
        return table(known.select("id", "n", "sketch", "short").join(roots, F.col("id") == F.col("node"), "left").select("id", "n", F.coalesce("root", "id").alias("group"), "sketch", "short"), "groups")

    for forest, levels, rest in ((range(1), 3, False), (range(1, trees + 1), depth, True)):
        groups = grouped()
        met = leaves(groups, forest, levels, rest)
        members = groups.select("id", "n", "group", "short")
        named = table(asked(met.join(members, "id")), "asked")
        # texts of those that have candidates, once each
        needed = named.select("id").distinct().join(heads, "id")
        text = texts.join(needed, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc"))).dropDuplicates(["id"]).select("id", "text")
        found = linked(named.join(members, "id").join(text, "id"), k)
        every = table(found if every is None else every.union(found), "links")
    return every


def near_duplicates(docs: DataFrame, k: int = 2, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Documents link if their sets of k-word shingles have a Jaccard similarity of 0.8 or more, by whole numbers;
    component_id is the smallest doc_id that links reach, and kept says that it is the document's own. With fewer words
    a set is the whole sequence; a text without words, or null, has no set and is linked with nothing. Equal sets are
    one node, so groups of copies cost one row. Repeated rows each give a row. A row without doc_id takes part but
    never names a component, unless no member has an id: then component_id is null and all are kept. Extra columns go;
    an empty table gives no rows.

    Recall, by calculation: a pair of similarity 0.8 meets in one tree with probability 0.84 at a depth of one, 0.48 at
    six, 0.41 at eight; twelve trees miss it by 4 in ten thousand at six, 2 in a thousand at eight. Chains often join
    what a link missed.
    """
    rows = cut(described(docs, k))
    known = classes(rows)
    roots = components(links(known, docs, k, trees, depth))
    of = known.select("id", "digest", F.col("head.doc_id").alias("doc_id")).join(roots, F.col("id") == F.col("node"), "left").select("digest", "doc_id", F.coalesce("root", "id").alias("group"))
    least = of.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    of = salted_join(of.select("digest", "group"), least, "group").select("digest", "component_id")
    some = rows.where("n > 0").select("doc_id", "n", "digest")
    out = salted_join(some, of, "digest").select("doc_id", "n", "component_id")
    out = out.union(rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
