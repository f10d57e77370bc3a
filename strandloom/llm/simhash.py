"""Near copies by 64-bit simhash, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strandloom.llm.components import components
from strandloom.llm import textbuf as tb
from strandloom.llm.shared import cut, salted_join
from strandloom.llm.textbuf import slices

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
RADIUS, TILE, BLOCK = 4, 32_768, 128
#: Words of a shingle where nothing else is said.
SHINGLE = 5


def simhash(text: bytes, k: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all k-word shingles, A-Z lower-cased; no words: 0."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(k, len(words))
    lo = [0, *(ends[: len(words) - k] + 1).tolist()]
    of = xxhash.xxh64_intdigest
    h = np.array([of(flat[a:b], seed) for a, b in zip(lo, ends[k - 1 :].tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 15):
        ones += np.unpackbits(h[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                fp = np.array([simhash(t or b"") for t in part.column("text").cast(pa.large_binary()).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def near(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that join what lies within the radius in two tiles; nodes number a, then b. Not all pairs.

    Rows are ordered by the population counts of their bytes and cut into blocks; two blocks are compared bit by bit
    unless the counts alone put them further apart than the radius. Found pairs go into a disjoint set at once, so
    what is kept never exceeds the number of rows.
    """

    def blocks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        counts = np.bitwise_count(x.view(np.uint8).reshape(-1, 8)).astype(np.int16)
        pairs = counts.reshape(-1, 4, 2).sum(axis=2)
        order = np.lexsort([*counts.T[::2], *pairs.T])
        cuts = np.arange(0, len(x), BLOCK)
        return order, cuts, np.minimum.reduceat(counts[order], cuts), np.maximum.reduceat(counts[order], cuts)

    n = len(a)
    oa, ca, lo_a, hi_a = blocks(a)
    ob, cb, lo_b, hi_b = (oa, ca, lo_a, hi_a) if same else blocks(b)
    root = np.arange(n if same else n + len(b))
    for i, at in enumerate(ca):
        gap = np.maximum(lo_b - hi_a[i], 0) + np.maximum(lo_a[i] - hi_b, 0)
        mine = oa[at : at + BLOCK]
        for j in np.flatnonzero(gap.sum(axis=1) <= radius):
            if same and j < i:
                continue
            theirs = ob[cb[j] : cb[j] + BLOCK]
            found = np.flatnonzero(np.bitwise_count(a[mine][:, None] ^ b[theirs][None, :]) <= radius)
            u, v = mine[found // len(theirs)], theirs[found % len(theirs)] + (0 if same else n)
            while len(u):
                ru, rv = root[u], root[v]
                apart = ru != rv
                if not apart.any():
                    break
                u, v = u[apart], v[apart]
                big, small = np.maximum(ru, rv)[apart], np.minimum(ru, rv)[apart]
                np.minimum.at(root, big, small)
                while (deeper := root[root]) is not None and (deeper != root).any():
                    root = deeper
    node = np.flatnonzero(root != np.arange(len(root)))
    return node, root[node]


def tiles(fps: DataFrame, tile: int) -> DataFrame:
    """id, c1, c2 (population counts of the two halves), chunk, fps (array): at most about `tile` fingerprints each."""
    half = fps.select("fp", F.bit_count(F.shiftrightunsigned("fp", 32)).cast("int").alias("c1"), F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF)).cast("int").alias("c2"))
    # 33 x 33 keys at most
    counts = half.groupBy("c1", "c2").agg(F.count("*").alias("n"))
    dealt = half.join(F.broadcast(counts), ["c1", "c2"]).withColumn("chunk", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / tile)).cast("int"))
    return dealt.groupBy("c1", "c2", "chunk").agg(F.collect_list("fp").alias("fps")).withColumn("id", (F.col("c1") * 33 + F.col("c2")).cast("long") * (1 << 40) + F.col("chunk"))


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) between distinct fingerprints: joined by them is whatever chains of at most `radius` bits join."""
    held = cut(tiles(fps, tile))
    # what tells a tile, a row each; partners have half counts that differ by the radius at most
    meta = held.select("id", "c1", "c2")
    steps = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if abs(x) + abs(y) <= radius]
    around = meta.select(F.col("id").alias("a"), F.explode(F.array(*[F.struct((F.col("c1") + x).alias("c1"), (F.col("c2") + y).alias("c2")) for x, y in steps])).alias("k")).select("a", "k.c1", "k.c2")
    pairs = around.join(meta.withColumnRenamed("id", "b"), ["c1", "c2"]).where("a <= b").select("a", "b")
    both = pairs.join(held.select(F.col("id").alias("a"), F.col("fps").alias("x")), "a").join(held.select(F.col("id").alias("b"), F.col("fps").alias("y")), "b").select((F.col("a") == F.col("b")).alias("same"), "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flat(col: pa.ListArray, i: int) -> np.ndarray:
            return np.asarray(col[i].values, dtype=np.int64).view(np.uint64)

        for batch in batches:
            for i, same in enumerate(batch.column("same").to_pylist()):
                a, b = flat(batch.column("x"), i), flat(batch.column("y"), i)
                node, root = near(a, b, radius, same)
                if len(node):
                    every = (a if same else np.concatenate([a, b])).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(every[node]), pa.array(every[root])], ["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every document.

    Documents link if their fingerprints differ in `radius` bits at most; component_id is the smallest doc_id that
    links reach. Equal fingerprints are one node, so groups of copies cost one row. Texts without words have the zero
    fingerprint and link like any other. Repeated rows each give a row; a null doc_id takes part but never names a
    component, unless no member has an id. An empty table gives no rows.
    """
    own = cut(fingerprints(docs))
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(nodes.select("fp"), radius, tile))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    named = salted_join(named, least, "root", "left").select(F.col("fp").alias("_fp"), F.coalesce("component_id", "first").alias("component_id"))
    return own.join(named, F.col("fp") == F.col("_fp")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def word_shingles(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the k-word shingles of the texts (fewer words: one of all), A-Z lower-cased, and how many each has."""
    buf, docs = tb.joined(texts)
    buf = tb.LOWER[buf]
    starts, ends = tb.words(buf, ~tb.SPACE)
    counts = tb.owner(starts, docs)
    h = tb.hashes(buf, starts, ends)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(h))
    out = np.zeros(len(h), np.uint64)
    padded = np.append(h, np.zeros(k, np.uint64))
    for j in range(k):
        out = np.where(left > j, tb.mix(out + padded[j : j + len(h)]), out)
    first = np.repeat(np.cumsum(counts) - counts, counts) == np.arange(len(h))
    return out[(left >= k) | first], np.maximum(counts - k + 1, np.minimum(counts, 1))


def digested(docs: DataFrame) -> DataFrame:
    """docs with digest, the 128 bits that tell its texts apart (null as the empty text); any column of that name goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                digests = [xxhash.xxh3_128_hexdigest(t or b"") for t in part.column("text").cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(digests, pa.string())], [*part.schema.names, "digest"])

    rows = docs.drop("digest")
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("digest", StringType())]))
