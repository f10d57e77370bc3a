"""Min-hash signatures, bins, approximate and exact nearest neighbours.

Tables: features(id, f, v), signatures(id, k, h), neighbors(a, b, rank, shared, sim).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.hashing import GOLDEN, MASK, UNSET
from strandloom.session import release, shared_dir


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """int_hash of many keys: 32-bit arithmetic that wraps."""
    with np.errstate(over="ignore"):
        k = np.floor(((keys * (seed + 1)) & MASK) * GOLDEN).astype(np.int64).astype(np.int32)
        k = ~k + (k << np.int32(15))
        k ^= k >> np.int32(12)
        k += k << np.int32(2)
        k ^= k >> np.int32(4)
        k *= np.int32(2057)
        return k ^ (k >> np.int32(16))


def minhash_signature(features: DataFrame, nhf: int, factor: int = 1) -> DataFrame:
    """id, k, h: for each of nhf * factor hash functions the least non-negative hash of the id's features.

    Feature 0 counts as 1; values are ignored; ids whose hashes are all negative have UNSET. Features are brought together
    by id before they are hashed, so an id has a row for each function from the start, however many parts hold its features.
    """
    rows = features.where("id is not null and f is not null").select(F.col("id").cast("long"), F.col("f").cast("long"))
    return set_signature(rows.groupBy("id").agg(F.collect_list("f").alias("fs")), nhf * factor)


def set_signature(sets: DataFrame, total: int) -> DataFrame:
    """minhash_signature of (id, fs), fs being an array with all features of the id; no array is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ids, fs = batch.column("id"), batch.column("fs")
            # a feature of many ids is hashed once; no list is empty
            f, at = np.unique(np.maximum(np.asarray(fs.flatten()), 1), return_inverse=True)
            size = np.asarray(fs.value_lengths()).astype(np.int64)
            first = np.cumsum(size) - size
            for k in range(total):
                h = mixed(f, k).astype(np.int64)
                h[h < 0] = UNSET
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(first), k, np.int32)), pa.array(np.minimum.reduceat(h[at], first))], ["id", "k", "h"])

    return sets.mapInArrow(run, "id long, k int, h long")


def packed_signature(sets: DataFrame, total: int) -> DataFrame:
    """id, s: the signature of each id's features in one row, s[k] being h - 2^31; of (id, fs), whose rows of one id count as one.

    Rows are hashed where they are, so what is shuffled are four bytes for each function and not the features.
    """
    rows = signed(sets.where("id is not null and size(fs) > 0").select(F.col("id").cast("long"), F.col("fs").cast("array<long>")), total)
    least = F.transform(F.sequence(F.lit(0), F.lit(total - 1)), lambda k: F.array_min(F.transform("l", lambda s: s[k])))
    return rows.groupBy("id").agg(F.collect_list("s").alias("l")).select("id", F.when(F.size("l") == 1, F.col("l")[0]).otherwise(least).alias("s"))


def signed(sets: DataFrame, total: int) -> DataFrame:
    """The rows with s, the signature of the row's features, instead of fs; no array is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            fs = batch.column("fs")
            f, at = np.unique(np.maximum(np.asarray(fs.flatten()), 1), return_inverse=True)
            size = np.asarray(fs.value_lengths()).astype(np.int64)
            first = np.cumsum(size) - size
            out = np.empty((len(first), total), np.int32)
            for k in range(total):
                h = mixed(f, k).astype(np.int64)
                h[h < 0] = UNSET
                out[:, k] = np.minimum.reduceat(h[at], first) - UNSET
            s = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * total, pa.int32()), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], s], [*kept, "s"])

    kept = [c for c in sets.columns if c != "fs"]
    return sets.select(*kept, "fs").mapInArrow(run, "".join(f"`{c}` {kind}, " for c, kind in sets.dtypes if c != "fs") + "s array<int>")


def signature_rows(packed: DataFrame) -> DataFrame:
    """id, k, h of packed_signature."""
    return packed.select("id", F.posexplode("s").alias("k", "h")).select("id", "k", (F.col("h") + F.lit(UNSET).cast("long")).alias("h"))


def compact_signature(signatures: DataFrame, nhf: int) -> DataFrame:
    """Signatures whose k are equal modulo nhf added up, as unsigned 32-bit."""
    return signatures.groupBy("id", (F.col("k") % nhf).cast("int").alias("k")).agg(F.sum("h").bitwiseAND(MASK).alias("h"))


def natural_signature(features: DataFrame, n: int) -> DataFrame:
    """The n smallest feature ids themselves."""
    w = Window.partitionBy("id").orderBy("f")
    return features.withColumn("k", F.row_number().over(w) - 1).where(F.col("k") < n).select("id", "k", F.col("f").alias("h"))


def bins(signatures: DataFrame) -> DataFrame:
    """k, h, size."""
    return signatures.groupBy("k", "h").agg(F.count("*").alias("size"))


def max_bin_share(n: int, target: int = 1000) -> float:
    """Largest share of all instances that a bin may hold: 1 up to `target` instances, else target / n to four digits, 1e-4 at least."""
    return 1.0 if n <= target else max(1e-4, float(f"{target / n:.4f}"))


def candidate_pairs(signatures: DataFrame, n: int, share: float, least: int = 2) -> DataFrame:
    """a, b, shared: ordered pairs that share `least` bins smaller than share * n; both directions.

    Bins are filtered by size before the self-join, which bounds what a bin can make; pairs are formed once (a < b).
    """
    small = bins(signatures).where(F.col("size") < F.lit(share * n)).where("size > 1").select("k", "h")
    rows = signatures.join(small, ["k", "h"])
    half = rows.select("k", "h", F.col("id").alias("a")).join(rows.select("k", "h", F.col("id").alias("b")), ["k", "h"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    return half.union(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))


def trim(candidates: DataFrame, most: int) -> DataFrame:
    """The candidates with most shared bins of each a (ties: smaller id first); 0 keeps all."""
    if not most:
        return candidates
    w = Window.partitionBy("a").orderBy(F.desc("shared"), "b")
    return candidates.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).drop("place")


def _first(row: np.ndarray, count: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the `most` with the largest counts (ties: smaller b), in order."""
    if len(b) and row.max() < 1 << 14 and count.max() < 1 << 9 and b.min() >= 0 and b.max() < 1 << 40:
        # all three in one number, whose order is the one asked for
        code = np.sort(row.astype(np.int64) << 49 | (511 - count.astype(np.int64)) << 40 | b)
        row, count, b = code >> 49, 511 - (code >> 40 & 511), code & (1 << 40) - 1
    else:
        order = np.lexsort([b, -count, row])
        row, count, b = row[order], count[order], b[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < most
    return row[keep], count[keep], b[keep]


def best_candidates(signatures: DataFrame, n: int, share: float, most: int, least: int = 2, block: int = 1 << 14, part: int = 1 << 20, hits: int = 1 << 22, labels: DataFrame | None = None) -> DataFrame:
    """trim(candidate_pairs(...), most) without a row for each pair of a bin.

    Ids go by blocks of `block` at most, with those of their bins that are small enough. A block meets all others one after
    another (beyond `part` ids, those of a part of them) and keeps each id's best, so what is shuffled are bins of ids and
    what is kept. Pairs are counted about `hits` at a time. Of bins that are too large there are fewer than functions / share;
    they are sent to all, the rows of the others aren't joined.

    labels (id, label) travel with the blocks: a candidate b then has a row for each of its labels, and none without any.
    """
    if not most:
        met = candidate_pairs(signatures, n, share, least)
        return met if labels is None else met.join(labels.select(F.col("id").alias("b"), "label"), "b").select("a", "b", "shared", "label")
    large = bins(signatures).where(~(F.col("size") < F.lit(share * n))).select("k", "h")
    rows = signatures.join(F.broadcast(large), ["k", "h"], "left_anti").select("id", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("h")).alias("key"))
    rows = rows.select(F.col("id").cast("long"), "key", F.lit(None).cast("string").alias("label"))
    if labels is not None:
        rows = rows.union(labels.where("id is not null").select(F.col("id").cast("long"), F.lit(None).cast("long"), F.col("label").cast("string")))
    cores = signatures.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n * 9 // (block * 8)), min(2 * cores, n // 1024))
    parts = max(1, -(-n // part))
    voting = labels is not None

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        t = pa.Table.from_batches(got)
        keyed = pc.is_valid(t.column("key"))
        ids, key = (np.concatenate([np.zeros(0, np.int64), *map(np.asarray, t.filter(keyed).column(c).chunks)]) for c in ("id", "key"))
        named = t.filter(pc.invert(keyed)).sort_by("id")
        whose, label = np.asarray(named.column("id")), named.column("label").combine_chunks()
        own, at = np.unique(ids, return_inverse=True)
        # a block holds more than its share by chance; what no longer fits a number of 16 bits makes further ones
        for lo in range(0, len(own), block):
            a = own[lo : lo + block]
            mine = (at >= lo) & (at < lo + block)
            order = np.argsort(key[mine], kind="stable")
            k, h = np.divmod(key[mine][order], 1 << 32)
            k, times = np.unique(k, return_counts=True)
            known = np.flatnonzero(a[np.minimum(np.searchsorted(a, whose), len(a) - 1)] == whose)
            cells = [a, k, times.astype(np.int64), h.astype(np.uint32), (at[mine][order] - lo).astype(np.uint16), whose[known].astype(np.int64)]
            names = pa.array([label.take(pa.array(known)).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*[pa.array([c.tobytes()], pa.binary()) for c in cells], names], ["ids", "k", "times", "h", "at", "whose", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(a: np.ndarray, found: list[tuple[np.ndarray, ...]], named: list[tuple[np.ndarray, pa.Array]]) -> Iterator[pa.RecordBatch]:
            row, count, b = _first(*(np.concatenate(c) for c in zip(*found, strict=True)), most) if found else (np.zeros(0, np.int64),) * 3
            if voting and len(row):
                whose = np.concatenate([x for x, _ in named])
                order = np.argsort(whose, kind="stable")
                whose, label = whose[order], pa.concat_arrays([x for _, x in named]).take(pa.array(order))
            for lo in range(0, len(row), 1 << 17):
                of = slice(lo, lo + (1 << 17))
                cells = [a[row[of]], b[of], count[of]]
                if not voting:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["a", "b", "shared"])
                    continue
                low = np.searchsorted(whose, cells[1])
                known = np.searchsorted(whose, cells[1], "right") - low
                # one without labels has its place all the same
                times = np.maximum(known, 1)
                at = np.arange(int(times.sum())) + np.repeat(low - (np.cumsum(times) - times), times)
                known = np.repeat(known > 0, times)
                cells = [*[pa.array(np.repeat(c, times)) for c in cells], label.take(pa.array(at, mask=~known)), pa.array(known)]
                yield pa.RecordBatch.from_arrays(cells, ["a", "b", "shared", "label", "known"])

        def cell(batch: pa.RecordBatch, name: str, i: int, kind: type) -> np.ndarray:
            return np.frombuffer(batch.column(name)[i].as_buffer(), kind)

        def keys(batch: pa.RecordBatch, tail: str, i: int) -> np.ndarray:
            return np.repeat(cell(batch, f"k{tail}", i, np.int64) << 32, cell(batch, f"times{tail}", i, np.int64)) + cell(batch, f"h{tail}", i, np.uint32)

        a, found, named = np.zeros(0, np.int64), [], []
        for batch in batches:
            for i in range(len(batch)):
                ids = cell(batch, "ids", i, np.int64)
                if not len(a) or a[0] != ids[0]:
                    yield from made(a, found, named)
                    a, key, at = ids.copy(), keys(batch, "", i), cell(batch, "at", i, np.uint16)
                    own = np.argsort(at, kind="stable")
                    of, found, named, waiting = at[own].astype(np.int64), [], [], 0
                    floor = np.full(len(a), least)
                b, other, to = cell(batch, "ids_", i, np.int64), keys(batch, "_", i), cell(batch, "at_", i, np.uint16)
                if voting:
                    named.append((cell(batch, "whose_", i, np.int64), batch.column("label_")[i].values))
                low = np.searchsorted(other, key)[own]
                times = np.searchsorted(other, key, "right")[own] - low
                upto = np.cumsum(times)
                last = np.searchsorted(of, np.arange(len(a)), "right")
                lo = 0
                while lo < len(a):
                    # whole ids, at least one
                    base = int(upto[last[lo - 1] - 1]) if lo else 0
                    hi = max(lo + 1, int(np.searchsorted(upto[last - 1], base + hits, "right")))
                    s = slice(int(last[lo - 1]) if lo else 0, int(last[hi - 1]))
                    t = times[s]
                    place = np.arange(int(t.sum())) + np.repeat(low[s] - (np.cumsum(t) - t), t)
                    code = np.sort(np.repeat(((of[s] - lo) * len(b)).astype(np.int64 if (hi - lo) * len(b) >> 31 else np.int32), t) + to[place])
                    start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
                    count = np.diff(start, append=len(code))
                    many = count >= least
                    row, col = np.divmod(code[start[many]], len(b))
                    row, count, met = row + lo, count[many], b[col]
                    keep = (count >= floor[row]) & (met != a[row])
                    if keep.any():
                        found.append((row[keep].astype(np.int64), count[keep], met[keep]))
                        waiting += int(keep.sum())
                    if waiting > hits:
                        found, waiting = [_first(*(np.concatenate(c) for c in zip(*found, strict=True)), most)], 0
                        row, count, _ = found[0]
                        full = np.bincount(row, minlength=len(a)) >= most
                        worst = np.full(len(a), least)
                        worst[row] = count  # the last of a row is its least
                        floor = np.where(full, np.maximum(worst, least), least)
                    lo = hi
        yield from made(a, found, named)

    own = rows.repartitionById(blocks, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).mapInArrow(laid, "ids binary, k binary, times binary, h binary, at binary, whose binary, label array<string>")
    others = own.select(*[F.col(c).alias(f"{c}_") for c in own.columns]).repartition(parts)
    pairs = own.drop("whose", "label").crossJoin(others.hint("shuffle_replicate_nl"))
    best = pairs.mapInArrow(run, "a long, b long, shared long" + (", label string, known boolean" if voting else ""))
    if parts > 1:
        # rows of one candidate, one for each label, have one place
        w = Window.partitionBy("a").orderBy(F.desc("shared"), "b")
        best = best.withColumn("place", F.dense_rank().over(w)).where(F.col("place") <= most).drop("place")
    return best.where("known").drop("known") if voting else best


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers as bytes, four for each where they fit, else eight."""
    return x.astype(np.int32 if not len(x) or -(1 << 31) <= x.min() and x.max() < 1 << 31 else np.int64).tobytes()


def _wide(cell: pa.BinaryScalar, n: int) -> np.ndarray:
    raw = cell.as_buffer()
    return np.frombuffer(raw, np.int64 if n and raw.size == 8 * n else np.int32).astype(np.int64)


def _stored(ids: np.ndarray, n: np.ndarray, f: np.ndarray, v: np.ndarray) -> list[bytes]:
    """A block of sparse vectors (id, its number of features, these, their values) as bytes; a value is stored once for an
    id that has no other."""
    own = np.zeros(len(n))
    own[n > 0] = v[(np.cumsum(n) - n)[n > 0]]
    return [ids.astype(np.int64).tobytes(), n.astype(np.int32).tobytes(), _narrow(f), (own if np.array_equal(np.repeat(own, n), v) else v).tobytes()]


def _loaded(ids: pa.BinaryScalar, n: pa.BinaryScalar, f: pa.BinaryScalar, v: pa.BinaryScalar) -> tuple[np.ndarray, ...]:
    ids, n, v = np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(n.as_buffer(), np.int32).astype(np.int64), np.frombuffer(v.as_buffer())
    total = int(n.sum())
    return ids, n, _wide(f, total), np.repeat(v, n) if len(v) == len(n) else v


def rerank(candidates: DataFrame, features: DataFrame, knn: int, block: int = 1 << 14, part: int = 1 << 17, steps: int = 1 << 22) -> DataFrame:
    """a, b, rank, sim: a itself first, then its candidates by dot product (ties: smaller id), `knn` in all.

    Products are rounded to six digits; ids without features have 0. Ids go by blocks of about `block`, with their features
    and candidates; a block meets the features of all others one after another (beyond `part` ids, of a part of them) and
    keeps each id's best, so features are shuffled once and not for each pair. About `steps` products are added up at a time.
    """
    ids = candidates.select(F.col("a").alias("id")).union(candidates.select("b")).distinct()
    n = ids.count()
    cores = candidates.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // block), min(2 * cores, n // 1024))
    parts = max(1, -(-n // part))
    number = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    lists = candidates.groupBy(F.col("a").alias("id")).agg(F.array_union(F.collect_list("b"), F.array(F.col("a"))).alias("bs"))
    rows = ids.join(packed(features), "id", "left").join(lists, "id", "left").select("id", "fs", "vs", "bs", F.transform("bs", number).alias("qs"), number("id").alias("p"))

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [x for x in batches if len(x)]
        if not got:
            return
        t = pa.Table.from_batches(got).sort_by("id").combine_chunks()
        fs, vs, bs, qs = (t.column(c).combine_chunks() for c in ("fs", "vs", "bs", "qs"))
        size = lambda x: np.asarray(pc.fill_null(pc.list_value_length(x), 0)).astype(np.int64)
        cells = _stored(np.asarray(t.column("id")), size(fs), np.asarray(pc.list_flatten(fs)), np.asarray(pc.list_flatten(vs), dtype=np.float64))
        row, b, q = np.repeat(np.arange(len(t)), size(bs)), np.asarray(pc.list_flatten(bs)), np.asarray(pc.list_flatten(qs))
        # pairs in order of the block that b is in
        order = np.argsort(q, kind="stable")
        upto = np.searchsorted(q[order], np.arange(blocks + 1))
        cells += [row[order].astype(np.int32).tobytes(), _narrow(b[order]), upto.astype(np.int64).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([t.column("p")[0].as_py()], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]], ["p", "ids", "n", "f", "v", "row", "b", "upto"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best(a: np.ndarray, row: np.ndarray, b: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            order = np.lexsort([b, -sim, b != a[row], row])
            order = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < knn]
            return row[order], b[order], sim[order]

        def made(a: np.ndarray, found: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            if found:
                row, b, sim = best(a, *(np.concatenate(c) for c in zip(*found, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(a[row]), pa.array(b), pa.array(sim)], ["a", "b", "sim"])

        at, a, found = None, None, []
        for batch in batches:
            for i in range(len(batch)):
                x = {c: batch.column(c)[i] for c in batch.schema.names}
                if x["p"].as_py() != at:
                    yield from made(a, found)
                    at, found = x["p"].as_py(), []
                    a, size, f, v = (c.copy() for c in _loaded(x["ids"], x["n"], x["f"], x["v"]))
                    upto = np.frombuffer(x["upto"].as_buffer(), np.int64).copy()
                    rows, bs = np.frombuffer(x["row"].as_buffer(), np.int32).astype(np.int64), _wide(x["b"], int(upto[-1]))
                    words, code = np.unique(f, return_inverse=True)
                    known = np.repeat(np.arange(len(a)), size) * len(words) + code
                mine = slice(int(upto[x["q"].as_py()]), int(upto[x["q"].as_py() + 1]))
                row, b = rows[mine], bs[mine]
                ids, n, g, w = _loaded(x["ids_"], x["n_"], x["f_"], x["v_"])
                place = np.searchsorted(ids, b)
                sims = np.zeros(len(b))
                if len(words):
                    col = np.minimum(np.searchsorted(words, g), len(words) - 1)
                    # features that no id of the block has are left out
                    here = words[col] == g
                    col, w = col[here], w[here]
                    n = np.bincount(np.repeat(np.arange(len(n)), n)[here], minlength=len(n))
                    start = np.cumsum(n) - n
                    many = np.cumsum(n[place])
                    lo = 0
                    while lo < len(b):
                        hi = max(lo + 1, int(np.searchsorted(many, (many[lo - 1] if lo else 0) + steps, "right")))
                        k = n[place[lo:hi]]
                        of = np.repeat(np.arange(hi - lo), k)
                        e = np.arange(len(of)) + np.repeat(start[place[lo:hi]] - (np.cumsum(k) - k), k)
                        key = row[lo:hi][of] * len(words) + col[e]
                        met = np.minimum(np.searchsorted(known, key), len(known) - 1)
                        both = known[met] == key
                        sims[lo:hi] = np.bincount(of[both], v[met[both]] * w[e[both]], hi - lo)
                        lo = hi
                if len(b):
                    found.append(best(a, row, b, np.round(sims, 6)))
        yield from made(a, found)

    own = rows.repartitionById(blocks, F.col("p")).mapInArrow(laid, "p int, ids binary, n binary, f binary, v binary, row binary, b binary, upto binary")
    others = own.select(F.col("p").alias("q"), *[F.col(c).alias(f"{c}_") for c in ("ids", "n", "f", "v")]).repartition(parts)
    met = own.crossJoin(others.hint("shuffle_replicate_nl")).mapInArrow(run, "a long, b long, sim double")
    w = Window.partitionBy("a").orderBy((F.col("a") != F.col("b")).cast("int"), F.desc("sim"), "b")
    return met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= knn).select("a", "b", "rank", "sim")


def forest_bins(signatures: DataFrame, trees: int, depth: int, most: int = 1000) -> DataFrame:
    """bin, id: for each of `trees` trees the bin of every id, of `most` members at most.

    The first function of a tree makes its bins; one that is too large is split by the tree's next function, `depth` of
    them in all (signatures hold trees * depth functions, those of a tree one after another). What still is too large
    is alike in all of them, and is cut by the id. So no bin is dropped, and no id is without one, whatever the table's size.
    """
    rows = signatures.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("k", "h"))).alias("s"))
    rows = rows.select("id", F.transform("s", lambda x: x["h"]).alias("s"))
    rows = rows.select("id", "s", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    at = lambda level: F.element_at("s", F.col("tree") * depth + level + 1)
    rows = rows.select("id", F.xxhash64("tree", at(0)).alias("bin"), "tree", "s")
    found = None
    for level in range(1, depth + 1):
        size = rows.groupBy("bin").agg(F.count("*").alias("size"))
        rows = rows.join(size, "bin")
        large = F.col("size") > most
        if level == depth:
            done = rows.select(F.when(large, F.xxhash64("bin", F.pmod("id", F.ceil(F.col("size") / most)))).otherwise(F.col("bin")).alias("bin"), "id")
        else:
            done = rows.where(~large).select("bin", "id")
            rows = rows.where(large).select("id", F.xxhash64("bin", at(level)).alias("bin"), "tree", "s")
        found = done if found is None else found.union(done)
    return found


def forest_leaves(packed: DataFrame, trees: int, depth: int, most: int = 500) -> DataFrame:
    """bin, id: bins of two ids or more, `most` members about, of packed signatures (id, s) with 2 * trees functions.

    A tree's bins are those of its two functions; one that is too large is split by functions of other trees, `depth` of
    them in all. What still is too large is cut into blocks, each two of which are a bin, so whoever is alike in the
    functions of a tree meets, and nobody is dropped.
    """
    n = 2 * trees
    of = lambda t: [2 * t, 2 * t + 1, (2 * t + 2) % n, (2 * t + 15) % n]
    keys = lambda t: F.struct(*[F.xxhash64(F.lit(t), *[F.col("s")[k] for k in of(t)[:level]]).alias(f"b{level}") for level in range(2, depth + 1)])
    rows = packed.select("id", F.explode(F.array(*map(keys, range(trees)))).alias("b")).select("id", "b.*")
    # a bin lies in one of the level before, so all are counted where the first are
    for level in range(2, depth + 1):
        rows = rows.withColumn(f"n{level}", F.count("*").over(Window.partitionBy(*[f"b{x}" for x in range(2, level + 1)])))
    levels = [(F.col(f"b{x}"), F.col(f"n{x}")) for x in range(2, depth + 1)]
    fits = [F.when(size <= most, F.struct(b.alias("bin"), size.alias("size"))) for b, size in levels]
    rows = rows.select("id", F.coalesce(*fits).alias("fit"), levels[-1][0].alias("last"), F.ceil(levels[-1][1] / most).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.xxhash64("last", F.least("own", o), F.greatest("own", o)))
    large = rows.where("fit is null").withColumn("own", own).select(F.explode(met).alias("bin"), "id")
    return rows.where("fit.size > 1").select("fit.bin", "id").union(large)


def _products(of: np.ndarray, f: np.ndarray, v: np.ndarray, m: int, width: int = 2048) -> np.ndarray:
    """Dot products of m sparse vectors (of: which one, f, v) with each other.

    Features of many vectors are laid out as a matrix, `width` at a time; of the others every pair that shares one is added up.
    """
    _, at, times = np.unique(f, return_inverse=True, return_counts=True)
    out = np.zeros((m, m))
    often = times * times * 2000 > m * m
    rank = np.cumsum(often) - 1
    here = often[at]
    col, row, val = rank[at[here]], of[here], v[here]
    for lo in range(0, int(often.sum()), width):
        some = (col >= lo) & (col < lo + width)
        x = np.zeros((m, min(width, int(often.sum()) - lo)))
        x[row[some], col[some] - lo] = val[some]
        out += x @ x.T
    rare = (times[at] > 1) & ~here
    order = np.flatnonzero(rare)[np.argsort(at[rare], kind="stable")]
    n = times[at[order]]
    # each entry beside all entries of its feature
    first = np.searchsorted(at[order], at[order])
    left = np.repeat(np.arange(len(order)), n)
    right = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    pair = of[order][left] * m + of[order][right]
    out += np.bincount(pair, v[order][left] * v[order][right], m * m).reshape(m, m)
    return out


_Sparse = tuple[np.ndarray, np.ndarray, np.ndarray]


def _laid(cell: pa.ListScalar) -> tuple[np.ndarray, _Sparse]:
    """Ids of a block of (id, fs, vs) in order, and its features: which id, feature, value."""
    ids, fs = np.asarray(cell.values.field("id")), cell.values.field("fs")
    order = np.argsort(ids, kind="stable")
    take = pa.array(order)
    of = np.repeat(np.arange(len(ids)), np.asarray(fs.value_lengths())[order])
    return ids[order], (of, np.asarray(fs.take(take).flatten()), np.asarray(cell.values.field("vs").take(take).flatten(), dtype=np.float64))


def _cross(x: _Sparse, y: _Sparse, m: int, n: int, common: bool = False, width: int = 2048, most: int = 1 << 22) -> np.ndarray:
    """Dot products of m sparse vectors with n others (common: how often a feature is in both).

    Features of many pairs are laid out as matrices, `width` at a time; of the others each pair that has one is added up,
    about `most` pairs at a time.
    """
    out = np.zeros((m, n))
    both = np.intersect1d(x[1], y[1])
    if not len(both):
        return out

    def met(of: np.ndarray, f: np.ndarray, v: np.ndarray) -> _Sparse:
        at = np.minimum(np.searchsorted(both, f), len(both) - 1)
        here = both[at] == f
        return of[here], at[here], np.ones(int(here.sum())) if common else v[here]

    (ox, ax, vx), (oy, ay, vy) = met(*x), met(*y)
    often = np.bincount(ax, minlength=len(both)) * np.bincount(ay, minlength=len(both)) * 2000 > m * n
    rank = np.cumsum(often) - 1
    for lo in range(0, int(often.sum()), width):

        def laid(of: np.ndarray, at: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
            some = often[at] & (rank[at] >= lo) & (rank[at] < lo + width)  # noqa: B023
            wide = min(width, int(often.sum()) - lo)  # noqa: B023
            return np.bincount(of[some] * wide + rank[at[some]] - lo, v[some], size * wide).reshape(size, wide)  # noqa: B023

        out += laid(ox, ax, vx, m) @ laid(oy, ay, vy, n).T
    left = np.flatnonzero(~often[ax])
    right = np.flatnonzero(~often[ay])
    right = right[np.argsort(ay[right], kind="stable")]
    first = np.searchsorted(ay[right], ax[left])
    times = np.searchsorted(ay[right], ax[left], "right") - first
    upto = np.cumsum(times)
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most)))
        t = times[lo:hi]
        p = np.repeat(left[lo:hi], t)
        q = right[np.repeat(first[lo:hi] - (np.cumsum(t) - t), t) + np.arange(int(t.sum()))]
        out += np.bincount(ox[p] * n + oy[q], vx[p] * vy[q], m * n).reshape(m, n)
        lo = hi
    return out


def bin_neighbors(bins: DataFrame, features: DataFrame, knn: int, rows: int = 1 << 22) -> DataFrame:
    """a, b, rank, sim: of each id itself, then those that share a bin with it by dot product (ties: smaller id), knn in all.

    A bin is compared exactly, all with all; its ids' features travel to it once, and each id keeps its best knn of it.
    Bins go in rounds of about `rows` ids; shuffle files of a round are let go before the next, so the space on disk that
    travelling features take doesn't grow with the table. Products are rounded to six digits.
    """
    spark = features.sparkSession
    shared_dir(spark)
    bins, own = bins.checkpoint(), packed(features).checkpoint()
    rounds = max(1, -(-bins.count() // rows))

    def best(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ids = np.asarray(t.column("id"))
        order = np.argsort(ids)
        take = pa.array(order)
        ids, fs, vs = ids[order], t.column("fs").take(take).combine_chunks(), t.column("vs").take(take).combine_chunks()
        m = len(ids)
        of = np.repeat(np.arange(m), np.asarray(pc.list_value_length(fs)))
        sims = np.round(_products(of, np.asarray(pc.list_flatten(fs)), np.asarray(pc.list_flatten(vs)), m), 6)
        rank = sims.copy()
        np.fill_diagonal(rank, np.inf)
        row, col = _greatest(rank, min(knn, m))
        order = np.lexsort([col, -rank[row, col], row])
        order = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < knn]
        row, col = row[order], col[order]
        return pa.table({"a": pa.array(ids[row]), "b": pa.array(ids[col]), "sim": pa.array(sims[row, col])})

    w = Window.partitionBy("a").orderBy((F.col("a") != F.col("b")).cast("int"), F.desc("sim"), "b")

    def first(met: DataFrame) -> DataFrame:
        met = met.groupBy("a", "b").agg(F.max("sim").alias("sim"))
        return met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= knn).select("a", "b", "rank", "sim")

    found = None
    for i in range(rounds):
        some = bins.where(F.pmod(F.xxhash64("bin"), F.lit(rounds)) == i).join(own, "id").select("bin", "id", "fs", "vs")
        met = first(some.groupBy("bin").applyInArrow(best, "a long, b long, sim double"))
        if rounds == 1:
            return met
        met = met.drop("rank").checkpoint()
        found = met if found is None else found.union(met)
        release(spark)
    return first(found)


def agreement(similarity: float, functions: int, loss: float = 1e-9) -> int:
    """The number of min-hash functions in which sets of this Jaccard similarity agree, but for a chance of `loss` at most."""
    below, least = 0.0, 0
    while least < functions:
        below += math.comb(functions, least) * similarity**least * (1 - similarity) ** (functions - least)
        if below > loss:
            break
        least += 1
    return least


def alike_groups(bins: DataFrame, signatures: DataFrame, least: int) -> DataFrame:
    """bin, id: the ids of each bin that agree in `least` functions or more, with what they are chained to by such; no group of one.

    A bin is compared all with all by signatures alone (id, k, h, or packed: id, s), 4 bytes for a function; many small
    bins are compared at once. Equal groups of several bins are one.
    """
    packed = signatures
    if "s" not in signatures.columns:
        packed = signatures.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("k", "h"))).alias("s")).select("id", F.transform("s", lambda x: (x["h"] - F.lit(UNSET).cast("long")).cast("int")).alias("s"))

    def grouped(bin_: np.ndarray, ids: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
        """Of whole bins in order."""
        fresh = np.concatenate([[True], (bin_[1:] != bin_[:-1]) | (ids[1:] != ids[:-1])])
        bin_, ids, s = bin_[fresh], ids[fresh], s[fresh]
        start = np.flatnonzero(np.concatenate([[True], bin_[1:] != bin_[:-1]]))
        size = np.diff(start, append=len(bin_))
        root = np.arange(len(bin_))
        for lo, m in zip(start[size > 64].tolist(), size[size > 64].tolist(), strict=True):
            same = np.zeros((m, m), np.uint16)
            for k in range(s.shape[1]):
                same += s[lo : lo + m, k][:, None] == s[lo : lo + m, k][None, :]
            root[lo : lo + m] = lo + _chains(same >= least)
        end = np.repeat(np.where(size > 64, 0, start + size), size)
        at, pairs = np.flatnonzero(end), []
        for d in range(1, 64):
            at = at[at + d < end[at]]
            if not len(at):
                break
            i = at[(s[at] == s[at + d]).sum(axis=1) >= least]
            pairs.append((i, i + d))
        if pairs:
            u, v = (np.concatenate(x) for x in zip(*pairs, strict=True))
            some, place = np.unique(np.concatenate([u, v]), return_inverse=True)
            root[some] = some[_joined(len(some), place[: len(u)], place[len(u) :])[0]]
        many = np.bincount(root, minlength=len(root))[root] > 1
        keep = np.flatnonzero(many)
        keep = keep[np.argsort(root[keep], kind="stable")]
        cuts = np.flatnonzero(np.diff(root[keep])) + 1
        # a group is named by its members, wherever it is found
        name = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) for x in np.split(ids[keep], cuts)] if len(keep) else []
        each = np.diff(np.concatenate([[0], cuts, [len(keep)]])) if len(keep) else 0
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(name, np.int64), each)), pa.array(ids[keep])], ["bin", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not len(batch):
                continue
            bin_, ids = np.asarray(batch.column("bin")), np.asarray(batch.column("id"))
            s = np.asarray(batch.column("s").flatten()).reshape(len(batch), -1)
            # what belongs to the last bin waits for the rest of it
            cut = int(np.searchsorted(bin_, bin_[-1]))
            held.append((bin_[:cut], ids[:cut], s[:cut]))
            if cut or held[0][0][0] != bin_[-1]:
                if sum(len(x[0]) for x in held):
                    yield grouped(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            held.append((bin_[cut:], ids[cut:], s[cut:]))
        if held:
            yield grouped(*(np.concatenate(x) for x in zip(*held, strict=True)))

    rows = bins.join(packed, "id").select("bin", F.col("id").cast("long"), "s")
    return rows.repartition("bin").sortWithinPartitions("bin", "id").mapInArrow(run, "bin long, id long").distinct()


def _chains(same: np.ndarray) -> np.ndarray:
    """The least place that each is chained to by a symmetric matrix."""
    root, seen = np.arange(len(same)), np.zeros(len(same), bool)
    for i in np.flatnonzero(same.sum(axis=1) > 1).tolist():
        if seen[i]:
            continue
        reach, done = same[i].copy(), np.zeros(len(same), bool)
        while len(new := np.flatnonzero(reach & ~done)):
            done[new] = True
            reach |= same[new].any(axis=0)
        root[done] = i
        seen |= done
    return root


def _joined(m: int, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Of m places the least that each is joined with by pairs (u, v), and pairs that join what no earlier one has joined."""
    root = list(range(m))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    found = []
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        p, q = top(a), top(b)
        if p != q:
            root[max(p, q)] = min(p, q)
            found.append((a, b))
    return np.array([top(x) for x in range(m)], dtype=np.int64), found


def bin_links(bins: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """a, b: of the ids of each bin that chains of feature sets (id, fs) with a Jaccard similarity of `least` or more join, the
    first with each of the others.

    A bin is compared exactly, all with all.
    """
    rows = bins.join(sets, "id").select("bin", "id", "fs")

    def joined(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ids, fs = np.asarray(t.column("id")), t.column("fs").combine_chunks()
        m = len(ids)
        n = np.asarray(pc.list_value_length(fs)).astype(np.int64)
        f = np.asarray(pc.list_flatten(fs))
        both = _products(np.repeat(np.arange(m), n), f, np.ones(len(f)), m)
        # what no product has added up is zero; each is alike to itself
        alike = both >= least * (n[:, None] + n[None, :] - both) - 1e-9
        np.fill_diagonal(alike, True)
        root = _chains(alike)
        b = np.flatnonzero(root != np.arange(m))
        return pa.table({"a": pa.array(ids[root[b]]), "b": pa.array(ids[b])})

    return rows.groupBy("bin").applyInArrow(joined, "a long, b long")


def approx_knn(features: DataFrame, nhf: int, knn: int, depth: int = 2, most: int = 1000) -> DataFrame:
    """Signatures of nhf functions, a forest of nhf / depth trees, and exact comparison inside its bins."""
    trees = max(1, nhf // depth)
    return bin_neighbors(forest_bins(minhash_signature(features, trees * depth), trees, depth, most), features, knn)


def dense_dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, z: s + z)


def unit(vectors: DataFrame) -> DataFrame:
    """id, vec scaled to length one (zero vectors stay)."""
    norm = F.sqrt(dense_dot(F.col("vec"), F.col("vec")))
    return vectors.withColumn("vec", F.transform("vec", lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0))))


def _greatest(sims: np.ndarray, knn: int, slack: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Places of all that can be among a row's greatest knn: knn of the greatest of slices are knn of the row, what lies
    below the least of them (by more than `slack`) can't be among the best."""
    m, n = sims.shape
    if n <= 4 * knn:
        return np.repeat(np.arange(m), n), np.tile(np.arange(n), m)
    slices = min(n // 2, max(64, 4 * knn))
    top = np.maximum.reduceat(sims, np.arange(slices) * n // slices, axis=1)
    return np.nonzero(sims >= (np.partition(top, slices - knn, axis=1)[:, slices - knn] - slack)[:, None])


def exact_knn(queries: DataFrame, vectors: DataFrame, knn: int, block: int = 1024) -> DataFrame:
    """a, b, rank, sim: the knn largest dot products of each query over all vectors, itself included (ties: smaller id)."""
    last = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return block_products(queries, vectors, knn, block).withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= knn).select("a", "b", "rank", "sim")


def block_products(queries: DataFrame, vectors: DataFrame, knn: int | None = None, block: int = 1024, parts: int = 16) -> DataFrame:
    """a, b, sim: of each query and part of the vectors the knn largest dot products (none: all of them).

    Queries and vectors are packed into blocks of about `block` rows, the vectors' blocks dealt to `parts` parts. A pair
    of blocks is one matrix product; a block of queries meets those of a part one after another and keeps its best knn
    of them, so rows that leave grow with the queries, not with all pairs of blocks; the JVM merges these. What a task
    holds is two blocks, their product and the best so far.
    """

    def packed(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
        n = df.count()
        rows = df.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // block)))))
        rows = rows.repartition(parts, "_b") if parts else rows
        return rows.groupBy("_b").agg(F.collect_list(F.struct("id", "vec")).alias(name)).withColumnRenamed("_b", f"_{name}")

    def best(sims: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, b and rounded product of each row's largest `knn` (ties: smaller b), in order."""
        m, n = sims.shape
        row, col = (np.repeat(np.arange(m), n), np.tile(np.arange(n), m)) if knn is None else _greatest(sims, knn, 2e-6)
        sim, b = np.round(sims[row, col], 6), b[col]
        return first(row, b, sim)

    def first(row: np.ndarray, b: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort([b, -sim, row])
        row, b, sim = row[order], b[order], sim[order]
        if knn is not None:
            here = np.arange(len(row)) - np.searchsorted(row, row) < knn
            row, b, sim = row[here], b[here], sim[here]
        return row, b, sim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts(cell: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
            ids = np.asarray(cell.values.field("id"))
            return ids, np.asarray(cell.values.field("vec").flatten(), dtype=np.float64).reshape(len(ids), -1)

        def made(a: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a[found[0]]), pa.array(found[1]), pa.array(found[2])], ["a", "b", "sim"])

        at, held = None, None
        for batch in batches:
            for key, x, y in zip(batch.column("_x").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                if key != at:
                    if held is not None:
                        yield made(a, held)
                    (a, u), at, held = parts(x), key, None
                b, v = parts(y)
                found = best(u @ v.T, b)
                if knn is None:
                    yield made(a, found)
                else:
                    held = found if held is None else first(*(np.concatenate(c) for c in zip(held, found, strict=True)))
        if held is not None:
            yield made(a, held)

    # all pairs of blocks are the operation itself; neither side is small enough to be sent to all
    pairs = packed(queries, "x").crossJoin(packed(vectors, "y", parts).drop("_y").hint("shuffle_replicate_nl"))
    return pairs.mapInArrow(run, "a long, b long, sim double")


def packed(features: DataFrame) -> DataFrame:
    """id, fs, vs: a row for each id, features in order."""
    pairs = F.array_sort(F.collect_list(F.struct("f", "v")))
    return features.groupBy("id").agg(pairs.alias("p")).select("id", F.transform("p", lambda x: x["f"]).alias("fs"), F.transform("p", lambda x: x["v"]).alias("vs"))


def exact_sparse_knn(features: DataFrame, knn: int, block: int = 1024, parts: int = 16) -> DataFrame:
    """a, b, rank, sim: of each id itself and the others with the largest dot products, knn in all (ties: smaller id).

    Ids go by blocks of about `block`, dealt to `parts` parts. A block meets those of a part one after another and keeps
    each id's best knn of them, so nothing of the size of all pairs is ever stored. The number of block pairs grows with
    the square of the ids: this is the yardstick for approx_knn, and for tables of moderate size.
    """
    rows = packed(features)
    n = rows.count()

    def blocks(name: str) -> DataFrame:
        dealt = rows.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // block))))).repartition(parts, "_b")
        return dealt.groupBy("_b").agg(F.collect_list(F.struct("id", "fs", "vs")).alias(name)).withColumnRenamed("_b", f"_{name}")

    def best(row: np.ndarray, b: np.ndarray, rank: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort([b, -rank, row])
        row = row[order]
        order = order[np.arange(len(row)) - np.searchsorted(row, row) < knn]
        return row[np.arange(len(row)) - np.searchsorted(row, row) < knn], b[order], rank[order], sim[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(a: np.ndarray, held: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a[held[0]]), pa.array(held[1]), pa.array(held[3])], ["a", "b", "sim"])

        at, held = None, None
        for batch in batches:
            for p, q, x, y in zip(batch.column("_x").to_pylist(), batch.column("_y").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                if p != at:
                    if held is not None:
                        yield made(a, held)
                    (a, own), at, held = _laid(x), p, None
                b, other = _laid(y)
                sims = np.round(_cross(own, other, len(a), len(b)), 6)
                rank = sims.copy()
                if p == q:
                    rank[a[:, None] == b[None, :]] = np.inf
                row, col = _greatest(rank, knn)
                found = best(row, b[col], rank[row, col], sims[row, col])
                held = found if held is None else best(*(np.concatenate(c) for c in zip(held, found, strict=True)))
        if held is not None:
            yield made(a, held)

    w = Window.partitionBy("a").orderBy((F.col("a") != F.col("b")).cast("int"), F.desc("sim"), "b")
    pairs = blocks("x").crossJoin(blocks("y").hint("shuffle_replicate_nl"))
    return pairs.mapInArrow(run, "a long, b long, sim double").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= knn).select("a", "b", "rank", "sim")


def recall(approx: DataFrame, true: DataFrame, knn: int) -> DataFrame:
    """One row: the share of true neighbours' places that approx fills as well, over all ids; ties with the last count as found."""
    last = true.groupBy("a").agg(F.min("sim").alias("least"))
    good = approx.join(last, "a").where(F.col("sim") >= F.col("least")).groupBy("a").agg(F.count("*").alias("hit"))
    every = last.join(good, "a", "left")
    return every.agg((F.round(F.sum(F.least(F.coalesce("hit", F.lit(0)), F.lit(knn))) / (F.count("*") * knn), 6)).alias("recall"), F.count("*").alias("instances"))


def kernel_matrix(features: DataFrame, block: int = 1024, parts: int = 16) -> DataFrame:
    """i, j, sim of all pairs with a common feature; i <= j.

    Ids go by blocks and each two blocks meet once, so what is shuffled are features, not the pairs that share one.
    """
    rows = packed(features.where("id is not null and f is not null"))
    n = rows.count()

    def blocks(name: str) -> DataFrame:
        dealt = rows.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // block))))).repartition(parts, "_b")
        return dealt.groupBy("_b").agg(F.collect_list(F.struct("id", "fs", "vs")).alias(name)).withColumnRenamed("_b", f"_{name}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            for p, q, x, y in zip(batch.column("_x").to_pylist(), batch.column("_y").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                if p != at:
                    (a, own), at = _laid(x), p
                b, other = _laid(y)
                met = _cross(own, other, len(a), len(b), common=True)
                sims = _cross(own, other, len(a), len(b))
                keep = met > 0.5
                if p == q:
                    keep &= a[:, None] <= b[None, :]
                for lo in range(0, len(a), 256):
                    u, v = np.nonzero(keep[lo : lo + 256])
                    i, j = a[lo + u], b[v]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(np.round(sims[lo + u, v], 6))], ["i", "j", "sim"])

    pairs = blocks("x").crossJoin(blocks("y").hint("shuffle_replicate_nl")).where("_x <= _y")
    return pairs.mapInArrow(run, "i long, j long, sim double")


def full_ranking(vectors: DataFrame, cells: int = 1 << 24, block: int = 1024, parts: int = 64) -> DataFrame:
    """a, b, sim, rank: each vector's dot products with all others, ranked (ties: smaller id).

    A block of queries meets all blocks of vectors one after another in one task and is ranked there, so nothing of the
    size of all pairs is shuffled or sorted by the JVM. Blocks of queries shrink as the table grows: what a task holds is
    `cells` products, three times over while they are put in order.
    """
    n = vectors.count()
    width = max(1, min(block, cells // max(1, n)))

    def blocks(name: str, size: int, parts: int) -> DataFrame:
        rows = vectors.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // size))))).repartition(parts, "_b")
        return rows.groupBy("_b").agg(F.collect_list(F.struct("id", "vec")).alias(name)).withColumnRenamed("_b", f"_{name}")

    def ranked(a: np.ndarray, sims: list[np.ndarray], ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        b = np.concatenate(ids)
        order = np.argsort(b, kind="stable")
        b, micro = b[order], np.rint(np.concatenate(sims, axis=1)[:, order] * 1e6)
        place = np.arange(len(b))
        for i, row in zip(a, micro, strict=True):
            if len(b) < 1 << 24 and np.abs(row).max() < 1 << 38:
                # place and product in one number: no two are equal, and its order is the one asked for
                first = np.sort((-row.astype(np.int64) << 24) | place) & ((1 << 24) - 1)
            else:
                first = np.argsort(-row, kind="stable")
            first = first[b[first] != i]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), i)), pa.array(b[first]), pa.array(row[first] / 1e6), pa.array(np.arange(1, len(first) + 1, dtype=np.int32))], ["a", "b", "sim", "rank"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def laid(cell: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
            ids = np.asarray(cell.values.field("id"))
            return ids, np.asarray(cell.values.field("vec").flatten(), dtype=np.float64).reshape(len(ids), -1)

        at, sims, ids = None, [], []
        for batch in batches:
            for key, x, y in zip(batch.column("_x").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                if key != at:
                    if sims:
                        yield from ranked(a, sims, ids)
                    (a, u), at, sims, ids = laid(x), key, [], []
                b, v = laid(y)
                sims.append(u @ v.T)
                ids.append(b)
        if sims:
            yield from ranked(a, sims, ids)

    # one part of vectors: a task sees all of them, block by block
    pairs = blocks("x", width, parts).crossJoin(blocks("y", block, 1).drop("_y").hint("shuffle_replicate_nl"))
    return pairs.mapInArrow(run, "a long, b long, sim double, rank int")


def knn_accuracy(approx: DataFrame, true: DataFrame, knn: int, n: int) -> DataFrame:
    """One row: mean over the ids of `true` of the common neighbours' share of min(knn, n)."""
    both = true.select("a", "b").join(approx.select("a", "b"), ["a", "b"]).groupBy("a").agg(F.count("*").alias("hit"))
    every = true.select("a").distinct().join(both, "a", "left")
    return every.agg(F.round(F.avg(F.coalesce("hit", F.lit(0)) / min(knn, n)), 6).alias("accuracy"), F.count("*").alias("instances"))


def knn_predict(neighbors: DataFrame, labels: DataFrame) -> DataFrame:
    """id, predicted: the most frequent label among the neighbours other than the id itself (ties: least label, none last)."""
    return predicted(neighbors.where("a <> b").join(labels.select(F.col("id").alias("b"), "label"), "b"))


def predicted(votes: DataFrame) -> DataFrame:
    """knn_predict of neighbours (a, label) that have their labels already."""
    w = Window.partitionBy("a").orderBy(F.desc("n"), F.asc_nulls_last("label"))
    votes = votes.groupBy("a", "label").agg(F.count("*").alias("n"))
    return votes.withColumn("r", F.row_number().over(w)).where("r = 1").select(F.col("a").alias("id"), F.col("label").alias("predicted"))


def bin_statistics(signatures: DataFrame) -> DataFrame:
    """num, sum, avg, sd (sample), min, q05 to q95 (elements at floor(n * q)), max of the bin sizes."""
    sizes = bins(signatures)
    return order_statistics(sizes, "size")


def order_statistics(df: DataFrame, column: str, quantiles: tuple[float, ...] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """One row of statistics; a quantile is the element at floor(n * q) of the sorted values.

    Equal values are counted first, so the sorted part has a row for each different value.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("x")).agg(F.count("*").alias("c"))
    upto = Window.orderBy("x")
    placed = counted.withColumn("upto", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(Window.partitionBy()))
    picks = [F.min(F.when(F.col("upto") > F.floor(F.col("n") * q), F.col("x"))).alias(f"q{round(q * 100):02d}") for q in quantiles]
    mean = F.sum(F.col("x") * F.col("c")) / F.sum("c")
    square = F.sum(F.col("x").cast("double") * F.col("x") * F.col("c")) - F.pow(F.sum(F.col("x") * F.col("c")), F.lit(2)) / F.sum("c")
    return placed.agg(
        F.sum("c").alias("num"), F.sum(F.col("x") * F.col("c")).alias("sum"), F.round(mean, 6).alias("avg"),
        F.round(F.sqrt(F.greatest(square, F.lit(0.0)) / F.nullif(F.sum("c") - 1, F.lit(0))), 6).alias("sd"), F.min("x").alias("min"), *picks, F.max("x").alias("max"),
    )
