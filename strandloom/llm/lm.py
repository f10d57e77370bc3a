"""Language-model scores of documents by a probabilistic suffix tree over words, beside a unigram base."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textbuf as tb
from strandloom.llm.shared import cut, parts, release
from strandloom.llm.suffix_tree import END, Texts

U = tb.U
#: A context occurs so often at least, and gains so many nats; neither grows with the table.
LEAST, NATS = 2, 2.0
#: Bytes of the texts that ask for their counts together, and of those that a step holds.
SLICE, STEP = 8 << 20, 2 << 20
#: Gains travel as whole numbers of 1 / SCALE nats.
SCALE = 256

WORDS, RUNS, CONTEXTS = range(3)
_SLICES = "slice long, ids array<long>, held array<boolean>, sizes array<int>, words binary, codes binary"
_ASKS = "slice long, kind int, bucket int, keys binary, sums binary"


def _squeezed(x: np.ndarray) -> bytes:
    """An array's bytes, equal places together, compressed, behind their number."""
    flat = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T)
    return len(x).to_bytes(8, "little") + (pa.Codec("zstd", 1).compress(flat.tobytes(), asbytes=True) if len(x) else b"")


def _restored(x: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(x[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    flat = np.frombuffer(pa.Codec("zstd").decompress(x[8:], n * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).view(kind).ravel()


def _keys(x: bytes) -> np.ndarray:
    """Sorted keys, which travel as differences."""
    return np.cumsum(_restored(x, "<u8"), dtype=U)


def pack(rows: DataFrame) -> DataFrame:
    """Slices of about SLICE bytes of texts: their documents, the hashes of their different words, and codes of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_id = TaskContext.get().partitionId() << 32
        found: list[tuple[np.ndarray, np.ndarray]] = []
        ids: list[int | None] = []
        flags: list[bool] = []
        held = 0

        def flush() -> pa.RecordBatch:
            coded = pa.array(np.concatenate([h for h, _ in found])).dictionary_encode()
            words = np.asarray(coded.dictionary)
            order = np.argsort(words)
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            words = words[order]
            sizes = np.concatenate([n for _, n in found]).astype(np.int32)
            return pa.RecordBatch.from_arrays([
                pa.array([slice_id], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int32())),
                pa.array([_squeezed(np.diff(words, prepend=U(0)))], pa.binary()), pa.array([_squeezed(rank[np.asarray(coded.indices)])], pa.binary()),
            ], ["slice", "ids", "held", "sizes", "words", "codes"])

        for batch in batches:
            col = batch.column("text")
            for lo, hi in tb.slices(col, STEP):
                buf, docs = tb.joined(col.slice(lo, hi - lo))
                buf = tb.LOWER[buf]
                starts, ends = tb.words(buf, ~tb.SPACE)
                counts = tb.owner(starts, docs)
                found.append((np.insert(tb.hashes(buf, starts, ends), np.cumsum(counts), END), counts + 1))
                ids += batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                flags += batch.column("held_out").slice(lo, hi - lo).to_pylist()
                held += len(buf)
                if held >= SLICE:
                    yield flush()
                    slice_id, found, ids, flags, held = slice_id + 1, [], [], [], 0
        if ids:
            yield flush()

    return rows.mapInArrow(run, _SLICES)


def _texts(row: dict) -> Texts:
    return Texts(_keys(row["words"]), _restored(row["codes"], "<u4"), np.array(row["sizes"], dtype=np.int64), np.array(row["held"], dtype=bool))


def _edges(keys: np.ndarray, top: int, n: int) -> np.ndarray:
    """Where each bucket begins in the sorted keys of `top` bits: buckets are ranges of hashes."""
    return np.append(np.searchsorted(keys, np.array([b * (1 << top) // n for b in range(n)], dtype=U)), len(keys))


def _sent(slice_id: int, kind: int, keys: np.ndarray, sums: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    edge = _edges(keys, 64 if kind == WORDS else 63, n)
    has = np.flatnonzero(edge[1:] > edge[:-1]).tolist()
    for lo in range(0, len(has), 64):
        some = has[lo : lo + 64]
        m = len(some)
        yield pa.RecordBatch.from_arrays([
            pa.array([slice_id] * m, pa.int64()), pa.array([kind] * m, pa.int32()), pa.array(some, pa.int32()),
            pa.array([_squeezed(np.diff(keys[edge[b] : edge[b + 1]], prepend=U(0))) for b in some], pa.binary()), pa.array([_squeezed(sums[edge[b] : edge[b + 1]]) for b in some], pa.binary()),
        ], ["slice", "kind", "bucket", "keys", "sums"])


def _received(answers: list[dict], kind: int, number: str) -> np.ndarray:
    """What came back for the sorted keys of a kind: buckets are ranges, so their answers follow one another."""
    own = sorted((r["bucket"], r["found"]) for r in answers if r["kind"] == kind)
    return np.concatenate([np.zeros(0, number), *[_restored(x, number) for _, x in own]])


def _answered(asks: DataFrame, nats: float) -> DataFrame:
    """slice, kind, bucket, found, total, kinds: to each slice the sums of its keys over all slices, or for contexts whether they are kept.

    total and kinds are a bucket's sum and its number of keys with a sum above zero.
    """

    def answer(t: pa.Table) -> pa.Table:
        own = [_keys(x.as_py()) for x in t.column("keys")]
        size = np.cumsum([len(x) for x in own])[:-1]
        keys = np.concatenate(own)
        order = np.argsort(keys)
        keys = keys[order]
        edge = np.append(True, keys[1:] != keys[:-1])
        sums = np.add.reduceat(np.concatenate([_restored(x.as_py(), "<i8") for x in t.column("sums")])[order], np.flatnonzero(edge))
        kind = t.column("kind")[0].as_py()
        values = (sums >= nats * SCALE).astype(np.uint8) if kind == CONTEXTS else sums
        back = np.empty(len(order), values.dtype)
        back[order] = values[np.cumsum(edge) - 1]
        m = len(own)
        return pa.table({
            "slice": t.column("slice"), "kind": t.column("kind"), "bucket": t.column("bucket"), "found": pa.array([_squeezed(x) for x in np.split(back, size)], pa.binary()),
            "total": pa.array([int(sums.sum())] * m, pa.int64()), "kinds": pa.array([int((sums > 0).sum())] * m, pa.int64()),
        })

    return asks.groupBy("kind", "bucket").applyInArrow(answer, "slice long, kind int, bucket int, found binary, total long, kinds long")


def score(docs: DataFrame, held_out: Column, least: int = LEAST, nats: float = NATS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Learns from the documents for which held_out isn't true. Tokens are words and an end for each text (null: empty).
    base_score is a unigram model with one added to each count; it is the tree's root. Below it are contexts of one and
    two words. Each mixes the shorter context's distribution into its own counts; it is kept if it occurs `least` times
    and gains `nats` over the shorter one, by counts that leave out the place that is judged; the longest kept context
    scores a word. So both scores are log10 probabilities of the same tokens.
    Repeated rows each give a row and count; without training rows all probabilities are one, as the base has it.

    The tree is never in one place. Slices of texts send the counts of their words and runs of words to buckets of
    hashes and get the corpus's counts back; then the gains of their contexts, and learn which are kept. What a bucket
    has of a key is a row for each slice at most, so no word, run or context is hot.
    """
    spark = docs.sparkSession
    n = parts(spark)
    packed = cut(pack(docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))))

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = _texts(row)
                yield from _sent(row["slice"], WORDS, t.words, t.counts(), n)
                yield from _sent(row["slice"], RUNS, *t.asked(), n)

    counted = cut(_answered(packed.mapInArrow(asks, _ASKS), nats))
    release(spark)  # what was asked lies behind the cut now
    whole = counted.where(F.col("kind") == WORDS).groupBy("bucket").agg(F.first("total").alias("total"), F.first("kinds").alias("kinds")).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds")).first()
    total, kinds = whole["total"], whole["kinds"]

    def told(left: pa.Table, answers: list[dict]) -> Texts:
        t = _texts(left.to_pylist()[0])
        t.told(_received(answers, WORDS, "<i8"), _received(answers, RUNS, "<i8"), total, kinds)
        return t

    def gains(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, sums = told(left, right.to_pylist()).gains(least)
        rows = list(_sent(left.column("slice")[0].as_py(), CONTEXTS, keys, np.rint(sums * SCALE).astype(np.int64), n))
        return pa.Table.from_batches(rows, schema=rows[0].schema if rows else pa.schema([("slice", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("sums", pa.binary())]))

    def result(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = right.to_pylist()
        t = told(left, answers)
        known, base, best = t.scores(_received(answers, CONTEXTS, "u1").astype(bool), least)
        m = len(known)
        return pa.table({
            "doc_id": pa.array(left.column("ids")[0].as_py(), pa.int64()), "held_out": pa.array(left.column("held")[0].as_py(), pa.bool_()), "n_tokens": pa.array(t.sizes), "n_known": pa.array(known),
            "train_tokens": pa.array([total] * m, pa.int64()), "base_score": pa.array(base), "score": pa.array(best),
        })

    own = packed.groupBy("slice")
    found = counted.select("slice", "kind", "bucket", "found")
    kept = _answered(own.cogroup(found.groupBy("slice")).applyInArrow(gains, _ASKS), nats).select("slice", "kind", "bucket", "found")
    return own.cogroup(found.union(kept).groupBy("slice")).applyInArrow(result, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
