"""One-permutation min-hash fingerprints of documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandloom.llm import textbuf as tb
from strandloom.llm.ordered import by_id

U = tb.U
BINS, BITS, WORDS = 256, 4, 5
_HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)
_MIX = tb.mix(np.arange(1, WORDS + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F)) | U(1)


def shingles(h: np.ndarray, counts: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words and the document of each; a document of fewer words (even none) has one, of them all."""
    first = np.cumsum(counts) - counts
    n = np.maximum(counts - k + 1, 1)
    doc = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + first[doc]
    out = np.zeros(len(doc), dtype=U)
    padded = np.append(h, U(0))
    for j in range(k):
        inside = at + j < (first + counts)[doc]
        out += np.where(inside, padded[np.minimum(at + j, len(h))] * _MIX[j], U(0))
    return tb.mix(out), doc


def signatures(texts: pa.Array) -> np.ndarray:
    """BINS low-order codes of each text, one row each.

    Each distinct shingle hash falls into the bin that its top bits name; a bin keeps its least hash. An empty bin
    takes the value of a full one, drawn by hashes of its own number until one is met, the same draws for every text.
    """
    buf, docs = tb.joined(texts)
    buf = tb.LOWER[buf]
    starts, ends = tb.words(buf, ~tb.SPACE)
    s, doc = shingles(tb.hashes(buf, starts, ends), tb.owner(starts, docs))
    none = np.iinfo(U).max
    least = np.full(len(texts) * BINS, none, dtype=U)
    np.minimum.at(least, doc * BINS + (s >> U(56)).astype(np.int64), s & U((1 << 56) - 1))
    least = least.reshape(len(texts), BINS)
    full = least != none
    row, col = np.nonzero(~full)
    for draw in range(1, 100_000):
        if not len(row):
            break
        pick = (tb.mix(col.astype(U) * U(0x9E3779B97F4A7C15) + U(draw * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)) & U(BINS - 1)).astype(np.int64)
        hit = full[row, pick]
        least[row[hit], col[hit]] = least[row[hit], pick[hit]]
        row, col = row[~hit], col[~hit]
    return (least & U((1 << BITS) - 1)).astype(np.uint8)


def packed(codes: np.ndarray) -> list[str]:
    """A hexadecimal digit for each bin."""
    return [bytes(r).decode("ascii") for r in _HEX[codes]]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of the shingle sets: the share of equal codes less what chance makes equal."""
    chance = 1 / (1 << BITS)
    return np.clip(((a == b).mean(axis=-1) - chance) / (1 - chance), 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of each document: 256 bins of 4 bits, as 256 hexadecimal digits.

    Shingles are five words in lower case (A-Z); fewer words make one shingle, an empty or null text the empty one.
    Equal texts have equal fingerprints. Repeated rows each give a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in tb.slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed(signatures(part.column("text"))), pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


_PAIRED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document in ascending doc_id.

    After the last document comes the first. Documents of equal doc_id follow one another by text; those without
    come last; null text is empty. A single document is its own successor. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int | None, str]] = []  # the last row waits for its successor

        def done(rows: list[tuple[int, int, int | None, str]]) -> Iterator[pa.RecordBatch]:
            own = [i for i in range(len(rows) - 1) if not rows[i][1]]
            if not own:
                return
            texts = [r[3] for r in rows]
            changed = [edited(texts[i], texts[i + 1]) for i in own]
            sig = signatures(pa.array(texts, pa.large_string()))
            other = signatures(pa.array(changed, pa.large_string()))
            at = np.array(own)
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][2] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
                pa.array(packed(sig[at]), pa.string()), pa.array(packed(other), pa.string()), pa.array(likeness(sig[at], other)), pa.array(likeness(sig[at], sig[at + 1])),
            ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for batch in batches:
            for lo, hi in tb.slices(batch.column("text"), rows=1024):
                part = batch.slice(lo, hi - lo)
                held += zip(*(part.column(c).to_pylist() for c in ("bucket", "look", "doc_id", "text")), strict=True)
                yield from done(held)
                held = held[-1:]

    return by_id(docs, lookahead=True).mapInArrow(run, _PAIRED)
