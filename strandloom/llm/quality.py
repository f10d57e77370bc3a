"""Document quality from a conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textbuf as tb
from strandloom.llm.crf import chains, marginals


#: Labelled documents of each label that are learnt from, about; chosen by a hash of doc_id.
SAMPLE = 600
#: Probability that a line's label differs from its document's.
NOISE = 0.1
#: Ridge on the transitions. Labelled documents hardly ever change sides, which says little about those that do: what
#: lines look like shall decide, and transitions no more than they must.
RIGID = 0.03
_OWN = 16

_CLASS = np.zeros(256, dtype=np.int64)  # 0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 sentence marks, 6 symbols, 7 bar, 8 exclamation
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[128:] = 2
_CLASS[48:58] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 5
_CLASS[[ord(c) for c in "#$%&*+/<=>@[]\\^_`{}~"]] = 6
_CLASS[ord("|")] = 7
_CLASS[ord("!")] = 8


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, length in bytes and document of every line that has a word.

    A line's own: shares of kinds of bytes, words repeated at once or elsewhere in the line, words ending in symbols,
    word lengths; then the same of the line before and after in its document (zeros at the ends), and a constant.
    """
    buf, docs = tb.joined(texts)
    starts, ends = tb.words(buf, ~tb.SPACE)
    if not len(starts):
        return np.zeros((0, 3 * _OWN + 1)), np.zeros(0), np.zeros(0, np.int64)
    breaks = np.flatnonzero(buf == 10)
    line = np.searchsorted(breaks, starts)
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    n = np.diff(np.append(first, len(line)))
    lo, hi = starts[first], ends[np.append(first[1:], len(line)) - 1]
    kind = _CLASS[buf]
    size = (hi - lo).astype(float)
    edge = np.append(lo, len(buf))
    share = [np.add.reduceat(kind == k, edge[:-1], dtype=np.int64) / size for k in (1, 2, 3, 5, 6, 7, 8)]
    h = tb.hashes(tb.LOWER[buf], starts, ends)
    same_line = np.concatenate([[False], line[1:] == line[:-1]])
    again = np.concatenate([[False], h[1:] == h[:-1]]) & same_line
    nth = np.repeat(np.arange(len(first)), n)
    code = tb.mix(h ^ tb.mix(nth.astype(np.uint64)))
    order = np.argsort(code)
    seen = np.zeros(len(code), dtype=bool)
    seen[order[1:]] = code[order[1:]] == code[order[:-1]]
    word = (ends - starts).astype(float)
    odd_end = np.isin(kind[ends - 1], (6, 8)) & (word > 1)
    sums = [np.add.reduceat(x, first) / n for x in (again.astype(float), seen.astype(float), odd_end.astype(float), (kind[starts] == 7).astype(float), np.isin(kind[starts], (1,)).astype(float), word / 8)]
    own = np.stack([*share, *sums, np.minimum(n, 60) / 60, np.log(size) / 8, np.isin(buf[hi - 1], (33, 46, 63)).astype(float)], axis=1)
    doc = np.searchsorted(docs, lo, "right") - 1
    together = (doc[1:] == doc[:-1])[:, None]
    empty = np.zeros((1, _OWN))
    before = np.concatenate([empty, own[:-1] * together])
    after = np.concatenate([own[1:] * together, empty])
    return np.concatenate([own, before, after, np.ones((len(own), 1))], axis=1), size, doc


class LineModel:
    """Weights of line features and of label transitions; label 1 is good."""

    def __init__(self, weights: np.ndarray, transition: np.ndarray, slope: float = 1.0, offset: float = 0.0, none: float = 0.5) -> None:
        self.weights, self.transition, self.slope, self.offset, self.none = weights, transition, slope, offset, none

    def lines(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginal probability of being good, length in bytes and text of every line that has a word."""
        x, size, doc = line_features(texts)
        return marginals(x @ self.weights, *chains(doc), self.transition)[0][:, 1], size, doc

    def share(self, texts: pa.Array) -> np.ndarray:
        """Length-weighted mean of the lines' probabilities; texts without words: not a number."""
        p, size, doc = self.lines(texts)
        total = np.bincount(doc, weights=size, minlength=len(texts))
        with np.errstate(invalid="ignore"):
            return np.bincount(doc, weights=size * p, minlength=len(texts)) / total

    def score(self, texts: pa.Array) -> np.ndarray:
        p = np.clip(self.share(texts), 1e-6, 1 - 1e-6)
        return np.where(np.isnan(p), self.none, 1 / (1 + np.exp(-(self.slope * np.log(p / (1 - p)) + self.offset))))


def train(texts: list[str], labels: list[int], steps: int = 150, penalty: float = 1e-3, rigid: float = RIGID) -> LineModel:
    """The lines' labels are latent: a document's label is seen on each of its lines, wrongly with probability NOISE.

    The likelihood of what is seen is climbed by Adam; its gradient is the difference of two runs of forward-backward,
    with and without the seen labels. So a line that looks like those of the other kind may have their label, and
    transitions learn how often labels change inside documents. Then the share of good lines is calibrated against the
    documents' labels.
    """
    y = np.array(labels, dtype=np.int64)
    column = pa.array(texts, pa.large_string())
    x, size, doc = line_features(column)
    if not len(doc) or len(set(labels)) < 2:
        flat = float(y.mean()) if len(y) else 0.5
        c = np.log((flat + 1e-3) / (1 - flat + 1e-3))
        return LineModel(np.zeros((x.shape[1], 2)), np.zeros((2, 2)), 0.0, c, flat)
    runs = chains(doc)
    seen = np.log(np.where(np.eye(2, dtype=bool)[y[doc]], 1 - NOISE, NOISE))
    theta = np.zeros((x.shape[1] + 2, 2))
    ridge = np.where(np.arange(len(theta)) < x.shape[1], penalty, rigid)[:, None]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        emission = x @ theta[:-2]
        free, moves, _ = marginals(emission, *runs, theta[-2:], pairs=True)
        held, told, _ = marginals(emission + seen, *runs, theta[-2:], pairs=True)
        g = np.concatenate([x.T @ (free - held), moves - told]) / len(doc) + ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model = LineModel(theta[:-2], theta[-2:])
    share = model.share(column)
    has = ~np.isnan(share)
    p = np.clip(share[has], 1e-6, 1 - 1e-6)
    z, t = np.log(p / (1 - p)), y[has]
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-(a * z + b)))
        w = q * (1 - q) + 1e-9
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [((q - t) * z).sum() + 1e-3 * (a - 1), (q - t).sum() + 1e-3 * b])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    blank = y[~has]
    return LineModel(theta[:-2], theta[-2:], float(a), float(b), float((blank.sum() + 0.5 * 2) / (len(blank) + 2)))


def learn(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> LineModel:
    """A model from about `sample` labelled documents of each label among those for which `usable` holds.

    The sample is the only bounded thing: rows whose doc_id hashes below a share of the range, the share being that of
    `sample` in the label's count. A document with several labels counts with each; null labels aren't used.
    """
    marked = labels.where(F.col("quality").isin(0, 1) & usable).select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y"))
    counts = {r["_y"]: r["n"] for r in marked.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.col("_id"), F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    limit = F.coalesce(*[F.when(F.col("_y") == k, F.lit(sample / n)) for k, n in counts.items()], F.lit(0.0))
    some = marked.where(place < limit)
    # at most about twice the sample, by the counts just taken
    rows = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_y").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["_y"], r["text"] or ""))
    return train([r["text"] or "" for r in rows], [r["_y"] for r in rows])


def score(docs: DataFrame, model: LineModel) -> DataFrame:
    """doc_id, score (0 to 1, higher: better) of every document; a text without words has the model's rate for these.

    Repeated rows each give a row; an empty table gives none. A document is one chain, however many lines it has.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in tb.slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sent.value.score(part.column("text")))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: LineModel, least: float = 0.5) -> DataFrame:
    """The documents (doc_id, text, lang, source, n_chars) with a score of at least `least`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in tb.slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(sent.value.score(part.column("text")) >= least))

    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return rows.mapInArrow(run, rows.schema)


