"""Languages of words by a conditional random field, and of documents from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textbuf as tb
from strandloom.llm.crf import chains, marginals

U = tb.U
#: Documents of each language that are learnt from, about; chosen by a hash of doc_id.
SAMPLE = 400
TABLE = 1 << 17


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the weight table for every word, where each word's begin, the word's line and document.

    A word's rows: one for each three bytes around a byte (the word's ends are bytes too, so affixes of two are among
    them), one for its first and one for its last three bytes, and one for the whole word: the lexicon.
    """
    buf, docs = tb.joined(texts)
    buf = tb.LOWER[buf]
    starts, ends = tb.words(buf, ~tb.SPACE)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = ends - starts
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) + np.repeat(starts - first, size)
    b = buf.astype(U)
    padded = np.concatenate([[U(32)], np.where(tb.SPACE[buf], U(32), b), [U(32)]])
    tri = padded[at] | padded[at + 1] << U(8) | padded[at + 2] << U(16)

    def three(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        x = np.zeros(len(p), dtype=U)
        for j in range(3):
            q = p + j
            x |= np.where((q >= lo) & (q < hi), b[np.clip(q, 0, len(b) - 1)], U(0)) << U(8 * j)
        return x

    extra = np.stack([three(starts, starts, ends) | U(1 << 24), three(ends - 3, starts, ends) | U(2 << 24), tb.hashes(buf, starts, ends) | U(1 << 63)], axis=1)
    total = size + 3
    begins = np.cumsum(total) - total
    keys = np.empty(int(total.sum()), dtype=U)
    own = np.arange(len(tri)) + np.repeat(begins - first, size)
    keys[own] = tri
    for j in range(3):
        keys[begins + size + j] = extra[:, j]
    rows = (tb.mix(keys) & U(TABLE - 1)).astype(np.int64)
    return rows, begins, np.searchsorted(np.flatnonzero(buf == 10), starts), np.searchsorted(docs, starts, "right") - 1


class WordModel:
    def __init__(self, names: list[str], table: np.ndarray, transition: np.ndarray) -> None:
        self.names, self.table, self.transition = names, table, transition

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Marginal probability of each language for every word, and the word's document."""
        rows, begins, line, doc = word_features(texts)
        if not len(begins) or not self.names:
            return np.zeros((len(begins), len(self.names))), doc
        return marginals(np.add.reduceat(self.table[rows], begins, axis=0), *chains(line), self.transition)[0], doc

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language whose words hold most of a text by their marginals, and its share; `und` without letters."""
        p, doc = self.words(texts)
        n, k = len(texts), len(self.names)
        buf, docs = tb.joined(texts)
        plain = ((buf >= 65) & (buf < 91)) | ((buf >= 97) & (buf < 123))
        sums = np.zeros((n, max(k, 1)))
        for j in range(k):
            sums[:, j] = np.bincount(doc, weights=p[:, j], minlength=n)
        best = sums.argmax(axis=1)
        share = sums[np.arange(n), best] / np.maximum(sums.sum(axis=1), 1e-300)
        count = np.concatenate([[0], np.cumsum(plain)])
        letters = count[docs[1:]] > count[docs[:-1]]
        wide = np.concatenate([[0], np.cumsum(buf >= 128)])
        for d in np.flatnonzero(~letters & (wide[docs[1:]] > wide[docs[:-1]])).tolist():
            letters[d] = any(map(str.isalpha, buf[docs[d] : docs[d + 1]].tobytes().decode()))
        letters &= k > 0
        return [self.names[b] if x else "und" for b, x in zip(best.tolist(), letters.tolist(), strict=True)], np.where(letters, share, 0.0)


def train(texts: list[str], langs: list[str], epochs: int = 3, batch: int = 32, penalty: float = 1e-4, seed: int = 5) -> WordModel:
    """Words take their document's language; likelihood by AdaGrad over batches of documents."""
    names = sorted(set(langs))
    k = len(names)
    y = np.array([names.index(x) for x in langs], dtype=np.int64)
    table, square = np.zeros((TABLE, k), dtype=np.float64), np.full((TABLE, k), 1e-2)
    transition, tsquare = np.zeros((k, k)), np.full((k, k), 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            rows, begins, line, doc = word_features(pa.array([texts[i] for i in some], pa.large_string()))
            if not len(begins):
                continue
            runs = chains(line)
            p, expected, _ = marginals(np.add.reduceat(table[rows], begins, axis=0), *runs, transition, pairs=True)
            label = y[some][doc]
            # documents count alike, however long
            weight = 1 / np.sqrt(np.bincount(doc, minlength=len(some))[doc])
            p[np.arange(len(label)), label] -= 1
            p *= (weight / weight.sum() * 50)[:, None]
            used, back = np.unique(rows, return_inverse=True)
            spread = np.repeat(p, np.diff(np.append(begins, len(rows))), axis=0)
            g = np.stack([np.bincount(back, weights=spread[:, j], minlength=len(used)) for j in range(k)], axis=1) + penalty * table[used]
            square[used] += g * g
            table[used] -= 0.2 * g / np.sqrt(square[used])
            inner = np.ones(len(label), dtype=bool)
            inner[runs[0]] = False
            at = np.flatnonzero(inner)
            if len(at):
                seen = np.zeros((k, k))
                np.add.at(seen, (label[at - 1], label[at]), 1)
                g = (expected - seen) / len(at) + 3e-3 * transition
                tsquare += g * g
                transition -= 0.2 * g / np.sqrt(tsquare)
    return WordModel(names, table.astype(np.float32), transition)


def learn(docs: DataFrame, usable: Column, sample: int = SAMPLE) -> WordModel:
    """A model from about `sample` documents of each language among those for which `usable` holds and lang isn't null.

    The sample is the only bounded thing: documents whose doc_id hashes below a share of the range, the share being
    that of `sample` in the language's count.
    """
    known = docs.where(F.col("lang").isNotNull() & usable)
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    limit = F.coalesce(*[F.when(F.col("lang") == k, F.lit(sample / n)) for k, n in counts.items()], F.lit(0.0))
    rows = known.where(place < limit).select("doc_id", "text", "lang").collect()
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["lang"], r["text"] or ""))
    return train([r["text"] or "" for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: WordModel) -> DataFrame:
    """doc_id, lang_pred, score of every document: the language with the largest sum of word marginals, and its share.

    `und` with score 0 if the text is null, empty or without letters, or if nothing could be learnt. A chain is
    all words of a line, however many. Languages with equal sums: the first by name. Repeated rows each give a row; an
    empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in tb.slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                names, share = sent.value.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(share)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
