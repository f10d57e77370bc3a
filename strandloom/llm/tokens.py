"""Token ids of documents in files of directly addressable codes."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm import textbuf as tb
from strandloom.llm.codes import Codes, encode
from strandloom.llm.ordered import by_id
from strandloom.llm.shared import table
from strandloom.llm.textbuf import slices

#: Ids in one file, about; a document is never split.
FILE_IDS = 1 << 20
#: Pieces that a worker remembers at most; beyond that it begins anew.
_KNOWN = 2_000_000
#: UTF-8 of white space beyond ASCII.
_WIDE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[w[0] for w in _WIDE]] = True


def _places(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after another."""
    return np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)


def _differ(a: np.ndarray, at: np.ndarray, size: np.ndarray, b: np.ndarray, bat: np.ndarray, bsize: np.ndarray) -> np.ndarray:
    """Which spans of a aren't the span of b beside them, given that their hashes are equal: up to eight bytes, sizes tell."""
    out = size != bsize
    check = np.flatnonzero(~out & (size > 8))
    if len(check):
        n = size[check]
        same = a[_places(at[check], n)] == b[_places(bat[check], n)]
        out[check] = ~np.logical_and.reduceat(same, np.cumsum(n) - n)
    return out


class Encoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library, no special tokens.

    Its pre-tokenisation starts a new piece at every single space between other characters, so what lies between two
    such spaces is encoded once and then found again by its 64-bit hash, size and bytes. A tokenizer whose file says
    otherwise encodes whole texts. Texts with other runs of white
    space, at the ends too, with white space beyond ASCII, or with a piece whose hash another piece has go to the
    library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.bpe = Tokenizer.from_file(path)
        self.bpe.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        rule = told.get("pre_tokenizer") or {}
        self.pieces = told.get("normalizer") is None and rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule.get("add_prefix_space", True)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted; for each, place and number of its ids and of its bytes
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.text_at = np.zeros(0, np.int64)
        self.text_size = np.zeros(0, np.int64)
        self.text = np.zeros(0, np.uint8)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.bpe.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """Many pieces that begin with a space are one text to the library; offsets tell their ids apart."""
        spaced = buf[lo] == 32
        size = np.zeros(len(keys), np.int64)
        ids: list[np.ndarray] = []
        order = np.concatenate([np.flatnonzero(~spaced), np.flatnonzero(spaced)])
        alone = int((~spaced).sum())
        got = self._whole([buf[a:b].tobytes().decode() for a, b in zip(lo[order[:alone]].tolist(), hi[order[:alone]].tolist(), strict=True)])
        size[order[:alone]] = [len(x) for x in got]
        ids += [np.array(x, dtype=np.uint32) for x in got]
        for i in range(alone, len(order), 4096):
            group = order[i : i + 4096]
            n = hi[group] - lo[group]
            first = np.cumsum(n) - n
            text = buf[np.arange(int(n.sum())) + np.repeat(lo[group] - first, n)]
            ends = np.cumsum(np.add.reduceat((text & 0xC0) != 0x80, first, dtype=np.int64))
            e = self.bpe.encode(text.tobytes().decode(), add_special_tokens=False)
            begins = np.array(e.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
            size[group] = np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(group))
            ids.append(np.array(e.ids, dtype=np.uint32))
        at = np.zeros(len(keys), np.int64)
        at[order] = len(self.flat) + np.cumsum(size[order]) - size[order]
        place = np.searchsorted(self.keys, keys)
        text_at, text_size = len(self.text) + np.cumsum(hi - lo) - (hi - lo), hi - lo
        self.keys, self.at, self.size, self.text_at, self.text_size = (np.insert(x, place, y) for x, y in ((self.keys, keys), (self.at, at), (self.size, size), (self.text_at, text_at), (self.text_size, text_size)))
        self.flat = np.concatenate([self.flat, *ids])
        self.text = np.concatenate([self.text, buf[_places(lo, hi - lo)]])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after another, and how many each has."""
        if not self.pieces:
            got = self._whole([x or "" for x in texts.to_pylist()])
            return np.array([i for ids in got for i in ids], dtype=np.uint32), np.array([len(ids) for ids in got], dtype=np.int64)
        buf, docs = tb.joined(texts)
        n = len(texts)
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        gap = tb.SPACE[buf]
        strange = np.flatnonzero(gap[:-1] & gap[1:])
        lead = np.flatnonzero(_LEAD[buf])
        lead = lead[[buf[p : p + 3].tobytes().startswith(tuple(_WIDE)) for p in lead.tolist()]] if len(lead) else lead
        odd = np.zeros(n + 1, dtype=bool)
        odd[np.searchsorted(docs, np.concatenate([strange, strange + 1, lead]), "right") - 1] = True
        odd[0] |= gap[0]
        odd = odd[:n]
        # pieces begin at the text and at each space in it, and end before the next
        begins = (buf == 32)[: len(buf)]
        begins[docs[:-1]] = True
        lo = np.flatnonzero(begins)
        of = np.searchsorted(docs, lo, "right") - 1
        keep = ~odd[of]
        hi = np.append(lo[1:], len(buf))
        hi -= np.append(of[1:] != of[:-1], True)  # the newline behind a text
        lo, hi, of = lo[keep], hi[keep], of[keep]
        keys, first, back = np.unique(tb.hashes(buf, lo, hi), return_index=True, return_inverse=True)
        if len(self.keys) > _KNOWN:
            self.clear()
        place = np.searchsorted(self.keys, keys)
        new = np.append(self.keys, np.uint64(0))[place] != keys
        new |= place == len(self.keys)
        if new.any():
            self._learn(keys[new], buf, lo[first[new]], hi[first[new]])
            place = np.searchsorted(self.keys, keys)
        rep = first[back]
        clash = _differ(buf, lo, hi - lo, buf, lo[rep], (hi - lo)[rep])
        clash |= _differ(buf, lo[first], (hi - lo)[first], self.text, self.text_at[place], self.text_size[place])[back]
        if clash.any():
            odd[of[clash]] = True
            keep = ~odd[of]
            back, of = back[keep], of[keep]
        at, size = self.at[place][back], self.size[place][back]
        counts = np.bincount(of, weights=size, minlength=n).astype(np.int64)
        flat = self.flat[_places(at, size)]
        if odd.any():
            whole = np.flatnonzero(odd)
            got = self._whole([buf[docs[d] : docs[d + 1] - 1].tobytes().decode() for d in whole.tolist()])
            cut = np.split(flat, np.cumsum(counts)[:-1])
            for d, ids in zip(whole.tolist(), got, strict=True):
                cut[d] = np.array(ids, dtype=np.uint32)
                counts[d] = len(ids)
            flat = np.concatenate(cut)
        return flat, counts


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker, so that what it has learnt serves its later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_FILES = "bucket int, file int, first long, doc_ids array<long>, n_tokens array<long>, raw binary"


def write(docs: DataFrame, path: str, end: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Files of the documents' ids in ascending doc_id: bucket, file, first (ids before it in its bucket), doc_ids, n_tokens, raw.

    `path` is the tokenizer's file. Each document ends with `end`; a null text is only that. A file has about
    `file_ids` ids, at least one document. The files are binary values of a Parquet table in the shared folder, which
    Spark commits, so a task that is run again leaves nothing twice, and any store will do. Pages are neither compressed
    nor coded, so a file's bytes lie there as they are, and codes.Remote reads any id of it by offsets alone. Rows
    without doc_id come last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        bucket, file, first = None, 0, 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []

        def flush() -> pa.RecordBatch:
            nonlocal file, first, ids, names
            sizes = [len(x) for x in ids]
            row = pa.RecordBatch.from_arrays([
                pa.array([bucket], pa.int32()), pa.array([file], pa.int32()), pa.array([first], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([encode(np.concatenate(ids))], pa.binary()),
            ], ["bucket", "file", "first", "doc_ids", "n_tokens", "raw"])
            file, first, ids, names = file + 1, first + sum(sizes), [], []
            return row

        last = np.array([end], dtype=np.uint32)
        held = 0
        for batch in batches:
            for lo, hi in slices(batch.column("text"), 1 << 22):
                part = batch.slice(lo, hi - lo)
                flat, counts = bpe(part.column("text"))
                for b, doc, got in zip(part.column("bucket").to_pylist(), part.column("doc_id").to_pylist(), np.split(flat, np.cumsum(counts)[:-1]), strict=True):
                    if ids and (b != bucket or held + len(got) >= file_ids):
                        yield flush()
                        held = 0
                    if b != bucket:
                        bucket, file, first = b, 0, 0
                    ids.append(np.append(got, last))
                    names.append(doc)
                    held += len(got) + 1
        if ids:
            yield flush()

    return table(by_id(docs).select("bucket", "doc_id", "text").mapInArrow(run, _FILES), "codes", compression="none", **{"parquet.enable.dictionary": "false"})


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    start counts the ids of all documents before it: those in its bucket's earlier files and documents, and in the
    earlier buckets, of which there is a row each.
    """
    sums = files.groupBy("bucket").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda s, n: s + n)).alias("n"))
    before = sums.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, at = Codes(row["raw"]), 0
                start, n = row["base"] + row["first"], row["n_tokens"]
                sums = []
                for k in n:
                    sums.append(zlib.crc32(codes.ids(at, at + k).astype("<u4").tobytes()))
                    at += k
                starts = start + np.cumsum([0, *n[:-1]])
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = files.join(F.broadcast(before), "bucket").select("first", "base", "doc_ids", "n_tokens", "raw")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
