"""Two tokenizers' tokens of the same text side by side: different segments are aligned once, documents are composed of them."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm import textbuf as tb
from strandloom.llm.packed import restored, restored_strings, squeezed, squeezed_strings
from strandloom.llm.shared import parts, table
from strandloom.llm.textbuf import slices

#: Bytes of the texts of a slice, about; a longer text is a slice of its own.
SLICE = 8 << 20
#: Bytes of the segments of all slices that one bucket aligns, about.
BUCKET = 16 << 20
#: UTF-8 of white space beyond ASCII.
_WIDE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: ASCII bytes before which or behind which nothing is split: white space, and the separators that some call so.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(9, 14), *range(0x1C, 0x21)]] = True


def _after_space(raw: bytes) -> bool:
    """Whether a space stands behind anything that isn't white space."""
    return any(raw[i] == 32 and not (_BLANK[raw[i - 1]] or raw[:i].endswith(tuple(_WIDE))) for i in range(1, len(raw)))


class Pair:
    """A byte-level BPE of the tokenizers library (A) and a sentencepiece BPE with byte fallback (B), with each id's bytes.

    `split` tells that no token of either reaches over a place before a space behind a character that isn't white space:
    A's pieces end there and none of its vocabulary holds such a place; B changes no character but the space and has
    no piece with its space mark behind another character. Then segments between such places are encoded by
    themselves as they are in the whole text. Otherwise a text is one segment.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        # byte-level alphabets give printable bytes to themselves and the others, ascending, to what follows U+00FF
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        char = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(plain)))}
        if set(char) != set(ByteLevel.alphabet()):
            raise ValueError("another byte-level alphabet")
        of_a = self.a.get_vocab()
        self.a_bytes = [b""] * (max(of_a.values()) + 1)
        for token, i in of_a.items():
            self.a_bytes[i] = bytes(char[c] for c in token) if all(c in char for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in y]) for y in (self.a_bytes, self.b_bytes))
        if b"".join(self.a_bytes[i] for i in self.a.encode(" The caf\u00e9", add_special_tokens=False).ids) != " The caf\u00e9".encode():
            raise ValueError("the first tokenizer is not byte-level")
        top = max(len(self.a_bytes), len(self.b_bytes))
        self.shown = [b"%d%c" % (i, c) for c in (44, 124, 59) for i in range(top)]
        self.shown_size = np.array([len(x) for x in self.shown])
        self.bar, self.semicolon = top, 2 * top
        with open(a_path, encoding="utf-8") as f:
            told = json.load(f)
        rule = told.get("pre_tokenizer") or {}
        self.split = (
            told.get("normalizer") is None and rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule.get("add_prefix_space", True)
            and not any(_after_space(x) for x in self.a_bytes) and not any("▁" in p.lstrip("▁") for p in pieces) and self._plain()
        )

    def _plain(self) -> bool:
        """Whether B keeps characters and runs of spaces, puts one space before the text, and merges over no split of a probe."""
        probe = ["a", "ﬁ", "Ångström", "é", "a  b", "A.B", "①"]
        back = [b"".join(self.b_bytes[i] for i in self.b.encode(x)) for x in probe]
        whole = self.b.encode(" ".join(probe))
        return back == [f" {x}".encode() for x in probe] and whole == [i for x in " ".join(probe).split(" ") for i in (self.b.encode(x) if x else [self.b.piece_to_id("▁")])]

    def cuts(self, buf: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where segments begin in texts laid end to end, each with a space before it: at the texts, and before a space
        behind a character that isn't white space, unless the space is the text's last character."""
        on = np.zeros(len(buf), dtype=bool)
        if self.split and len(buf):
            on[1:] = (buf[1:] == 32) & ~_BLANK[buf[:-1]]
            wide = np.flatnonzero(on[1:] & (buf[:-1] >= 0x80)) + 1
            on[wide[[buf[max(p - 3, 0) : p].tobytes().endswith(tuple(_WIDE)) for p in wide.tolist()]]] = False
            on[begins[1:] - 1] = False
        on[begins[:-1][np.diff(begins) > 0]] = True
        return np.flatnonzero(on)

    def _alone(self, raw: bytes) -> tuple[list[int], list[int]] | None:
        text = raw.decode()
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:])
        return (a, b) if b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b]) else None

    def tokens(self, segments: pa.Array, most: int = 1 << 14) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids of A and of B of the segments, how many of each a segment has, and whether both give it back (else it has none).

        Segments that end in a character which isn't white space are one text to the encoders, about `most` bytes of
        them at a time: they meet where nothing merges. A batch that isn't given back is encoded segment by segment.
        """
        size = np.asarray(pc.binary_length(segments), dtype=np.int64)
        ends = np.cumsum(size)
        out_a, out_b = [], []
        n_a, n_b, good = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64), np.ones(len(size), dtype=bool)
        lo = 0
        while lo < len(size):
            hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")), lo + 1)
            some = segments.slice(lo, hi - lo).to_pylist()
            raw = b"".join(some)
            own = np.cumsum(size[lo:hi])
            whole = self._alone(raw) if self.split and all(not _BLANK[x[-1]] and not x.endswith(tuple(_WIDE)) for x in some) else None
            if whole:
                a, b = np.array(whole[0], np.int64), np.array(whole[1], np.int64)
                at_a, at_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
                end_a, end_b = np.searchsorted(at_a, own), np.searchsorted(at_b, own)
                if (at_a[end_a] == own).all() and (at_b[end_b] == own).all():
                    n_a[lo:hi], n_b[lo:hi] = np.diff(end_a + 1, prepend=0), np.diff(end_b + 1, prepend=0)
                    out_a.append(a)
                    out_b.append(b)
                    lo = hi
                    continue
            for i, x in enumerate(some, lo):
                got = self._alone(x)
                good[i] = got is not None
                if got:
                    n_a[i], n_b[i] = map(len, got)
                    out_a.append(np.array(got[0], np.int64))
                    out_b.append(np.array(got[1], np.int64))
            lo = hi
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *out_a]), np.concatenate([none, *out_b]), n_a, n_b, good

    def align(self, segments: pa.Array) -> dict[str, np.ndarray | pa.Array]:
        """good, n_a, n_b, n_groups, n_links of the segments; links (A's id times 2^32 plus B's) of all, one segment after
        another; groups, each segment's as text with a semicolon behind each."""
        a, b, n_a, n_b, good = self.tokens(segments)
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        every = np.union1d(end_a, end_b)
        starts = np.append(0, every[:-1]) if len(every) else every
        links = a[np.searchsorted(end_a, starts, "right")] << 32 | b[np.searchsorted(end_b, starts, "right")]
        size = np.where(good, np.asarray(pc.binary_length(segments), dtype=np.int64), 0)
        ends = np.append(0, np.cumsum(size))
        n_links, n_groups = np.diff(np.searchsorted(every, ends, "right")), np.diff(np.searchsorted(both, ends, "right"))
        # a comma behind an id, a bar behind the last of A's in a group, a semicolon behind the last of B's
        group = np.concatenate([np.searchsorted(both, end_a), np.searchsorted(both, end_b)])
        last = np.concatenate([np.isin(end_a, both, assume_unique=True), np.isin(end_b, both, assume_unique=True)])
        order = np.argsort(group * 2 + np.repeat([0, 1], [len(a), len(b)]), kind="stable")
        item = np.concatenate([a + self.bar * last[: len(a)], b + self.semicolon * last[len(a) :]])[order]
        text = b"".join(map(self.shown.__getitem__, item.tolist()))
        per = np.append(0, np.cumsum(self.shown_size[item]))[np.append(0, np.cumsum(n_a + n_b))]
        groups = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(per.astype(np.int64)), pa.py_buffer(text)])
        return {"good": good, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "links": links, "groups": groups}


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair(a_path: str, b_path: str) -> Pair:
    """One for each worker."""
    if (a_path, b_path) not in _PAIRS:
        _PAIRS[a_path, b_path] = Pair(a_path, b_path)
    return _PAIRS[a_path, b_path]


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_SUMS = (*_NUMBERS, "n_best", "count_sum")
_SLICES = "slice long, doc_ids array<long>, sizes array<int>, codes binary, hashes binary, segments binary, counts binary, bytes long"


def pack(docs: DataFrame, a_path: str, b_path: str, most: int = SLICE) -> DataFrame:
    """Slices of about `most` bytes of texts: their documents, numbers of segments of each and codes of these, and the
    different segments in the order of their hashes, with their numbers of occurrences. Null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        own = pair(a_path, b_path)
        held: list[tuple[pa.Array, pa.Array]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids, texts = (pa.concat_arrays([x[k] for x in held]) for k in (0, 1))
            buf = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            begins = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            buf, begins = np.ascontiguousarray(buf[begins[0] : begins[-1]]), begins - begins[0]
            at = own.cuts(buf, begins)
            offsets = pa.py_buffer(np.append(at, len(buf)))
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, offsets, pa.py_buffer(buf)]).dictionary_encode()
            some = coded.dictionary
            ends = np.frombuffer(some.buffers()[1], np.int64)[: len(some) + 1] if len(some) else np.zeros(1, np.int64)
            h = tb.hashes(np.frombuffer(some.buffers()[2] or b"", np.uint8), ends[:-1], ends[1:])
            order = np.argsort(h)
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            codes = rank[np.asarray(coded.indices)]
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([np.diff(np.searchsorted(at, begins)).astype(np.int32)], pa.list_(pa.int32())), pa.array([squeezed(codes)], pa.binary()), pa.array([squeezed(np.diff(h[order], prepend=tb.U(0)))], pa.binary()),
                pa.array([squeezed_strings(some.take(pa.array(order)))], pa.binary()), pa.array([squeezed(np.bincount(codes, minlength=len(some)))], pa.binary()), pa.array([int(ends[-1]) + 8 * len(some)], pa.int64()),
            ], ["slice", "doc_ids", "sizes", "codes", "hashes", "segments", "counts", "bytes"])

        for batch in batches:
            for lo, hi in slices(batch.column("text"), 1 << 21):
                part = batch.slice(lo, hi - lo)
                text = part.column("text").cast(pa.large_string())
                spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string()))
                spaced = pc.if_else(pc.fill_null(pc.equal(text, ""), True), pa.scalar("", pa.large_string()), spaced)
                held.append((part.column("doc_id"), spaced))
                size += int(pc.sum(pc.binary_length(spaced)).as_py() or 0) + 8 * len(spaced)
                if size >= most:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SLICES)
    return table(rows, "segments", compression="zstd")


def _edges(row: dict, n: int) -> np.ndarray:
    """Where the segments of each of the n buckets, which are ranges of hashes, begin in a slice."""
    h = np.cumsum(restored(row["hashes"], "<u8"), dtype=tb.U)
    return np.append(np.searchsorted(h, np.array([b * (1 << 64) // n for b in range(n)], dtype=tb.U)), len(h))


_ASKS = "slice long, bucket int, segments binary, counts binary"
_ALIGNED = "bucket int, slices array<long>, sizes array<int>, codes binary, n binary, good binary, n_a binary, n_b binary, n_groups binary, n_links binary, links binary, groups binary"


def aligned(packed: DataFrame, a_path: str, b_path: str, n: int) -> DataFrame:
    """The different segments of all slices, in n buckets, each aligned once; and where each slice's segments are among them."""

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                edge, segments, counts = _edges(row, n), restored_strings(row["segments"]), restored(row["counts"], "<i8")
                for b in np.flatnonzero(edge[1:] > edge[:-1]).tolist():
                    lo, hi = int(edge[b]), int(edge[b + 1])
                    yield pa.RecordBatch.from_pydict({"slice": [row["slice"]], "bucket": pa.array([b], pa.int32()), "segments": [squeezed_strings(segments.slice(lo, hi - lo))], "counts": [squeezed(counts[lo:hi])]})

    def answer(t: pa.Table) -> pa.Table:
        own = [restored_strings(x.as_py()) for x in t.column("segments")]
        coded = pa.concat_arrays(own).dictionary_encode()
        codes = np.asarray(coded.indices, dtype=np.int32)
        counts = np.bincount(codes, np.concatenate([restored(x.as_py(), "<i8") for x in t.column("counts")]), len(coded.dictionary)).astype(np.int64)
        got = pair(a_path, b_path).align(coded.dictionary)
        row = {"bucket": pa.array([t.column("bucket")[0].as_py()], pa.int32()), "slices": pa.array([t.column("slice").to_pylist()], pa.list_(pa.int64())), "sizes": pa.array([[len(x) for x in own]], pa.list_(pa.int32()))}
        row |= {"codes": pa.array([squeezed(codes)], pa.binary()), "n": pa.array([squeezed(counts)], pa.binary()), "good": pa.array([squeezed(got["good"].astype(np.uint8))], pa.binary())}
        row |= {c: pa.array([squeezed(got[c])], pa.binary()) for c in (*_NUMBERS, "links")} | {"groups": pa.array([squeezed_strings(got["groups"])], pa.binary())}
        return pa.table(row)

    rows = packed.select("slice", "hashes", "segments", "counts").mapInArrow(asks, _ASKS).groupBy("bucket").applyInArrow(answer, _ALIGNED)
    return table(rows, "alignments", compression="none")


def _codes(row: dict) -> list[np.ndarray]:
    """For each slice of a bucket, which of the bucket's segments it uses."""
    return np.split(restored(row["codes"], "<i4"), np.cumsum(row["sizes"])[:-1])


def spoilt(packed: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """bucket, slice, less: how often a slice's segments occur in documents that one of the tokenizers doesn't give back."""

    def bad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                good = restored(row["good"], "u1").astype(bool)
                if not good.all():
                    for at, codes in zip(row["slices"], _codes(row), strict=True):
                        hit = np.flatnonzero(~good[codes])
                        if len(hit):
                            yield pa.RecordBatch.from_pydict({"of": [at], "bucket": pa.array([row["bucket"]], pa.int32()), "at": pa.array([hit], pa.list_(pa.int32()))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                edge, codes, size = _edges(row, n), restored(row["codes"], "<i4"), np.array(row["sizes"], dtype=np.int64)
                wrong = np.concatenate([edge[x["bucket"]] + np.array(x["at"]) for x in row["bad"]])
                of = np.repeat(np.arange(len(size)), size)
                lost = np.bincount(of[np.isin(codes, wrong)], minlength=len(size)) > 0
                less = np.bincount(codes[lost[of]], minlength=int(edge[-1]))
                for b in np.flatnonzero(np.add.reduceat(np.append(less, 0), edge[:-1]) * (edge[1:] > edge[:-1])).tolist():
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "slice": [row["slice"]], "less": [squeezed(less[edge[b] : edge[b + 1]])]})

    marks = known.select("bucket", "slices", "sizes", "codes", "good").mapInArrow(bad, "of long, bucket int, at array<int>")
    marks = marks.groupBy("of").agg(F.collect_list(F.struct("bucket", "at")).alias("bad"))
    return packed.select("slice", "sizes", "codes", "hashes").join(marks, F.col("slice") == F.col("of")).drop("of").mapInArrow(run, "bucket int, slice long, less binary")


def _net(row: dict) -> np.ndarray:
    """How often each of a bucket's segments occurs in documents that count."""
    n = restored(row["n"], "<i8").copy()
    if row["lost"]:
        codes = dict(zip(row["slices"], _codes(row), strict=True))
        for x in row["lost"]:
            np.subtract.at(n, codes[x["slice"]], restored(x["less"], "<i8"))
    return n


def linked_ids(known: DataFrame, lost: DataFrame) -> DataFrame:
    """bucket, link, n: how many links of a bucket's segments, wherever these occur, hold a pair of ids (A's times 2^32 plus B's)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                links, at = np.unique(restored(row["links"], "<i8"), return_inverse=True)
                n = np.bincount(at, np.repeat(_net(row), restored(row["n_links"], "<i8")), len(links)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(links), row["bucket"], np.int32)), pa.array(links), pa.array(n)], ["bucket", "link", "n"])

    less = lost.groupBy(F.col("bucket").alias("_bucket")).agg(F.collect_list(F.struct("slice", "less")).alias("lost"))
    rows = known.select("bucket", "slices", "sizes", "codes", "n", "n_links", "links").join(less, F.col("bucket") == F.col("_bucket"), "left").drop("_bucket")
    return rows.mapInArrow(run, "bucket int, link long, n long")


def link_counts(links: DataFrame) -> DataFrame:
    """link, n, best: each pair of ids' count over the corpus; best says that no pair of the same B id has more."""
    counts = links.groupBy("link").agg(F.sum("n").alias("n")).withColumn("b", F.col("link").bitwiseAND(0xFFFFFFFF))
    # a row for each different pair, fewer than the vocabularies' product, however large the corpus
    top = Window.partitionBy("b")
    return counts.withColumn("best", F.col("n") == F.max("n").over(top)).select("link", "n", "best")


def align(docs: DataFrame, a_path: str, b_path: str, most: int = SLICE, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The packed documents; their different segments' alignments, in buckets of about `bucket` bytes; and linked_ids of these."""
    packed = pack(docs, a_path, b_path, most)
    size = packed.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n = max(parts(docs.sparkSession), -(-size // bucket))
    known = aligned(packed, a_path, b_path, n)
    return packed, known, table(linked_ids(known, spoilt(packed, known, n)), "links")


def composed(packed: DataFrame, known: DataFrame, links: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document, put together from its segments.

    With texts, groups too: the groups themselves as text.
    """
    counts = links.select(F.col("bucket").alias("of"), "link").join(link_counts(links), "link").select("of", "link", "n", "best")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        right = right.combine_chunks()
        at = np.asarray(right.column("link"))
        order = np.argsort(at)
        place = order[np.searchsorted(at[order], restored(row["links"], "<i8"))] if len(at) else order
        value = {c: restored(row[c], "<i8") for c in _NUMBERS}
        ends = np.append(0, np.cumsum(value["n_links"]))
        for c, x in (("n_best", "best"), ("count_sum", "n")):
            value[c] = np.diff(np.append(0, np.cumsum(np.asarray(right.column(x))[place].astype(np.int64)))[ends])
        value["good"] = restored(row["good"], "u1")
        groups = restored_strings(row["groups"])
        own = _codes(row)
        out = {"of": pa.array(row["slices"], pa.int64()), "bucket": pa.array([row["bucket"]] * len(own), pa.int32())}
        out |= {c: pa.array([squeezed(value[c][x]) for x in own], pa.binary()) for c in ("good", *_SUMS)}
        return pa.table(out | {"groups": pa.array([squeezed_strings(groups.take(pa.array(x))) for x in own], pa.binary())})

    names = ", ".join(f"{c} binary" for c in ("good", *_SUMS, "groups"))
    told = known.select("bucket", "slices", "sizes", "codes", "good", *_NUMBERS, "links", "groups")
    answers = told.groupBy("bucket").cogroup(counts.groupBy("of")).applyInArrow(answer, f"of long, bucket int, {names}")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        own = sorted(right.to_pylist(), key=lambda x: x["bucket"])
        codes, size = restored(row["codes"], "<i4"), np.array(row["sizes"], dtype=np.int64)
        sums = {c: np.zeros(len(size), np.int64) for c in _SUMS}
        good, some, begins = np.ones(len(size), dtype=bool), size > 0, np.cumsum(size) - size
        if len(codes):
            good[some] = np.logical_and.reduceat(np.concatenate([restored(x["good"], "u1") for x in own])[codes], begins[some])
            for c in _SUMS:
                sums[c][some] = np.add.reduceat(np.concatenate([restored(x[c], "<i8") for x in own])[codes], begins[some])
                sums[c][~good] = 0
        groups = [g for x in own for g in restored_strings(x["groups"]).to_pylist()]
        shown = [b"".join(map(groups.__getitem__, codes[lo : lo + n].tolist()))[:-1] if fine and n else b"" for lo, n, fine in zip(begins.tolist(), size.tolist(), good.tolist(), strict=True)]
        digests = pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in shown], pa.string())
        out = {"doc_id": pa.array(row["doc_ids"], pa.int64())} | {c: pa.array(x) for c, x in sums.items()} | {"groups_sha256": digests}
        return pa.table(out | ({"groups": pa.array([x.decode() for x in shown], pa.string())} if texts else {}))

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _SUMS) + ", groups_sha256 string" + (", groups string" if texts else "")
    return packed.select("slice", "doc_ids", "sizes", "codes").groupBy("slice").cogroup(answers.groupBy("of")).applyInArrow(run, schema)


def report(docs: DataFrame, a_path: str, b_path: str, most: int = SLICE, bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    A's tokens of a space and the text stand beside B's of the text. Places where tokens of both end cut them into
    groups; tokens whose bytes overlap are linked. n_best counts the links whose pair of ids is linked as often, in the
    whole corpus, as any pair of its B id; count_sum adds these counts up. Texts that are null, empty or not given back
    by both tokenizers have no tokens, count nowhere, and have zeros and an empty digest. Repeated rows each give a row
    and count, rows without doc_id too; extra columns go; an empty table gives no rows.

    A slice of texts sends each of its different segments once to a bucket of hashes; the bucket aligns different ones
    once and answers each slice. So a segment has a row for each slice at most, whatever its frequency.
    """
    return composed(*align(docs, a_path, b_path, most, bucket))
