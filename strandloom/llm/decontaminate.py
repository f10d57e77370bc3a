"""Passages of benchmark items in documents: found, reported, cut out."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from strandloom.llm.automaton import Automaton
from strandloom.llm.shared import table
from strandloom.llm.textbuf import slices

SPAN = 10
#: Words of benchmark items that go into one automaton, about 60 bytes each once built, and those that a worker holds at
#: once. A larger test set is taken in several passes over the documents.
BLOCK_WORDS, PASS_WORDS = 200_000, 2_000_000
#: Every byte as it counts: A-Z in lower case, other ASCII but letters and digits as a space.
_FOLD = bytes(i + 32 if 65 <= i < 91 else i if 48 <= i < 58 or 97 <= i < 123 or i > 127 else 32 for i in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and anything beyond ASCII, A-Z in lower case."""
    return text.translate(_FOLD).split()


def automata(items: DataFrame, span: int = SPAN, block: int = BLOCK_WORDS, most: int = PASS_WORDS) -> Iterator[list]:
    """Lists of broadcast automata over items (item_id, text): each of at most `block` words, or one item; each list of about `most`.

    The test set streams through the driver a partition at a time, which holds one automaton's words and no more.
    """
    sc = items.sparkSession.sparkContext
    out: list = []
    now: dict[object, list[bytes]] = {}
    n = held = 0
    for row in items.select("item_id", "text").where("text is not null").toLocalIterator():
        ws = words_of(row["text"].encode())
        if n + len(ws) > block and now:
            out.append(sc.broadcast(Automaton(now, span)))
            held += n
            now, n = {}, 0
            if held >= most:
                yield out
                out, held = [], 0
        # several texts under one id are its parts: each is an item of that id
        now[(row["item_id"], len(now))] = ws
        n += len(ws)
    yield [*out, sc.broadcast(Automaton(now, span))]


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(a + b):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _sorted(ids: set) -> list:
    """Ids as sorted strings, the null one last."""
    return sorted((None if k is None else str(k) for k in ids), key=lambda k: (k is None, k or ""))


def hits(text: bytes, blocks: list) -> tuple[int, list[tuple[int, int]], list[str | None]]:
    """Number of words, ranges of words in windows, sorted ids of the items these belong to (items without id: one null)."""
    ws = words_of(text)
    spans: list[tuple[int, int]] = []
    found: set = set()
    for b in blocks:
        s, f = b.value.spans(ws)
        if s:
            spans, found = _merged(spans, s), found | f
    return len(ws), spans, _sorted({k for k, _ in found})


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without these words and what stands between them; a space where something was cut."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw)]
    out, last = [], 0
    for lo, hi in spans:
        out.append(raw[last : at[lo][0]])
        last = at[hi - 1][1]
    return b" ".join(x.strip(b" ") if i else x for i, x in enumerate([*out, raw[last:]])).decode()


def _matched(docs: DataFrame, passes: Iterator[list], schema: dict[str, str], one: Callable[[dict, int, list[tuple[int, int]], list[str]], tuple | None]) -> DataFrame:
    """The rows that `one` makes of each row, its number of words, its spans and its items; a few megabytes of text at a time.

    With several passes, what is found goes along with the documents in a table from each pass to the next, so that a
    worker holds the automata of one.
    """
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}

    def mapped(rows: DataFrame, blocks: list, schema: dict[str, str], last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in slices(batch.column("text")):
                    out = []
                    for row in batch.slice(lo, hi - lo).to_pylist():
                        n, spans, found = hits((row["text"] or "").encode(), blocks)
                        if "_spans" in row:
                            before = row.pop("_spans")
                            spans = _merged(spans, list(zip(before[::2], before[1::2], strict=True)))
                            found = _sorted({*found, *row.pop("_found")})
                        made = one(row, n, spans, found) if last else (*row.values(), [x for s in spans for x in s], found)
                        if made is not None:
                            out.append(made)
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[k]) for i, k in enumerate(schema.values())], list(schema))

        return rows.mapInArrow(run, ", ".join(f"{k} {v}" for k, v in schema.items()))

    own = {c: t.replace("bigint", "long") for c, t in docs.dtypes} | {"_spans": "array<long>", "_found": "array<string>"}
    blocks = next(passes)
    for following in passes:
        docs = table(mapped(docs, blocks, own, False), "matched")
        blocks = following
    return mapped(docs, blocks, schema, True)


def report(docs: DataFrame, items: DataFrame, span: int = SPAN, most: int = PASS_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document.

    A window is `span` consecutive words of an item, or all of a shorter one. Null and empty texts have no words and
    null or wordless items no window; repeated rows each give a row; without items nothing is hit. The digest is of
    the item ids that have windows in the document, as sorted strings with commas (none: of the empty string). Items
    without id hit words like others; together they count as one item, which the digest doesn't have.
    """

    def one(row: dict, n: int, spans: list[tuple[int, int]], found: list[str]) -> tuple:
        hit = sum(b - a for a, b in spans)
        return row["doc_id"], n, hit, len(found), hashlib.sha256(",".join(k for k in found if k is not None).encode()).hexdigest(), hit > 0

    return _matched(docs.select("doc_id", "text"), automata(items, span, min(BLOCK_WORDS, most), most), {"doc_id": "long", "n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean"}, one)


def remove(docs: DataFrame, items: DataFrame, span: int = SPAN, coverage: float = 0.5, most: int = PASS_WORDS) -> DataFrame:
    """Documents (doc_id, text, lang, source, n_chars) without benchmark passages.

    Spans of words inside windows are cut out and n_chars is counted anew; a document of which windows cover more
    than `coverage` goes. Untouched documents keep their text as it is; null texts stay null.
    """

    def one(row: dict, n: int, spans: list[tuple[int, int]], found: list[str]) -> tuple | None:
        text = row["text"]
        if spans:
            if sum(b - a for a, b in spans) > coverage * n:
                return None
            text = without(text, spans)
            row["n_chars"] = len(text)
        return row["doc_id"], text, row["lang"], row["source"], row["n_chars"]

    return _matched(docs.select("doc_id", "text", "lang", "source", "n_chars"), automata(items, span, min(BLOCK_WORDS, most), most), {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}, one)
