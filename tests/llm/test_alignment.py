"""Tokens of two tokenizers side by side, against whole texts aligned one by one."""

import hashlib
from collections import Counter

import pytest

from tests.llm.test_operators import SCHEMA, table

public_tokenizers = pytest.importorskip("public_tokenizers")
from strandloom.llm import alignment  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", None, " ", "  ", "a ", "  a  b   c ", "▁x y", "foo ▁ bar the the", "a b 　c   d  e \u0085 f", "x\x1f  y\x1f z", "line\n\n  next\tone \r\n", "don't 've '' 's'll",
    "<|endoftext|> </s> <s> <0x41>", "日本語 テスト 😀 é é ﬁ", "a\x00b \x00 c", " lead", "trail \n", "foo  bar", "1,234.56  $%^ &*( ) ___", "aaaa" * 500, "the cat the dog the cat",
]
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def brute(rows):
    """For each (doc_id, text) the numbers and the groups as text: two pointers over the tokens of whole texts."""
    own = alignment.pair(A, B)
    per, counts = [], Counter()
    for _, text in rows:
        a = b = []
        if text:
            raw = (" " + text).encode()
            a, b = own.a.encode(" " + text, add_special_tokens=False).ids, own.b.encode(text)
            if b"".join(own.a_bytes[i] for i in a) != raw or b"".join(own.b_bytes[i] for i in b) != raw:
                a = b = []
        i = j = x = y = 0
        links, groups, now = [], [], ([], [])
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = x + len(own.a_bytes[a[i]]), y + len(own.b_bytes[b[j]])
            if end_a <= end_b:
                now[0].append(a[i])
                i, x = i + 1, end_a
            if end_b <= end_a:
                now[1].append(b[j])
                j, y = j + 1, end_b
            if end_a == end_b:
                groups.append("|".join(",".join(map(str, k)) for k in now))
                now = ([], [])
        per.append((len(a), len(b), len(groups), links, ";".join(groups)))
        counts.update(links)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    return Counter(
        (i, n_a, n_b, n_groups, len(links), sum(counts[k] == top[k[1]] for k in links), sum(counts[k] for k in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for (i, _), (n_a, n_b, n_groups, links, g) in zip(rows, per, strict=True)
    )


@pytest.mark.parametrize("split", [True, False])
def test_report(spark, monkeypatch, split):
    if not split:
        monkeypatch.setattr(alignment.Pair, "_plain", lambda self: False)
        monkeypatch.setattr(alignment, "_PAIRS", {})
    assert alignment.pair(A, B).split == split
    rows = [(r[0], r[1]) for r in table()] + [(1000 + i, x) for i, x in enumerate(ODD)] + [(1000, "a second text"), (None, "▁ bad"), (None, "the cat ▁")]
    docs = spark.createDataFrame([(i, x, "en", "s", 1, 2, 3, "z", "q") for i, x in rows], SCHEMA).repartition(3)
    out = alignment.report(docs, A, B, most=1 << 12, bucket=1 << 10)
    assert out.columns == ["doc_id", *NUMBERS, "groups_sha256"]
    assert Counter(map(tuple, out.collect())) == brute(rows)


def test_segments_are_encoded_as_in_the_text():
    own = alignment.pair(A, B)
    import pyarrow as pa

    segments = pa.array([b" the", b" cat's", b" \xe2\x96\x81", b"  a \n ", b" x\xc2\xa0", b" y"], pa.large_binary())
    a, b, n_a, n_b, good = own.tokens(segments)
    assert good.tolist() == [True, True, False, True, True, True]
    assert a.tolist() == [i for x, fine in zip(segments.to_pylist(), good, strict=True) if fine for i in own.a.encode(x.decode(), add_special_tokens=False).ids]
    assert b.tolist() == [i for x, fine in zip(segments.to_pylist(), good, strict=True) if fine for i in own.b.encode(x.decode()[1:])]
    assert n_a.sum() == len(a) and n_b.sum() == len(b)


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(1, "The cats' unbelievable tokenizers"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in alignment.composed(*alignment.align(docs, A, B), texts=True).collect()}
    assert hashlib.sha256(got[1].groups.encode()).hexdigest() == got[1].groups_sha256 and got[1].groups.count(";") == got[1].n_groups - 1
    assert got[2].groups == "" and got[2].groups_sha256 == "" and got[2].n_a == 0


def test_tables_without_tokens(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.report(empty, A, B).collect() == []
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.report(none, A, B).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_another_kind_of_tokenizer_is_refused():
    with pytest.raises(ValueError):
        alignment.Pair(public_tokenizers.path("word_bpe_49k.json"), B)
