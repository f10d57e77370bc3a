"""Small tables with nulls, empty and long texts, ties, repeated rows and extra columns, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandloom.llm import codes, crf, decontaminate, fingerprint, language, lm, mixing, ordered, quality, reputation, sharding, simhash, textbuf, tokens
from strandloom.llm.automaton import Automaton
from strandloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, _pid int, score string, bucket string"
LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
WORDS = ["the", "of", "Cat", "été", "naïve", "x1", "dog.", "tree", "river", "stone", "wind", "lamp"]


def text(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(WORDS, n))


def table():
    rows = [(i, text(i, 5 + 7 * i), "en", f"s{i % 3}") for i in range(24)]
    rows += [(24, text(3, 26), "fr", None), (25, text(3, 26) + " end", None, "s0"), (26, None, "fr", "s1"), (27, "", "en", "s1"), (28, " \n\t ", None, None), (29, "a" * 150_000, "en", "s2"), (30, text(9, 20_000), "en", "s2")]
    rows += [(31, "one two three", "en", "s0"), (31, "one two three", "en", "s0"), (32, "日本 語　テキスト", "ja", "s9"), (None, "no id here at all", "en", "s0"), (None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(a, b, c, d, len(b or ""), 7, 1, "z", "q") for a, b, c, d in table()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return (r[0] is None, r[0], r[1] or "")


def test_fingerprints_with_edits(docs, empty):
    rows = sorted(table(), key=key)
    out = fingerprint.compare_with_edits(docs).collect()
    want = Counter()
    for i, r in enumerate(rows):
        t, nxt = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        h = len(t) // 2
        want[(r[0], len(t), hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == want
    by = {r.doc_id: r for r in out}
    assert by[26].fingerprint == by[27].fingerprint and by[3].fingerprint == by[24].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert fingerprint.compare_with_edits(empty).count() == 0
    assert {r.fingerprint for r in fingerprint.fingerprint(docs).where("doc_id = 3").collect()} == {by[3].fingerprint}


def brute_signature(t):
    """The bins of a text, one shingle after another, with the module's word hashes and scrambling as given."""
    mask = (1 << 64) - 1

    def mix(x):
        for _ in range(2):
            x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & mask
        return x ^ (x >> 32)

    w = (t or "").encode().translate(LOW).split()
    buf = np.frombuffer(b" ".join(w) + b"\n", np.uint8)
    ends = np.cumsum([len(x) + 1 for x in w], dtype=np.int64) - 1
    h = textbuf.hashes(buf, ends - [len(x) for x in w], ends).tolist() if w else []
    factor = [mix(((j + 1) * 0xC2B2AE3D27D4EB4F) & mask) | 1 for j in range(5)]
    least = {}
    for i in range(max(len(h) - 4, 1)):
        s = mix(sum(x * f for x, f in zip(h[i : i + 5], factor, strict=False)) & mask)
        least[s >> 56] = min(least.get(s >> 56, mask), s & ((1 << 56) - 1))
    digits = []
    for b in range(256):
        draw, at = 0, b
        while at not in least:
            draw += 1
            at = mix((b * 0x9E3779B97F4A7C15 + draw * 0xD1B54A32D192ED03) & mask) % 256
        digits.append(least[at] % 16)
    return "".join(f"{x:x}" for x in digits)


def test_fingerprint_digits_and_likeness(docs):
    rows = sorted(table(), key=key)
    texts = [r[1] or "" for r in rows]
    want = Counter()
    for i, (r, t) in enumerate(zip(rows, texts, strict=True)):
        nxt = texts[(i + 1) % len(texts)]
        other = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        own, edit, after = (brute_signature(x) for x in (t, other, nxt))
        alike = lambda b: round(max(0.0, (sum(x == y for x, y in zip(own, b, strict=True)) / 256 - 1 / 16) / (15 / 16)), 9)  # noqa: B023, E731
        want[(r[0], own, edit, alike(edit), alike(after))] += 1
    out = fingerprint.compare_with_edits(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in out) == want


def test_likeness_is_unbiased():
    r = np.random.default_rng(1)
    errors = []
    for share in (0.1, 0.5, 0.9):
        for k in range(20):
            a = [f"w{x}" for x in r.integers(0, 10**6, 400)]
            n = int(400 * share)
            b = a[:n] + [f"v{x}" for x in r.integers(0, 10**6, 400 - n)]
            sig = fingerprint.signatures(pa.array([" ".join(a), " ".join(b)]))
            sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b)]
            errors.append(fingerprint.likeness(sig[0], sig[1]) - len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.15


def test_one_document_follows_itself(spark):
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    assert fingerprint.compare_with_edits(one).first().edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_shards(docs, empty):
    out = sharding.shard(docs, 4).collect()
    rows = table()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter((a, len((b or "").encode()) + 1, zlib.crc32((b or "").encode())) for a, b, _, _ in rows)
    total, before = sum(r["size"] for r in out), 0
    last = -1
    for r in sorted(out, key=lambda r: (r.shard, r.slot)):
        assert r.shard == min(3, (2 * before + r["size"]) * 4 // (2 * total)) and r.law == "bytes"
        before += r["size"]
        assert r.doc_id is None or r.doc_id >= last
        last = r.doc_id if r.doc_id is not None else 10**9
    for s in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert sharding.shard(empty).count() == 0


def test_mixing(docs, empty):
    out = mixing.mix(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r["size"]) for r in out) == Counter((a, size(b)) for a, b, _, _ in table())
    own = Counter()
    for _, t, _, s in table():
        own[s] += size(t)
    names = sorted(own, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, goal, open_ = 1.5 * sum(own.values()), {}, set(names)
    while open_:
        w = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / w > 2 * own[s]]
        if not full:
            goal |= {s: left * weight[s] / w for s in open_}
            break
        for s in full:
            goal[s] = 2 * own[s]
            left -= goal[s]
            open_.discard(s)
    assert all(abs(r.target - goal[r.source]) < 1e-6 and r.source_size == own[r.source] and r.taken <= 2 * r["size"] for r in out)
    biggest = max(size(b) for _, b, _, _ in table())
    for s in names:
        assert abs(sum(r.taken for r in out if r.source == s) - goal[s]) <= biggest
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken) for r in out) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.mix(empty).count() == 0


def test_mixing_of_wordless_documents(spark):
    t = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mix(t).collect()] == [(0, 0.0)] * 2


def brute_simhash(t):
    w = (t or "").encode().translate(LOW).split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(docs, empty):
    out = simhash.near_duplicates(docs).collect()
    rows = table()
    fp = [brute_simhash(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    least = {k: min([x for x in v if x is not None], default=None) for k, v in groups.items()}
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in out) == Counter((r[0], f"{f:016x}", least[find(i)]) for i, (r, f) in enumerate(zip(rows, fp, strict=True)))
    assert simhash.near_duplicates(empty).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.integers(1, 300))
def test_tiles_find_all_links(seed, n, m):
    r = np.random.default_rng(seed)
    base = r.integers(0, 2**64, 6, dtype=np.uint64)

    def some(k):
        x = base[r.integers(0, 6, k)]
        for _ in range(5):
            x = x ^ np.where(r.random(k) < 0.5, np.uint64(1) << r.integers(0, 64, k).astype(np.uint64), np.uint64(0))
        return x

    a, b = some(n), some(m)

    def classes(pairs, size):
        root = list(range(size))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in pairs:
            root[max(find(x), find(y))] = min(find(x), find(y))
        return [find(x) for x in range(size)]

    node, to = simhash.near(a, b, 4, False)
    assert len(node) < n + m
    want = [(i, n + j) for i in range(n) for j in range(m) if (int(a[i]) ^ int(b[j])).bit_count() <= 4]
    assert classes(zip(node.tolist(), to.tolist(), strict=True), n + m) == classes(want, n + m)
    node, to = simhash.near(a, a, 4, True)
    want = [(i, j) for i in range(n) for j in range(i) if (int(a[i]) ^ int(a[j])).bit_count() <= 4]
    assert classes(zip(node.tolist(), to.tolist(), strict=True), n) == classes(want, n)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7)]
    out = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert out == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_report(docs, items, span=10):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").encode().translate(LOW))
    windows = defaultdict(set)
    for k, t in items:
        w = split(t)
        for i in range(max(1, len(w) - span + 1)) if w else ():
            windows[tuple(w[i : i + span])].add(k)
    out = Counter()
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if (g := tuple(w[j : j + n])) in windows:
                    hit |= set(range(j, j + n))
                    found |= windows[g]
        out[(d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(str(k) for k in found if k is not None)).encode()).hexdigest(), bool(hit))] += 1
    return out


def test_decontamination(spark, docs, empty):
    items = [(1, text(5, 30)), (2, text(5, 30)[20:90]), (3, "one two"), (4, None), (5, "..."), (None, text(8, 12)), (10, text(30, 60)), (3, "Cat été")]
    bench = spark.createDataFrame([(a, b, "junk") for a, b in items], "item_id long, text string, lang string")
    out = decontaminate.report(docs, bench).collect()
    assert Counter(map(tuple, out)) == brute_report([r[:2] for r in table()], items)
    assert Counter(map(tuple, decontaminate.report(docs, bench, most=40).collect())) == Counter(map(tuple, out))
    one, several = (decontaminate.remove(docs, bench, most=k) for k in (10**6, 40))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, several.collect()))
    none = decontaminate.report(docs, bench.limit(0)).collect()
    assert len(none) == len(table()) and not any(r.contaminated for r in none)
    assert decontaminate.report(empty, bench).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=5), st.lists(st.sampled_from("abcd"), max_size=30), st.integers(1, 5))
def test_automaton_against_windows(items, doc, span):
    a = Automaton({k: [w.encode() for w in ws] for k, ws in enumerate(items)}, span)
    spans, found = a.spans([w.encode() for w in doc])
    hit, want = set(), set()
    for k, ws in enumerate(items):
        for i in range(max(1, len(ws) - span + 1)) if ws else ():
            g = ws[i : i + span]
            for j in range(len(doc) - len(g) + 1):
                if doc[j : j + len(g)] == g:
                    hit |= set(range(j, j + len(g)))
                    want.add(k)
    assert {x for lo, hi in spans for x in range(lo, hi)} == hit and found == want


def test_passages_are_cut_out(spark):
    item = text(77, 15)
    docs = spark.createDataFrame([(1, f"Keep this, please. {item} And (this) too: " + text(1, 40), "en", "s", 1), (2, item, "en", "s", 1), (3, "clean  text\n", "en", "s", 12), (4, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in decontaminate.remove(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert set(out) == {1, 3, 4} and out[3].text == "clean  text\n" and out[4].text is None
    assert item not in out[1].text and out[1].text.startswith("Keep this, please.") and "And (this) too:" in out[1].text and out[1].n_chars == len(out[1].text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1200), st.data())
def test_codes_round_trip(ids, data):
    c = codes.Codes(codes.encode(np.array(ids, dtype=np.uint32)))
    assert len(c) == len(ids) and c.ids().tolist() == ids
    if ids:
        i = data.draw(st.integers(0, len(ids) - 1))
        j = data.draw(st.integers(i, len(ids)))
        assert c[i] == ids[i] and c.ids(i, j).tolist() == ids[i:j]
        assert codes.Remote(lambda at, n: codes.encode(np.array(ids, dtype=np.uint32))[at : at + n])[i] == ids[i]


def test_one_id_from_a_stored_file(spark, docs):
    files = tokens.write(docs, PATH)
    row = max(files.collect(), key=lambda r: len(r.raw))
    want = codes.Codes(bytes(row.raw)).ids()
    for f in files.inputFiles():
        path = f.removeprefix("file://")
        data = open(path, "rb").read()
        if (start := data.find(bytes(row.raw))) >= 0:
            break
    assert start >= 0, "the bytes lie in the file as they are"
    spent = []

    def read(at, n):
        spent.append(n)
        with open(path, "rb") as g:
            g.seek(start + at)
            return g.read(n)

    remote = codes.Remote(read)
    for i in (0, len(want) // 2, len(want) - 1):
        assert remote[i] == want[i]
    assert sum(spent) < 700 < len(row.raw)


def test_codes_reject_what_is_not_theirs():
    with pytest.raises(ValueError):
        codes.Codes(b"nothing")
    with pytest.raises(ValueError):
        codes.encode(np.array([70000]), (8, 8))
    with pytest.raises(IndexError):
        codes.Codes(codes.encode(np.array([1])))[1]


public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abzéñ日 \n\t.,'!1 　 ’😀Ã")), max_size=40), max_size=6))
def test_encoder_agrees_with_the_library(texts):
    e = tokens.encoder(PATH)
    flat, counts = e(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])][: len(texts)] == [x.ids for x in e.bpe.encode_batch(texts, add_special_tokens=False)] if texts else not len(flat)


def test_encoder_of_another_tokenizer_encodes_whole_texts():
    e = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Hello world the cats", None, "", "a  b", " x y"]
    flat, counts = e(pa.array(texts, pa.string()))
    assert not e.pieces and tokens.encoder(PATH).pieces
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [x.ids for x in e.bpe.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def thue_morse(n):
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


@settings(max_examples=12, deadline=None)
@given(st.integers(3, 12), st.lists(st.sampled_from(["{a}", "{b}", "x {a} {b} y", "{b} {b}", "{a}{b}"]), max_size=5))
def test_words_that_collide_by_power_sums(n, forms):
    a, b = thue_morse(n)
    texts = [x.format(a=a, b=b) for x in ["{a}", "{b}", *forms]]
    e = tokens.encoder(PATH)
    flat, counts = e(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [x.ids for x in e.bpe.encode_batch(texts, add_special_tokens=False)]
    buf = np.frombuffer(f"{a} {b} {a}\n".encode(), np.uint8)
    h = textbuf.hashes(buf, *textbuf.words(buf, ~textbuf.SPACE))
    assert h[0] == h[2] != h[1]


def test_encoder_with_a_hash_that_always_collides(monkeypatch):
    e = tokens.Encoder(PATH)
    monkeypatch.setattr(tokens.tb, "hashes", lambda buf, lo, hi: (hi - lo).astype(np.uint64) // np.uint64(12))
    for texts in (["the cat sat", "on another mat", "extraordinarily extraordinariLy long"], ["a dog sat", "the cat sat", "extraordinariLy so"]):
        flat, counts = e(pa.array(texts))
        assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [x.ids for x in e.bpe.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=90).map(lambda x: x.replace(b" ", b"_")), min_size=1, max_size=30))
def test_word_hashes_tell_words_apart(words):
    buf = np.frombuffer(b" ".join(words) + b"\n", np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    h = textbuf.hashes(buf, ends - [len(w) for w in words], ends)
    assert len(set(h.tolist())) == len(set(words)) == len(set(zip(words, h.tolist(), strict=True)))


def test_token_files(docs, empty):
    bpe = tokens.encoder(PATH).bpe
    out = tokens.read(tokens.write(docs, PATH, file_ids=500)).collect()
    start, want = 0, Counter()
    for d, t, _, _ in sorted(table(), key=key):
        ids = bpe.encode(t or "", add_special_tokens=False).ids + [0]
        want[(d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))] += 1
        start += len(ids)
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == want
    assert tokens.read(tokens.write(empty, PATH)).count() == 0


def test_scores(docs, empty):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    out = lm.score(docs, held).collect()
    is_held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    split = lambda t: [*(t or "").encode().translate(LOW).split(), b"\n"]
    c = Counter()
    for d, t, _, _ in table():
        if not is_held(d):
            c.update(split(t))
    n, v = sum(c.values()), len(c)
    want = Counter((d, is_held(d), len(split(t)), sum(c[w] > 0 for w in split(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in split(t)), 5)) for d, t, _, _ in table())
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want
    assert all(r.score < 0 for r in out)
    same = defaultdict(set)
    for r, (d, t, _, _) in zip(sorted(out, key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens)), sorted(table(), key=lambda r: (r[0] is None, r[0], len(split(r[1])))), strict=True):
        same[" ".join((t or "").split())].add(round(r.score, 2))
    assert all(len(x) == 1 for x in same.values())
    assert lm.score(empty, held).count() == 0
    assert all(r.n_known == 0 for r in lm.score(docs, F.lit(True)).collect())


def brute_tree(train, texts, least=2, nats=2.0, weight=0.9):
    """log10 probabilities of lists of words that end with an end, by dictionaries of contexts; the kept contexts."""
    n = defaultdict(Counter)

    def places(t):
        for i, x in enumerate(t):
            before = (["<s>", *t[:i]])[-2:]
            yield x, [tuple(before[len(before) - d :]) for d in range(min(len(before), 2) + 1)]

    for t in train:
        for x, contexts in places(t):
            for c in contexts:
                n[c][x] += 1
    total, kinds = sum(n[()].values()), len(n[()])

    def p(c, x, less):
        if not c:
            return (max(n[c][x] - less, 0) + 1) / (total - less + kinds + 1)
        size = max(sum(n[c].values()) - less, 0) if c in n else 0
        w = max(size, 1) ** weight
        return (max((n[c][x] if c in n else 0) - less, 0) + w * p(c[1:], x, less)) / (size + w)

    gain = Counter()
    for t in train:
        for x, contexts in places(t):
            for c in contexts[1:]:
                shorter = max(p(c[i:], x, 1) for i in range(1, len(c) + 1))
                gain[c] += math.log(p(c, x, 1) / shorter)
    kept = {c for c, g in gain.items() if g >= nats and sum(n[c].values()) >= least}
    return [sum(math.log10(p(max((c for c in contexts if not c or c in kept), key=len), x, 0)) for x, contexts in places(t)) for t in texts], kept, p


def plain_words(t):
    return [*(t or "").encode().translate(LOW).split(), "</s>"]


def test_scores_by_the_whole_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "SLICE", 700)
    rows = [(i, text(i, 12)) for i in range(30)] + [(i, text(7, 30) + " Quartz vow") for i in range(30, 33)] + [(33, "abc zbc " * 40), (40, "\0 zz  Quartz"), (41, None), (43, "one two"), (44, "one two"), (45, "quartz VOW")]
    out = lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), F.col("doc_id") % 5 == 2).collect()
    want, kept, _ = brute_tree([plain_words(t) for i, t in rows if i % 5 != 2], [plain_words(t) for _, t in rows])
    assert {1, 2} <= set(map(len, kept))
    want = {i: w for (i, _), w in zip(rows, want, strict=True)}
    assert len(out) == len(rows) and all(abs(r.score - want[r.doc_id]) < 1e-6 for r in out)
    assert all(r.held_out == (r.doc_id % 5 == 2) for r in out)


def test_contexts_stay_when_the_table_grows(spark):
    r = np.random.default_rng(0)
    odd = " ".join("".join(r.choice(list("qxzjkvw"), 6)) for _ in range(40))
    rows = [(i, odd) for i in range(3)]
    few = spark.createDataFrame(rows + [(9, text(9, 2000))], "doc_id long, text string")
    much = spark.createDataFrame(rows + [(i, text(i, 20_000)) for i in range(9, 59)], "doc_id long, text string")
    a, b = (lm.score(t, F.col("doc_id") == 0).where("doc_id = 0").first() for t in (few, much))
    assert a.score / a.n_tokens > -0.5 and b.score / b.n_tokens > -0.5 and b.base_score / b.n_tokens < -4


def test_documents_that_occur_twice_stand_apart(spark):
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    make = lambda: " ".join(r.choice(words, 120))
    twice, once = [make() for _ in range(20)], [make() for _ in range(100)]
    rows = [(i, t) for i, t in enumerate(twice * 2 + once)]
    out = {x.doc_id: x.score - x.base_score for x in lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), F.lit(False)).collect()}
    assert min(out[i] for i in range(40)) > max(out[i] for i in range(40, 140)) + 50


def test_suffix_tree_is_a_distribution():
    train = [plain_words(text(i, 30)) for i in range(40)]
    _, kept, p = brute_tree(train, [])
    known = {x for t in train for x in t}
    assert kept and all(abs(sum(p(c, x, 0) for x in known) + p(c, "never seen", 0) - 1) < 1e-9 for c in kept | {()})


def test_chains_against_enumeration():
    r = np.random.default_rng(4)
    for n, k in ((1, 3), (4, 2), (5, 3)):
        e, a = r.normal(size=(n, k)), r.normal(size=(k, k))
        p, pairs, z = crf.marginals(e, np.array([0]), np.array([n]), a, pairs=True)
        want, total, both = np.zeros((n, k)), 0.0, np.zeros((k, k))
        for code in range(k**n):
            ys = [code // k**i % k for i in range(n)]
            w = math.exp(sum(e[i, y] for i, y in enumerate(ys)) + sum(a[x, y] for x, y in zip(ys, ys[1:], strict=False)))
            total += w
            for i, y in enumerate(ys):
                want[i, y] += w
            for x, y in zip(ys, ys[1:], strict=False):
                both[x, y] += w
        assert np.allclose(p, want / total) and np.allclose(pairs, both / total) and abs(z - math.log(total)) < 1e-9


def test_long_chains_are_whole():
    r = np.random.default_rng(6)
    for k, lengths in ((2, [10_000, 3, 256, 257]), (4, [1, 513, 10_000])):
        e, a = 3 * r.normal(size=(sum(lengths), k)), r.normal(size=(k, k)) + 3 * np.eye(k)
        starts = np.cumsum(lengths) - lengths
        p, pairs, z = crf.marginals(e, starts, np.array(lengths), a, pairs=True)
        want, both, total = np.zeros((0, k)), np.zeros((k, k)), 0.0
        for at, n in zip(starts, lengths, strict=True):
            f, b = np.exp(e[at : at + n]), np.ones((n, k))
            x = f.copy()
            for t in range(n):
                f[t] = x[t] * (f[t - 1] @ np.exp(a) if t else 1)
                total += math.log(f[t].sum())
                f[t] /= f[t].sum()
            for t in range(n - 2, -1, -1):
                b[t] = np.exp(a) @ (x[t + 1] * b[t + 1])
                b[t] /= b[t].sum()
            q = f * b
            want = np.concatenate([want, q / q.sum(axis=1, keepdims=True)])
            for t in range(n - 1):
                y = f[t][:, None] * np.exp(a) * (x[t + 1] * b[t + 1])[None]
                both += y / y.sum()
        assert np.abs(p - want).max() < 1e-9 and np.allclose(pairs, both) and abs(z - total) < 1e-6


def junk(seed):
    return " | ".join(np.random.default_rng(seed).choice(WORDS, 30)) + "\n" + "BUY!! NOW!! " * 10


def test_quality(spark, docs, empty):
    rows = [(i, text(i, 60) + ".\n" + text(i + 500, 40) + "." if i % 2 else junk(i), i) for i in range(200)]
    t = spark.createDataFrame(rows, "doc_id long, text string, size long")
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(200)] + [(None, 1, 0, "x"), (3, None, 0, "x")], "doc_id long, quality int, toxic int, text string")
    model = quality.learn(t, labels, F.col("doc_id") % 3 != 1)
    out = {r.doc_id: r.score for r in quality.score(t, model).collect()}
    assert all((out[i] >= 0.5) == bool(i % 2) for i in range(200))
    odd = quality.score(docs, model).collect()
    assert len(odd) == len(table()) and all(0 <= r.score <= 1 for r in odd)
    assert quality.score(empty, model).count() == 0
    kept = {r.doc_id for r in quality.keep_good(t.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars")), model).collect()}
    assert kept == set(range(1, 200, 2))
    halves = [("\n".join(text(900 + j, 40) + "." for j in range(6)), 1), ("\n".join(junk(j) for j in range(6)), 0)]
    for (a, first), (b, second) in (halves, halves[::-1]):
        p, _, _ = model.lines(pa.array([a + "\n" + b]))
        k = a.count("\n") + 1
        assert ((p[:k] >= 0.5) == first).mean() > 0.9 and ((p[k:] >= 0.5) == second).mean() > 0.9
    blind = quality.learn(empty, labels.limit(0), F.lit(True))
    assert {round(r.score, 3) for r in quality.score(docs, blind).collect()} == {0.5}


def test_language(spark, docs, empty):
    parts = {"aa": ["tion", "ing", "the"], "bb": ["heit", "sch", "und"], "cc": ["ción", "ado", "que"]}

    def make(lang, seed, n=40):
        r = np.random.default_rng(seed)
        return " ".join("".join(r.choice(parts[lang], r.integers(1, 4))) for _ in range(n))

    rows = [(i, make(lang, i), lang) for i, lang in enumerate(list(parts) * 60)]
    t = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(t, F.col("doc_id") % 5 != 0)
    out = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(t, model).collect()}
    assert all(out[i][0] == lang and 0 <= out[i][1] <= 1 for i, _, lang in rows)
    mixed = pa.array([make("aa", 900, 60) + " " + make("bb", 901, 20), "12 34 !!", None, "日本"])
    names, share = model.predict(mixed)
    assert names[0] == "aa" and 0.6 < share[0] < 0.9 and names[1:3] == ["und", "und"] and names[3] in parts and share[1] == 0
    order = ["aa", "bb", "cc", "aa"]
    p, _ = model.words(pa.array([" ".join(make(x, 950 + j, 250) for j, x in enumerate(order))]))
    assert (p.argmax(axis=1) == np.repeat([model.names.index(x) for x in order], 250)).mean() > 0.97
    assert len(language.identify(docs, model).collect()) == len(table()) and language.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.learn(empty, F.lit(True))).collect()} == {"und"}


def brute_rule(host, path):
    best = None
    for v, h, p in reputation.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best or (None, None)


def test_reputation(spark):
    urls = ["http://A.Example.ORG/es/x?y", "https://x.org", "ftp://b.com/fr/1#z", "http://b.com/de/", "http://example.org/en/1", "http://notexample.org/en/1", "no url", None, "", "http://bad.net/x", "://h?/q", "a://b://c/d", "http://xcom/fr/"]
    rows = [(i, u, "<p>", 1) for i, u in enumerate(urls)] + [(100 + i, "http://bad.net/p", "", 2) for i in range(60)] + [(200 + i, "http://good.net/p", "", 2) for i in range(60)] + [(None, "http://good.net/", "", 0), (3, "http://b.com/de/", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n int")
    labels = spark.createDataFrame([(100 + i, int(i % 5 == 0), 0) for i in range(60)] + [(200 + i, 1, 0) for i in range(60)] + [(None, 0, 1), (0, None, None)], "doc_id long, quality int, toxic int")
    out = reputation.judge(pages, labels).collect()
    assert Counter(r.page_id for r in out) == Counter(r[0] for r in rows)
    for r in out:
        u = next(x[1] for x in rows if x[0] == r.page_id)
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        assert (r.host, r.path) == ((m[1].lower(), m[2]) if m else ("", ""))
        rule, verdict = brute_rule(r.host, r.path)
        assert r.rule == rule and (verdict is None or r.verdict == verdict)
    by = {r.host: r.verdict for r in out if r.rule is None}
    assert by["bad.net"] == "block" and by["good.net"] == "allow"
    assert reputation.judge(pages.limit(0), labels).count() == 0
    assert {r.verdict for r in reputation.judge(pages, labels.limit(0)).collect() if r.rule is None} == {"allow"}


def test_registered_domains_and_addresses(spark):
    names = {"a.bad.co.uk": ("bad.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.com": ("y.com", "com"), "com": ("com", "com"), "": ("", ""), "10.0.0.1": ("10.0.0.1", ""), "[::1]": ("[::1]", ""), "1.2.3.4.com": ("4.com", "com"), "xco.uk": ("xco.uk", "uk"), "a.b.co.il": ("b.co.il", "co.il"), "co.com": ("co.com", "com")}
    t = spark.createDataFrame([(k,) for k in names], "h string")
    domain, suffix = reputation.levels(F.col("h"))
    assert {r.h: (r.d, r.s) for r in t.select("h", domain.alias("d"), suffix.alias("s")).collect()} == names
    hosts = ["u:p@bad.co.uk", "bad.co.uk:800", "bad.co.uk", "a@b@bad.co.uk:", "[::1]:80", "fine:8x"]
    sites = [r.s for r in spark.createDataFrame([(h,) for h in hosts], "h string").select(reputation.site(F.col("h")).alias("s")).collect()]
    assert sites == ["bad.co.uk"] * 4 + ["[::1]", "fine:8x"]


def test_listed_suffixes(spark):
    counted = spark.createDataFrame([(h, 1, 0) for h in ("a.b.site.io", "b.site.io", "site.io", "x.co.il", "10.0.0.1", "", "q.w.other")], "host string, n long, bad long")
    listed = spark.createDataFrame([("Site.io",), ("io",), ("b.site.io",), (None,), ("",)], "suffix string")
    got = {r.host: (r.domain, r.suffix) for r in reputation.with_levels(counted, reputation.SECOND, listed).collect()}
    assert got == {"a.b.site.io": ("a.b.site.io", "b.site.io"), "b.site.io": ("b.site.io", "b.site.io"), "site.io": ("site.io", "site.io"), "x.co.il": ("x.co.il", "co.il"), "10.0.0.1": ("10.0.0.1", ""), "": ("", ""), "q.w.other": ("w.other", "other")}


@pytest.mark.parametrize("end", ["co.il", "com.pl", "gov.za"])
def test_a_bad_domain_of_any_country_leaves_strangers_alone(spark, end):
    urls = [(i, f"http://bad.{end}/x") for i in range(60)] + [(100 + i, f"http://fine{i}.{end}/") for i in range(5)] + [(300 + i, f"http://good{i % 9}.net/") for i in range(90)]
    labels = spark.createDataFrame([(i, 0, 0) for i in range(60)] + [(300 + i, 1, 0) for i in range(90)], "doc_id long, quality int, toxic int")
    out = {r.page_id: r.verdict for r in reputation.judge(spark.createDataFrame(urls, "page_id long, url string"), labels).collect()}
    assert {out[100 + i] for i in range(5)} == {"allow"} and out[0] == "block"


def test_items_without_id(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "l m n"), (3, "a b c d e f g h i j l m n")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b c d e f g h i j"), (None, "l m n"), (7, "m n")], "item_id long, text string")
    for most in (decontaminate.PASS_WORDS, 1):
        got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.report(docs, items, most=most).collect()}
        none, seven = (hashlib.sha256(x.encode()).hexdigest() for x in ("", "7"))
        assert got == {1: (10, 1, none), 2: (3, 2, seven), 3: (13, 2, seven)}


def test_a_bad_host_does_not_taint_its_public_suffix(spark):
    urls = [(i, "http://bad.co.uk/x") for i in range(60)] + [(100 + i, f"http://fine{i}.co.uk/") for i in range(3)] + [(200, "http://u:p@bad.co.uk/"), (201, "http://bad.co.uk:800/"), (202, "http://[::1]:8/"), (203, "http://10.0.0.1/")]
    urls += [(300 + i, f"http://good{i % 9}.net/") for i in range(90)]
    labels = spark.createDataFrame([(i, 0, 0) for i in range(60)] + [(300 + i, 1, 0) for i in range(90)], "doc_id long, quality int, toxic int")
    out = {r.page_id: (r.host, r.verdict) for r in reputation.judge(spark.createDataFrame(urls, "page_id long, url string"), labels).collect()}
    assert {out[100 + i][1] for i in range(3)} == {"allow"} and out[200] == ("u:p@bad.co.uk", "block") and out[201] == ("bad.co.uk:800", "block") and out[0][1] == "block"
    assert out[202][1] == out[203][1] == "allow"


def test_ordered_ranges(docs):
    got = [r.doc_id for r in ordered.by_id(docs).collect()]
    assert [x for x in got if x is not None] == sorted(x for x in got if x is not None) and len(got) == len(table())
