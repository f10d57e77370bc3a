"""The stages over a small folder, each against what it was given."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from strandloom.llm import queries
from tests.llm.test_operators import brute_report, brute_simhash, junk, text

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, text(i, 60) + ".\n" + text(i + 500, 50) + "." if i % 4 else junk(i), "en", f"s{i % 5}") for i in range(160)]
    rows += [(200 + i, rows[1][1], "en", "s0") for i in range(30)]
    item = " ".join(np.random.default_rng(7).choice(["alpha", "beta", "gamma", "delta", "rho"], 14))
    rows += [(300, rows[2][1].replace("\n", f" {item} \n"), "en", None), (301, None, "en", "s1"), (302, "", None, None), (1, rows[1][1], "en", "s1")]
    docs = [(a, b, c, d, len(b or "")) for a, b, c, d in rows]
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(160) if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, item


def test_stages(spark, folder):
    root, item = folder
    seen = []
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, root).write.parquet(f"{root}/stage{k}")
        docs = spark.read.parquet(f"{root}/stage{k}")
        seen.append(docs.collect())
        if k < 4:
            assert docs.schema == spark.createDataFrame([], DOCS).schema
    good, single, clean, mixed, shards = seen
    ids = [r.doc_id for r in good]
    assert {i for i in range(160) if i % 4} <= set(ids) and not {i for i in range(160) if not i % 4} & set(ids)
    fp = {r.doc_id: brute_simhash(r.text) for r in good}
    kept = [r.doc_id for r in single]
    assert len(kept) == len(set(kept)) and 1 in kept and not any(200 <= i < 300 for i in kept)
    for i in kept:
        assert all((fp[i] ^ fp[j]).bit_count() > 4 for j in kept if j < i)
    assert {r.doc_id for r in clean} == set(kept)
    assert all(c[2] == 0 for c in brute_report([(r.doc_id, r.text) for r in clean], [(1, item)]))
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2 and {r.doc_id for r in mixed} <= set(kept)
    assert Counter((r.doc_id, r.text) for r in shards) == Counter((r.doc_id, r.text) for r in mixed)
    assert all(r["size"] == len((r.text or "").encode()) + 1 for r in shards)


def test_near_copies_down_to_08(spark):
    r = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, want = [], set()
    for i in range(150):
        w = list(r.choice(vocabulary, 500))
        rows.append((i, " ".join(w)))
        for k, changed in enumerate((5, 9, 150)):
            v = list(w)
            for at in r.choice(500, changed, replace=False):
                v[at] = f"x{i}-{at}"
            a, b = ({tuple(x[j : j + 5]) for j in range(496)} for x in (w, v))
            rows.append((1000 * (k + 1) + i, " ".join(v)))
            if len(a & b) >= 0.8 * len(a | b):
                want.add(rows[-1][0])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS).repartition(4)
    kept = {x.doc_id for x in corpus_pipeline.near_copies_stage(spark, docs, "").collect()}
    assert len(want) > 250 and {i for i, _ in rows} - kept == want


def test_template_family_loses_no_link(spark):
    # slots of a template differ at random: links of just 0.8 beside pairs just below it
    r = np.random.default_rng(11)
    rows = []
    for i in range(400):
        w = [f"t{j}" for j in range(120)]
        for at in (20, 60, 100):
            w[at] = f"v{r.integers(0, 40)}"
        if r.random() < 0.5:
            w[80] = f"z{r.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[x : x + 5]) for x in range(116)} for _, t in rows]
    fps = [brute_simhash(t) for _, t in rows]
    root = list(range(400))
    for i in range(400):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) or (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS).repartition(4)
    assert {x.doc_id for x in corpus_pipeline.near_copies_stage(spark, docs, "").collect()} == set(root)


def test_two_sources_with_equal_texts_are_mixed_apart(spark):
    # of equal texts without id each source has its own share
    rows = [(None, text(i % 20, 30), f"s{i % 2}") for i in range(200)] + [(None, text(50, 30), "s1")] * 40
    docs = spark.createDataFrame([(i, t, None, s, 1) for i, t, s in rows], DOCS).repartition(4)
    from strandloom.llm import mixing

    want = Counter()
    for x in mixing.mix(docs).where("copies > 0").collect():
        want[x.source, x.text_hash] += x["copies"]
    out = corpus_pipeline.mixing_stage(spark, docs, "").selectExpr("source", "xxhash64(text) as h").collect()
    assert Counter((x.source, x.h) for x in out) == want


def test_rows_are_told_apart_by_id_and_text(spark):
    a, near, b = text(1, 80), text(1, 79), text(2, 90)
    rows = [(1, a, "s"), (5, a, "s"), (5, b, "s"), (5, b, "t"), (7, near + " tail", "s"), (None, a, "s"), (None, a, "t"), (None, None, "s"), (8, None, "s"), (9, "", "s"), (10, "x" * 200_000, "s")]
    docs = spark.createDataFrame([(i, t, "en", s, 1, "extra", "row", 3) for i, t, s in rows], DOCS + ", digest string, row string, near long").repartition(3)
    out = corpus_pipeline.near_copies_stage(spark, docs, "")
    assert out.columns == [x.split()[0] for x in DOCS.split(", ")]
    want = Counter([(1, a, "s"), (5, b, "s"), (None, a, "s"), (None, a, "t"), (None, None, "s"), (8, None, "s"), (10, "x" * 200_000, "s")])
    assert Counter((r.doc_id, r.text, r.source) for r in out.collect()) == want


def test_stages_of_odd_rows(spark, folder):
    root, item = folder
    rows = [(1, text(1, 60)), (1, text(2, 60)), (1, text(1, 60)), (None, text(3, 60)), (None, text(3, 60)), (None, None), (2, ""), (3, item), (4, "a " * 50_000)]
    docs = spark.createDataFrame([(i, t, "en", None, 1, 5, "z") for i, t in rows], DOCS + ", size long, shard string").repartition(2)
    whole = Counter(rows)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = [(r.doc_id, r.text) for r in stage(spark, docs, root).collect()]
        if k == 1:
            assert Counter(out) == Counter([(1, text(1, 60)), (1, text(2, 60)), (None, text(3, 60)), (None, text(3, 60)), (None, None), (2, ""), (3, item), (4, "a " * 50_000)])
        elif k == 2:
            assert Counter(out) == whole - Counter([(3, item)])
        elif k == 3:
            assert set(out) <= set(rows) and max(Counter(out).values()) <= 2 * max(whole.values())
        elif k == 4:
            assert Counter(out) == whole


def test_run_equals_the_stages(spark, folder):
    root, _ = folder
    out = corpus_pipeline.run(spark, root)
    assert Counter((r.doc_id, r.shard, r.slot) for r in out.collect()) == Counter((r.doc_id, r.shard, r.slot) for r in spark.read.parquet(f"{root}/stage4").collect())


def test_empty_documents(spark, folder, tmp_path):
    root, _ = folder
    d = str(tmp_path)
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{root}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{d}/documents.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0


def test_names():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 13))
