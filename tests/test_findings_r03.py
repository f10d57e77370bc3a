"""Findings of round 3: what must not come back."""

import re

import numpy as np
from pyspark.sql import functions as F

from strandloom.operators import evaluation, graphs, intervals, lsh, partitions, seqprep, trees, vectors
from strandloom.plans import further, similarity
from strandloom.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_ranking_shuffles_no_pairs(spark):
    x = np.random.default_rng(5).integers(-2, 3, (90, 4)).astype(float)
    t = spark.createDataFrame([(i * 7 % 90, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    vec = {i * 7 % 90: v for i, v in enumerate(x)}
    out = lsh.full_ranking(t, cells=900, block=16, parts=3)
    assert "Window" not in plan(out)
    want = set()
    for a in vec:
        order = sorted((-float(vec[a] @ vec[b]), b) for b in vec if b != a)
        want |= {(a, b, -s + 0.0, k) for k, (s, b) in enumerate(order, 1)}
    assert {tuple(r) for r in out.collect()} == want
    # beyond what fits beside the place in one number
    large = t.selectExpr("id", "transform(vec, x -> x * 1e9) as vec")
    assert {(r.a, r.b, r.rank) for r in lsh.full_ranking(large, cells=900, block=16, parts=3).collect()} == {(a, b, k) for a, b, _, k in want}


def test_fragments_grow_in_one_pass_over_sorted_rows(spark):
    r = np.random.default_rng(9)
    rows = []
    for i in range(900):
        a, n = int(r.integers(1, 1500)), int(r.integers(1, 90))
        rows.append((i, f"s{i % 5}", a, a + n, "+-"[i % 2], f"k{i}", "ACGU"[i % 4] * (n + 1)))
    t = spark.createDataFrame(rows, "id long, seqid string, start int, stop int, strand string, key string, seq string").repartition(4)
    out = intervals.merge_fragments(t, cutoff=0.4)
    # not a group of pandas for each sequence: these are too many
    assert "FlatMapGroupsInPandas" not in plan(out)
    want = []
    for of in {(x[1], x[4]) for x in rows}:
        left = sorted((x for x in rows if (x[1], x[4]) == of), key=lambda x: (x[2], x[3], x[0]))
        while left:
            base, left = left[0], left[1:]
            stop, text, trace, grown = base[3], base[6], [f"{base[0]}:{base[5]}"], True
            while grown:
                grown = False
                for x in list(left):
                    common, short = min(stop, x[3]) - max(base[2], x[2]) + 1, min(stop - base[2], x[3] - x[2]) + 1
                    if common > 0 and (200 * common + short) // (2 * short) >= 40:
                        more = max(0, x[3] - stop)
                        if more:
                            text = text + x[6][-more:] if of[1] == "+" else x[6][:more] + text
                        stop, grown = max(stop, x[3]), True
                        trace.append(f"{x[0]}:{x[5]}")
                        left.remove(x)
            want.append((f"{base[0]}.1", of[0], of[1], base[2], stop, text, ";".join(trace)))
    assert sorted(tuple(x) for x in out.collect()) == sorted(want) and len(want) < 700
    assert intervals.merge_fragments(t.where("id < 0")).collect() == []


def _features(spark, n, words, seed):
    r = np.random.default_rng(seed)
    rows = {(i, int(f)): float(r.integers(1, 5)) / 4 for i in range(n) for f in r.zipf(1.4, 12) % words + 1}
    t = spark.createDataFrame([(i * 3 % n, f, v) for (i, f), v in rows.items()], "id long, f long, v double").repartition(4)
    of = {}
    for (i, f), v in rows.items():
        of.setdefault(i * 3 % n, {})[f] = v
    return t, of


def _dot(x, y):
    return round(sum(v * y[f] for f, v in x.items() if f in y), 6)


def test_kernel_matrix_shuffles_no_pairs(spark):
    t, of = _features(spark, 100, 300, 11)
    zero = spark.createDataFrame([(200, 7, 0.0), (201, 7, 0.0), (202, None, 1.0)], "id long, f long, v double")
    of |= {200: {7: 0.0}, 201: {7: 0.0}}
    out = lsh.kernel_matrix(t.union(zero), block=16, parts=3)
    # pairs leave as they are made: nothing is grouped behind that
    assert "MapInArrow" in plan(out) and "Aggregate" not in plan(out).split("MapInArrow")[0]
    want = {(i, j): _dot(of[i], of[j]) for i in of for j in of if i <= j and of[i].keys() & of[j].keys()}
    got = {(r.i, r.j): r.sim for r in out.collect()}
    assert got == want and got[200, 201] == 0


def test_exact_sparse_neighbours_of_blocks(spark):
    t, of = _features(spark, 97, 500, 12)
    got = {}
    for r in lsh.exact_sparse_knn(t, 4, block=10, parts=3).collect():
        got.setdefault(r.a, []).append((r.rank, r.b, r.sim))
    for a in of:
        near = sorted((b != a, -_dot(of[a], of[b]), b) for b in of)[:4]
        assert sorted(got[a]) == [(k, b, -s) for k, (_, s, b) in enumerate(near, 1)]


def test_cross_products_of_rare_and_frequent_features():
    r = np.random.default_rng(13)
    x, y = (r.random((m, 90)) * (r.random((m, 90)) < r.random(90) ** 3) for m in (60, 50))
    own, other = ((*np.nonzero(z), z[np.nonzero(z)]) for z in (x, y))
    for width, most in ((2048, 1 << 22), (7, 5)):
        assert np.allclose(lsh._cross(own, other, 60, 50, width=width, most=most), x @ y.T)
        assert (lsh._cross(own, other, 60, 50, True, width, most) == (x > 0).astype(float) @ (y > 0).T.astype(float)).all()


def test_class_similarities_of_groups_make_no_pairs(spark):
    r = np.random.default_rng(14)
    x = r.normal(size=(150, 6))
    v = spark.createDataFrame([(i % 3, i * 7, z.tolist()) for i, z in enumerate(x)] + [(9, 5000, [1.0] * 6)], "group long, id long, vec array<double>")
    classes = spark.createDataFrame([(i * 7, i % 4) for i in range(150) if i % 4], "id long, class long")
    sims = spark.createDataFrame([("k", i * 7, j * 7, float(x[i] @ x[j])) for i in range(150) for j in range(i + 1, 150) if i % 3 == j % 3], "kind string, i long, j long, val double")
    out = evaluation.class_similarities_of_groups(v, classes, {"k": lambda i, u, j, w: u @ w.T}, block=8)
    assert "Join" not in plan(out).split("FlatMapGroupsInArrow")[0]
    got = {tuple(r)[:4]: r.mean for r in out.collect()}
    want = {tuple(r)[:4]: r.mean for r in evaluation.class_similarities(sims, classes).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-5 for k in want) and len(want) == 15


def test_overlapping_cells_are_damped_row_by_row(spark):
    r = np.random.default_rng(15)
    rows = [(i, f"s{i % 2}", int(a), int(a) + 40, "+") for i, a in enumerate(r.integers(1, 400, 60))]
    f = spark.createDataFrame(rows, "id long, seqid string, start long, stop long, strand string")
    val = lambda i, j: (i * 7 + j * 3) % 50 / 4 - 2
    pairs = intervals.pairs_within(f, 4)
    cells = pairs.selectExpr("a_id as i", "b_id as j", "(a_id * 7 + b_id * 3) % 50 / 4 - 2 as val", *[f"{p}_{c}" for p in "ab" for c in ("seqid", "start", "stop")])
    out = intervals.damp_cells(cells, 1)
    # cells aren't sent anywhere
    assert "SortMergeJoin" in plan(out) and "hashpartitioning" not in plan(out).split("SortMergeJoin")[0]
    want = {}
    for i, s, a, b, _ in rows:
        for j, q, c, e, _ in rows:
            common = min(b, e) - max(a, c) + 1
            hit = i != j and s == q and common > 0 and (200 * common + 41) // 82 >= 10
            want[i, j] = (s == q, -3.0 if hit else val(i, j))
    got = {(x.i, x.j): x.val for x in out.collect()}
    assert got.keys() == {k for k, (same, _) in want.items() if same} and all(abs(got[k] - want[k][1]) <= 0.05 for k in got)
    every = spark.createDataFrame([(i, j, val(i, j)) for i, j in want], "i long, j long, val double")
    assert {(x.i, x.j): x.val for x in intervals.damp_overlapping(every, f, 1).collect()}.items() >= got.items()


def test_hits_are_not_dealt_by_cluster(spark):
    rows = [(f"k{i}", float(i), None, f"1.{i % 4}") for i in range(40)]
    h = spark.createDataFrame(rows, "key string, bitscore double, evalue double, name string")
    merged = spark.createDataFrame([("1.1", "1.3"), ("1.2", "1.3")], "name string, cluster string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = partitions.filter_clusters(h, 15, merged)
        out = partitions.partition_rows(kept, partitions.cluster_index(kept.select(kept["cluster"].alias("name"))))
        assert "SortMergeJoin" not in plan(out)
        assert {(r.key, r.merged, r.name, r.idx) for r in out.collect()} == {(k, "1.3", n, 1) for k, _, _, n in rows if n != "1.0"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_balls_are_encoded_without_a_group_for_each_graph(spark):
    v, e = graphs.backbone(spark.createDataFrame([(g, "ACGUACGA"[: 4 + g % 5]) for g in range(40)], "graph_id long, seq string"))
    out = graphs.encode_rk(v, graphs.undirected(e), 2)
    assert "InPandas" not in plan(out)
    got = {}
    for r in out.collect():
        got.setdefault(r.graph_id, {})[r.vid] = r.enc
    assert all(len(got[g]) == 4 + g % 5 and got[g] == got[g % 5] for g in range(40)) and len(set(got[4].values())) > 3
    # a graph without edges has its vertices' balls
    assert graphs.encode_rk(v.where("vid = 0"), e.where("src < 0"), 2).count() == 40


def test_best_candidates_keep_no_row_for_each_pair_of_a_bin(spark):
    r = np.random.default_rng(1)
    rows = [(i * 3, k, int(r.integers(0, 25))) for i in range(300) for k in range(12)]
    t = spark.createDataFrame(rows, "id long, k int, h long").repartition(3)
    want = sorted(tuple(x) for x in lsh.trim(lsh.candidate_pairs(t, 300, 0.06), 7).collect())
    assert len(want) > 2000
    for how in ({}, {"block": 64, "hits": 500}, {"block": 20, "part": 100, "hits": 100}):
        out = lsh.best_candidates(t, 300, 0.06, 7, **how)
        assert "mapInArrow" in plan(out).replace("MapInArrow", "mapInArrow") and plan(out).count("SortMergeJoin") + plan(out).count("HashJoin") <= 2
        assert sorted(tuple(x) for x in out.collect()) == want
    # ids that don't fit beside row and count in one number
    far = t.selectExpr("id - 200 as id", "k", "h")
    assert sorted((x.a + 200, x.b + 200, x.shared) for x in lsh.best_candidates(far, 300, 0.06, 7, block=64, hits=500).collect()) == want
    assert lsh.best_candidates(t.where("id < 0"), 0, 1.0, 7).collect() == []


def test_rerank_shuffles_no_features_for_each_pair(spark):
    r = np.random.default_rng(1)
    known = {i: {int(f): float(r.integers(1, 4)) for f in r.choice(60, 8, replace=False)} for i in range(200) if i % 17}
    pairs = [(i, int(j)) for i in range(200) if i % 5 for j in r.choice(200, 12, replace=False) if j != i]
    c = spark.createDataFrame(pairs, "a long, b long").repartition(3)
    f = spark.createDataFrame([(i, f, v) for i, x in known.items() for f, v in x.items()], "id long, f long, v double").repartition(3)
    want = set()
    for a in {a for a, _ in pairs}:
        dots = [(b != a, -sum(v * known.get(b, {}).get(f, 0) for f, v in known.get(a, {}).items()), b) for b in {b for p, b in pairs if p == a} | {a}]
        want |= {(a, b, k, 0.0 - s) for k, (_, s, b) in enumerate(sorted(dots)[:4], 1)}
    for how in ({}, {"block": 30, "part": 70, "steps": 40}):
        out = lsh.rerank(c, f, 4, **how)
        assert "FlatMapGroupsInArrow" not in plan(out)
        assert {tuple(x) for x in out.collect()} == want
    assert lsh.rerank(c.where("a < 0"), f, 4).collect() == []


def test_prediction_by_bins_forms_no_pairs_by_a_join(spark, tmp_path):
    words = [f"w{chr(97 + i % 7)}{chr(97 + i % 5)} same{chr(97 + i % 3)} x{chr(97 + i % 11)}" for i in range(60)]
    spark.createDataFrame([(i, w, f"s{i % 2}", f"l{i % 3}", len(w)) for i, w in enumerate(words)], "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = similarity.knn_predict_lsh(spark, str(tmp_path))
    assert "CartesianProduct" in plan(out)
    n = 60
    old = lsh.trim(lsh.candidate_pairs(similarity.signatures(spark, str(tmp_path)), n, lsh.max_bin_share(n)), similarity.EXCESS * similarity.KNN)
    labels = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("doc_id as id", "lang as label")
    want = {tuple(x) for x in lsh.knn_predict(old, labels).collect()}
    assert len(want) > 50 and {tuple(x) for x in out.collect()} == want


def test_near_copies_travel_whole_only_where_signatures_agree(spark):
    r = np.random.default_rng(3)
    texts = {i: "".join(r.choice(list("abcdé "), 400)) for i in range(40)}
    for i in range(10):
        texts[100 + i] = texts[i][:395] + "xyzzy"
        texts[200 + i] = texts[i][:200] + texts[i + 20][:200]
    texts |= {300: "", 301: "ab", 302: "ab"}
    t = spark.createDataFrame(list(texts.items()), "value long, seq string").repartition(3)
    sets = {i: {x[j : j + 8] for j in range(max(1, len(x) - 7))} for i, x in texts.items()}
    assert {x.id: len(x.fs) for x in seqprep.shingle_sets(t, 8).collect()} == {i: len(x) for i, x in sets.items()}
    want = {i: min(j for j in sets if len(sets[i] & sets[j]) >= 0.9 * len(sets[i] | sets[j])) for i in sets}
    assert {x.value: x.keeper for x in seqprep.near_duplicates(t, 0.9).collect()} == want
    # bins in which all are: groups of signatures that agree, each once
    s = lsh.set_signature(seqprep.shingle_sets(t, 8), 32)
    bins = spark.createDataFrame([(b, i) for b in (1, 2) for i in texts], "bin long, id long")
    groups = {}
    for x in lsh.alike_groups(bins, s, lsh.agreement(0.9, 32)).collect():
        groups.setdefault(x.bin, set()).add(x.id)
    assert len(groups) < 15 and all({i, 100 + i} <= next(g for g in groups.values() if i in g) for i in range(10))
    assert lsh.agreement(0.9, 32) == 15


def test_bins_are_compared_in_rounds(spark):
    r = np.random.default_rng(8)
    vec = {i: {int(f): float(r.integers(1, 4)) for f in r.choice(90, 9, replace=False)} for i in range(150)}
    f = spark.createDataFrame([(i, f, v) for i, x in vec.items() for f, v in x.items()], "id long, f long, v double").repartition(3)
    met = [(int(b), i) for i in vec for b in set(r.integers(0, 12, 3))]
    bins = spark.createDataFrame(met, "bin long, id long").repartition(3)
    own = {b: {i for c, i in met if c == b} for b in range(12)}
    want = set()
    for a in vec:
        others = set().union(*[m for m in own.values() if a in m])
        dots = sorted((b != a, -sum(v * vec[b].get(f, 0) for f, v in vec[a].items()), b) for b in others)
        want |= {(a, b, k, 0.0 - s) for k, (_, s, b) in enumerate(dots[:4], 1)}
    for rows in (1 << 22, 100):
        assert {tuple(x) for x in lsh.bin_neighbors(bins, f, 4, rows=rows).collect()} == want


def test_lines_of_sparse_vectors_are_numbered_across_splits(spark, tmp_path):
    lines = [" 1:0.5 2:1.5e-1\r" if i % 5 == 0 else "" if i % 5 == 1 else f"{i}:{i}.25  7:1" for i in range(400)]
    for k in range(2):
        (tmp_path / f"part{k}.txt").write_bytes("\n".join(lines[k * 100 :]).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        out = readers.read_sparse_text(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        got = sorted(tuple(x) for x in out.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert "wholetext" not in plan(out) and out.inputFiles()
    want = []
    for k in range(2):
        for i, x in enumerate(x for x in lines[k * 100 :] if x.strip(" ")):
            want += [(i, int(e.split(":")[0]), float(e.split(":")[1])) for e in x.split()]
    assert got == sorted(want)


def test_candidates_bring_their_labels_along(spark, tmp_path):
    r = np.random.default_rng(5)
    rows = [(i, k, int(r.integers(0, 9))) for i in range(300) if i % 13 for k in range(6)]
    t = spark.createDataFrame(rows, "id long, k int, h long").repartition(3)
    named = [(i, None if i % 5 == 0 else f"l{i % 3}") for i in range(0, 300) if i % 7] + [(i, "more") for i in range(0, 300, 4)] + [(900, "x"), (None, "x")]
    labels = spark.createDataFrame(named, "id long, label string").repartition(3)
    old = lsh.trim(lsh.candidate_pairs(t, 300, 0.12), 7)
    want = sorted(map(str, old.join(labels.selectExpr("id as b", "label"), "b").select("a", "b", "shared", "label").collect()))
    for how in ({}, {"block": 64, "part": 100, "hits": 500}):
        out = lsh.best_candidates(t, 300, 0.12, 7, labels=labels, **how)
        assert "Inner" not in plan(out)
        assert sorted(map(str, out.collect())) == want and len(want) > 1000
    # no label is a label too, the last of those with equal votes
    votes = spark.createDataFrame([(1, None), (1, "b"), (2, None), (2, None), (2, "a")], "a long, label string")
    assert {tuple(x) for x in lsh.predicted(votes).collect()} == {(1, "b"), (2, None)}
    # a text's features are hashed where it is; texts of one id count as one
    docs = [(i % 40, f"w{chr(97 + i % 7)} same {chr(97 + i % 11)} w{chr(97 + i % 7)}" if i % 9 else "12 .") for i in range(60)]
    docs = spark.createDataFrame([*docs, (None, "a b"), (77, None)], "doc_id long, text string").repartition(3)
    got = lsh.signature_rows(lsh.packed_signature(vectors.token_sets(docs, "doc_id", "text"), 8))
    assert "explode(regexp" not in plan(got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, lsh.minhash_signature(vectors.token_counts(docs, "doc_id", "text"), 8).collect()))


def test_pairs_of_a_group_are_neither_shuffled_nor_joined(spark, tmp_path):
    r = np.random.default_rng(6)
    rows = [(int(g), int(i)) for i, g in enumerate(r.integers(0, 3, 90))] + [(7, 500), (8, 501), (8, 502), (None, 3), (1, None), (0, 4), (0, 4)]
    t = spark.createDataFrame(rows, '"group" long, id long'.replace('"', "`")).repartition(3)
    kept = [x for x in rows if None not in x]
    want = sorted((g, i, j) for g, i in kept for h, j in kept if g == h and i < j)
    for block in (1024, 4):
        assert sorted(map(tuple, trees.pairs_of(t, block).collect())) == want
    known = spark.createDataFrame([(g, i, j, i / 8, None, 0.25) for g, i, j in set(want) if (i + j) % 3 == 0], "`group` long, i long, j long, score double, width double, center double")
    out = trees.alignment_features(t, lambda i, j: ((i + j) % 3 == 0, {"score": i / 8, "width": F.lit(None).cast("double"), "center": F.lit(0.25)}))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, trees.alignment_features(t, known).collect()))
    t.selectExpr("cast(`group` as int) as label", "id as vec_id").write.parquet(f"{tmp_path}/embeddings.parquet")
    # behind the last exchange pairs are only unfolded
    made = plan(further.alignment_features(spark, str(tmp_path))).split("Exchange")[0]
    assert "Join" not in made and "Sort" not in made and made.count("Generate explode") == 2


def test_sequences_are_cut_into_fragments_where_they_are(spark):
    r = np.random.default_rng(7)
    texts = ["".join("ACGU"[c] * 1 if c < 4 else "N" * int(r.integers(1, 40)) for c in r.choice(5, int(r.integers(0, 400)), p=[0.24] * 4 + [0.04])) for _ in range(60)]
    t = spark.createDataFrame([(i, f"s{i % 3}" if i % 4 else None, x) for i, x in enumerate([*texts, "", None, "N" * 50, "NNACGUNN"])], "seq_idx long, source string, seq string").repartition(3)
    pieces = seqprep.split_masked(t)
    assert "Window" not in plan(pieces) and "Exchange hashpartitioning" not in plan(pieces)
    want = []
    for i, x in enumerate(texts + ["N" * 50, "NNACGUNN"]):
        at = 0
        for k, s in enumerate(s for s in re.split("(N{16,})", x) if s):
            want.append((i if i < 60 else i + 2, k, s, at + 1, at + len(s)))
            at += len(s)
    assert sorted(map(tuple, pieces.collect())) == want
    for window in (0, 30):
        out = seqprep.cut_fragments(t, window, 50, 5)
        assert "Exchange hashpartitioning" not in plan(out)
        old = seqprep.window_fragments(pieces, window, 50, 5).join(t.select("seq_idx", "source"), "seq_idx")
        assert sorted(map(str, out.select(old.columns).collect())) == sorted(map(str, old.collect())) and out.count() > 100
    sizes = {x.seq_idx: (x.source, x.length, x.segments) for x in seqprep.segment_counts(t).collect()}
    assert sizes == {i: (f"s{i % 3}" if i % 4 else None, sum(len(w[2]) for w in want if w[0] == i), sum(w[0] == i for w in want)) for i in {w[0] for w in want}}
