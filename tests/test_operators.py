"""Operators that SQL doesn't express, formats and control, against plain Python."""

import dataclasses
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom import adapters
from strandloom.config import Config, dump_config, parse_config
from strandloom.functions.hashing import codes, feature_hash, int_hash
from strandloom.operators import density, graphs, intervals, lsh, partitions, seqprep, trees
from strandloom.plans.rounds import RoundState, next_round, run
from strandloom.sources import readers, writers
from strandloom.streaming import signatures


def test_hashes(spark):
    t = spark.createDataFrame([("abc",), ("",), ("a longer label",)], "s string").select("s", feature_hash(codes(F.col("s"))).alias("h"))
    assert {r.s: r.h for r in t.collect()} == {s: graphs._hash_text(s) for s in ("abc", "", "a longer label")}
    keys = np.array([1, 5, 123456789, 2**31 - 1])
    got = spark.createDataFrame([(int(k),) for k in keys], "k long").select("k", *[int_hash(F.col("k"), s).alias(f"h{s}") for s in (0, 7)]).collect()
    for r in got:
        assert r.h0 == lsh.mixed(np.array([r.k]), 0)[0] and r.h7 == lsh.mixed(np.array([r.k]), 7)[0]


def test_signature_default_and_recall(spark):
    rows = [(i, int(f), 1.0) for i in range(60) for f in np.random.default_rng(i // 2).integers(1, 10**6, 30)]
    t = spark.createDataFrame(rows, "id long, f long, v double").dropDuplicates(["id", "f"])
    near = lsh.approx_knn(t, 24, 2).where("rank = 2").collect()
    assert len(near) == 60 and all(r.a // 2 == r.b // 2 for r in near)
    # bins that are too large are split by the next function, then by the id; nobody is left out
    bins = lsh.forest_bins(lsh.minhash_signature(t.withColumn("f", F.when(F.col("id") < 40, F.col("f") % 3 + 1).otherwise(F.col("f"))), 6), 3, 2, 10).groupBy("bin").agg(F.count("*").alias("n"), F.collect_list("id").alias("ids")).collect()
    assert max(r.n for r in bins) <= 10 and sorted(i for r in bins for i in r.ids) == sorted(list(range(60)) * 3)


def test_products_of_sparse_vectors():
    r = np.random.default_rng(3)
    for m, wide in ((1, 5), (7, 40), (50, 3000)):
        x = (r.random((m, wide)) < 0.1) * r.random((m, wide))
        x[:, 0] = 1
        of, f = np.nonzero(x)
        assert np.allclose(lsh._products(of, f.astype(np.int64) * 7, x[of, f], m, 8)[~np.eye(m, dtype=bool)], (x @ x.T)[~np.eye(m, dtype=bool)])


def test_signature_limits():
    assert lsh.max_bin_share(1000) == 1 and lsh.max_bin_share(3000) == 0.3333 and lsh.max_bin_share(10**9) == 1e-4


def test_windows_as_defined(spark):
    rows = [(n, 0, "ACGU" * (n // 4) + "A" * (n % 4), 101, 100 + n) for n in (29, 30, 149, 150, 151, 160, 225, 226, 240, 241, 300, 391, 1000)]
    t = spark.createDataFrame(rows, "seq_idx int, part int, seg string, abs_start int, abs_end int")
    for win, pct, least in ((150, 50, 30), (100, 20, 30), (40, 100, 30)):
        shift = min(max(int(win / 100 * pct), 1), win)
        want = set()
        for n, _, s, start, _ in rows:
            if n < least:
                continue
            at, used = 0, n
            while True:
                if n <= win:
                    used = n
                elif n - at <= win * 0.5:
                    used = int(max(least, win * 0.6))
                    at = n - used
                elif n - at - (win - shift) <= shift + win * 0.1:
                    used = max(win, n - at - (win - shift))
                    at = n - used
                else:
                    used = win
                want.add((n, start + at, start + at + used - 1, s[at : at + used]))
                at += shift
                if at - shift + used >= n:
                    break
        assert {(r.seq_idx, r.start, r.stop, r.seq) for r in seqprep.window_fragments(t, win, pct, least).collect()} == want
    assert seqprep.window_fragments(t, 0, 50, 30).count() == 12


def test_masks(spark):
    s = "ACGU" * 10 + "N" * 15 + "GGCC" * 8 + "N" * 16 + "AAAA"
    t = spark.createDataFrame([(1, s), (2, "")], "seq_idx int, seq string")
    parts = seqprep.segment_status(seqprep.split_masked(t), 30).orderBy("part").collect()
    assert [len(r.seg) for r in parts] == [87, 16, 4] and "".join(r.seg for r in parts) == s
    assert [(r.abs_start, r.abs_end, r.status) for r in parts] == [(1, 87, "MASKED"), (88, 103, "SMALLER_THAN"), (104, 107, "SMALLER_THAN")]


def test_locations(spark):
    cases = [("hg19.chr1:949858-949920:+", "", "hg19.chr1:949858-949920:+"), ("x", "chrX_10_5", "undef.chrx:5-10:-"), ("x", "none", "MISS"), ("x", "GENOME_LOC mm9.chr2:5-9:- more", "mm9.chr2:5-9:-"), ("x", "chr2:1-9 strand=-", "undef.chr2:1-9:-")]
    t = spark.createDataFrame([(a, b) for a, b, _ in cases], "id string, header string").select(seqprep.genome_locations(F.col("id"), F.col("header")).alias("l")).collect()
    assert [r.l for r in t] == [c for _, _, c in cases]


def test_suppressed_hits_still_suppress(spark):
    rows = [(1, "s", 1, 100, "+", 9.0, "a"), (2, "s", 40, 140, "+", 8.0, "b"), (3, "s", 80, 180, "+", 7.0, "c"), (4, "t", 1, 10, "+", 5.0, "z"), (5, "t", 1, 10, "+", 5.0, "y"), (6, "t", 1, 10, "-", 5.0, "x")]
    t = spark.createDataFrame(rows, "rid long, seqid string, start int, stop int, strand string, bitscore double, name string")
    assert {r.rid for r in partitions.unique_hits(t, 0.51).collect()} == {1, 5, 6}


def test_overlaps_of_all_lengths(spark):
    r = np.random.default_rng(8)
    rows = []
    for i in range(400):
        a, n = int(r.integers(1, 60_000)), int(2 ** r.uniform(0, 17))
        rows.append((i, f"s{i % 3}", a, a + n, "+-"[i % 2]))
    t = spark.createDataFrame([*rows, (400, "s0", 1, 250_000_000, "+")], "rid long, seqid string, start int, stop int, strand string").repartition(3)
    rows.append((400, "s0", 1, 250_000_000, "+"))
    got = {(x.a_rid, x.b_rid) for x in intervals.overlap_join(t, t.where("rid % 3 < 2"), 0.4).collect()}
    want = set()
    for a in rows:
        for b in rows:
            common = min(a[3], b[3]) - max(a[2], b[2]) + 1
            short = min(a[3] - a[2], b[3] - b[2]) + 1
            if a[0] != b[0] and b[0] % 3 < 2 and a[1] == b[1] and a[4] == b[4] and common > 0 and (200 * common + short) // (2 * short) >= 40:
                want.add((a[0], b[0]))
    assert got == want and len(want) > 1000
    assert len(intervals.overlap_join(t, t, 0.4).collect()) == len({(x.a_rid, x.b_rid) for x in intervals.overlap_join(t, t, 0.4).collect()})


def test_merge_map_and_fragments(spark):
    p = spark.createDataFrame([("a", "b", 90), ("b", "c", 80), ("c", "a", 70)], "i string, j string, ratio_pct int")
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "name string")
    assert dict(partitions.merge_map(p, names).collect()) == {"a": "c", "b": "c", "c": "c", "d": "d"}
    f = spark.createDataFrame([(1, "s", 1, 10, "+", "k1", "AAAAAAAAAA"), (2, "s", 9, 20, "+", "k2", "CCCCCCCCCCCC"), (3, "s", 20, 40, "+", "k3", "G" * 21), (4, "s", 5, 9, "-", "k4", "UUUUU")], "id long, seqid string, start int, stop int, strand string, key string, seq string")
    got = {r.id: (r.start, r.stop, r.seq, r.provenance) for r in intervals.merge_fragments(f).collect()}
    assert got["1.1"] == (1, 20, "A" * 10 + "C" * 10, "1:k1;2:k2") and got["3.1"][:2] == (20, 40) and got["4.1"][:2] == (5, 9)
    with pytest.raises(Exception, match="not an interval key"):
        intervals.parse_keys(spark.createDataFrame([("a#1#2",)], "key string")).collect()


def test_dense_centers(spark):
    near = spark.createDataFrame([(a, b, r + 1, 1.0 if a == b else s) for a, bs in ((1, [1, 2, 3]), (2, [2, 1, 3]), (7, [7, 8, 9])) for r, (b, s) in enumerate((x, 0.9 - a / 100) for x in bs)], "a long, b long, rank int, sim double")
    c = density.dense_centers(near, density.approx_density(near), 5, 0).collect()
    assert [(r.center_rank, r.id) for r in c] == [(1, 1), (2, 7)]


def test_structures(spark):
    t = spark.createDataFrame([(1, "(((...)))."), (2, "....."), (3, "((..)..(...))")], "graph_id long, struct string")
    assert {(r.graph_id, r.i, r.j) for r in graphs.base_pairs(t).collect()} == {(1, 0, 8), (1, 1, 7), (1, 2, 6), (3, 0, 12), (3, 1, 4), (3, 7, 11)}
    v, _ = graphs.abstract_graph(t)
    kinds = {(r.graph_id, r.label) for r in v.collect()}
    assert (1, "AS#HL") in kinds and (2, "AS#EL") in kinds and (3, "AS#ML") in kinds
    with pytest.raises(Exception, match="unbalanced"):
        graphs.base_pairs(spark.createDataFrame([(1, "(()")], "graph_id long, struct string")).collect()
    s = adapters.max_pairing("GGGAAACCC")
    assert s == [("(((...)))", -3.0)]


def test_kernel_of_equal_graphs_is_one(spark):
    seqs = spark.createDataFrame([(1, "ACGUACGUAC"), (2, "ACGUACGUAC"), (3, "GGGGGGGGGG")], "graph_id long, seq string")
    v, e = graphs.backbone(seqs)
    k = {(r.i, r.j): r.sim for r in lsh.kernel_matrix(graphs.graph_vectors(v, e, 2, 2)).collect()}
    assert abs(k[1, 1] - 1) < 1e-6 and abs(k[1, 2] - 1) < 1e-6 and k.get((1, 3), 0) < 0.5


def test_tree(spark):
    d = spark.createDataFrame([(1, 1, 2, 1.0), (1, 1, 3, 4.0), (1, 2, 3, 6.0)], "group long, i long, j long, d double")
    t = trees.average_linkage(d)
    assert trees.newick(t).first().newick == "((1:0.5,2:0.5):2,3:2.5):0;" or trees.newick(t).first().newick.count("(") == 2
    assert {(r.height, r.leaves) for r in t.where("not leaf").collect()} == {(0.5, 2), (2.5, 3)}
    assert {r.root for r in trees.subtrees(t, 2, 2).collect()} == {r.node for r in t.where("leaves = 2").collect()}
    assert readers.parse_newick("((1:1,2:1):0.5,3:1.5):0") == [(0, None, "", 0.0), (1, 0, "", 0.5), (2, 1, "1", 1.0), (3, 1, "2", 1.0), (4, 0, "3", 1.5)]


def test_formats(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    fa = readers.read_fasta(spark, put("a.fa", ">s1 head one\nACGU\nAC GU\n(((...))) #FS\n> s2\nGGG\n")).orderBy("at").collect()
    assert [(r.id, r.header, r.seq, r.meta) for r in fa] == [("s1", "head one", "ACGUACGU", {"FS": "(((...)))"}), ("s2", "", "GGG", {})]
    twice = put("b.fa", ">x\nA\n>x\nC\n")
    assert sorted(r.id for r in readers.read_fasta(spark, twice, make_unique=True).collect()) == ["x", "x_1"]
    with pytest.raises(Exception, match="different sequences"):
        readers.read_fasta(spark, twice).collect()
    v, e = readers.read_gspan(spark, put("g.gspan", "t # 1\nv 0 A 1\nv 1 ^R\ne 0 1 @r\nt # 2\nV 5 C\n"))
    assert [(r.label, r.is_kernel, r.is_view, r.is_abs) for r in v.orderBy("graph_id", "vid").collect()] == [("A", True, True, False), ("^R", False, True, True), ("C", True, False, False)] and e.count() == 2
    hits = readers.read_hits(spark, put("h.tab", "# c\nm s1 30 10 1 20 42.4 - 50\n# end\n")).first()
    assert (hits.start, hits.stop, hits.strand, hits.evalue, hits.key) == (10, 30, "-", None, "s1#10#30#-")
    assert readers.read_hits(spark, put("cut.tab", "# c\nm s1 30 10 1 20 42.4 - 50\n")).count() == 0
    sp = readers.read_sparse_text(spark, put("v.txt", " 12:5.0000000e-01 40:1\n\n 7:2\n"))
    assert {(r.id, r.f, r.v) for r in sp.collect()} == {(0, 12, 0.5), (0, 40, 1.0), (1, 7, 2.0)}
    raw = b"".join(r.value for r in writers.sparse_binary(sp).orderBy("id").collect())
    (tmp_path / "v.bin").write_bytes(raw)
    assert {(r.id, r.f, r.v) for r in readers.read_sparse_binary(spark, str(tmp_path / "v.bin")).collect()} == {(0, 12, 0.5), (0, 40, 1.0), (1, 7, 2.0)}
    assert [r.value for r in writers.sparse_lines(sp).orderBy("id").collect()] == [" 12:5.0000000e-01 40:1.0000000e+00", " 7:2.0000000e+00"]
    aln = readers.read_clustal(spark, put("c.aln", "CLUSTAL W\n\na AC-\nb AG.\n\na GU\nb GU\n"), unify_gaps=True).orderBy("row").collect()
    assert [(r.name, r.gapped) for r in aln] == [("a", "AC-GU"), ("b", "AG-GU")]
    rows, tags = readers.read_stockholm(spark, put("s.stk", "# STOCKHOLM 1.0\na AC\n#=GC SS_cons ((\na GU\n#=GC SS_cons ))\n//\nb XX\n"))
    assert rows.first().gapped == "ACGU" and tags.first().text == "(())" and rows.count() == 1
    pairs = readers.read_pair_archive(spark, put("p.txt", "@1 Score: 1930\n1 ~AC-\n2 GAC~\n\n\n@2 Score: -5\n1 A\n3 A\n\n\n")).orderBy("no").collect()
    assert [(r.score, r.iid, r.jid, r.start_col, r.end_col) for r in pairs] == [(1930, 1, 2, 2, 3), (-5, 1, 3, 1, 1)]
    shapes = readers.read_shapes(spark, put("f.txt", ">x\n1 10\nACGUACGUAC\n((..))....  (-10.10)  [[]][]\n..........  (0.00)  (0.7)  _\n"), drop_unshaped=True).collect()
    assert [(r.win_start, r.energy, r.shape) for r in shapes] == [(1, -10.1, "[[]][]")]
    vi = readers.read_vienna(spark, put("q.txt", ">x\nACGUACGU\n((....)) (-1.0)\n(......) {0.2 MEA=3}\n")).first()
    assert (vi.seq, vi.mfe, vi.mea) == ("ACGUACGU", "((....))", "(......)")
    assert writers.export_graph(v, e, "dot").count() == 2
    with pytest.raises(ValueError):
        writers.export_graph(v, e, "other")


def test_config_and_rounds():
    c, odd = parse_config("nspdk_knn_center   20 # note\nnspdk_nhf 400\nwhat is this\n")
    assert c.kernel_nhf == 400 and odd == ["what"] and "nspdk_nhf                     400" in dump_config(c)
    assert parse_config("nspdk_other 3\n", force=True)[1] == ["nspdk_other"] and parse_config(dump_config(c)) == (c, [])
    s = RoundState(0, 400)
    assert next_round(s, c, 1, 1) == RoundState(2, 400) and next_round(s, c, 5, 2) == RoundState(0, 450) and next_round(RoundState(10, 1000), c, 1, 0) is None


@pytest.fixture(scope="module")
def families(spark):
    r = np.random.default_rng(3)
    fam = ["".join(r.choice(list("ACGU"), 60)) for _ in range(2)]
    rows = []
    for k in range(12):
        s = list(fam[k % 2])
        for p in r.integers(0, 60, 3):
            s[p] = "ACGU"[r.integers(0, 4)]
        rows.append((k + 1, f"s{k}", "", "".join(s)))
    return spark.createDataFrame(rows, "seq_idx int, id string, header string, seq string")


ROUNDS = Config(GLOBAL_num_clusters=2, GLOBAL_iterations=1, kernel_nhf=20, kernel_knn_center=4, results_min_cluster_size=2, kernel_radius=1, kernel_distance=2, cm_min_bitscore=40.0)


def test_rounds_find_families(spark, tmp_path, families):
    root = str(tmp_path / "run")
    early = run(spark, families, ROUNDS, root, until="features")
    assert set(early) == {"fragments", "features"} and not any(x.startswith("hits") for x in os.listdir(root))
    assert "soft" not in run(spark, families, ROUNDS, root, results_only=True)
    out = run(spark, families, ROUNDS, root)
    assert out["soft"].count() >= out["hard"].count() > 0
    assert {int(x[3:]) % 2 for x in (r.seqid for r in out["soft"].where("name = '1.1'").collect())} in ({0}, {1})
    made = sorted(os.listdir(root))
    again = run(spark, families, ROUNDS, root, results_only=True)
    assert sorted(os.listdir(root)) == made and again["soft"].count() == out["soft"].count()
    # a setting of the results makes nothing anew; one of the hits only what follows them
    other = run(spark, families, dataclasses.replace(ROUNDS, results_top_num=1), root)
    assert sorted(os.listdir(root)) == made and other["top"].groupBy("name").count().agg(F.max("count")).first()[0] == 1
    run(spark, families, dataclasses.replace(ROUNDS, cm_min_bitscore=60.0), root)
    fresh = {x.split("-")[0] for x in set(os.listdir(root)) - set(made)}
    assert fresh == {"hits1", "black1", "collected"}


def test_rounds_with_grey_and_special_lists(spark, tmp_path, families):
    root = str(tmp_path / "run")
    grey = spark.createDataFrame([(k,) for k in range(1, 13, 2)], "seq_idx int")
    out = run(spark, families, ROUNDS, root, grey=grey)
    values = {r.value: r.seq_idx for r in out["fragments"].collect()}
    assert {values[v] for v in range(1, 7)} == set(range(1, 13, 2))
    # clusters of grey sequences only aren't there
    by = {}
    for r in out["hits"].collect():
        by.setdefault(r.name, set()).add(int(r.seqid[3:]))
    assert by and all(any(k % 2 == 0 for k in x) for x in by.values())
    special = spark.createDataFrame([(v,) for v, k in values.items() if k % 2 == 0 and k > 2], "id long")
    left = run(spark, families, ROUNDS, str(tmp_path / "other"), special=spark.createDataFrame([(r.value,) for r in run(spark, families, ROUNDS, str(tmp_path / "other"), until="fragments")["fragments"].collect() if r.seq_idx % 2], "id long"))
    near = [x for x in os.listdir(tmp_path / "other") if x.startswith("neighbors1")]
    ids = {r.a for r in spark.read.parquet(f"{tmp_path}/other/{near[0]}").collect()}
    odd = {r.value for r in left["fragments"].collect() if r.seq_idx % 2}
    assert ids and not ids & odd and special.count() == 5


def test_stream_equals_batch(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"the cat {i} sat on mat {i % 3}") for i in range(20)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "in"))
    from strandloom.operators.vectors import token_counts

    signatures.start(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in")), "doc_id", "text", str(tmp_path / "out")).awaitTermination()
    got = signatures.signatures(spark, str(tmp_path / "out"))
    assert got.exceptAll(lsh.minhash_signature(token_counts(docs, "doc_id", "text"), 16)).count() == 0 and got.count() == 320


def test_full_ranking_has_all_others(spark, tmp_path):
    from strandloom.plans import similarity

    r = np.random.default_rng(3)
    x = r.normal(size=(130, 64)).astype("float32")
    spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = similarity.full_ranking(spark, str(tmp_path)).collect()
    assert len(out) == 130 * 129
    assert all(sorted(r.rank for r in out if r.a == a) == list(range(1, 130)) for a in (0, 77))


def test_similarity_to_the_whole_set(spark, tmp_path):
    from strandloom.plans import similarity

    x = np.random.default_rng(4).normal(size=(60, 64)).astype("float32")
    spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = {r.a: r.avg_sim for r in similarity.similarity_to_set(spark, str(tmp_path)).collect()}
    want = x.astype(float) @ x[::2].astype(float).T
    assert sorted(out) == list(range(60)) and all(abs(out[i] - want[i].mean()) < 2e-6 for i in range(60))


def test_near_copies_in_large_bins(spark):
    r = np.random.default_rng(6)
    base = r.choice(list("ACGU"), 600)

    def edited(i):
        x = base.copy()
        x[[i % 500 + 20, (7 * i) % 500 + 30]] = ["N", "ACGU"[i // 500]]
        return "".join(x)

    rows = [(i, edited(i)) for i in range(1300)] + [(2000 + i, "".join(r.choice(list("ACGU"), 600))) for i in range(20)]
    out = {x.value: x.keeper for x in seqprep.near_duplicates(spark.createDataFrame(rows, "value long, seq string"), 0.9).collect()}
    assert len({s for _, s in rows}) > 1200
    assert all(out[v] == (0 if v < 2000 else v) for v, _ in rows)
    pair = spark.createDataFrame(rows[:2], "value long, seq string")
    assert {x.keeper for x in seqprep.near_duplicates(pair, 0.9).collect()} == {0}


def test_fragments_of_all_models_are_merged(spark, tmp_path):
    from strandloom.plans import relational

    # models 1, 1, 2 and 3 on one sequence and strand: only the first two may merge
    rows = [(n, 1, 5, p, 10.0, "N", 1.0, "1995-01-01") for n, p in enumerate((1, 21, 2, 3))]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_returnflag string, l_extendedprice double, l_shipdate string").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = relational.merge_fragments(spark, str(tmp_path)).collect()
    assert sorted(r.id for r in out) == ["1.1", "17.1", "25.1"] and {r.seqid for r in out} == {"5"}


def test_fold_windows_and_packages(spark):
    t = spark.createDataFrame([(1, "ACGUACGUAC"), (2, "ACG"), (3, "")], "graph_id long, seq string")
    got = {(r.graph_id, r.size, r.at, r.level, r.seq) for r in seqprep.fold_windows(t, [8, 4, 20], 50, {3: 5, 4: 8}).collect()}
    four = {(1, 4, a, 0, "ACGUACGUAC"[a : a + 4]) for a in (0, 2, 4, 6)}
    assert got == four | {(1, 8, 0, 4, "ACGUACGU"), (1, 8, 2, 4, "GUACGUAC"), (1, 20, 0, 4, "ACGUACGUAC"), (2, 4, 0, 0, "ACG")}
    with pytest.raises(ValueError):
        seqprep.fold_windows(t, [8], 50, {6: 1})
    ranked = spark.createDataFrame([(7, k, 100 - k) for k in range(1, 9)] + [(8, 1, 8)], "center long, rank int, id long")
    assert {r.center: (r.members, r.extended) for r in density.packaged(ranked, 2).collect()} == {7: ([99, 98], [99, 98, 97, 96, 95, 94]), 8: ([8], [8])}


def test_feature_map_names_the_features(spark):
    v, e = graphs.backbone(spark.createDataFrame([(1, "ACGUA")], "graph_id long, seq string"))
    both = graphs.undirected(e)
    names = {r.f: r.plain for r in graphs.feature_map(v, both, 1, 1).collect()}
    assert set(names) == {r.f for r in graphs.vectorise(graphs.pair_features(v, both, 1, 1)).collect()}
    assert "<d:1 r:0> <A> <C>" in names.values() and "<d:0 r:1> <A:C->> <A:C->>" in names.values()
    with pytest.raises(ValueError):
        graphs.feature_map(v, both, 2, 1)


def test_graph_joins_send_no_table_through_the_driver(spark):
    t = spark.createDataFrame([(1, "ACGUA"), (2, "GGC")], "graph_id long, seq string")
    v, e = graphs.backbone(t)
    both = graphs.undirected(e)
    dist = graphs.distances(v, both, 2)
    ball = dist.select("graph_id", F.col("src").alias("root"), F.col("dst").alias("vid"))
    made = [dist, graphs.shortest_path_union(dist), graphs.induced_edges(ball, both), graphs.pair_features(v, both, 1, 2), graphs.alive_edges(v, e), graphs.abstraction_features(v, e)]
    for df in made:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_block_products_keep_the_best_of_a_part(spark):
    """Rows that leave grow with the queries and the parts, not with the pairs of blocks; ties go to the smaller id."""
    v = np.round(np.random.default_rng(3).normal(size=(96, 4)), 1)
    v[50:60] = v[7]
    t = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id long, vec array<double>")
    made = lsh.block_products(t, t, 3, block=8, parts=2)
    assert made.count() <= 96 * 3 * 2
    sims = np.round(v @ v.T, 6)
    for block in (8, 64):
        got = {(r.a, r["rank"]): (r.b, r.sim) for r in lsh.exact_knn(t, t, 3, block).collect()}
        for a in range(96):
            for k, b in enumerate(np.lexsort([np.arange(96), -sims[a]])[:3]):
                assert got[a, k + 1] == (b, sims[a, b])


def test_signatures_are_made_once_for_an_id(spark):
    """No minima of parts of an id are left to be brought together after the hashing."""
    t = spark.createDataFrame([(i % 7, i * 31 + 1, 1.0) for i in range(70)], "id long, f long, v double").repartition(5)
    made = lsh.minhash_signature(t, 6)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Aggregate")
    h = {(i, k): min([x for x in lsh.mixed(np.arange(i, 70, 7) * 31 + 1, k).tolist() if x >= 0], default=lsh.UNSET) for i in range(7) for k in range(6)}
    assert {(r.id, r.k): r.h for r in made.collect()} == h
