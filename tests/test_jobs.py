"""The jobs: SQL over whole tables, two runs over growing input, runs that broke off, odd rows."""

import glob
import json
import os

import pytest

from jobs import fragment_library, hit_partition
from jobs.queries import QUERIES
from tests.test_oracles import DIR, rows


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    con = pytest.importorskip("duckdb").connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    run, sql = QUERIES[name]
    got, want = run(spark, DIR), con.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    found = rows(got.columns, got.collect())
    assert found == rows(want.columns, want.fetchall()) and found


FRAGMENT_CONFIG = json.loads(fragment_library.CONFIG.read_text()) | {"window": 20, "min_length": 5}
DOCS = "doc_id long, text string, source string, window string, batch string"


def seq(seed, n):
    import numpy as np

    return "".join(np.random.default_rng(seed).choice(list("ACGU"), n))


def documents(spark, path, rows):
    spark.createDataFrame([(i, t, s, "w", "b") for i, t, s in rows], DOCS).coalesce(1).write.mode("append").parquet(path)


def library(spark, tmp_path, runs):
    docs, labels, out = (f"{tmp_path}/{x}" for x in ("documents.parquet", "labels", "out"))
    spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1)], "doc_id long, toxic int").write.parquet(labels)
    for added in runs:
        documents(spark, docs, added)
        got = fragment_library.run(spark, docs, labels, out, FRAGMENT_CONFIG)
    return docs, labels, out, sorted(map(tuple, got.drop("batch").collect()), key=repr)


FIRST = [(1, seq(1, 70), "a"), (2, seq(2, 55), None), (3, "acgt" + "N" * 20 + seq(3, 30).lower(), "001"), (4, None, "a"), (5, "", "a"), (None, seq(4, 40), "a"), (6, "AC", "b"), (1, seq(1, 70) + "G", "z")]
SECOND = [(7, seq(1, 70), "b"), (8, seq(8, 20_000), "a"), (2, seq(9, 60), "again"), (9, seq(2, 55), "a/b=c")]


def test_library_grows(spark, tmp_path):
    docs, labels, out, grown = library(spark, tmp_path / "two", [FIRST, SECOND])
    _, _, _, once = library(spark, tmp_path / "one", [FIRST + [r for r in SECOND if r[0] != 2]])
    assert grown == once and len({r[0] for r in grown}) == 6
    by = {r[1]: r for r in grown}
    assert all(r[8] == (r[0] == 1) for r in grown) and {r[9] for r in grown if r[0] == 3} == {"001"} and {r[9] for r in grown if r[0] == 9} == {"a/b=c"}
    # copies of earlier fragments name them
    assert all(by[r[7]][5] == r[5] for r in grown) and all(r[7].startswith("SEQ1#") for r in grown if r[0] == 7)
    sizes = {r.seq_idx: r for r in spark.read.parquet(f"{out}/sequences").collect()}
    assert set(sizes) == {1, 2, 3, 5, 6, 7, 8, 9} and sizes[8].length == 20_000 and sizes[5].fragments == 0 and sizes[3].segments == 3
    assert all(sizes[i].fragments == sum(r[0] == i for r in grown) for i in sizes)
    # nothing new: nothing changes
    files = sorted(spark.read.parquet(f"{out}/fragments").inputFiles())
    again = fragment_library.run(spark, docs, labels, out, FRAGMENT_CONFIG)
    assert sorted(map(tuple, again.drop("batch").collect()), key=repr) == grown and sorted(spark.read.parquet(f"{out}/fragments").inputFiles()) == files


def test_a_batch_that_is_run_again_replaces_its_own(spark, tmp_path):
    docs, labels, out, once = library(spark, tmp_path, [FIRST])
    fragment_library.add(spark.read.parquet(docs), 0, spark.read.parquet(labels), out, FRAGMENT_CONFIG)
    got = fragment_library.stored(spark, f"{out}/fragments", fragment_library.FRAGMENTS)
    assert sorted(map(tuple, got.drop("batch").collect()), key=repr) == once


def test_library_of_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels")
    assert fragment_library.run(spark, f"{tmp_path}/documents.parquet", f"{tmp_path}/labels", f"{tmp_path}/out", FRAGMENT_CONFIG).collect() == []


def test_one_file_is_followed(spark, tmp_path):
    documents(spark, f"{tmp_path}/folder", FIRST)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels")
    (one,) = glob.glob(f"{tmp_path}/folder/part*")
    os.rename(one, f"{tmp_path}/documents.parquet")
    assert {r.seq_idx for r in fragment_library.run(spark, f"{tmp_path}/documents.parquet", f"{tmp_path}/labels", f"{tmp_path}/out", FRAGMENT_CONFIG).collect()} == {1, 2, 3}


HIT_CONFIG = json.loads(hit_partition.CONFIG.read_text()) | {"overlap": 0.5, "min_cluster_size": 2, "buckets": 4}
HITS = "rid long, seqid string, start int, stop int, strand string, bitscore double, evalue double, name string, key string, bucket string"


def hits(seed, rounds):
    import numpy as np

    r = np.random.default_rng(seed)
    out = []
    for k in rounds:
        for i in range(60):
            a = int(r.integers(1, 200))
            out.append((k * 1000 + i, f"S{r.integers(0, 6)}", a, a + int(r.integers(5, 40)), "+-"[r.integers(0, 2)], float(r.integers(1, 6)), None, f"{k}.{r.integers(1, 5)}", "k", "b"))
    return out


def expected(rows):
    """Every hit against every other."""
    from collections import Counter

    def pct(a, b):
        common, short = min(a[3], b[3]) - max(a[2], b[2]) + 1, min(a[3] - a[2], b[3] - b[2]) + 1
        return (200 * common + short) // (2 * short) if common > 0 else 0

    best = {a[0]: not any(a[0] != b[0] and a[1] == b[1] and a[4] == b[4] and pct(a, b) >= 50 and (b[5] > a[5] or (b[5] == a[5] and b[7] < a[7])) for b in rows) for a in rows}
    soft, hard = Counter(r[7] for r in rows), Counter(r[7] for r in rows if best[r[0]])
    return sorted((r[0], r[7], best[r[0]], soft[r[7]] >= 2, best[r[0]] and hard[r[7]] >= 2) for r in rows)


def partition(got):
    return sorted(map(tuple, got.select("rid", "name", "best", "soft", "hard").collect()))


def test_partition_grows(spark, tmp_path):
    path, out = f"{tmp_path}/hits", f"{tmp_path}/out"
    early, late = hits(1, [1, 2]), hits(2, [3])
    late = [r for r in late if r[1] in ("S1", "S4")] + [(9001, "S1", 5, 30, "+", 9.0, None, "2.99", "k", "b")]
    spark.createDataFrame(early, HITS).write.parquet(f"{path}")
    assert partition(hit_partition.run(spark, path, out, HIT_CONFIG)) == expected(early)
    files = set(spark.read.parquet(f"{out}/partition").inputFiles())
    assert partition(hit_partition.run(spark, path, out, HIT_CONFIG)) == expected(early)
    assert set(spark.read.parquet(f"{out}/partition").inputFiles()) == files
    spark.createDataFrame(late, HITS).write.mode("append").parquet(path)
    assert partition(hit_partition.run(spark, path, out, HIT_CONFIG)) == expected(early + late)
    # buckets of sequences without new hits are the files that they were
    now = set(spark.read.parquet(f"{out}/partition").inputFiles())
    assert now & files and files - now
    touched = {r[0] for r in spark.read.parquet(f"{out}/partition").where("seqid in ('S1', 'S4')").select("bucket").distinct().collect()}
    assert all(int(f.split("bucket=")[1].split("/")[0]) in touched for f in files ^ now)


def test_partition_of_a_run_that_broke_off(spark, tmp_path, monkeypatch):
    path, out = f"{tmp_path}/hits", f"{tmp_path}/out"
    early, late = hits(3, [1]), hits(4, [2])
    spark.createDataFrame(early, HITS).write.parquet(path)
    hit_partition.run(spark, path, out, HIT_CONFIG)
    spark.createDataFrame(late, HITS).write.mode("append").parquet(path)
    real = hit_partition.stored

    def broken(spark, where, schema):
        if where.endswith("/partition") and broken.left == 0:
            raise RuntimeError("lost")
        broken.left -= where.endswith("/partition")
        return real(spark, where, schema)

    broken.left = 1
    monkeypatch.setattr(hit_partition, "stored", broken)
    with pytest.raises(RuntimeError):
        hit_partition.run(spark, path, out, HIT_CONFIG)
    monkeypatch.setattr(hit_partition, "stored", real)
    assert partition(hit_partition.run(spark, path, out, HIT_CONFIG)) == expected(early + late)


def test_partition_of_odd_rows(spark, tmp_path):
    good = [(1, "S", 1, 20, "+", 3.0, None, "1.1", "k", "b"), (2, "S", 5, 20, "+", 3.0, None, "1.2", "k", "b"), (3, "S", 5, 20, "-", None, None, "1.2", "k", "b")]
    odd = [(None, "S", 1, 20, "+", 3.0, None, "1.1", "k", "b"), (5, None, 1, 20, "+", 3.0, None, "1.1", "k", "b"), (6, "S", None, 20, "+", 3.0, None, "1.1", "k", "b"), (7, "S", 1, 20, "+", 3.0, None, None, "k", "b")]
    spark.createDataFrame(good + good + odd, HITS).write.parquet(f"{tmp_path}/hits")
    got = partition(hit_partition.run(spark, f"{tmp_path}/hits", f"{tmp_path}/out", HIT_CONFIG))
    assert got == [(1, "1.1", True, False, False), (2, "1.2", False, True, False), (3, "1.2", True, True, False)]
    spark.createDataFrame([], HITS).write.parquet(f"{tmp_path}/none")
    assert hit_partition.run(spark, f"{tmp_path}/none", f"{tmp_path}/out2", HIT_CONFIG).collect() == []


@pytest.mark.parametrize("module", ["fragment_library", "hit_partition"])
def test_command_line(spark, tmp_path, monkeypatch, module):
    import jobs.fragment_library as one
    import jobs.hit_partition as two

    job = {"fragment_library": one, "hit_partition": two}[module]
    spark.createDataFrame(hits(5, [1]), HITS).write.parquet(f"{tmp_path}/hits")
    documents(spark, f"{tmp_path}/documents", FIRST)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels")
    args = ["--hits", f"{tmp_path}/hits"] if module == "hit_partition" else ["--documents", f"{tmp_path}/documents", "--labels", f"{tmp_path}/labels"]
    monkeypatch.setattr("sys.argv", [module, *args, "--out", f"{tmp_path}/out"])
    monkeypatch.setattr(job, "session", lambda: spark)
    stopped = []
    monkeypatch.setattr(type(spark), "stop", lambda self: stopped.append(True))
    job.main()
    assert stopped and spark.read.parquet(f"{tmp_path}/out/{'partition' if module == 'hit_partition' else 'sequences'}").count() > 0
