"""Queries of features, signatures, neighbours, prediction and density."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from strandloom.functions.hashing import GOLDEN, ap_hash, codes, int_hash, rs_hash
from strandloom.operators import density, evaluation, lsh
from strandloom.plans.tables import DOC_FEATURES, SET_FEATURES, VECTORS, doc_features, doc_sets, read, set_features, vectors

#: 32 trees of two functions find 0.947 of the five nearest documents at sf0.1 (query knn_accuracy).
NHF, KNN, EXCESS, DEPTH, MOST = 64, 5, 40, 2, 1000


def token_features(s, d):
    return doc_features(s, d).select("id", "f", F.round("v", 9).alias("v"))


def string_hashes(s, d):
    c = codes(F.col("p_name"))
    return read(s, d, "part").select("p_partkey", ap_hash(c).alias("ap"), rs_hash(c).alias("rs"))


_BYTES = "list_transform(range(1, length(p_name) + 1), lambda i: ascii(substr(p_name, i, 1))::BIGINT)"
STRING_HASHES = f"""
SELECT p_partkey,
  list_reduce(list_prepend(2863311530::BIGINT, b), lambda h, x, i: CASE WHEN (i - 2) % 2 = 0
    THEN xor(h, xor(h * 128, x * (h >> 3)) & 4294967295) ELSE xor(h, xor(xor(h * 2048 + x, h >> 5) & 4294967295, 4294967295)) END) AS ap,
  (list_reduce(list_prepend({{'h': 0::HUGEINT, 'a': 63689::HUGEINT}}, list_transform(b, lambda x: {{'h': x::HUGEINT, 'a': 0::HUGEINT}})),
    lambda s, x: {{'h': (s.h * s.a + x.h) % 4294967296, 'a': (s.a * 378551) % 4294967296}})).h::BIGINT AS rs
FROM (SELECT p_partkey, {_BYTES} AS b FROM part)"""


def _mixed(source: str) -> str:
    """CTEs that end in mixed(..., h): the seeded mix of columns key and k of `source`."""
    fold = "(({0} + 2147483648) & 4294967295) - 2147483648".format
    return f"""
m0 AS (SELECT *, floor(((key * (k + 1)) & 4294967295) * {GOLDEN!r})::BIGINT AS x FROM {source}),
m1 AS (SELECT * REPLACE ({fold("x * 32768 - x - 1")} AS x) FROM m0), m2 AS (SELECT * REPLACE (xor(x, x >> 12) AS x) FROM m1),
m3 AS (SELECT * REPLACE ({fold("x * 5")} AS x) FROM m2), m4 AS (SELECT * REPLACE (xor(x, x >> 4) AS x) FROM m3),
m5 AS (SELECT * REPLACE ({fold("x * 2057")} AS x) FROM m4), mixed AS (SELECT * EXCLUDE (x), xor(x, x >> 16) AS h FROM m5)"""


def int_hash_grid(s, d):
    return read(s, d, "part").select(F.col("p_partkey").alias("key"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("k")).select("key", "k", int_hash(F.col("key"), F.col("k")).alias("h"))


INT_HASH_GRID = f"WITH g AS (SELECT p_partkey AS key, unnest(range(16))::INT AS k FROM part), {_mixed('g')} SELECT key, k, h FROM mixed"

SIGNATURES = f"""{DOC_FEATURES},
grid AS (SELECT id, f AS key, k::BIGINT AS k FROM features, range({NHF}) r(k)), {_mixed("grid")},
signatures AS (SELECT id, k::INT AS k, coalesce(min(CASE WHEN h >= 0 THEN h END), 2147483648) AS h FROM mixed GROUP BY id, k)"""


def kept(df):
    """Persisted: read several times by the plan that follows; a lost executor's part is computed again."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _packed(s, d):
    return lsh.packed_signature(doc_sets(s, d), NHF)


def signatures(s, d):
    return lsh.signature_rows(_packed(s, d))


def minhash_signature(s, d):
    return signatures(s, d)


def compact_signature(s, d):
    return lsh.compact_signature(signatures(s, d), 4)


def natural_signature(s, d):
    return lsh.natural_signature(doc_features(s, d), 8)


def bin_stats(s, d):
    return lsh.bin_statistics(signatures(s, d))


_QS = ", ".join(f"list_sort(list(size))[floor(count(*) * {q})::INT + 1] AS q{round(q * 100):02d}" for q in (0.05, 0.25, 0.5, 0.75, 0.95))
BIN_STATS = f"""WITH {SIGNATURES}, b AS (SELECT k, h, count(*) AS size FROM signatures GROUP BY k, h)
SELECT count(*) AS num, sum(size)::BIGINT AS sum, round(avg(size), 6) AS avg, round(stddev_samp(size), 6) AS sd, min(size) AS min, {_QS}, max(size) AS max FROM b"""


def hot_bins(s, d):
    n = read(s, d, "documents").count()
    return lsh.bins(signatures(s, d)).where(F.col("size") >= n * 0.2)


HOT_BINS = f"WITH {SIGNATURES} SELECT k, h, count(*) AS size FROM signatures GROUP BY k, h HAVING count(*) >= (SELECT count(*) FROM documents) * 0.2"


def _candidates(s, d, labels=None):
    n = read(s, d, "documents").count()
    return lsh.best_candidates(lsh.signature_rows(kept(_packed(s, d))), n, lsh.max_bin_share(n), EXCESS * KNN, labels=labels)


CANDIDATES = f"""{SIGNATURES},
total AS (SELECT count(*) AS n FROM documents),
small AS (SELECT k, h FROM signatures GROUP BY k, h HAVING count(*) < (SELECT CASE WHEN n <= 1000 THEN 1.0 ELSE greatest(0.0001, round(1000.0 / n, 4)) END * n FROM total)),
rows_ AS (SELECT id, k, h FROM signatures SEMI JOIN small USING (k, h)),
pairs AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM rows_ x JOIN rows_ y ON x.k = y.k AND x.h = y.h AND x.id <> y.id GROUP BY 1, 2 HAVING count(*) >= 2),
candidates AS (SELECT a, b, shared FROM pairs QUALIFY row_number() OVER (PARTITION BY a ORDER BY shared DESC, b) <= {EXCESS * KNN})"""


def approx_candidates(s, d):
    return _candidates(s, d)


def approx_knn(s, d):
    return lsh.approx_knn(kept(set_features(doc_features(s, d))), NHF, KNN, DEPTH, MOST)


def reranked(s, d):
    return lsh.rerank(kept(_candidates(s, d)), kept(set_features(doc_features(s, d))), KNN)


def _near_sql(own: str) -> str:
    return f"""{SET_FEATURES}, own AS ({own}),
dots AS (SELECT a, b, sum(x.v * y.v) AS sim FROM own JOIN sets x ON x.id = a JOIN sets y ON y.id = b AND y.f = x.f GROUP BY a, b),
sims AS (SELECT a, b, round(coalesce(sim, 0), 6) AS sim FROM own LEFT JOIN dots USING (a, b)),
near AS (SELECT a, b, (row_number() OVER (PARTITION BY a ORDER BY a <> b, sim DESC, b))::INT AS rank, sim FROM sims QUALIFY rank <= {KNN})"""


RERANKED = f"{CANDIDATES}, {_near_sql('SELECT a, b FROM candidates UNION SELECT DISTINCT a, a FROM candidates')}"
#: Trees of two functions: a bin that is too large is split by the second, then by the id.
APPROX = f"""{SIGNATURES},
trees_ AS (SELECT x.id, x.k // 2 AS tree, x.h AS h0, y.h AS h1 FROM signatures x JOIN signatures y ON y.id = x.id AND y.k = x.k + 1 WHERE x.k % 2 = 0),
sized AS (SELECT *, count(*) OVER (PARTITION BY tree, h0) AS size0, count(*) OVER (PARTITION BY tree, h0, h1) AS size1 FROM trees_),
bins_ AS (SELECT id, tree, h0, CASE WHEN size0 > {MOST} THEN h1 END AS h1, CASE WHEN size0 > {MOST} AND size1 > {MOST} THEN id % ceil(size1 / {MOST})::BIGINT END AS part FROM sized),
{_near_sql("SELECT DISTINCT x.id AS a, y.id AS b FROM bins_ x JOIN bins_ y ON x.tree = y.tree AND x.h0 = y.h0 AND x.h1 IS NOT DISTINCT FROM y.h1 AND x.part IS NOT DISTINCT FROM y.part")}"""


def _exact(s, d, k=10):
    v = vectors(s, d)
    return kept(lsh.exact_knn(v, v, k))


EXACT = f"""{VECTORS}, sims AS (SELECT x.id AS a, y.id AS b, round(list_dot_product(x.vec, y.vec), 6) AS sim FROM vectors x, vectors y),
knn AS (SELECT a, b, (row_number() OVER (PARTITION BY a ORDER BY sim DESC, b))::INT AS rank, sim FROM sims QUALIFY rank <= 10)"""


def exact_knn(s, d):
    return _exact(s, d)


def full_ranking(s, d):
    return lsh.full_ranking(vectors(s, d))


FULL_RANKING = f"""WITH {VECTORS}, sims AS (SELECT x.id AS a, y.id AS b, round(list_dot_product(x.vec, y.vec), 6) AS sim FROM vectors x JOIN vectors y ON x.id <> y.id)
SELECT a, b, sim, (row_number() OVER (PARTITION BY a ORDER BY sim DESC, b))::INT AS rank FROM sims"""


def _part_features(s, d):
    w = read(s, d, "part").select(F.col("p_partkey").alias("id"), F.explode(F.split("p_name", " ")).alias("w"))
    return w.select("id", (F.conv(F.substring(F.md5("w"), 1, 7), 16, 10).cast("long") + 1).alias("f"), F.lit(0.5).alias("v"))


def kernel_matrix(s, d):
    return lsh.kernel_matrix(_part_features(s, d))


KERNEL_MATRIX = """WITH w AS (SELECT p_partkey AS id, unnest(string_split(p_name, ' ')) AS f FROM part)
SELECT x.id AS i, y.id AS j, round(sum(0.25), 6)::DOUBLE AS sim FROM w x JOIN w y ON x.f = y.f AND x.id <= y.id GROUP BY 1, 2"""


def exact_documents(s, d):
    return lsh.exact_sparse_knn(set_features(doc_features(s, d)), KNN)


EXACT_DOCUMENTS = f"""pairs_ AS (SELECT x.id AS a, y.id AS b, round(sum(x.v * y.v), 6) AS sim FROM sets x JOIN sets y ON x.f = y.f GROUP BY 1, 2),
grid_ AS (SELECT x.id AS a, y.id AS b FROM lengths x, lengths y), every AS (SELECT a, b, coalesce(sim, 0) AS sim FROM grid_ LEFT JOIN pairs_ USING (a, b)),
true_ AS (SELECT a, b, (row_number() OVER (PARTITION BY a ORDER BY a <> b, sim DESC, b))::INT AS rank, sim FROM every QUALIFY rank <= {KNN})"""


def knn_accuracy(s, d):
    return lsh.recall(approx_knn(s, d), kept(exact_documents(s, d)), KNN)


KNN_ACCURACY = f"""WITH {APPROX}, {EXACT_DOCUMENTS}, last_ AS (SELECT a, min(sim) AS least FROM true_ GROUP BY a),
good AS (SELECT n.a, count(*) AS hit FROM near n JOIN last_ l ON l.a = n.a AND n.sim >= l.least GROUP BY 1)
SELECT round(sum(least(coalesce(hit, 0), {KNN})) / (count(*) * {KNN}), 6) AS recall, count(*) AS instances FROM last_ LEFT JOIN good USING (a)"""


def neighbor_agreement(s, d):
    """How far the neighbours by the second half of the dimensions are those by the first."""
    halves = [vectors(s, d).withColumn("vec", F.slice("vec", lo, 32)) for lo in (1, 33)]
    first, second = (lsh.exact_knn(v, v, 10) for v in halves)
    return lsh.knn_accuracy(second, first, 10, read(s, d, "embeddings").count())


AGREEMENT = f"""WITH {VECTORS}, first AS (SELECT x.id AS a, y.id AS b FROM vectors x, vectors y QUALIFY row_number() OVER (PARTITION BY x.id ORDER BY round(list_dot_product(x.vec[1:32], y.vec[1:32]), 6) DESC, y.id) <= 10),
second AS (SELECT x.id AS a, y.id AS b FROM vectors x, vectors y QUALIFY row_number() OVER (PARTITION BY x.id ORDER BY round(list_dot_product(x.vec[33:64], y.vec[33:64]), 6) DESC, y.id) <= 10),
h AS (SELECT f.a, count(s.b) AS hit FROM first f LEFT JOIN second s ON f.a = s.a AND f.b = s.b GROUP BY f.a)
SELECT round(avg(hit / least(10, (SELECT count(*) FROM embeddings))), 6) AS accuracy, count(*) AS instances FROM h"""


def knn_predict_exact(s, d):
    return lsh.knn_predict(_exact(s, d), read(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label")))


KNN_PREDICT_EXACT = f"""WITH {EXACT}, votes AS (SELECT a AS id, label::VARCHAR AS label, count(*) AS n FROM knn JOIN vectors v ON v.id = b WHERE a <> b GROUP BY 1, 2)
SELECT id, label AS predicted FROM votes QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, label) = 1"""


def knn_predict_lsh(s, d):
    return lsh.predicted(_candidates(s, d, read(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))))


KNN_PREDICT_LSH = f"""WITH {CANDIDATES}, votes AS (SELECT a AS id, lang AS label, count(*) AS n FROM candidates JOIN documents ON doc_id = b GROUP BY 1, 2)
SELECT id, label AS predicted FROM votes QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, label) = 1"""


def approx_density(s, d):
    return density.approx_density(_exact(s, d))


DENSITY = "SELECT a AS id, round((sum(sim::DECIMAL(18,9)) FILTER (a <> b))::DOUBLE / nullif(count(*) FILTER (a <> b), 0), 6) AS density FROM {} GROUP BY a"


def shared_neighbors(s, d):
    return density.shared_neighbors(_exact(s, d))


SHARED = f"""{EXACT}, n AS (SELECT a, count(*) AS n FROM knn GROUP BY a),
common AS (SELECT x.a, x.b, count(*) AS c FROM knn x JOIN knn y ON y.a = x.b JOIN knn z ON z.a = x.a AND z.b = y.b GROUP BY 1, 2),
shared AS (SELECT k.a, k.b, round(coalesce(c, 0) / sqrt(n1.n * coalesce(n2.n, 1)), 6) AS cosine FROM knn k JOIN n n1 ON n1.a = k.a LEFT JOIN n n2 ON n2.a = k.b LEFT JOIN common c ON c.a = k.a AND c.b = k.b)"""


def shared_density(s, d):
    return density.shared_density(_exact(s, d))


def smoothed_density(s, d):
    return density.smoothed_density(_exact(s, d))


def true_density(s, d):
    return density.true_density(vectors(s, d))


TRUE_DENSITY = f"WITH {VECTORS} SELECT x.id, round(avg(list_dot_product(x.vec, y.vec)), 6) AS density FROM vectors x JOIN vectors y ON x.id <> y.id GROUP BY x.id"


def similarity_to_set(s, d):
    return density.similarity_to_set(vectors(s, d), read(s, d, "embeddings").where("label = 0").select(F.col("vec_id").alias("id")))


def _centers(s, d):
    near = _exact(s, d)
    return near, density.dense_centers(near, density.approx_density(near), 20, 2)


def dense_centers(s, d):
    return _centers(s, d)[1]


def refined_centers(s, d):
    near, c = _centers(s, d)
    return density.refine_centers(c, near, density.approx_density(near))


def center_rankings(s, d):
    near, c = _centers(s, d)
    return density.center_rankings(c, near)


def center_lists(s, d):
    """Every id as a centre, with its first three and first nine."""
    return density.packaged(_exact(s, d).select(F.col("a").alias("center"), "rank", F.col("b").alias("id")), 3).select("center", F.array_join("members", " ").alias("members"), F.array_join("extended", " ").alias("extended"))


def center_classes(s, d):
    """Every id as a centre, by the labels of its first five neighbours."""
    labels = read(s, d, "embeddings").select(F.col("vec_id").alias("b"), F.col("label").alias("class"))
    near = _exact(s, d).where("rank <= 5").select(F.col("a").alias("center"), "b").join(labels, "b").select("center", "class")
    return evaluation.center_classes(near, labels.groupBy("class").agg(F.count("*").alias("size")))


CENTER_CLASSES = f"""WITH {EXACT}, m AS (SELECT a AS center, label AS class, count(*) AS n FROM knn JOIN embeddings e ON e.vec_id = b WHERE rank <= 5 GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER w AS place, first_value(class) OVER w AS lead_, max(n) FILTER (class <> 0) OVER (PARTITION BY center) AS top FROM m WINDOW w AS (PARTITION BY center ORDER BY n DESC, class = 0, class)),
u AS (SELECT *, count(*) FILTER (class <> 0 AND n = top) OVER (PARTITION BY center) AS alike FROM t),
j AS (SELECT class, n, place = 1 OR (lead_ = 0 AND class <> 0 AND n = top) AS major, class <> 0 AND n = top AND alike = 1 AS uniq FROM u),
o AS (SELECT class, sum(n) AS met, count(*) FILTER (major) AS centers, round(avg(n) FILTER (major), 1) AS mm, count(*) FILTER (uniq) AS uc, round(avg(n) FILTER (uniq), 1) AS mu, max(n) FILTER (major) AS most FROM j GROUP BY 1),
s AS (SELECT label AS class, count(*) AS size FROM embeddings GROUP BY 1)
SELECT class, size, round(coalesce(met / (SELECT sum(n) FROM m), 0), 6)::DOUBLE AS share, coalesce(centers, 0) AS centers, coalesce(mm, 0) AS mean_members, coalesce(uc, 0) AS unique_centers, coalesce(mu, 0) AS mean_unique, coalesce(most, 0) AS most FROM s LEFT JOIN o USING (class)"""


def ungreyed_centers(s, d):
    near, c = _centers(s, d)
    return density.with_ungreyed(density.center_rankings(c, near), read(s, d, "embeddings").where("label < 5").select(F.col("vec_id").alias("id")), 5)


def sampled_ids(s, d):
    return density.sampled(read(s, d, "embeddings").select(F.col("vec_id").alias("id")), 0.3, 7)


def list_filters(s, d):
    from strandloom.sources.readers import list_filter

    labels = read(s, d, "labels")
    docs = read(s, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    return list_filter(docs, labels.where("quality = 1").select(F.col("doc_id").alias("id")), labels.where("toxic = 1").select(F.col("doc_id").alias("id")))


QUERIES = {
    "token_features": (token_features, f"WITH {DOC_FEATURES} SELECT id, f, round(v, 9) AS v FROM features"),
    "string_hashes": (string_hashes, STRING_HASHES),
    "int_hash_grid": (int_hash_grid, INT_HASH_GRID),
    "minhash_signature": (minhash_signature, f"WITH {SIGNATURES} SELECT id, k, h FROM signatures"),
    "compact_signature": (compact_signature, f"WITH {SIGNATURES} SELECT id, (k % 4)::INT AS k, sum(h)::BIGINT & 4294967295 AS h FROM signatures GROUP BY 1, 2"),
    "natural_signature": (natural_signature, f"WITH {DOC_FEATURES} SELECT id, (row_number() OVER (PARTITION BY id ORDER BY f) - 1)::INT AS k, f AS h FROM features QUALIFY k < 8"),
    "bin_stats": (bin_stats, BIN_STATS),
    "hot_bins": (hot_bins, HOT_BINS),
    "approx_candidates": (approx_candidates, f"WITH {CANDIDATES} SELECT a, b, shared FROM candidates"),
    "approx_knn": (approx_knn, f"WITH {APPROX} SELECT a, b, rank, sim FROM near"),
    "reranked_candidates": (reranked, f"WITH {RERANKED} SELECT a, b, rank, sim FROM near"),
    "exact_knn": (exact_knn, f"WITH {EXACT} SELECT a, b, rank, sim FROM knn"),
    "full_ranking": (full_ranking, FULL_RANKING),
    "kernel_matrix": (kernel_matrix, KERNEL_MATRIX),
    "exact_documents": (exact_documents, f"WITH {DOC_FEATURES}, {SET_FEATURES}, {EXACT_DOCUMENTS} SELECT a, b, rank, sim FROM true_"),
    "knn_accuracy": (knn_accuracy, KNN_ACCURACY),
    "neighbor_agreement": (neighbor_agreement, AGREEMENT),
    "knn_predict_exact": (knn_predict_exact, KNN_PREDICT_EXACT),
    "knn_predict_lsh": (knn_predict_lsh, KNN_PREDICT_LSH),
    "approx_density": (approx_density, f"WITH {EXACT} {DENSITY.format('knn')}"),
    "shared_neighbors": (shared_neighbors, f"WITH {SHARED} SELECT a, b, cosine FROM shared"),
    "shared_density": (shared_density, f"WITH {SHARED}, w AS (SELECT a, b, sim * cosine AS sim FROM knn JOIN shared USING (a, b)) {DENSITY.format('w')}"),
    "smoothed_density": (smoothed_density, f"WITH {EXACT}, d AS ({DENSITY.format('knn')}) SELECT a AS id, round(sum(density::DECIMAL(18,9))::DOUBLE / count(density), 6) AS density FROM knn JOIN d ON d.id = b GROUP BY a"),
    "true_density": (true_density, TRUE_DENSITY),
    "similarity_to_set": (similarity_to_set, f"WITH {VECTORS} SELECT x.id AS a, round(avg(list_dot_product(x.vec, y.vec)), 6) AS avg_sim FROM vectors x, vectors y WHERE y.label = 0 GROUP BY x.id"),
    "dense_centers": (dense_centers, None),
    "refined_centers": (refined_centers, None),
    "center_rankings": (center_rankings, None),
    "center_lists": (center_lists, f"WITH {EXACT} SELECT a AS center, string_agg(b::VARCHAR, ' ' ORDER BY rank) FILTER (rank <= 3) AS members, string_agg(b::VARCHAR, ' ' ORDER BY rank) AS extended FROM knn WHERE rank <= 9 GROUP BY a"),
    "center_classes": (center_classes, CENTER_CLASSES),
    "ungreyed_centers": (ungreyed_centers, None),
    "sampled_ids": (sampled_ids, None),
    "list_filters": (list_filters, "SELECT doc_id AS id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"),
}
