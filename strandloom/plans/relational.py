"""Queries of intervals, partitions, evaluation and sequence preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import evaluation, intervals, partitions, seqprep
from strandloom.operators.lsh import order_statistics
from strandloom.plans.tables import HITS, SEQUENCES, hits, overlaps_sql, read, sequences


def interval_overlap(s, d):
    h = hits(s, d)
    return intervals.overlap_join(h, h, 0.2, ignore_strand=True).select("a_rid", "b_rid", "pct")


def self_overlap(s, d):
    h = hits(s, d)
    return intervals.overlap_join(h, h, 0.51).select("a_rid", "b_rid", "pct")


def blacklist(s, d):
    h = hits(s, d)
    frags = h.where("strand = '+'").withColumnRenamed("rid", "id")
    grey = h.where("name = '1.3'").select(F.col("rid").alias("id"))
    return intervals.blacklist(frags, h.where("bitscore > 90000"), grey)


BLACKLIST = f"""WITH {HITS}, f AS (SELECT * FROM hits WHERE strand = '+'), t AS (SELECT * FROM hits WHERE bitscore > 90000),
o AS ({overlaps_sql("f", "t", 20, strand=False, other=False)})
SELECT DISTINCT a.rid AS id FROM o WHERE a.rid NOT IN (SELECT rid FROM hits WHERE name = '1.3')"""


def merge_islands(s, d):
    return intervals.merge_islands(hits(s, d))


ISLANDS = f"""WITH {HITS}, m AS (SELECT *, CASE WHEN max(stop) OVER w >= start THEN 0 ELSE 1 END AS fresh FROM hits
  WINDOW w AS (PARTITION BY seqid, strand ORDER BY start, stop, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY seqid, strand ORDER BY start, stop, rid ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT seqid, strand, min(start) AS start, max(stop) AS stop, count(*) AS n FROM i GROUP BY seqid, strand, island"""


def hit_texts(rows):
    """Hits with seq, their residues: an axis has those that the digits of its name's hash stand for, again and again; reverse-complemented on the minus strand."""
    axis = F.translate(F.sha2("seqid", 512), "0123456789abcdef", "ACGU" * 4)
    part = F.substring(F.repeat(axis, (F.col("stop") / 128).cast("int") + 1), F.col("start"), F.col("stop") - F.col("start") + 1)
    return rows.withColumn("seq", F.when(F.col("strand") == "-", seqprep.reverse_complement(part)).otherwise(part))


def merge_fragments(s, d):
    # each model by itself
    h = hit_texts(hits(s, d)).withColumn("seqid", F.concat_ws("/", "name", "seqid"))
    merged = intervals.merge_fragments(h.select(F.col("rid").alias("id"), "seqid", "start", "stop", "strand", "key", "seq"))
    return merged.withColumn("seqid", F.substring_index("seqid", "/", -1))


def interval_keys(s, d):
    return intervals.parse_keys(hits(s, d).select("rid", "key"))


def to_genome(s, d):
    loc = read(s, d, "supplier").select(F.col("s_suppkey").cast("string").alias("seqid"), (F.col("s_nationkey") * 1000 + 1).alias("loc_start"), (F.col("s_nationkey") * 1000 + 5000).alias("loc_stop"), F.when(F.col("s_nationkey") % 2 == 0, "+").otherwise("-").alias("loc_strand"))
    return intervals.to_genome(hits(s, d), loc).select("rid", "g_start", "g_stop", "g_strand")


TO_GENOME = f"""WITH {HITS}, l AS (SELECT s_suppkey::VARCHAR AS seqid, s_nationkey * 1000 + 1 AS a, s_nationkey * 1000 + 5000 AS b, s_nationkey % 2 = 0 AS plus FROM supplier)
SELECT rid, CASE WHEN plus THEN a + start - 1 WHEN NOT plus THEN b - stop + 1 END AS g_start, CASE WHEN plus THEN a + stop - 1 WHEN NOT plus THEN b - start + 1 END AS g_stop,
  CASE WHEN plus IS NULL THEN NULL WHEN plus = (strand = '+') THEN '+' ELSE '-' END AS g_strand FROM hits LEFT JOIN l USING (seqid)"""


def _overlap_of(least):
    return f"WITH {HITS}, o AS ({overlaps_sql('hits', 'hits', least)})"


def score_cutoff(s, d):
    return partitions.score_cutoff(hits(s, d), 50000.0, 0.0).select("rid")


def collect_hits(s, d):
    h = hits(s, d).withColumn("name", F.concat_ws(".", "name", "seqid"))
    return partitions.collect_hits(h, 20, h.where("bitscore < 1200").select("seqid")).select("rid")


COLLECT = f"""WITH {HITS}, h AS (SELECT * REPLACE (name || '.' || seqid AS name) FROM hits), g AS (SELECT DISTINCT seqid FROM h WHERE bitscore < 1200),
ok AS (SELECT name FROM h GROUP BY name HAVING count(*) >= 20 AND bool_or(seqid NOT IN (SELECT seqid FROM g))) SELECT rid FROM h WHERE name IN (SELECT name FROM ok)"""


def soft_partition(s, d):
    rows = partitions.filter_clusters(hits(s, d), 5)
    return partitions.partition_rows(rows, partitions.cluster_index(rows.select("name")))


def _partition_sql(rows):
    return f"""n AS (SELECT name AS cluster FROM {rows} GROUP BY name HAVING count(*) >= 5),
idx AS (SELECT cluster, dense_rank() OVER (ORDER BY split_part(cluster, '.', 1)::INT, split_part(cluster, '.', 2)::INT)::INT AS idx FROM n)
SELECT key, bitscore, NULL::DOUBLE AS evalue, cluster AS merged, name, idx FROM {rows} JOIN idx ON cluster = name"""


def unique_hits(s, d):
    return partitions.unique_hits(hits(s, d), 0.51).select("rid")


_BETTER = "b.bitscore > a.bitscore OR (b.bitscore = a.bitscore AND b.name < a.name)"
UNIQUE = f"{_overlap_of(51)}, beaten AS (SELECT DISTINCT a.rid AS rid FROM o WHERE {_BETTER}), uniq AS (SELECT * FROM hits ANTI JOIN beaten USING (rid))"


def hard_partition(s, d):
    rows = partitions.filter_clusters(partitions.unique_hits(hits(s, d), 0.51), 5)
    return partitions.partition_rows(rows, partitions.cluster_index(rows.select("name")))


def cluster_overlap(s, d):
    return partitions.cluster_overlap(hits(s, d))


CLUSTER_OVERLAP = f"""{_overlap_of(51)},
best AS (SELECT a.name AS i, b.name AS j, a.rid AS x, b.rid AS y FROM o WHERE a.name <> b.name QUALIFY row_number() OVER (PARTITION BY a.name, b.name, a.rid ORDER BY pct DESC, b.rid) = 1),
ol AS (SELECT i, j, count(DISTINCT y) AS ol FROM best GROUP BY i, j), size AS (SELECT name AS i, count(*) AS size FROM hits GROUP BY name),
matrix AS (SELECT i, j, ol, size, ((200 * ol + size) // (2 * size))::INT AS ratio_pct FROM ol JOIN size USING (i))"""


def best_partner(s, d):
    return partitions.best_partner(partitions.cluster_overlap(hits(s, d)), 5)


def merged_partition(s, d):
    h = hits(s, d)
    m = partitions.merge_map(partitions.best_partner(partitions.cluster_overlap(h), 5), h)
    rows = partitions.filter_clusters(h, 5, m)
    return partitions.partition_rows(rows, partitions.cluster_index(rows.select(F.col("cluster").alias("name"))))


def oracle_merge(s, d):
    c = hits(s, d).groupBy("name").agg((F.max("rid") % 4).alias("class"))
    return partitions.oracle_merge(c)


ORACLE_MERGE = f"WITH {HITS}, c AS (SELECT name, max(rid) % 4 AS class FROM hits GROUP BY name) SELECT name, CASE WHEN class = 0 THEN name ELSE max(name) OVER (PARTITION BY class) END AS cluster FROM c"


def hit_types(s, d):
    h = hits(s, d)
    return partitions.hit_types(h, h.where("bitscore > 95000"), h.where("bitscore < 5000"))


HIT_TYPES = f"""WITH {HITS}, m AS (SELECT * FROM hits WHERE bitscore > 95000), r AS (SELECT * FROM hits WHERE bitscore < 5000),
om AS ({overlaps_sql("hits", "m", 51, other=False)}), ob AS ({overlaps_sql("hits", "r", 51, other=False)})
SELECT rid, CASE WHEN rid IN (SELECT a.rid FROM om) THEN 'MODEL' WHEN rid IN (SELECT a.rid FROM ob) THEN 'BLASTCLUST' ELSE 'CMSEARCH' END AS type FROM hits"""


def models_without_hit(s, d):
    h = hits(s, d)
    return partitions.models_without_hit(h.where("bitscore > 60000"), h.where("bitscore < 15000")).select("rid")


WITHOUT = f"""WITH {HITS}, m AS (SELECT * FROM hits WHERE bitscore > 60000), r AS (SELECT * FROM hits WHERE bitscore < 15000), o AS ({overlaps_sql("m", "r", 51, other=False)})
SELECT rid FROM m WHERE rid NOT IN (SELECT a.rid FROM o)"""


def top_hits(s, d):
    return partitions.top_hits(hits(s, d), 15).select("name", "rid", "rank")


def cluster_stats(s, d):
    return partitions.cluster_stats(hits(s, d).withColumn("cluster", F.substring_index("name", ".", 1)))


def found_clusters(s, d):
    return partitions.found_clusters(hits(s, d))


def bed_lines(s, d):
    return partitions.bed(hits(s, d).withColumn("bitscore", F.col("bitscore").cast("int")))


def gev_cutoffs(s, d):
    return partitions.gev_cutoffs(hits(s, d), 0.05)


def _signals(s, d):
    """Every hit, five days later, as a signal of one of seven classes."""
    return hits(s, d).select("rid", "seqid", (F.col("start") + 5).alias("start"), (F.col("stop") + 5).alias("stop"), "strand", (F.col("rid") % 7).cast("int").alias("class"))


def evaluated_hits(s, d):
    h = hits(s, d).withColumn("cluster", F.col("name"))
    return evaluation.evaluate_hits(h, _signals(s, d)).select("rid", "cluster", "class", "dup")


EVALUATED = f"""{HITS}, sig AS (SELECT rid, seqid, start + 5 AS start, stop + 5 AS stop, strand, (rid % 7)::INT AS class FROM hits),
o AS ({overlaps_sql("hits", "sig", 51, other=False)}),
met AS (SELECT a.rid AS rid, a.name AS cluster, a.bitscore AS bitscore, b.rid AS signal, b.class AS class, pct FROM o),
major AS (SELECT cluster, class AS major FROM (SELECT DISTINCT cluster, rid, class FROM met WHERE class <> 0) GROUP BY cluster, class QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, class DESC) = 1),
own AS (SELECT m.* FROM met m LEFT JOIN major USING (cluster) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY coalesce(class = major, false) DESC, pct DESC, signal) = 1),
flagged AS (SELECT rid, class, row_number() OVER (PARTITION BY cluster, signal ORDER BY bitscore DESC, rid) > 1 AND class <> 0 AS dup FROM own),
evaluated AS (SELECT h.rid, h.name AS cluster, coalesce(f.class, 0) AS class, coalesce(f.dup, false) AS dup FROM hits h LEFT JOIN flagged f USING (rid))"""


def class_majority(s, d):
    return evaluation.class_majority(evaluated_hits(s, d))


MAJORITY = "own2 AS (SELECT cluster, class FROM evaluated GROUP BY cluster, class QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY class = 0, count(*) DESC, class DESC) = 1)"


def f_measure(s, d):
    sizes = _signals(s, d).groupBy("class").agg(F.count("*").alias("size"))
    return evaluation.f_measure(evaluated_hits(s, d), sizes)


F_MEASURE = f"""WITH {EVALUATED}, {MAJORITY}, sizes AS (SELECT class, count(*) AS size FROM sig GROUP BY class),
c AS (SELECT e.cluster, o.class, sum((e.class = o.class AND NOT dup)::INT) AS tp, sum((NOT (e.class = o.class AND NOT dup))::INT) AS fp FROM evaluated e JOIN own2 o USING (cluster) GROUP BY 1, 2),
x AS (SELECT c.cluster, c.class, tp::BIGINT AS tp, fp::BIGINT AS fp, greatest(coalesce(size, 0) - tp, 0)::BIGINT AS fn, (SELECT coalesce(sum(size), 0) FROM sizes WHERE class = 0)::BIGINT AS tn FROM c LEFT JOIN sizes s ON s.class = c.class),
y AS (SELECT *, CASE WHEN class <> 0 THEN coalesce(tp / nullif(tp + fp, 0), 0) ELSE 0 END AS p, CASE WHEN class <> 0 THEN coalesce(tp / nullif(tp + fn, 0), 0) ELSE 0 END AS r FROM x)
SELECT cluster, class, tp, fp, fn, tn, round(p, 3) AS precision, round(r, 3) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 3) AS f,
  round(CASE WHEN class <> 0 THEN (tp + tn) / nullif(tp + tn + fp + fn, 0) ELSE 0 END, 3) AS accuracy FROM y"""


def macro_average(s, d):
    return evaluation.macro_average(f_measure(s, d))


def _labelled(s, d):
    return read(s, d, "labels").join(read(s, d, "documents").select("doc_id", "lang", "source"), "doc_id")


def adjusted_rand(s, d):
    return evaluation.adjusted_rand(_labelled(s, d).select(F.col("lang").alias("truth"), (F.col("quality") * 2 + F.col("toxic")).alias("pred")))


ADJUSTED_RAND = """WITH t AS (SELECT lang, quality * 2 + toxic AS p, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2),
a AS (SELECT sum(n * (n - 1) / 2) AS a, sum(n) AS total FROM t), b AS (SELECT sum(n * (n - 1) / 2) AS b FROM (SELECT sum(n) AS n FROM t GROUP BY lang)), c AS (SELECT sum(n * (n - 1) / 2) AS c FROM (SELECT sum(n) AS n FROM t GROUP BY p))
SELECT round((a - b * c / (total * (total - 1) / 2)) / ((b + c) / 2 - b * c / (total * (total - 1) / 2)), 6)::DOUBLE AS ari FROM a, b, c"""


def purity(s, d):
    return evaluation.purity(_labelled(s, d).select(F.col("source").alias("cluster"), (F.col("quality") + 2 * F.col("toxic")).alias("class")))


PURITY = """WITH r AS (SELECT source AS cluster, nullif(quality + 2 * toxic, 0) AS c FROM labels JOIN documents USING (doc_id)), k AS (SELECT cluster, c, count(*) AS n FROM r GROUP BY 1, 2)
SELECT cluster, sum(n)::BIGINT AS size, round(max(CASE WHEN c IS NULL THEN 1 ELSE n END) / sum(n), 4) AS purity FROM k GROUP BY cluster"""


def subtree_quality(s, d):
    return evaluation.subtree_quality(purity(s, d))


def _overrepresented(s, d):
    t = _labelled(s, d)
    n = t.count()
    size = t.groupBy("lang").agg(F.count("*").alias("class_size"))
    sample = t.groupBy("source").agg(F.count("*").alias("sample"))
    return t.groupBy("source", "lang").agg(F.count("*").alias("hits")).join(size, "lang").join(sample, "source").select("source", "lang", "class_size", "sample", "hits"), n


def hypergeometric(s, d):
    rows, n = _overrepresented(s, d)
    return evaluation.hypergeometric_tail(rows, n).withColumn("p", F.round("p", 6))


HYPERGEOMETRIC = """t AS (SELECT doc_id, lang, source FROM labels JOIN documents USING (doc_id)), n AS (SELECT count(*) AS n FROM t),
r AS (SELECT source, lang, count(*) AS hits FROM t GROUP BY 1, 2), cs AS (SELECT lang, count(*) AS class_size FROM t GROUP BY 1), ss AS (SELECT source, count(*) AS sample FROM t GROUP BY 1),
rows_ AS (SELECT source, lang, class_size, sample, hits, n FROM r JOIN cs USING (lang) JOIN ss USING (source), n),
terms AS (SELECT *, unnest(range(greatest(hits, class_size + sample - n), least(class_size, sample) + 1)) AS x FROM rows_),
tails AS (SELECT source, lang, class_size, sample, hits, least(1.0, sum(exp(lgamma(class_size + 1) - lgamma(x + 1) - lgamma(class_size - x + 1) + lgamma(n - class_size + 1) - lgamma(sample - x + 1) - lgamma(n - class_size - sample + x + 1)
  - lgamma(n + 1) + lgamma(sample + 1) + lgamma(n - sample + 1)))) AS p FROM terms GROUP BY ALL)"""


def pvalue_report(s, d):
    return evaluation.pvalue_report(hypergeometric(s, d).select((F.col("hits") % 3 + 1).cast("int").alias("round"), "p"))


PVALUE_REPORT = f"""WITH {HYPERGEOMETRIC}, c AS (SELECT (hits % 3 + 1)::INT AS round, round(p, 6) AS p, unnest([1.0::DOUBLE, 0.1, 0.05, 0.01, 0.001, 0.0001]) AS cutoff FROM tails)
SELECT CASE WHEN grouping(c.round) = 1 THEN 0 ELSE c.round END AS round, cutoff, count(*) AS centers, count(*) FILTER (p <= cutoff) AS below, round(count(*) FILTER (p <= cutoff) / count(*), 4) AS ratio
FROM c GROUP BY GROUPING SETS ((c.round, cutoff), (cutoff))"""


def round_summary(s, d):
    rows = f_measure(s, d).select((F.substring_index("cluster", ".", -1).cast("int") % 4 + 1).alias("round"), "class", "f")
    return evaluation.round_summary(rows)


ROUND_SUMMARY = f"""WITH f AS (SELECT (split_part(cluster, '.', 2)::INT % 4 + 1) AS round, class, f FROM ({F_MEASURE})),
fresh AS (SELECT round, count(*) AS fresh FROM (SELECT class, min(round) AS round FROM f WHERE class <> 0 GROUP BY class) GROUP BY round),
e AS (SELECT round, count(*) AS n, sum(f) AS s, count(*) FILTER (f >= 0.9) AS t90, count(*) FILTER (f >= 0.8) AS t80, count(*) FILTER (f >= 0.7) AS t70, count(*) FILTER (f >= 0.5) AS t50 FROM f GROUP BY round)
SELECT round, sum(n) OVER w AS clusters, sum(coalesce(fresh, 0)) OVER w AS classes, round(sum(s) OVER w / sum(n) OVER w, 4) AS mean_f, sum(t90) OVER w AS f90, sum(t80) OVER w AS f80, sum(t70) OVER w AS f70, sum(t50) OVER w AS f50
FROM e LEFT JOIN fresh USING (round) WINDOW w AS (ORDER BY round ROWS UNBOUNDED PRECEDING)"""


def normalize_seq(s, d):
    return read(s, d, "documents").select("doc_id", F.md5(seqprep.normalize(F.col("text"))).alias("digest"), F.length(seqprep.normalize(F.col("text"))).alias("n"))


NORMALIZE = r"""WITH n AS (SELECT doc_id, regexp_replace(translate(translate(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), 'T', 'U'), '[^AUGCN]', 'N', 'g') AS s FROM documents) SELECT doc_id, md5(s) AS digest, length(s) AS n FROM n"""


def reverse_complement(s, d):
    return sequences(s, d).select("seq_idx", F.md5(seqprep.reverse_complement(F.col("seq"))).alias("digest"))


def _masked(s, d):
    return sequences(s, d).withColumn("seq", F.regexp_replace("seq", "AGC", "N" * 17))


_MASKED = SEQUENCES + ", masked AS (SELECT seq_idx, regexp_replace(seq, 'AGC', repeat('N', 17), 'g') AS seq FROM sequences)"


def split_masked(s, d):
    t = seqprep.segment_status(seqprep.split_masked(_masked(s, d)), 30)
    return t.select("seq_idx", "part", "abs_start", "abs_end", F.md5("seg").alias("digest"), "status")


_SPLIT = f"""{_MASKED}, p AS (SELECT seq_idx, list_filter(string_split(regexp_replace(seq, '(N{{16,}})', '|\\1|', 'g'), '|'), lambda x: x <> '') AS p FROM masked WHERE seq <> ''),
u AS (SELECT seq_idx, unnest(p) AS seg, (unnest(range(len(p))))::INT AS part FROM p),
segments AS (SELECT seq_idx, part, seg, (sum(length(seg)) OVER w)::INT AS abs_end, (sum(length(seg)) OVER w - length(seg) + 1)::INT AS abs_start FROM u WINDOW w AS (PARTITION BY seq_idx ORDER BY part ROWS UNBOUNDED PRECEDING))"""
SPLIT = f"WITH {_SPLIT} SELECT seq_idx, part, abs_start, abs_end, md5(seg) AS digest, CASE WHEN length(seg) < 30 THEN 'SMALLER_THAN' WHEN regexp_matches(seg, 'N{{15,}}') THEN 'MASKED' ELSE 'USED' END AS status FROM segments"


def window_fragments(s, d):
    return seqprep.window_fragments(seqprep.split_masked(_masked(s, d)), 150, 50, 30).select("key", "start", "stop", F.md5("seq").alias("digest"))


#: The windows by stepping, as they are defined, not in closed form.
WINDOWS = f"""WITH RECURSIVE {_SPLIT},
used AS (SELECT seq_idx, abs_start, length(regexp_extract(seg, '^(N*)', 1)) AS cue, regexp_replace(regexp_replace(seg, '^N+', ''), 'N+$', '') AS s FROM segments WHERE length(seg) >= 30 AND NOT regexp_matches(seg, 'N{{15,}}')),
base AS (SELECT *, length(s) AS n FROM used WHERE s <> ''),
steps AS (
  SELECT seq_idx, abs_start, cue, s, n, 0 AS z, CASE WHEN n <= 150 THEN n WHEN n <= 75 THEN 90 WHEN n - 75 <= 90 THEN greatest(150, n - 75) ELSE 150 END AS len,
    CASE WHEN n <= 150 THEN 0 WHEN n - 75 <= 90 THEN n - greatest(150, n - 75) ELSE 0 END AS p FROM base
  UNION ALL
  SELECT seq_idx, abs_start, cue, s, n, p + 75, CASE WHEN n - (p + 75) <= 75 THEN 90 WHEN n - (p + 75) - 75 <= 90 THEN greatest(150, n - (p + 75) - 75) ELSE 150 END,
    CASE WHEN n - (p + 75) <= 75 THEN n - 90 WHEN n - (p + 75) - 75 <= 90 THEN n - greatest(150, n - (p + 75) - 75) ELSE p + 75 END
  FROM steps WHERE p + len < n)
SELECT DISTINCT 'SEQ' || seq_idx || '#' || (abs_start + cue + p) || '#' || (abs_start + p + len - 1) || '#+' AS key, abs_start + cue + p AS start, abs_start + p + len - 1 AS stop, md5(substr(s, p + 1, len)) AS digest FROM steps"""


def genome_locations(s, d):
    t = read(s, d, "events").select("event_id", F.concat(F.lit("hg"), (F.col("user_id") % 3).cast("string"), F.lit(".chr"), (F.col("user_id") % 22).cast("string"), F.lit(":"), (F.col("event_id") * 7 % 1000).cast("string"), F.lit("-"), (F.col("event_id") * 3 % 1000).cast("string"), F.when(F.col("event_id") % 5 == 0, ":+").otherwise("")).alias("id"), F.when(F.col("event_id") % 7 == 0, "strand=- note").otherwise("note").alias("header"))
    return t.select("event_id", seqprep.genome_locations(F.col("id"), F.col("header")).alias("location"))


GENOME_LOCATIONS = """WITH t AS (SELECT event_id, user_id, event_id * 7 % 1000 AS a, event_id * 3 % 1000 AS b FROM events)
SELECT event_id, 'hg' || (user_id % 3) || '.chr' || (user_id % 22) || ':' || least(a, b) || '-' || greatest(a, b) || ':' ||
  CASE WHEN event_id % 7 = 0 THEN '-' WHEN event_id % 5 = 0 THEN '+' WHEN a > b THEN '-' ELSE '+' END AS location FROM t"""


def url_locations(s, d):
    """Locations in headers made of page numbers; a third of them have none."""
    k = F.col("page_id") % 3
    header = F.when(k == 0, "no place").when(k == 1, F.format_string("GENOME_LOC mm%d.chr%d:%d-%d:-", F.col("page_id") % 4, F.col("page_id") % 19, F.col("page_id"), F.col("page_id") + 70)).otherwise(F.format_string("chr%d:%d-%d strand=+", F.col("page_id") % 19, F.col("page_id"), F.col("page_id") + F.length("url")))
    return read(s, d, "pages").select("page_id", seqprep.genome_locations(F.lit("x"), header).alias("location"))


def near_duplicates(s, d):
    f = read(s, d, "documents").select(F.col("doc_id").alias("value"), F.col("text").alias("seq"))
    return seqprep.near_duplicates(f, 0.9)


def exact_duplicates(s, d):
    return read(s, d, "documents").groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n"))


def class_signals(s, d):
    t = read(s, d, "part").select(F.col("p_partkey").cast("int").alias("seq_idx"), F.concat(F.lit("CLASS_MULTI "), (F.col("p_partkey") % 4).cast("string"), F.lit("#"), "p_type", F.lit("#"), F.col("p_size").cast("string"), F.lit("#20;1#x#1#9")).alias("header"), F.lit("ACGU").alias("seq"))
    return seqprep.class_signals(t)


CLASS_SIGNALS = """WITH t AS (SELECT p_partkey::INT AS i, (p_partkey % 4)::INT AS class, p_type AS name, p_size AS a, 20 AS b FROM part WHERE p_partkey % 4 <> 0 UNION ALL SELECT p_partkey::INT, 1, 'x', 1, 9 FROM part),
u AS (SELECT class, name, 'SEQ' || i AS seqid, least(a, b) AS start, greatest(a, b) AS stop, CASE WHEN a > b THEN '-' ELSE '+' END AS strand FROM t)
SELECT *, seqid || '#' || start || '#' || stop || '#' || strand AS key FROM u"""


def annotate_fragments(s, d):
    return seqprep.annotate_fragments(hits(s, d), _signals(s, d).where("class <> 0"))


ANNOTATE = f"""WITH {HITS}, sig AS (SELECT rid, seqid, start + 5 AS start, stop + 5 AS stop, strand, (rid % 7)::INT AS class FROM hits WHERE rid % 7 <> 0), o AS ({overlaps_sql("hits", "sig", 5, other=False)}),
m AS (SELECT a.rid AS rid, max({{'pct': pct, 'class': b.class}}) AS m FROM o GROUP BY 1) SELECT rid, coalesce(m.m.class, 0) AS class FROM hits LEFT JOIN m USING (rid)"""


def grey_indices(s, d):
    return seqprep.grey_indices(sequences(s, d), [3, 5], ["src1$", "^7"], 2)


def fragment_ids(s, d):
    h = hits(s, d).select(F.col("seqid").cast("int").alias("seq_idx"), "start", F.concat_ws("/", "key", F.col("rid").cast("string")).alias("key"))
    return seqprep.fragment_ids(h, s.range(0, 10).select(F.col("id").cast("int").alias("seq_idx"))).select("key", "value")


FRAGMENT_IDS = f"WITH {HITS} SELECT key || '/' || rid AS key, row_number() OVER (ORDER BY seqid::INT >= 10, seqid::INT, start, key || '/' || rid) AS value FROM hits"


def overlap_statistics(s, d):
    return order_statistics(self_overlap(s, d), "pct")


QUERIES = {
    "interval_overlap": (interval_overlap, f"WITH {HITS}, o AS ({overlaps_sql('hits', 'hits', 20, strand=False)}) SELECT a.rid AS a_rid, b.rid AS b_rid, pct FROM o"),
    "self_overlap": (self_overlap, f"{_overlap_of(51)} SELECT a.rid AS a_rid, b.rid AS b_rid, pct FROM o"),
    "blacklist": (blacklist, BLACKLIST),
    "merge_islands": (merge_islands, ISLANDS),
    "merge_fragments": (merge_fragments, None),
    "interval_keys": (interval_keys, f"WITH {HITS} SELECT rid, key, seqid, start, stop, strand FROM hits"),
    "to_genome": (to_genome, TO_GENOME),
    "score_cutoff": (score_cutoff, f"WITH {HITS} SELECT rid FROM hits WHERE bitscore >= 50000"),
    "collect_hits": (collect_hits, COLLECT),
    "soft_partition": (soft_partition, f"WITH {HITS}, {_partition_sql('hits')}"),
    "unique_hits": (unique_hits, f"{UNIQUE} SELECT rid FROM uniq"),
    "hard_partition": (hard_partition, f"{UNIQUE}, {_partition_sql('uniq')}"),
    "cluster_overlap": (cluster_overlap, f"{CLUSTER_OVERLAP} SELECT i, j, ol, size, ratio_pct FROM matrix"),
    "best_partner": (best_partner, f"{CLUSTER_OVERLAP} SELECT i, j, ol, size, ratio_pct FROM (SELECT * FROM matrix QUALIFY row_number() OVER (PARTITION BY i ORDER BY ratio_pct DESC, j) = 1) WHERE ratio_pct >= 5"),
    "merged_partition": (merged_partition, None),
    "oracle_merge": (oracle_merge, ORACLE_MERGE),
    "hit_types": (hit_types, HIT_TYPES),
    "models_without_hit": (models_without_hit, WITHOUT),
    "top_hits": (top_hits, f"WITH {HITS} SELECT name, rid, row_number() OVER (PARTITION BY name ORDER BY bitscore DESC, rid) AS rank FROM hits WHERE bitscore > 0 QUALIFY rank <= 15"),
    "cluster_stats": (cluster_stats, f"WITH {HITS} SELECT split_part(name, '.', 1) AS cluster, count(*) AS seqs, count(DISTINCT seqid) AS ids_unique, count(DISTINCT name) AS models, round(max(bitscore), 4) AS best, round(avg(bitscore), 4) AS mean_score FROM hits GROUP BY 1"),
    "found_clusters": (found_clusters, f"WITH {HITS} SELECT DISTINCT split_part(name, '.', 2)::INT AS idx FROM hits"),
    "bed_lines": (bed_lines, f"WITH {HITS} SELECT seqid || chr(9) || (start - 1) || chr(9) || stop || chr(9) || name || chr(9) || floor(bitscore)::INT || chr(9) || strand AS value FROM hits"),
    "gev_cutoffs": (gev_cutoffs, None),
    "evaluated_hits": (evaluated_hits, f"WITH {EVALUATED} SELECT rid, cluster, class, dup FROM evaluated"),
    "class_majority": (class_majority, f"WITH {EVALUATED}, {MAJORITY} SELECT cluster, class FROM own2"),
    "f_measure": (f_measure, F_MEASURE),
    "macro_average": (macro_average, "SELECT " + ", ".join(f"((2 * sum(round({c} * 1000)::BIGINT) + count(*)) // (2 * count(*)))::DOUBLE / 1000 AS {c}" for c in ("precision", "recall", "f", "accuracy")) + f" FROM ({F_MEASURE})"),
    "adjusted_rand": (adjusted_rand, ADJUSTED_RAND),
    "purity": (purity, PURITY),
    "subtree_quality": (subtree_quality, f"WITH p AS ({PURITY}) SELECT cluster, round(0.7::DOUBLE * purity + 0.3::DOUBLE * size / (SELECT max(size) FROM p), 4) AS quality FROM p"),
    "hypergeometric": (hypergeometric, f"WITH {HYPERGEOMETRIC} SELECT source, lang, class_size, sample, hits, round(p, 6) AS p FROM tails"),
    "pvalue_report": (pvalue_report, PVALUE_REPORT),
    "round_summary": (round_summary, ROUND_SUMMARY),
    "normalize_seq": (normalize_seq, NORMALIZE),
    "reverse_complement": (reverse_complement, f"WITH {SEQUENCES} SELECT seq_idx, md5(reverse(translate(seq, 'AUGC', 'UACG'))) AS digest FROM sequences"),
    "split_masked": (split_masked, SPLIT),
    "window_fragments": (window_fragments, WINDOWS),
    "genome_locations": (genome_locations, GENOME_LOCATIONS),
    "url_locations": (url_locations, "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'MISS' WHEN 1 THEN 'mm' || page_id % 4 || '.chr' || page_id % 19 || ':' || page_id || '-' || (page_id + 70) || ':-' ELSE 'undef.chr' || page_id % 19 || ':' || page_id || '-' || (page_id + length(url)) || ':+' END AS location FROM pages"),
    "near_duplicates": (near_duplicates, None),
    "exact_duplicates": (exact_duplicates, "SELECT md5(text) AS digest, min(doc_id) AS keeper, count(*) AS n FROM documents GROUP BY 1"),
    "class_signals": (class_signals, CLASS_SIGNALS),
    "annotate_fragments": (annotate_fragments, ANNOTATE),
    "grey_indices": (grey_indices, "SELECT (doc_id + 1)::INT AS seq_idx FROM documents WHERE doc_id + 1 <= 2 OR doc_id + 1 IN (3, 5) OR regexp_matches(doc_id || ' ' || source, 'src1$|^7')"),
    "fragment_ids": (fragment_ids, FRAGMENT_IDS),
    "overlap_statistics": (overlap_statistics, f"{_overlap_of(51)} SELECT count(*) AS num, sum(pct)::BIGINT AS sum, round(avg(pct), 6) AS avg, round(stddev_samp(pct), 6) AS sd, min(pct) AS min, " + ", ".join(f"list_sort(list(pct))[floor(count(*) * {q})::INT + 1] AS q{round(q * 100):02d}" for q in (0.05, 0.25, 0.5, 0.75, 0.95)) + ", max(pct) AS max FROM o"),
}
