"""Queries of sources and sinks: the driver's rows are written in a format, read back, and compared with the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators import graphs, partitions, seqprep
from strandloom.plans.relational import _SPLIT, _masked, _partition_sql
from strandloom.plans.structure import ALIGNMENTS, BACKBONE, STRUCTURES, _alignments, _structures, _text_graphs
from strandloom.plans.tables import DOC_FEATURES, HITS, SEQUENCES, doc_features, hits, read, sequences
from strandloom.session import shared_dir
from strandloom.sources import readers, writers


def _put(lines: DataFrame, *by: str) -> str:
    """The folder where the lines (value) are; with `by`, a folder for each value, in which they are one file."""
    path = f"{shared_dir(lines.sparkSession)}/lines-{uuid.uuid4().hex}"
    if by:
        lines.write.partitionBy(*by).text(path)
    else:
        writers.write_text(lines, path)
    return path


def _of(column: str, name: str, kind: str = "long"):  # noqa: ANN202
    """What the name of a file says of a partition column."""
    return F.regexp_extract(column, rf"/{name}=([^/]*)/", 1).cast(kind)


def _parts(s, d):
    return read(s, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_type").alias("header"), F.upper(F.regexp_replace("p_name", " ", "")).alias("seq"), "p_partkey", "p_size")


_PARTS = "p AS (SELECT p_partkey::VARCHAR AS id, p_type AS header, upper(replace(p_name, ' ', '')) AS seq, p_partkey, p_size FROM part)"


def fasta_records(s, d):
    return readers.read_fasta(s, _put(writers.fasta_lines(_parts(s, d)))).select("id", "header", "seq")


def fasta_meta(s, d):
    t = _parts(s, d).select(F.concat(F.lit(">"), "id", F.lit("\n"), F.substring("seq", 1, 3), F.lit("\n"), F.expr("substr(seq, 4)"), F.lit("\n((. #FS\n..) #FS\n"), "header", F.lit(" #KIND")).alias("value"))
    return readers.read_fasta(s, _put(t)).select("id", "seq", F.col("meta")["FS"].alias("fs"), F.col("meta")["KIND"].alias("kind"))


def fasta_repeats(s, d):
    t = _parts(s, d).select(F.concat(F.lit(">size"), F.col("p_size").cast("string"), F.lit("\n"), "seq").alias("value"))
    return readers.read_fasta(s, _put(t), make_unique=True).select("id")


def vienna_records(s, d):
    t = _structures(s, d).select(F.concat(F.lit(">"), F.col("graph_id").cast("string"), F.lit("\n"), F.translate("struct", "(.)", "GAC"), F.lit("\n"), "struct", F.lit(" (-1.50)\n"), F.translate("struct", "()", ".."), F.lit(" {-1.0 MEA=2.5}")).alias("value"))
    return readers.read_vienna(s, _put(t))


def gspan_graphs(s, d):
    v, e = graphs.backbone(_text_graphs(s, d))
    # a vertex that is no viewpoint carries the graph's number through the file
    n = v.groupBy("graph_id").agg((F.max("vid") + 1).alias("vid")).withColumns({"label": F.concat(F.lit("^"), F.col("graph_id").cast("string")), "is_view": F.lit(False)})
    text = writers.gspan(v.select("graph_id", "vid", "label", "is_view").unionByName(n), e)
    v, e = readers.read_gspan(s, _put(text), kind="AS_IS")
    name = v.where("is_abs and not is_view").select("graph_id", F.substring("label", 2, 99).cast("long").alias("name"))
    return name.join(v.where("is_kernel").groupBy("graph_id").agg(F.count("*").alias("vertices"), F.count_if(F.col("label") == "U").alias("us")), "graph_id").join(e.groupBy("graph_id").agg(F.count("*").alias("edges")), "graph_id").drop("graph_id")


def sparse_vectors(s, d):
    got = readers.read_sparse_text(s, _put(writers.sparse_lines(doc_features(s, d))))
    # a file numbers its lines from 0, so ids of several files meet: what is compared are the pairs
    return got.groupBy("f", "v").agg(F.count("*").alias("n"))


def fragment_list(s, d):
    return readers.read_fragments(s, _put(hits(s, d).select(F.concat_ws(" ", F.col("rid").cast("string"), "key").alias("value"))))


def partition_table(s, d):
    rows = partitions.filter_clusters(hits(s, d), 5)
    t = partitions.partition_rows(rows, partitions.cluster_index(rows.select("name"))).withColumn("evalue", F.lit("-"))
    return readers.read_partition(s, _put(writers.padded_columns(t, ["key", "bitscore", "evalue", "merged", "name", "idx"])))


def hit_tables(s, d):
    h = hits(s, d)
    first, last = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("stop")), F.when(F.col("strand") == "+", F.col("stop")).otherwise(F.col("start"))
    line = F.concat_ws("  ", "name", "seqid", first.cast("string"), last.cast("string"), F.lit("1"), F.lit("20"), F.col("bitscore").cast("string"), F.lit("-"), F.lit("50"))
    # a table for each model and sequence; the second of those with an odd number was cut off and counts for nothing
    t = h.withColumn("whole", (F.col("seqid").cast("int") % 2).cast("int")).groupBy("name", "seqid", "whole").agg(F.array_join(F.collect_list(line), "\n").alias("l"))
    end = F.when(F.col("whole") == 0, F.lit("\n# end")).otherwise(F.lit(""))
    good = t.where("whole = 0").select(F.concat(F.lit("# model\n"), "l", end).alias("value"))
    cut = t.where("whole = 1").select("seqid", F.concat(F.lit("# model\n"), "l", end).alias("value"))
    rows = readers.read_hits(s, _put(good)).union(readers.read_hits(s, _put(cut.repartition("seqid"), "seqid")))
    return rows.select("name", "seqid", "start", "stop", "strand", "bitscore", "key")


def clustal_files(s, d):
    t = writers.clustal_lines(_alignments(s, d).withColumn("name", F.concat(F.lit("p"), F.col("row").cast("string"))), 10)
    path = _put(t.repartition("aln_id").sortWithinPartitions("aln_id", "block", "row").select("aln_id", "value"), "aln_id")
    return readers.read_clustal(s, f"{path}/*").select(_of("aln_id", "aln_id").alias("aln_id"), "name", "gapped")


def stockholm_files(s, d):
    a = _alignments(s, d).withColumn("name", F.concat(F.lit("p"), F.col("row").cast("string")))
    cons = a.groupBy("aln_id").agg(F.rpad(F.lit("(("), 16, ")").alias("text"))
    rows, tags = readers.read_stockholm(s, f"{_put(writers.stockholm(a, cons).repartition('aln_id'), 'aln_id')}/*")
    return rows.select(_of("aln_id", "aln_id").alias("aln_id"), "name", "gapped").union(tags.select(_of("aln_id", "aln_id"), "tag", "text"))


def maf_files(s, d):
    line = F.concat(F.lit("s p"), F.col("row").cast("string"), F.lit(" 0 16 + 16 "), "gapped")
    text = _alignments(s, d).groupBy("aln_id").agg(F.concat(F.lit("##maf\na score=1\n"), F.array_join(F.collect_list(line), "\n"), F.lit("\n")).alias("value"))
    return readers.read_maf(s, f"{_put(text.repartition('aln_id'), 'aln_id')}/*").select(_of("aln_id", "aln_id").alias("aln_id"), "name", "gapped")


def pair_archive(s, d):
    t = read(s, d, "part").where("p_size > 0")
    rows = F.concat(F.lit("@"), F.col("p_partkey").cast("string"), F.lit(" Score: "), (F.col("p_size") * 10 - 100).cast("string"), F.lit("\n"), F.lit("1 "), F.expr("repeat('~', p_size % 4)"), F.lit("ACG-\n2 "), F.expr("rpad('AC-GU', p_size % 4 + 4, '~')"), F.lit("\n"))
    return readers.read_pair_archive(s, _put(t.select(rows.alias("value"))))


PAIR_ARCHIVE = """WITH t AS (SELECT p_partkey::INT AS no, p_size * 10 - 100 AS score, 1::BIGINT AS iid, 2::BIGINT AS jid, repeat('~', p_size % 4) || 'ACG-' AS iseq, rpad('AC-GU', p_size % 4 + 4, '~') AS jseq FROM part WHERE p_size > 0)
SELECT *, greatest(length(regexp_extract(iseq, '^~*')), length(regexp_extract(jseq, '^~*'))) + 1 AS start_col, length(iseq) - greatest(length(regexp_extract(iseq, '~*$')), length(regexp_extract(jseq, '~*$'))) AS end_col FROM t"""


def local_hits(s, d):
    t = hits(s, d).select(F.concat_ws(" ", F.when(F.col("strand") == "+", " HIT").otherwise("MISS"), (F.col("rid") % 1000).cast("string"), F.col("start").cast("string"), F.lit("1"), F.col("stop").cast("string"), F.lit("9")).alias("value"))
    return readers.read_local_hits(s, _put(t)).groupBy("score", "istart", "istop").agg(F.count("*").alias("n"))


def newick_files(s, d):
    leaf = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(":"), (F.col("n_nationkey") / 4 + 0.5).cast("string"))
    t = read(s, d, "nation").groupBy("n_regionkey").agg(F.concat(F.lit("(("), F.array_join(F.collect_list(leaf), ","), F.lit("):0.25,r"), F.col("n_regionkey").cast("string"), F.lit(":2):0;")).alias("value"))
    n = readers.read_newick(s, f"{_put(t.repartition('n_regionkey'), 'n_regionkey')}/*")
    return n.where("name <> ''").select(_of("tree_id", "n_regionkey", "int").alias("region"), "name", "length")


def subset_line(s, d):
    t = read(s, d, "supplier").groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s_suppkey")), lambda x: x.cast("string")), " ").alias("value"))
    every = read(s, d, "nation").select(F.col("n_nationkey").alias("s_nationkey")).join(t, "s_nationkey", "left").select("s_nationkey", F.coalesce("value", F.lit("")).alias("value"))
    # one file, as a line's number is the centre's: 25 lines
    return readers.read_subset(s, _put(every.coalesce(1).sortWithinPartitions("s_nationkey")), 4, 5)


def class_info(s, d):
    root = f"{shared_dir(s)}/classes-{uuid.uuid4().hex}"
    p = read(s, d, "part")
    key = F.concat_ws("#", F.concat(F.lit("SEQ"), F.col("p_partkey").cast("string")), F.lit("1"), F.col("p_size").cast("string"), F.lit("+"))
    cls = (F.col("p_partkey") % 9).cast("string")
    writers.write_text(p.select(F.concat_ws(" ", F.col("p_partkey").cast("string"), cls, key).alias("value")), f"{root}/class.hash")
    writers.write_text(p.select(F.concat_ws(" ", cls, key).alias("value")), f"{root}/class.hash.scan")
    sizes = p.groupBy(cls.alias("c")).agg(F.count("*").alias("n"), F.countDistinct("p_size").alias("u"))
    writers.write_text(sizes.select(F.concat_ws(" ", F.col("n").cast("string"), "c", F.col("n").cast("string"), F.col("u").cast("string"), F.concat(F.lit("k"), "c")).alias("value")), f"{root}/class.size")
    frags, scan, sizes = readers.read_class_info(s, root)
    return frags.join(scan, ["class", "key"]).join(sizes.select("class", "n", "uniq", "name"), "class")


def time_files(s, d):
    t = read(s, d, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.unix_timestamp(F.min("ts")).alias("a"), F.unix_timestamp(F.max("ts")).alias("b"))
    text = t.select("day", F.concat_ws("\n", "day", F.col("a").cast("string"), "day", F.col("b").cast("string")).alias("value"))
    return readers.read_times(s, f"{_put(text.repartition('day'), 'day')}/*").select(_of("file", "day", "string").alias("day"), "start", "stop", "seconds")


def shape_windows(s, d):
    t = _structures(s, d).select("graph_id", (F.col("graph_id") % 16).alias("part"), F.concat(F.col("graph_id").cast("string"), F.lit(" "), (F.col("graph_id") + F.length("struct")).cast("string"), F.lit("\n"), F.translate("struct", "(.)", "GAC"), F.lit("\n"), "struct", F.lit("  (-3.25)  (0.5)  0.75  []\n"), F.translate("struct", "()", ".."), F.lit("  (0.00)  _")).alias("block"))
    text = t.groupBy("part").agg(F.concat(F.lit(">x\n"), F.array_join(F.collect_list("block"), "\n")).alias("value"))
    return readers.read_shapes(s, f"{_put(text.repartition('part'), 'part')}/*", most=2, drop_unshaped=True).select("win_start", "win_end", "seq", "struct", "energy", "prob", "shapeprob", "shape")


def id_list(s, d):
    return readers.read_int_list(s, _put(read(s, d, "documents").select(F.col("doc_id").cast("string").alias("value"))))


def word_list(s, d):
    # one file, as its words are numbered: 25 lines
    t = read(s, d, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select(F.col("n_name").alias("value"))
    return readers.read_string_list(s, _put(t))


def reimported(s, d):
    t = sequences(s, d)
    lines = writers.scan_outputs(t.where("seq <> ''"), t.limit(0).selectExpr("seq_idx", "1 abs_start", "1 abs_end", "'' status"), t.limit(0).selectExpr("seq_idx", "'' location"))["scan"]
    got = readers.read_fasta(s, _put(lines))
    a, b = readers.reimport(F.col("header"))
    return got.select("id", a.alias("orig"), b.alias("head"), F.md5("seq").alias("digest"))


def scan_segments(s, d):
    t = _masked(s, d)
    seg = seqprep.segment_status(seqprep.split_masked(t), 30)
    t = t.withColumns({"id": F.lit(""), "header": F.lit("")})
    lines = writers.scan_outputs(t, seg, t.limit(0).selectExpr("seq_idx", "'' location"))["segments"]
    return readers.read_table(s, _put(lines), ["segment", "status"])


def fragment_files(s, d):
    t = hits(s, d).select(F.col("rid").alias("value"), "key", F.expr("repeat('A', stop - start + 1)").alias("seq"))
    out = writers.fragment_outputs(t)
    lens = readers.read_table(s, _put(out["lens"]), ["value", "size"])
    fasta = readers.read_fasta(s, _put(out["fasta"])).select(F.col("id").alias("value"), F.col("header").alias("key"), F.length("seq").alias("n"))
    names = readers.read_fragments(s, _put(out["names"])).select(F.col("value").cast("string").alias("value"), "start", "stop")
    return lens.join(fasta, "value").join(names, "value").select(F.col("value").cast("long").alias("value"), F.col("size").cast("int").alias("size"), "key", "n", "start", "stop")


def graph_lines(s, d):
    v, e = graphs.backbone(_text_graphs(s, d))
    return writers.export_graph(v, e, "csv").select("graph_id", "value")


def graph_dot(s, d):
    v, e = graphs.backbone(_text_graphs(s, d))
    return writers.export_graph(v, e, "dot").select("graph_id", F.md5("value").alias("digest"))


def stored_tables(s, d):
    root = f"{shared_dir(s)}/tables-{uuid.uuid4().hex}"
    writers.write_tables({"hits": hits(s, d).select("rid", "key", "bitscore")}, root)
    return s.read.parquet(f"{root}/hits")


_ROWS = f"WITH {ALIGNMENTS} SELECT aln_id, 'p' || row AS name, gapped FROM al"
_LINES = "SELECT graph_id, 0 AS k, vid AS a, 0 AS b, 'v,' || vid || ',' || label AS l FROM v UNION ALL SELECT graph_id, 1, src, dst, 'e,' || src || ',' || dst || ',' || label FROM e1"
_DOT = """SELECT graph_id, 0 AS k, vid AS a, 0 AS b, vid || ' [label="' || label || '"]' AS l FROM v UNION ALL SELECT graph_id, 1, src, dst, src || ' -> ' || dst || ' [label="' || label || '"]' FROM e1"""

QUERIES = {
    "fasta_records": (fasta_records, f"WITH {_PARTS} SELECT id, header, seq FROM p"),
    "fasta_meta": (fasta_meta, f"WITH {_PARTS} SELECT id, seq, '((...)' AS fs, header AS kind FROM p"),
    "fasta_repeats": (fasta_repeats, "SELECT 'size' || p_size || CASE WHEN n > 1 THEN '_' || (n - 1) ELSE '' END AS id FROM (SELECT p_size, row_number() OVER (PARTITION BY p_size) AS n FROM part)"),
    "vienna_records": (vienna_records, f"WITH {STRUCTURES}, x AS (SELECT graph_id, '.(' || repeat('(', k) || repeat('.', l) || repeat(')', k) || '..' || repeat('(', k) || repeat('.', l) || repeat(')', k) || ')..' AS s FROM st) SELECT graph_id::VARCHAR AS id, translate(s, '(.)', 'GAC') AS seq, s AS mfe, translate(s, '()', '..') AS mea FROM x"),
    "gspan_graphs": (gspan_graphs, f"WITH {BACKBONE} SELECT graph_id AS name, count(*) AS vertices, count(*) FILTER (label = 'U') AS us, count(*) - 1 AS edges FROM v GROUP BY 1"),
    "sparse_vectors": (sparse_vectors, f"WITH {DOC_FEATURES} SELECT f, format('{{:.7e}}', v)::DOUBLE AS v, count(*) AS n FROM features GROUP BY 1, 2"),
    "fragment_list": (fragment_list, f"WITH {HITS} SELECT rid AS value, key, seqid, start, stop, strand FROM hits"),
    "hit_tables": (hit_tables, f"WITH {HITS} SELECT name, seqid, start, stop, strand, bitscore, key FROM hits WHERE seqid::INT % 2 = 0"),
    "clustal_files": (clustal_files, _ROWS),
    "stockholm_files": (stockholm_files, f"{_ROWS} UNION ALL SELECT DISTINCT aln_id, 'GC SS_cons', rpad('((', 16, ')') FROM al"),
    "maf_files": (maf_files, _ROWS),
    "pair_archive": (pair_archive, PAIR_ARCHIVE),
    "local_hits": (local_hits, f"WITH {HITS} SELECT (rid % 1000)::INT AS score, start AS istart, stop AS istop, count(*) AS n FROM hits WHERE strand = '+' GROUP BY 1, 2, 3"),
    "newick_files": (newick_files, "SELECT n_regionkey AS region, 'n' || n_nationkey AS name, n_nationkey / 4 + 0.5 AS length FROM nation UNION ALL SELECT DISTINCT n_regionkey, 'r' || n_regionkey, 2 FROM nation"),
    "subset_line": (subset_line, "SELECT (row_number() OVER (ORDER BY s_suppkey))::INT AS rank, s_suppkey AS id FROM supplier WHERE s_nationkey = 3 QUALIFY rank <= 5"),
    "class_info": (class_info, "WITH p AS (SELECT p_partkey AS id, (p_partkey % 9)::INT AS class, 'SEQ' || p_partkey || '#1#' || p_size || '#+' AS key, p_size FROM part), z AS (SELECT class, count(*) AS n, count(DISTINCT p_size) AS uniq FROM p GROUP BY 1) SELECT class, key, id, n::INT AS n, uniq::INT AS uniq, 'k' || class AS name FROM p JOIN z USING (class)"),
    "time_files": (time_files, "SELECT ts::DATE::VARCHAR AS day, floor(epoch(min(ts)))::BIGINT AS start, floor(epoch(max(ts)))::BIGINT AS stop, floor(epoch(max(ts)))::BIGINT - floor(epoch(min(ts)))::BIGINT AS seconds FROM events GROUP BY 1"),
    "shape_windows": (shape_windows, f"WITH {STRUCTURES}, x AS (SELECT graph_id, '.(' || repeat('(', k) || repeat('.', l) || repeat(')', k) || '..' || repeat('(', k) || repeat('.', l) || repeat(')', k) || ')..' AS s FROM st) SELECT graph_id::INT AS win_start, (graph_id + length(s))::INT AS win_end, translate(s, '(.)', 'GAC') AS seq, s AS struct, -3.25 AS energy, 0.5 AS prob, 0.75 AS shapeprob, '[]' AS shape FROM x"),
    "id_list": (id_list, "SELECT doc_id AS id FROM documents"),
    "word_list": (word_list, "SELECT row_number() OVER (ORDER BY n_nationkey, k) - 1 AS id, label FROM (SELECT n_nationkey, unnest(string_split(n_name, ' ')) AS label, unnest(range(len(string_split(n_name, ' ')))) AS k FROM nation)"),
    "reimported": (reimported, f"WITH {SEQUENCES} SELECT 'SEQ' || s.seq_idx AS id, s.id AS orig, coalesce(d.source, '') AS head, md5(seq) AS digest FROM sequences s JOIN documents d ON d.doc_id = s.id::BIGINT WHERE seq <> '' AND d.source IS NOT NULL"),
    "scan_segments": (scan_segments, f"WITH {_SPLIT} SELECT 'SEQ' || seq_idx || '#' || abs_start || '#' || abs_end AS segment, CASE WHEN length(seg) < 30 THEN 'SMALLER_THAN' WHEN regexp_matches(seg, 'N{{15,}}') THEN 'MASKED' ELSE 'USED' END AS status FROM segments"),
    "fragment_files": (fragment_files, f"WITH {HITS} SELECT rid AS value, (stop - start + 1)::INT AS size, key, (stop - start + 1)::INT AS n, start, stop FROM hits"),
    "graph_lines": (graph_lines, f"WITH {BACKBONE}, r AS ({_LINES}) SELECT graph_id, string_agg(l, chr(10) ORDER BY k, a, b) AS value FROM r GROUP BY 1"),
    "graph_dot": (graph_dot, f"WITH {BACKBONE}, r AS ({_DOT}), x AS (SELECT graph_id, string_agg(l, chr(10) ORDER BY k, a, b) AS l FROM r GROUP BY 1) SELECT graph_id, md5('digraph G {{' || chr(10) || l || chr(10) || '}}') AS digest FROM x"),
    "stored_tables": (stored_tables, f"WITH {HITS} SELECT rid, key, bitscore FROM hits"),
    "partition_table": (partition_table, f"WITH {HITS}, {_partition_sql('hits')}"),
}
