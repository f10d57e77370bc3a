"""The jobs as queries over the driver's tables: each runs twice into one new folder, and its output is read back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from jobs import fragment_library, hit_partition
from strandloom.plans.relational import WINDOWS
from strandloom.plans.tables import LETTERS, RESIDUES, overlaps_sql
from strandloom.session import shared_dir

#: Letters of texts as residues, some of them masked.
SEQUENCE = f"regexp_replace(translate(regexp_replace(lower(text), '[^a-z]', 'N'), '{LETTERS}', '{RESIDUES}'), 'AGC', '{'N' * 17}')"
#: Line items as hits: a model for each year and a twentieth of the parts, on the supplier's axis of days.
DAY = "datediff(cast(l_shipdate as date), date'1992-01-01') + 1"
COLUMNS = {
    "rid": "l_orderkey * 8 + l_linenumber", "round": "year(l_shipdate) - 1991", "name": "concat(year(l_shipdate) - 1991, '.', l_partkey % 20)", "seqid": "l_suppkey",
    "start": DAY, "stop": f"{DAY} + cast(l_quantity as int)", "strand": "case when l_returnflag = 'N' then '+' else '-' end", "bitscore": "l_extendedprice",
}


def _new(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def job1_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = json.loads(fragment_library.CONFIG.read_text()) | {"id": "doc_id + 1", "sequence": SEQUENCE}
    out = _new(spark, "job1")
    for _ in range(2):
        got = fragment_library.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", out, config)
    return got.select("seq_idx", "key", "start", "stop", "digest", "first_key", "grey", "source")


def job2_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = json.loads(hit_partition.CONFIG.read_text()) | {"columns": COLUMNS}
    out = _new(spark, "job2")
    for _ in range(2):
        got = hit_partition.run(spark, f"{sf_dir}/lineitem.parquet", out, config)
    return got.select("rid", "round", "name", "key", "bitscore", "best", "soft", "hard")


FRAGMENTS = f"""WITH w AS ({WINDOWS}), f AS (SELECT split_part(substr(key, 4), '#', 1)::BIGINT AS seq_idx, key, start::BIGINT AS start, stop::BIGINT AS stop, digest FROM w),
first AS (SELECT digest, key AS first_key FROM f QUALIFY row_number() OVER (PARTITION BY digest ORDER BY seq_idx, start, key) = 1),
grey AS (SELECT DISTINCT doc_id + 1 AS seq_idx, true AS grey FROM labels WHERE toxic = 1)
SELECT f.seq_idx, key, start, stop, digest, first_key, coalesce(grey, false) AS grey, source FROM f JOIN first USING (digest) JOIN documents ON doc_id + 1 = f.seq_idx LEFT JOIN grey ON grey.seq_idx = f.seq_idx"""

PARTITION = f"""WITH lines AS (SELECT l_orderkey * 8 + l_linenumber AS rid, (year(l_shipdate) - 1991)::INT AS round, (year(l_shipdate) - 1991) || '.' || (l_partkey % 20) AS name, l_suppkey::VARCHAR AS seqid,
  (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + 1)::BIGINT AS start, (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + 1 + l_quantity::INT)::BIGINT AS stop,
  CASE WHEN l_returnflag = 'N' THEN '+' ELSE '-' END AS strand, l_extendedprice AS bitscore FROM lineitem),
hits AS (SELECT *, seqid || '#' || start || '#' || stop || '#' || strand AS key FROM lines QUALIFY row_number() OVER (PARTITION BY rid ORDER BY round, name, seqid, start, stop, strand, bitscore) = 1),
o AS ({overlaps_sql("hits", "hits", 51)}),
beaten AS (SELECT DISTINCT a.rid AS rid FROM o WHERE b.bitscore > a.bitscore OR (b.bitscore = a.bitscore AND b.name < a.name)),
marked AS (SELECT rid, round, name, key, bitscore, rid NOT IN (SELECT rid FROM beaten) AS best FROM hits),
sizes AS (SELECT name, count(*) >= 5 AS soft, count(*) FILTER (best) >= 5 AS hard FROM marked GROUP BY name)
SELECT rid, round, name, key, bitscore, best, soft, best AND hard AS hard FROM marked JOIN sizes USING (name)"""

QUERIES = {"job1_fragments": (job1_fragments, FRAGMENTS), "job2_partition": (job2_partition, PARTITION)}
