"""The registered queries over a small folder: columns, types, rows and the rules that the contracts fix."""

import zlib

import pytest

from strandloom.llm import queries
from tests.llm.test_operators import junk, text

COLUMNS = {
    "op1_fingerprint": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op2_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op3_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_reputation": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op5_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op7_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op9_tokens": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op10_suffix_tree": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op11_alignment": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
    "op12_setjoin": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
}
HELD = {"op3_quality": (3, 1), "op7_language": (5, 0), "op10_suffix_tree": (7, 2)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, text(i, 40) + ".\n" + text(i + 500, 30) + "." if i % 3 else junk(i), "en" if i % 2 else "fr", f"s{i % 4}") for i in range(90)]
    rows += [(None, text(3, 20), None, None), (None, None, "en", "s1"), (500, "", "en", "s1"), (500, None, "fr", None)]
    docs = spark.createDataFrame([(a, b, c, d, len(b or ""), "junk") for a, b, c, d in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    docs.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, text(1, 15)), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(i, f"http://h{i % 5}.net/fr/{i}", "") for i in range(40)] + [(None, None, None)], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    return root, rows


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, folder, name):
    root, rows = folder
    if name in ("op9_tokens", "op11_alignment"):
        pytest.importorskip("public_tokenizers")
    out = queries.queries()[name](spark, root)
    assert dict(out.dtypes) == COLUMNS[name]
    got = out.collect()
    ids = [r[0] for r in rows] if name != "op4_reputation" else [*range(40), None]
    assert sorted((r[0] is None, r[0] or 0) for r in got) == sorted((i is None, i or 0) for i in ids)
    if name in HELD:
        mod, left = HELD[name]
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % mod == left) for r in got)
    if name == "op3_quality":
        assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
        assert all(r.predicted == (r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 90)
    if name == "op7_language":
        assert {r.lang_pred for r in got} <= {"en", "fr", "und"} and all(r.lang_pred == "und" for r in got if r.doc_id == 500)
