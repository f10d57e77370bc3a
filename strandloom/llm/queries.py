"""The ten queries over whole tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import alignment, decontaminate, fingerprint, language, lm, mixing, quality, reputation, setjoin, sharding, simhash, tokens
from strandloom.llm.oracles import ORACLES
from strandloom.llm.shared import id_crc, read


def _held(mod: int, left: int) -> Column:
    """Whether crc32 of doc_id leaves `left`; a row without doc_id isn't held out."""
    return F.coalesce(id_crc(F.col("doc_id"), mod) == left, F.lit(False))


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(read(spark, sf_dir, "documents"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=16)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.learn(docs, read(spark, sf_dir, "labels"), ~_held(3, 1))
    scored = quality.score(docs, model)
    return scored.select("doc_id", _held(3, 1).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op4_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2).select("doc_id", "size", "source_size", "target", "taken")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.learn(docs, ~_held(5, 0))
    return language.identify(docs, model).select("doc_id", _held(5, 0).alias("held_out"), "lang_pred", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), span=10)


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.read(tokens.write(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0))


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"), _held(7, 2))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.report(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.near_duplicates(read(spark, sf_dir, "documents"), k=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_fingerprint, op2_shards, op3_quality, op4_reputation, op5_simhash, op6_mixing, op7_language, op8_decontamination, op9_tokens, op10_suffix_tree, op11_alignment, op12_setjoin)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
