"""The operators' queries over whole tables, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.llm import (
    blob_ledger,
    brown_lm,
    drr_packing,
    flow_mixing,
    histogram_topk,
    kneser_ney_langid,
    license_windows,
    merkle_fixity,
    ordinal_quality,
    probminhash_dedup,
    rule_lists,
    source_divergence,
    swar_fim,
)
from custodia.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_fixity.page_audit(table(spark, sf_dir, "pages"))


def op2_rule_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_lists.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.scored(table(spark, sf_dir, "documents"))


def op4_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_mixing.mixed(table(spark, sf_dir, "documents"))


def op5_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_windows.scan(table(spark, sf_dir, "documents"))


def op6_drr_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drr_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ordinal_quality.accepted(docs, table(spark, sf_dir, "labels")).drop("text")


def op10_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.digest(table(spark, sf_dir, "documents"))


def op11_swar_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swar_fim.digest(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op13_kneser_ney_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney_langid.identified(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_merkle_fixity, op2_rule_lists, op3_brown_lm, op4_flow_mixing, op5_license_windows, op6_drr_packing,
        op7_histogram_topk, op8_probminhash_dedup, op9_ordinal_quality, op10_blob_ledger,
        op11_swar_fim, op12_source_divergence, op13_kneser_ney_langid,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_merkle_fixity": merkle_fixity.page_audit_sql(),
        "op5_license_windows": license_windows.scan_sql(),
        "op7_histogram_topk": histogram_topk.search_sql(),
        "op11_swar_fim": swar_fim.digest_sql(),
        "op12_source_divergence": source_divergence.audit_sql(),
    }
