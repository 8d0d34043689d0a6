"""The registered queries of the numbered operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import bpe, chatrepair, decontam, digest, langid, licenses, mixing, neardup, reputation, suffixdedup, toxicity, warc, whitening
from tableferry.plans.queries import table

Query = Callable[[SparkSession, str], DataFrame]


def _outcomes(labels: DataFrame) -> DataFrame:
    """Labels as page outcomes: good is of quality and not toxic; pages carry the labels of their number."""
    known = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    good = F.when(known, ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int"))
    return labels.select(F.col("doc_id").alias("page_id"), good.alias("good"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.fingerprints(spark, table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.report(spark, table(spark, sf_dir, "documents"))


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return reputation.judge_urls(pages, _outcomes(table(spark, sf_dir, "labels")))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(spark, table(spark, sf_dir, "documents"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, table(spark, sf_dir, "documents"), k=2, percent=80)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chatrepair.repair(spark, table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"))


def registry() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op") and name[2].isdigit()}


ORACLES = {
    "op5_url_reputation": reputation.ORACLE,
    "op6_source_mix": mixing.ORACLE,
    "op7_warc_revisits": warc.ORACLE,
}
