"""From raw documents to a training mix: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableferry.llm import decontam, langid, mixing, neardup, suffixdedup
from tableferry.llm.components import stored

#: Bytes of the shortest passage that may not stand twice: 50 words of four letters and a space.
PASSAGE = 250


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the recurrent network recognises; none of an empty table."""
    return langid.recognised(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; wordless ones and empty tables stay as they are."""
    return neardup.without_duplicates(spark, docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand at more than one place; short and null texts stay as they are."""
    return suffixdedup.without_repeats(spark, docs, length=PASSAGE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; all of them if either table is empty."""
    return decontam.clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix by source takes of each document; no rows of an empty table."""
    return mixing.mix_report(spark, docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontamination", decontamination),
    ("source_mix", mix),
]

#: A recurrent network and a suffix order have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
