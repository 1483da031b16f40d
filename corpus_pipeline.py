"""From raw documents to a training mix, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again, so a
lost executor repeats one stage at most. All stages but the last return the
columns of ``documents``, further ones whatever their names; the mix adds shard and place.

Defined results, in every stage: null and empty texts, and nulls in any other column,
are rows like others; texts of any length count whole; no documents give no rows. What that
means for a stage's verdict is said with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataline.llm import decontaminate, linededup, mixing, quality, simhash
from strataline.llm.common import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier predicts to be good.

    A null or empty text has the score of a text that neither dictionary shortens; repeated
    rows score alike; without labels of both classes the share of good ones decides for all.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those with nothing left go.

    Texts without a line that has a word stay. Of equal rows of at least 50 words one stays;
    shorter copies are left to the next stage. Ties of id go by a hash of the text.
    """
    return linededup.remove_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Null and empty texts are one group. Ids that are null come last; equal ids go by a hash of
    the text, and of equal rows one stays.
    """
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    Without words a text is clean; repeated rows get equal verdicts; an empty benchmark leaves
    every document.
    """
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time a document is taken, by shard.

    A null source is a source of its own. Empty texts are taken as often as their block. Equal
    rows are taken together. Where documents have columns of these names, the added ones end
    in an underscore.
    """
    return mixing.mixed(docs, mixing.plan_mix(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mix", source_mix),
]

# Compression sizes and XXH64 fingerprints have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; only the last one's result is not written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
