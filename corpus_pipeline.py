"""A training corpus from raw documents, stage by stage; each stage is written and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from stillroom.llm.common import ship, stored
from stillroom.llm.decontaminate import keep_uncontaminated
from stillroom.llm.language import keep_identified
from stillroom.llm.packing import pack
from stillroom.llm.secrets import find_secrets, redact
from stillroom.llm.simhash import keep_representatives
from stillroom.plans import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def shipped(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@shipped
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without letters and doubtful ones go."""
    return keep_identified(docs)


@shipped
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_representatives(docs)


@shipped
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


@shipped
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return redact(docs, stored(find_secrets(docs), "findings"))


@shipped
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Trained models, fingerprints and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
