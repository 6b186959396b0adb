"""The corpus pipeline: each stage works on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from afterview.llm.base import stored
from afterview.llm.contamination import decontaminate
from afterview.llm.hostrules import keep_good
from afterview.llm.nearduplicates import one_of_each
from afterview.llm.packing import pack
from afterview.llm.secrets import redact
from afterview.session import ship


# Every stage takes tables with further columns of any name and hands them on; an
# empty table stays empty; texts of any length are judged whole.


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule go, and those of failing hosts (keep_good). A null
    or empty text has no words and goes; repeated rows go or stay together."""
    ship(spark)
    return keep_good(docs)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the least id
    (one_of_each). Texts without words (null, empty) all stay; of repeated rows one."""
    ship(spark)
    return one_of_each(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go (decontaminate). A null or empty text is not
    contaminated; repeated rows go or stay together."""
    ship(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays (redact). A null or empty
    text stays as it is; repeated rows get equal texts."""
    ship(spark)
    return redact(docs)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of 1024 tokens (pack). A null or empty text is
    one end token; repeated rows are packed each for itself; only id and text are read."""
    ship(spark)
    return pack(docs)


STAGES = [
    ("quality", _quality),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontamination),
    ("secrets", _secrets),
    ("packing", _packing),
]

#: Signatures, a trained forest and token ids have no SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
