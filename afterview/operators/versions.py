"""Rows by key: latest version, first arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order. Filter after this, never before."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(at)).where("_n = 1").drop("_n")


def collapsed(df: DataFrame) -> DataFrame:
    """Says of a table that it holds one row a key already (a serving table does), so that
    current() and current_exposures() hand it back as it is."""
    df._one_a_key = True
    return df


def _is_collapsed(df: DataFrame) -> bool:
    return df.__dict__.get("_one_a_key", False)


def current(attributed: DataFrame) -> DataFrame:
    """The current row of each conversion: the latest version, and of equal ones the reconciled."""
    if _is_collapsed(attributed):
        return attributed
    return latest_by(attributed, ["conversion_id"], [F.col("processed_at").desc(), F.col("path").desc()])


def current_exposures(exposures: DataFrame) -> DataFrame:
    """Re-sent exposures are equal to the first."""
    if _is_collapsed(exposures):
        return exposures
    return exposures.dropDuplicates(["exposure_id"])


def first_arrivals(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first arrival of each key; others are re-sent."""
    return latest_by(df, keys, [F.col("ingest_time"), F.col("event_time")])


def suppressed(df: DataFrame, keys: list[str]) -> Column:
    """How many rows first_arrivals drops, as an aggregate."""
    return F.count(F.lit(1)) - F.count_distinct(*keys)


def collapse_versions(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Like latest_by with one version, as a hash aggregate instead of a sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_r")).select(*keys, "_r.*")
