"""Reconciliation of what the hot path left open, over the long window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import household_bucket
from .attribute import LONG_WINDOW, decided, touches
from .versions import current


def reconciled_at(exposures: DataFrame, attributed: DataFrame) -> DataFrame:
    """One row: a second after the last arrival; no clock is read."""
    both = exposures.select("ingest_time").unionByName(attributed.select("ingest_time"))
    return both.agg((F.max("ingest_time") + F.expr("interval 1 second")).alias("reconciled_at"))


def open_rows(attributed: DataFrame) -> DataFrame:
    """Current rows that are unattributed and never were corrected."""
    return current(attributed).where("not attributed and path = 'hot'")


def expanded(rows: DataFrame) -> DataFrame:
    """One row per candidate household."""
    homes = F.when(F.col("candidate_count") > 1, F.col("candidate_households")).otherwise(F.array("household_id"))
    return rows.withColumn("household_id", F.explode(homes)).drop("exposure_id", "assists", "attributed", "path", "processed_at", "reason")


def recover(attributed: DataFrame, exposures: DataFrame, window: int = LONG_WINDOW, at: Column | None = None) -> DataFrame:
    """Corrections: open rows that match now. Of several households the one
    touched last wins, ties by exposure and household. Rows that still miss are
    not returned, so a second pass finds nothing new.

    Exposures may come with a `household_bucket` column (the lake's layout):
    then it is a join key too, so that rows meet bucket by bucket.
    """
    asked = expanded(open_rows(attributed))
    if "household_bucket" in exposures.columns:
        asked = asked.withColumn("household_bucket", household_bucket(F.col("household_id")))
    won = touches(asked, exposures, window).where("exposure_id is not null")
    best = won.groupBy("conversion_id").agg(F.max_by(F.struct(*(c for c in won.columns if c != "conversion_id")), F.struct("touch_time", "exposure_id", "household_id")).alias("_r")).select("conversion_id", "_r.*")
    stamp = F.lit(reconciled_at(exposures, attributed).first()["reconciled_at"]) if at is None else at  # one row
    return decided(best, "reconciled", stamp)
