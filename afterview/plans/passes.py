"""The passes: hot, reconcile, serve."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attribute import ALLOWED_LATENESS, HOT_WINDOW, LONG_WINDOW, engine
from ..operators.reconcile import recover
from ..operators.resolve import one_per_conversion, resolve
from ..operators.rollup import dirty, hourly, recorded, refreshed_rollup
from ..operators.versions import first_arrivals
from ..sources.lake import LakeTable
from ..sources.tables import Tables
from .reports import snapshot


@dataclass(frozen=True)
class Hot:
    exposures: DataFrame  # first arrivals
    resolved: DataFrame  # with fan-out, first arrivals
    one_row: DataFrame
    attributed: DataFrame


def hot_pass(tables: Tables, window: int = HOT_WINDOW, lateness: int = ALLOWED_LATENESS, dedup: bool = True) -> Hot:
    """Resolve, drop re-sent rows, attribute as the stream engine does.

    What later steps read several times is kept in the cache (it spills to disk,
    and lost blocks are computed again).
    """
    resolved = resolve(tables.conversions, tables.graph)
    exposures = tables.exposures
    if dedup:
        exposures = first_arrivals(exposures, ["exposure_id"])
        resolved = first_arrivals(resolved, ["conversion_id", "household_id"])
    exposures, resolved = exposures.cache(), resolved.cache()
    one_row = one_per_conversion(resolved).cache()
    return Hot(exposures, resolved, one_row, engine(exposures, one_row, window, lateness).cache())


def full_pass(tables: Tables, window: int = HOT_WINDOW, long_window: int = LONG_WINDOW) -> tuple[Hot, DataFrame]:
    """The hot pass and all versions after reconciliation: hot rows and corrections."""
    hot = hot_pass(tables, window)
    return hot, hot.attributed.unionByName(recover(hot.attributed, hot.exposures, long_window).cache())


def snapshots(hot: Hot, versions: DataFrame) -> DataFrame:
    """The report as it was after the hot pass, and as it is after reconciliation."""
    before = snapshot(hot.exposures, versions, "all", 0, hot_only=True)
    return before.unionByName(snapshot(hot.exposures, versions, "all", 1000))


def reconcile_lake(exposures: LakeTable, attributed: LakeTable, days: list | None = None) -> list:
    """Reconciles the lake in place: the open rows of `days` (all, if none are
    named), with exposures read from the buckets and days that they can match.
    Returns the days that got corrections; a second call returns none."""
    versions = attributed.read().drop("event_day", "household_bucket").distinct()
    asked = versions if days is None else attributed.for_days(days)
    edges = asked.agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    if edges["a"] is None:
        return []
    homes = asked.where("not attributed").select(F.explode(F.when(F.col("candidate_count") > 1, F.col("candidate_households")).otherwise(F.array("household_id"))).alias("household_id"))
    shown = exposures.for_households(homes, edges["a"] - _days(LONG_WINDOW), edges["b"] + _days(86400), keep_bucket=True)
    at = exposures.read().select("ingest_time").unionByName(versions.select("ingest_time")).agg((F.max("ingest_time") + F.expr("interval 1 second")).alias("t")).first()["t"]
    return attributed.append(recover(asked, shown, at=F.lit(at)))


def _days(seconds: int):
    import datetime

    return datetime.timedelta(seconds=seconds)


def incremental(hot: Hot, versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dirty keys after reconciliation, rollup refreshed at them from the hot one)."""
    stamped = recorded(hot.exposures, hot.attributed)
    keys = dirty(recorded(hot.exposures, versions), stamped)
    return keys, refreshed_rollup(hourly(hot.exposures, hot.attributed), hot.exposures, versions, keys)
