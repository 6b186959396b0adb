"""The hourly campaign rollup: full, by dirty keys, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import exact_sum, hour
from .versions import current, current_exposures, latest_by

KEYS = ["campaign_id", "hour"]


def credits(attributed: DataFrame, exposures: DataFrame, hot_only: bool = False) -> DataFrame:
    """Credited conversions with their exposure's campaign, time and genre."""
    rows = current(attributed).where("attributed")
    if hot_only:
        rows = rows.where("path = 'hot'")
    shown = current_exposures(exposures).select("exposure_id", "campaign_id", "program_genre", F.col("event_time").alias("exposure_time"))
    return rows.join(shown, "exposure_id")


def _facts(exposures: DataFrame, credited: DataFrame) -> DataFrame:
    """Exposures and credits as one list; a credit counts in its exposure's hour."""
    is_type = lambda t: F.when(F.col("conversion_type") == t, 1).otherwise(0)
    seen = exposures.select("campaign_id", hour(F.col("event_time")).alias("hour"), "spend", F.lit(1).alias("e"), F.lit(0).alias("c"), F.lit(0).alias("p"), F.lit(0).alias("s"), F.lit(0.0).alias("revenue"), F.col("ingest_time").alias("stamp"))
    won = credited.select("campaign_id", hour(F.col("exposure_time")).alias("hour"), F.lit(0.0).alias("spend"), F.lit(0).alias("e"), F.lit(1).alias("c"), is_type("purchase").alias("p"), is_type("site_visit").alias("s"), "revenue", F.col("processed_at").alias("stamp"))
    return seen.unionByName(won)


def hourly(exposures: DataFrame, attributed: DataFrame, keys: DataFrame | None = None, hot_only: bool = False) -> DataFrame:
    """campaign_hourly rows; with `keys` only those (both sides are cut before the aggregate)."""
    shown = current_exposures(exposures)
    if keys is not None:
        wanted = keys.select(*KEYS)
        shown = shown.withColumn("hour", hour(F.col("event_time"))).join(wanted, KEYS, "left_semi").drop("hour")
    facts = _facts(shown, credits(attributed, shown, hot_only))
    return facts.groupBy(*KEYS).agg(
        exact_sum(F.col("spend")).alias("spend"), F.sum("e").alias("exposures"), F.sum("c").alias("attributed_conversions"), F.sum("p").alias("purchases"),
        F.sum("s").alias("site_visits"), exact_sum(F.col("revenue")).alias("revenue"), F.max("stamp").alias("reported_at"),
    )


def recorded(exposures: DataFrame, attributed: DataFrame, days: list | None = None) -> DataFrame:
    """Dirty keys with their version: the newest stamp of any row that lands in
    the key. `days` limits it to what loading those days touches, from both
    sides, so the order of loads doesn't matter."""
    shown, won = current_exposures(exposures), credits(attributed, exposures)
    key = lambda t: hour(F.col(t)).alias("hour")
    on = lambda t: F.lit(True) if days is None else F.to_date(t).isin(days) if days else F.lit(False)
    rows = shown.where(on("event_time")).select("campaign_id", key("event_time"), F.col("ingest_time").alias("version"))
    rows = rows.unionByName(won.where(on("event_time") | on("exposure_time")).select("campaign_id", key("exposure_time"), F.col("processed_at").alias("version")))
    return rows.groupBy(*KEYS).agg(F.max("version").alias("version"))


def dirty(noted: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Keys whose noted version isn't the one they were refreshed at; each key for itself."""
    was = refreshed.select(*KEYS, F.col("version").alias("_was"))
    return noted.join(was, KEYS, "left").where(F.col("_was").isNull() | (F.col("version") != F.col("_was"))).drop("_was")


def refreshed_rollup(rollup: DataFrame, exposures: DataFrame, attributed: DataFrame, keys: DataFrame) -> DataFrame:
    """The rollup with the keys' rows computed anew. Stamp `keys` after it is written, not before."""
    new = hourly(exposures, attributed, keys)
    return latest_by(rollup.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1))), KEYS, [F.col("_new").desc()]).drop("_new")


def changed_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys whose numbers differ between two rollups, to six decimals."""
    numbers = ("spend", "exposures", "attributed_conversions", "purchases", "site_visits", "revenue")
    rounded = lambda d, name: d.select(*KEYS, F.struct(*(F.round(c, 6).alias(c) for c in numbers)).alias(name))
    both = rounded(before, "_a").join(rounded(after, "_b"), KEYS, "full")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*KEYS)
