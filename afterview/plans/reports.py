"""Reports over exposures and attributed conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import exact_sum, lag_seconds, ratio
from ..operators.rollup import credits
from ..operators.versions import current, current_exposures

METRICS = ["campaign", "spend", "exposures", "conversions", "purchases", "revenue", "roas", "cpa", "cvr", "site_visit_rate"]


def _ratios(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.withColumns({"roas": ratio(c("revenue"), c("spend")), "cpa": ratio(c("spend"), c("purchases")), "cvr": ratio(c("conversions"), c("exposures")), "site_visit_rate": ratio(c("site_visits"), c("exposures"))})


def report(exposures: DataFrame, attributed: DataFrame, hot_only: bool = False) -> DataFrame:
    """Per campaign: spend, exposures, credited conversions, and ratios (null on
    a zero denominator). Campaigns without conversions stay."""
    spent = current_exposures(exposures).groupBy("campaign_id").agg(exact_sum(F.col("spend")).alias("spend"), F.count(F.lit(1)).alias("exposures"))
    won = credits(attributed, exposures, hot_only).groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("conversions"), F.count_if(F.col("conversion_type") == "purchase").alias("purchases"),
        F.count_if(F.col("conversion_type") == "site_visit").alias("site_visits"), exact_sum(F.col("revenue")).alias("revenue"), F.max("processed_at").alias("credited_at"),
    )
    rows = spent.join(won, "campaign_id", "left").fillna(0, ["conversions", "purchases", "site_visits", "revenue"])
    return _ratios(rows.withColumnRenamed("campaign_id", "campaign")).orderBy("campaign")


def report_from_rollup(hourly: DataFrame) -> DataFrame:
    """The same report from the hourly rollup: components first, then ratios."""
    total = lambda c: F.sum(c).alias(c)
    rows = hourly.groupBy(F.col("campaign_id").alias("campaign")).agg(exact_sum(F.col("spend")).alias("spend"), total("exposures"), F.sum("attributed_conversions").alias("conversions"), total("purchases"), total("site_visits"), exact_sum(F.col("revenue")).alias("revenue"))
    return _ratios(rows).orderBy("campaign")


def snapshot(exposures: DataFrame, attributed: DataFrame, period: str, offset_ms: int, hot_only: bool = False) -> DataFrame:
    """Report rows as they are at this state: `reported_at` follows from the last
    arrival, `snapshot_version` from the credited rows, or from all current
    ones where nothing is credited."""
    rows = current(attributed)
    stamps = current_exposures(exposures).select(F.lit("at").alias("what"), F.col("ingest_time").alias("t")).unionByName(rows.select(F.lit("at").alias("what"), F.col("ingest_time").alias("t")))
    stamps = stamps.unionByName(rows.select(F.lit("every").alias("what"), F.col("processed_at").alias("t"))).unionByName(credits(attributed, exposures, hot_only).select(F.lit("credited").alias("what"), F.col("processed_at").alias("t")))
    found = {r["what"]: r["t"] for r in stamps.groupBy("what").agg(F.max("t").alias("t")).collect()}  # three rows
    at, version = found.get("at"), found.get("credited") or found.get("every")
    reported = F.timestamp_millis(F.unix_millis(F.lit(at)) + offset_ms) if at is not None else F.lit(None).cast("timestamp")
    made = report(exposures, attributed, hot_only)
    return made.select(reported.alias("reported_at"), F.col("campaign").alias("campaign_id"), F.lit(period).alias("period"), "spend", "revenue", "conversions", "purchases", "exposures", "roas", "cpa", "cvr", "site_visit_rate", F.lit(version).cast("timestamp").alias("snapshot_version"))


def restatement(snapshots: DataFrame, campaign: str | None = None) -> DataFrame:
    """First against last snapshot of each campaign and period. A value that is
    null in a snapshot is passed over, not taken."""
    rows = snapshots if campaign is None else snapshots.where(F.col("campaign_id") == campaign)

    def ends(c: str) -> tuple[Column, Column]:
        known = F.when(F.col(c).isNotNull(), F.struct("reported_at", c))
        return F.min(known)[c], F.max(known)[c]

    (r0, r1), (c0, c1), (v0, v1) = ends("roas"), ends("conversions"), ends("revenue")
    return rows.groupBy("campaign_id", "period").agg(
        r0.alias("roas_as_reported"), r1.alias("roas_now"), F.round(r1 - r0, 4).alias("roas_delta"), c0.alias("conversions_as_reported"), c1.alias("conversions_now"), F.round(v1 - v0, 2).alias("revenue_delta")
    ).drop("period").orderBy("campaign_id")


def largest_restatement(snapshots: DataFrame) -> DataFrame:
    return restatement(snapshots).agg(F.coalesce(F.max(F.abs("roas_delta")), F.lit(0.0)).alias("max_abs_roas_delta"))


def match_rate_by_day(attributed: DataFrame) -> DataFrame:
    return current(attributed).groupBy(F.to_date("event_time").alias("day")).agg(F.count(F.lit(1)).alias("processed"), F.count_if("attributed").alias("attributed_count")).orderBy("day")


def match_rate(attributed: DataFrame) -> DataFrame:
    rows = current(attributed).agg(F.count(F.lit(1)).alias("processed"), F.count_if("attributed").alias("attributed_count"))
    return rows.withColumn("match_rate", ratio(F.col("attributed_count"), F.col("processed")))


def window_edge_lags(attributed: DataFrame, exposures: DataFrame) -> DataFrame:
    rows = credits(attributed, exposures, hot_only=True).where("event_time >= exposure_time")
    return rows.select("conversion_id", lag_seconds(F.col("exposure_time"), F.col("event_time")).alias("lag_seconds"))


def window_edge_distribution(attributed: DataFrame, exposures: DataFrame) -> DataFrame:
    """Days between exposure and conversion; not clamped."""
    return window_edge_lags(attributed, exposures).groupBy(F.expr("lag_seconds div 86400").alias("day_bucket")).agg(F.count(F.lit(1)).alias("n")).orderBy("day_bucket")


def window_edge_histogram(attributed: DataFrame, exposures: DataFrame, days: int = 7) -> DataFrame:
    """The same in `days` fixed bins, empty ones too; the last takes what lies on the edge."""
    rows = window_edge_lags(attributed, exposures)
    bins = rows.sparkSession.range(days).select(F.col("id").alias("bin"))
    found = rows.groupBy(F.expr(f"least(greatest(lag_seconds div 86400, 0), {days - 1})").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return bins.join(found, "bin", "left").fillna(0, ["n"]).orderBy("bin")


def ip_clusters(attributed: DataFrame) -> DataFrame:
    rows = current(attributed).where("attributed")
    return rows.agg(F.count(F.lit(1)).alias("attributed_count"), F.count_if(F.col("resolution") == "ip").alias("ip_resolved"), F.count_if("ambiguous").alias("ambiguous_count"), F.max("candidate_count").alias("max_candidate_count"))


def ip_cluster_top(attributed: DataFrame, n: int = 10) -> DataFrame:
    rows = current(attributed).where("attributed and resolution = 'ip'").groupBy("ip").agg(F.count(F.lit(1)).alias("attributed_conversions"), F.max("candidate_count").alias("max_candidate_count"))
    return rows.orderBy(F.desc("attributed_conversions"), "ip").limit(n)


def genre_exposures(exposures: DataFrame) -> DataFrame:
    return current_exposures(exposures).groupBy(F.col("program_genre").alias("genre")).agg(F.count(F.lit(1)).alias("exposures")).orderBy("genre")


def genre_conversions(attributed: DataFrame, exposures: DataFrame) -> DataFrame:
    return credits(attributed, exposures).groupBy(F.col("program_genre").alias("genre")).agg(F.count(F.lit(1)).alias("attributed_conversions")).orderBy("genre")


def genre_reach(attributed: DataFrame, exposures: DataFrame) -> DataFrame:
    rows = genre_exposures(exposures).join(genre_conversions(attributed, exposures), "genre", "left").fillna(0, ["attributed_conversions"])
    return rows.withColumn("conversions_per_exposure", ratio(F.col("attributed_conversions"), F.col("exposures"))).orderBy("genre")


def alerts(attributed: DataFrame, snapshots: DataFrame, exposures: DataFrame, backlog: int = 0, parts: int = 0) -> DataFrame:
    """The alert rules, one row each: what is measured and whether it fires."""
    lag = current(attributed).agg(F.coalesce(F.max(F.unix_seconds("ingest_time") - F.unix_seconds("event_time")), F.lit(0)).cast("double").alias("value")).select(F.lit("lag_seconds").alias("alert"), "value", (F.col("value") > 14400).alias("firing"))
    rate = match_rate(attributed).select(F.lit("match_rate").alias("alert"), F.coalesce("match_rate", F.lit(0.0)).alias("value")).withColumn("firing", ~F.col("value").between(0.80, 0.98))
    delta = largest_restatement(snapshots).select(F.lit("restatement").alias("alert"), F.col("max_abs_roas_delta").alias("value")).withColumn("firing", F.col("value") > 1.0)
    fixed = lag.sparkSession.createDataFrame([("backlog", float(backlog), backlog > 100), ("parts", float(parts), parts > 150)], "alert string, value double, firing boolean")
    return lag.unionByName(rate).unionByName(delta).unionByName(fixed)


def context(exposures: DataFrame, attributed: DataFrame, snapshots: DataFrame) -> DataFrame:
    """All of the above as one row of nested values, for whoever explains a change."""

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name)).withColumn("_k", F.lit(0))

    parts = [
        listed(match_rate_by_day(attributed), "match_rate"), listed(window_edge_histogram(attributed, exposures), "window_edge"), listed(ip_clusters(attributed), "ip_clusters"),
        listed(ip_cluster_top(attributed), "ip_top"), listed(genre_reach(attributed, exposures), "genres"), listed(report(exposures, attributed).select(*METRICS), "campaigns"), listed(restatement(snapshots), "restatements"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "_k")
    return out.drop("_k")
