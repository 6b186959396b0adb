"""The domain tables, derived from the event stream by integer rules.

A view is an exposure; a purchase or a signup is a conversion. Every user is a
household with one device, an address of its own and one shared by three.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GENRES = ("sports", "news", "drama", "comedy")


@dataclass(frozen=True)
class Tables:
    exposures: DataFrame
    conversions: DataFrame
    graph: DataFrame
    truth: DataFrame


def _name(prefix: str, value: str, width: int) -> str:
    return f"concat('{prefix}-', lpad(cast({value} as string), {width}, '0'))"


def domain(spark: SparkSession, sf_dir: str) -> Tables:
    """Exposures and conversions with re-sent rows, the device graph, the true links."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time"), "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    late = F.expr("make_dt_interval(0, 0, 0, if(event_id % 10 = 0, (event_id % 400) * 60, event_id % 60))")
    events = events.withColumn("ingest_time", F.col("event_time") + late)
    views = events.where("event_type = 'view'")
    exposures = views.selectExpr(
        "event_id", f"{_name('e', 'event_id', 9)} exposure_id", "event_time", "ingest_time", f"{_name('camp', 'k % 5', 2)} campaign_id", f"{_name('h', 'user_id', 6)} household_id",
        "concat('10-', user_id) ip", "concat('app-', k % 3) app_id", f"element_at(array{GENRES}, k % 4 + 1) program_genre", "value spend",
    )
    bought = events.where("event_type in ('purchase', 'signup')")
    conversions = bought.selectExpr(
        "event_id", f"{_name('c', 'event_id', 9)} conversion_id", "event_time", "ingest_time", "if(event_id % 10 < 3, concat('u-', event_id), concat('d-', user_id)) device_id",
        "if(event_id % 4 = 0, concat('100-', user_id div 3), concat('10-', user_id)) ip", "if(event_type = 'purchase', 'purchase', 'site_visit') conversion_type",
        "if(event_type = 'purchase', value, 0.0D) revenue", "if(event_type = 'purchase', concat('o-', event_id), null) order_id",
    )
    graph = events.where("user_id % 50 <> 49").select("user_id").distinct().selectExpr(
        "user_id seen_at", f"{_name('h', 'user_id', 6)} household_id", "array(named_struct('device_id', concat('d-', user_id), 'kind', 'phone')) devices",
        "array(concat('10-', user_id), concat('100-', user_id div 3)) ips",
    )
    seen = views.selectExpr("user_id", "event_time view_time", f"{_name('e', 'event_id', 9)} exposure_id")
    caused = bought.where("event_id % 2 = 0").selectExpr("user_id", "event_time", f"{_name('c', 'event_id', 9)} conversion_id")
    # by spans of 20 days, so that a user with a long history joins only what can match
    span = "unix_seconds({}) div 1728000"
    caused = caused.selectExpr("*", f"explode(array({span.format('event_time')}, {span.format('event_time')} - 1)) span")
    truth = caused.join(seen.selectExpr("*", f"{span.format('view_time')} span"), ["user_id", "span"]).where("view_time between event_time - interval 20 days and event_time").groupBy("conversion_id").agg(F.min(F.struct("view_time", "exposure_id"))["exposure_id"].alias("truth_exposure_id"))

    def sent(df: DataFrame) -> DataFrame:
        return df.unionByName(df.where("event_id % 9 = 0")).drop("event_id")

    return Tables(sent(exposures), sent(conversions), graph, truth)
