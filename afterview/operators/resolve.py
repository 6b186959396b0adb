"""Conversions to households through the device graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CONVERSION


def device_index(graph: DataFrame) -> DataFrame:
    """(device_id, device_household): a device listed twice belongs to the household seen last."""
    rows = graph.select("seen_at", "household_id", F.explode("devices.device_id").alias("device_id"))
    return rows.groupBy("device_id").agg(F.max_by("household_id", "seen_at").alias("device_household"))


def ip_index(graph: DataFrame) -> DataFrame:
    """(ip, owners): the households behind an address, sorted."""
    return graph.select("household_id", F.explode("ips").alias("ip")).groupBy("ip").agg(F.array_sort(F.collect_set("household_id")).alias("owners"))


def resolve(conversions: DataFrame, graph: DataFrame) -> DataFrame:
    """One row per conversion and candidate household.

    A device hit beats the address; an address of several households fans out;
    an address that nobody owns drops the conversion. Both lookups are equi
    joins whose build side the optimizer sizes; no side is forced.
    """
    known = conversions.join(device_index(graph), "device_id", "left").join(ip_index(graph), "ip", "left")
    hit = F.col("device_household").isNotNull()
    owners = F.when(hit, F.array("device_household")).otherwise(F.col("owners"))
    rows = known.withColumn("_owners", owners).where("_owners is not null")
    return rows.select(
        *CONVERSION.names, F.explode("_owners").alias("household_id"), F.when(hit, "device").otherwise("ip").alias("resolution"),
        (F.size("_owners") > 1).alias("ambiguous"), F.size("_owners").alias("candidate_count"),
    )


def one_per_conversion(resolved: DataFrame) -> DataFrame:
    """The fan-out collapsed to its least household, with the candidates of ambiguous rows."""
    rest = [c for c in resolved.columns if c not in ("conversion_id", "household_id")]
    held = resolved.groupBy("conversion_id").agg(
        F.min("household_id").alias("household_id"), F.min_by(F.struct(*rest), "household_id").alias("_r"), F.array_sort(F.collect_set("household_id")).alias("_all")
    )
    return held.select("conversion_id", "household_id", "_r.*", F.when(F.col("_r.candidate_count") > 1, F.col("_all")).otherwise(F.array().cast("array<string>")).alias("candidate_households"))
