"""Serving tables loaded from the lake: current rows, rollup, bookkeeping, snapshots, marker."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rollup import KEYS, dirty, hourly, recorded
from ..operators.versions import collapse_versions, collapsed, current_exposures, latest_by
from ..schemas import ATTRIBUTED, EXPOSURE, columns
from ..session import shared_dir
from ..sources.lake import EmptyLake, LakeTable
from ..sources.tables import domain
from .passes import Hot, hot_pass, reconcile_lake
from .reports import snapshot

HOURLY = columns("campaign_id string, hour timestamp, spend double, exposures long, attributed_conversions long, purchases long, site_visits long, revenue double, reported_at timestamp")
NOTED = columns("campaign_id string, hour timestamp, version timestamp")
SNAPSHOT = columns(
    "reported_at timestamp, campaign_id string, period string, spend double, revenue double, conversions long, purchases long, exposures long, "
    "roas double, cpa double, cvr double, site_visit_rate double, snapshot_version timestamp"
)
MARKER = columns("k int, profile string")
#: What a reload builds anew; report snapshots are history and stay.
DERIVED = ("exposures_landed", "attributed_conversions", "campaign_hourly", "rollup_dirty", "rollup_refreshed", "eval_meta")
BY_DAY = {"exposures_landed": EXPOSURE, "attributed_conversions": ATTRIBUTED}
APPENDED = {"campaign_hourly": HOURLY, "rollup_dirty": NOTED, "rollup_refreshed": NOTED, "report_snapshots": SNAPSHOT, "eval_meta": MARKER}


class UnknownDay(ValueError):
    """A day outside the calendar."""


class ProfileMismatch(RuntimeError):
    """The tables were filled from another profile, or nobody said from which."""


def key_rows(spark: SparkSession, keys: Iterable[tuple[str, int]]) -> DataFrame:
    """(campaign_id, hour) of a list of pairs with the hour in epoch seconds, as one bound array taken apart in the plan."""
    listed = F.array(*(F.struct(F.lit(c).alias("c"), F.lit(s).cast("long").alias("s")) for c, s in keys)).cast("array<struct<c:string,s:bigint>>")
    return spark.range(1).select(F.inline(listed)).select(F.col("c").alias("campaign_id"), F.timestamp_seconds("s").alias("hour"))


class Serving:
    """The serving tables of one lake, under one folder.

    Exposures and conversions hold one current row a key, by day: loading a day
    replaces that day, so a load may be repeated. The others are appended with
    versions and read at the newest one.
    """

    def __init__(self, spark: SparkSession, path: str, exposures: LakeTable, attributed: LakeTable, calendar: tuple[dt.date, dt.date] | None = None):
        self.spark, self.path, self.lake, self.calendar = spark, path, (exposures, attributed), calendar
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _table(self, name: str) -> DataFrame:
        at = f"{self.path}/{name}"
        day = [T.StructField("event_day", T.DateType())] if name in BY_DAY else []
        schema = T.StructType([*(BY_DAY | APPENDED)[name], *day])
        return self.spark.read.schema(schema).parquet(at) if self._fs.exists(self._path(at)) else self.spark.createDataFrame([], schema)

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.select(*APPENDED[name].names).hint("rebalance").write.mode("append").parquet(f"{self.path}/{name}")

    def exposures(self, days: list[dt.date] | None = None) -> DataFrame:
        rows = self._table("exposures_landed")
        return collapsed(rows if days is None else rows.where(F.col("event_day").isin(days) if days else F.lit(False)))

    def attributed(self, days: list[dt.date] | None = None) -> DataFrame:
        rows = self._table("attributed_conversions")
        return collapsed(rows if days is None else rows.where(F.col("event_day").isin(days) if days else F.lit(False)))

    def rollup(self) -> DataFrame:
        return collapse_versions(self._table("campaign_hourly"), KEYS, "reported_at")

    def noted(self) -> DataFrame:
        return self._table("rollup_dirty").groupBy(*KEYS).agg(F.max("version").alias("version"))

    def refreshed(self) -> DataFrame:
        return latest_by(self._table("rollup_refreshed"), KEYS, [F.col("version").desc()])

    def snapshots(self) -> DataFrame:
        return collapse_versions(self._table("report_snapshots"), ["reported_at", "campaign_id", "period"], "snapshot_version")

    def dirty(self) -> DataFrame:
        """Keys that were noted and not refreshed since."""
        return dirty(self.noted(), self.refreshed())

    def load_day(self, day: dt.date) -> dict[str, int]:
        return self.load([day])

    def load(self, days: list[dt.date]) -> dict[str, int]:
        """Loads exactly these days from the lake, notes the rollup keys that they
        touch, and refreshes the rollup at them; rows loaded by table, keys
        refreshed. Days outside the calendar are refused before anything is done.
        Loading again changes nothing."""
        out = {"exposures": 0, "attributed": 0, "rollup_keys": 0}
        if not days:
            return out
        unknown = sorted(d for d in set(days) if self.calendar and not self.calendar[0] <= d <= self.calendar[1])
        if unknown:
            raise UnknownDay(f"{', '.join(map(str, unknown))}: the calendar is {self.calendar[0]} to {self.calendar[1]}")
        shown, rows = self.lake
        for name, key, df in (("exposures_landed", "exposures", current_exposures(shown.for_days(days))), ("attributed_conversions", "attributed", rows.current(days))):
            put = df.withColumn("event_day", F.to_date("event_time"))
            put.hint("rebalance", "event_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_day").parquet(f"{self.path}/{name}")
            self.spark.catalog.refreshByPath(f"{self.path}/{name}")
            out[key] = self._table(name).where(F.col("event_day").isin(days)).count()
        # of the days loaded, from both sides: the order of loads does not matter
        self._append("rollup_dirty", recorded(self.exposures(), self.attributed(), days))
        out["rollup_keys"] = self.refresh()
        return out

    def refresh(self) -> int:
        """Computes the dirty keys of the rollup anew; stamps them after that is written."""
        aside = f"{self.path}/_keys-{uuid.uuid4().hex}"
        self.dirty().select(*NOTED.names).write.parquet(aside)
        wanted = self.spark.read.schema(NOTED).parquet(aside)
        n = wanted.count()
        if n:
            self._append("campaign_hourly", hourly(self.exposures(), self.attributed(), wanted))
            self._append("rollup_refreshed", wanted)
        self._fs.delete(self._path(aside), True)
        return n

    def note_snapshot(self, offset_ms: int, hot_only: bool = False, period: str = "all") -> None:
        rows = snapshot(self.exposures(), self.attributed(), period, offset_ms, hot_only)
        self._append("report_snapshots", rows)

    def finalize(self, days: list[dt.date] | None = None) -> list[dt.date]:
        """Reconciles the open rows of the days in the lake, loads what was
        corrected, refreshes the rollup, and takes the snapshots before and after.
        Returns the days corrected; called again it corrects nothing and leaves
        every table's current rows as they are."""
        touched = reconcile_lake(*self.lake, days)
        self.load(touched)
        self.note_snapshot(0, hot_only=True)
        self.note_snapshot(1000)
        return touched

    def rebuild(self, days: list[dt.date] | None = None) -> dict[str, int]:
        """Empties the derived tables and loads them from the lake; refuses an empty lake."""
        days = sorted({d for t in self.lake for d in t.days()}) if days is None else days
        if not days:
            raise EmptyLake(self.path)
        for name in DERIVED:
            self._fs.delete(self._path(f"{self.path}/{name}"), True)
            self.spark.catalog.refreshByPath(f"{self.path}/{name}")
        return self.load(days)

    def merge(self) -> None:
        """Rewrites the appended tables to their current rows: one file each."""
        views = {"campaign_hourly": self.rollup(), "rollup_dirty": self.noted(), "rollup_refreshed": self.refreshed(), "report_snapshots": self.snapshots()}
        for name, view in views.items():
            new, old = self._path(f"{self.path}/_{name}"), self._path(f"{self.path}/{name}")
            if self._fs.exists(old):
                view.coalesce(1).write.mode("overwrite").parquet(new.toString())
                self._fs.delete(old, True)
                self._fs.rename(new, old)
                self.spark.catalog.refreshByPath(old.toString())

    def mark(self, profile: str) -> None:
        """Says from which profile the tables were filled."""
        self.spark.createDataFrame([(0, profile)], MARKER).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/eval_meta")

    def marker(self) -> str | None:
        rows = self._table("eval_meta").collect()
        return rows[0]["profile"] if rows else None

    def check_marker(self, profile: str) -> None:
        """Refuses to score tables that hold another profile, or an unknown one."""
        found = self.marker()
        if found != profile:
            raise ProfileMismatch(f"the tables hold {found or 'no named profile'}, not {profile}")

    def decisions(self) -> DataFrame:
        return self.attributed().select("conversion_id", "household_id", "exposure_id", "attributed", "assists", "path", "reason").orderBy("conversion_id")

    def credited(self) -> DataFrame:
        return self.attributed().where("attributed").select("conversion_id", "household_id", "exposure_id").orderBy("conversion_id")

    def exposure_households(self) -> DataFrame:
        return self.exposures().select("exposure_id", "household_id").orderBy("exposure_id")

    def storage(self) -> list[tuple[str, int, int]]:
        """(table, commits or files, those beyond the first of their day or table): what a merge would take away."""
        out = []
        for name, table in zip(("lake_exposures", "lake_attributed"), self.lake, strict=True):
            held = [commits for _, commits, _, _ in table.storage()]
            out.append((name, max(held, default=0), sum(n - 1 for n in held)))
        for name in APPENDED:
            at = self._path(f"{self.path}/{name}")
            files = [s for s in self._fs.listStatus(at) if s.getPath().getName().endswith(".parquet")] if self._fs.exists(at) else []
            out.append((name, len(files), max(0, len(files) - 1)))
        return out


@dataclass(frozen=True)
class Served:
    hot: Hot
    serving: Serving
    exposures: LakeTable
    attributed: LakeTable
    hot_only: LakeTable

    @property
    def versions(self) -> DataFrame:
        """The current rows."""
        return self.serving.attributed()


def build(spark: SparkSession, sf_dir: str, path: str) -> Served:
    """The whole path once: hot pass into the lake, load, reconcile, load what changed, snapshots."""
    tables = domain(spark, sf_dir)
    hot = hot_pass(tables)
    shown, rows = LakeTable(spark, f"{path}/exposures", EXPOSURE), LakeTable(spark, f"{path}/attributed", ATTRIBUTED)
    before = LakeTable(spark, f"{path}/attributed_hot", ATTRIBUTED)
    days = sorted({*shown.append(hot.exposures), *rows.append(hot.attributed)})
    before.append(hot.attributed)
    for kept in (hot.exposures, hot.resolved, hot.one_row, hot.attributed):
        kept.unpersist()
    serving = Serving(spark, f"{path}/serving", shown, rows, (days[0], days[-1]) if days else None)
    serving.mark(sf_dir)
    serving.load(days)
    serving.finalize()
    return Served(Hot(serving.exposures(), hot.resolved, hot.one_row, collapsed(before.read().drop("event_day", "household_bucket"))), serving, shown, rows, before)


def served(spark: SparkSession, sf_dir: str) -> Served:
    """The stored tables of a data set: built at first use in this application, and
    again if its events are written anew."""
    events = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    fs = events.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    state = (sf_dir, fs.getFileStatus(events).getModificationTime(), fs.getContentSummary(events).getLength())
    known = spark.sparkContext.__dict__.setdefault("_afterview_served", {})
    if state not in known:
        known[state] = build(spark, sf_dir, f"{shared_dir(spark)}/served-{uuid.uuid4().hex}")
    return known[state]
