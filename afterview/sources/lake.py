"""The append-only lake: Parquet by commit, event day and household bucket, under a manifest."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import BUCKETS, household_bucket
from ..operators.versions import current

LAYOUT = ["event_day", "household_bucket"]
#: Rows of one file at most; a bucket of a big day becomes several files.
FILE_ROWS = 20_000_000


class LayoutMismatch(RuntimeError):
    """The table on disk was written with another layout."""


class EmptyLake(RuntimeError):
    """A rebuild from nothing was refused."""


class LakeTable:
    """One table of the lake. Rows are only appended; what is current is decided on reading.

    Each write is a commit, a folder of its own. What belongs to the table is said
    by the newest manifest, a list of (commit, day); a commit counts from the
    moment its manifest is renamed into place, so a crash leaves the table as it
    was before, and whatever is not listed is ignored and removed by `vacuum`.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.buckets = spark, path, schema, buckets
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._guard()

    def _guard(self) -> None:
        """The layout is written beside the table and checked whenever it is opened."""
        mine = {"partitions": LAYOUT, "buckets": self.buckets, "schema": self.schema.json()}
        at = f"{self.path}/layout.json"
        if not self._fs.exists(self._path(at)):
            self._put(at, mine)
        found = self._get(at)
        if found != mine:
            raise LayoutMismatch(f"{self.path}: {found['partitions']} x {found['buckets']}, wanted {LAYOUT} x {self.buckets}")

    def _put(self, at: str, what) -> None:
        """A small file that is whole or not there: written aside, then renamed."""
        aside = self._path(f"{self.path}/_aside-{uuid.uuid4().hex}")
        out = self._fs.create(aside)
        out.write(json.dumps(what).encode())
        out.close()
        self._fs.mkdirs(self._path(at).getParent())
        if self._fs.exists(self._path(at)) or not self._fs.rename(aside, self._path(at)):
            raise RuntimeError(f"{at} is already there: another writer was faster")

    def _get(self, at: str):
        return json.loads("\n".join(r["value"] for r in self.spark.read.text(at).collect()))

    def _names(self, at: str) -> list[str]:
        path = self._path(at)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def parts(self) -> list[tuple[str, dt.date]]:
        """(commit, day) of the newest manifest."""
        found = self._names(f"{self.path}/manifest")
        return [(c, dt.date.fromisoformat(d)) for c, d in self._get(f"{self.path}/manifest/{found[-1]}")] if found else []

    def _publish(self, parts: list[tuple[str, dt.date]]) -> None:
        found = self._names(f"{self.path}/manifest")
        number = int(found[-1].split(".")[0]) + 1 if found else 0
        self._put(f"{self.path}/manifest/{number:012d}.json", [(c, d.isoformat()) for c, d in sorted(parts)])

    def _committed(self, rows: DataFrame) -> tuple[str, list[dt.date]]:
        """Writes rows as a commit that no manifest names yet; the days in it, from its folders."""
        commit = uuid.uuid4().hex
        # a rebalance and not a repartition: what is big is split, what is small is put together
        dealt = rows.hint("rebalance", *LAYOUT).sortWithinPartitions(*LAYOUT, "event_time")
        dealt.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(*LAYOUT).parquet(f"{self.path}/data/commit={commit}")
        days = [n.split("=")[1] for n in self._names(f"{self.path}/data/commit={commit}") if n.startswith("event_day=")]
        return commit, [dt.date.fromisoformat(d) for d in days]

    def append(self, df: DataFrame) -> list[dt.date]:
        """Appends rows; returns the days that they touch. The input is evaluated
        once; within a file rows are sorted by time, so the statistics of row
        groups prune time ranges."""
        cut = [F.date_trunc("MILLISECOND", c).alias(c) if isinstance(self.schema[c].dataType, T.TimestampType) else F.col(c) for c in self.schema.names]
        rows = df.select(*cut).withColumns({"event_day": F.to_date("event_time"), "household_bucket": household_bucket(F.col("household_id"), self.buckets)})
        commit, days = self._committed(rows)
        if days:
            self._publish(self.parts() + [(commit, d) for d in days])
        return days

    def _read(self, parts: list[tuple[str, dt.date]]) -> DataFrame:
        full = T.StructType([*self.schema, T.StructField("event_day", T.DateType()), T.StructField("household_bucket", T.IntegerType())])
        if not parts:
            return self.spark.createDataFrame([], full)
        paths = [f"{self.path}/data/commit={c}/event_day={d}" for c, d in parts]
        return self.spark.read.schema(T.StructType([*full, T.StructField("commit", T.StringType())])).option("basePath", f"{self.path}/data").parquet(*paths).drop("commit")

    def read(self) -> DataFrame:
        return self._read(self.parts())

    def for_days(self, days: list[dt.date]) -> DataFrame:
        """Distinct rows of some days; none of no days. Only the folders of those days are listed and read."""
        wanted = set(days)
        return self._read([p for p in self.parts() if p[1] in wanted]).drop(*LAYOUT).distinct()

    def for_households(self, households: DataFrame, start: dt.datetime, end: dt.datetime, keep_bucket: bool = False) -> DataFrame:
        """Distinct rows of a set of households in [start, end): only days of the
        range are read, and a semi join on bucket and household follows."""
        wanted = households.select("household_id").distinct().withColumn("household_bucket", household_bucket(F.col("household_id"), self.buckets))
        rows = self._read([p for p in self.parts() if start.date() <= p[1] <= end.date()])
        rows = rows.where((F.col("event_time") >= start) & (F.col("event_time") < end))
        return rows.join(wanted, ["household_bucket", "household_id"], "left_semi").select(*self.schema.names, *(["household_bucket"] if keep_bucket else [])).distinct()

    def days(self) -> list[dt.date]:
        """From the manifest; no row is read."""
        return sorted({d for _, d in self.parts()})

    def current(self, days: list[dt.date] | None = None) -> DataFrame:
        return current(self.for_days(days) if days is not None else self.read().drop(*LAYOUT).distinct())

    def storage(self) -> list[tuple[str, int, int, int]]:
        """(day, commits, files, bytes) of each day, from the manifest and the listing."""
        out: dict[dt.date, list[int]] = {}
        for commit, day in self.parts():
            held = self._fs.getContentSummary(self._path(f"{self.path}/data/commit={commit}/event_day={day}"))
            row = out.setdefault(day, [0, 0, 0])
            row[0], row[1], row[2] = row[0] + 1, row[1] + held.getFileCount(), row[2] + held.getLength()
        return [(d.isoformat(), *row) for d, row in sorted(out.items())]

    def compact(self, days: list[dt.date] | None = None) -> int:
        """Rewrites the days that lie in several commits into one; rows stay as
        they are. The new files count from the moment that the manifest names them,
        the old ones go after that. Returns the number of days rewritten."""
        parts = self.parts()
        held = [d for _, d in parts]
        many = sorted({d for d in held if held.count(d) > 1 and (days is None or d in set(days))})
        if many:
            old = [p for p in parts if p[1] in set(many)]
            commit, _ = self._committed(self._read(old))
            self._publish([p for p in parts if p not in old] + [(commit, d) for d in many])
            self.vacuum()
        return len(many)

    def vacuum(self) -> int:
        """Removes folders that the manifest does not name; the number of them."""
        live, gone = self.parts(), 0
        for name in self._names(f"{self.path}/data"):
            commit = name.split("=")[1]
            for day in self._names(f"{self.path}/data/{name}"):
                if day.startswith("event_day=") and (commit, dt.date.fromisoformat(day.split("=")[1])) not in live:
                    self._fs.delete(self._path(f"{self.path}/data/{name}/{day}"), True)
                    gone += 1
        return gone

    def rebuild(self, path: str) -> DataFrame:
        """The current rows as a fresh serving table; refuses to overwrite it with nothing."""
        if not self.parts():
            raise EmptyLake(self.path)
        self.current().write.mode("overwrite").parquet(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def migrate(self, path: str, change) -> LakeTable:
        """A copy of the table under a changed schema; refused if rows are missing."""
        rows = change(self.read().drop(*LAYOUT))
        new = LakeTable(self.spark, path, rows.schema, self.buckets)
        new.append(rows)
        if new.read().count() != self.read().count():
            raise RuntimeError("the copy is short")
        return new


def lake_days(*tables: LakeTable) -> list[dt.date]:
    """Days over several tables; opening none of them creates data."""
    return sorted({d for t in tables for d in t.days()})
