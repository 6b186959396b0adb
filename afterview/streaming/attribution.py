"""Attribution as a keyed Structured Streaming operator.

One state per household. Rows wait there until Spark's watermark over the
arrival times says that no earlier arrival can come any more; then all rows
below it are settled at once, in order of arrival. So neither the number of
files nor the order of triggers matters, as long as arrivals are out of order by
no more than `disorder`. The household's own watermark over event times, which
decides what is released and evicted, is kept in state beside the rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from ..operators.attribute import ALLOWED_LATENESS, HOT_WINDOW
from ..schemas import columns

EVENTS = columns("household_id string, kind string, id string, event_us long, ingest_us long, certain boolean")
BOOK = columns("mark long, live int, peak int, evicted int")
BUFFERED = columns("kind string, id string, event_us long, ingest_us long, certain boolean")
HELD, WAITING, SEEN = columns("id string, at long"), columns("id string, at long, certain boolean"), columns("id string")
OUT = "conversion_id string, household_id string, exposure_id string, assists array<string>, attributed boolean, peak int, evicted int, final int"
END, TAIL = "zzz", "tail"  # END sorts behind every other kind; TAIL is no household's
#: How far arrivals may be out of order between files and triggers.
DISORDER = ALLOWED_LATENESS
NO_MARK = -(1 << 62)


@dataclass
class Settled:
    decisions: list[tuple[str, str | None, list[str]]]  # conversion, winner, assists
    held: list[tuple[str, int]]
    waiting: list[tuple[str, int, bool]]
    mark: int
    live: np.ndarray  # exposures held after each arrival
    evicted: int


def settle(kinds: np.ndarray, ids: np.ndarray, times: np.ndarray, certain: np.ndarray, held: list, waiting: list, mark: int, window: int, lateness: int) -> Settled:
    """What arrivals in the given order do to a household that holds `held` and waits for `waiting`.

    The watermark after each arrival is a running maximum, so the arrival at which
    a conversion is released or an exposure has to go is a binary search in it:
    a conversion goes at the first arrival, from its own on, whose watermark
    reaches its time (or at an END), an exposure at the first one whose watermark
    is beyond its time plus the window. An exposure counts for a release if it
    arrived by then and did not go before.
    """
    n = len(kinds)
    end = kinds == END
    reach = np.maximum.accumulate(np.where(end, NO_MARK, times - lateness).clip(mark)) if n else np.zeros(0, np.int64)
    ends = np.append(np.flatnonzero(end), n)

    shown = np.flatnonzero(kinds == "exp")
    e_id = np.array([i for i, _ in held] + ids[shown].tolist(), object)
    e_at = np.array([t for _, t in held] + times[shown].tolist(), np.int64)
    e_in = np.concatenate([np.full(len(held), -1), shown])
    e_out = np.maximum(e_in, np.searchsorted(reach, e_at + window, side="right"))
    order = np.array(sorted(range(len(e_id)), key=lambda i: (e_at[i], e_id[i])), np.int64)
    e_id, e_at, e_in, e_out = e_id[order], e_at[order], e_in[order], e_out[order]

    asked = np.flatnonzero(kinds == "res")
    open_ = [(c, t, s, -1) for c, t, s in waiting] + list(zip(ids[asked].tolist(), times[asked].tolist(), certain[asked].tolist(), asked.tolist(), strict=True))
    decisions, still = [], []
    for c, t, sure, arrived in open_:
        tick = min(max(arrived, int(np.searchsorted(reach, t))), int(ends[np.searchsorted(ends, arrived)]))
        if tick >= n:
            still.append((c, int(t), bool(sure)))
            continue
        a, b = np.searchsorted(e_at, t - window), np.searchsorted(e_at, t, side="right")
        there = np.flatnonzero((e_in[a:b] <= tick) & (e_out[a:b] >= tick)) + a if sure else []
        best = e_id[there[-1]] if len(there) else None
        decisions.append((c, best, sorted({e_id[i] for i in there} - {best})))

    change = np.bincount(shown, minlength=n) - np.bincount(e_out[e_out < n], minlength=n) if n else np.zeros(0, np.int64)
    stay = e_out >= n
    left = list(zip(e_id[stay].tolist(), e_at[stay].tolist(), strict=True))
    return Settled(decisions, left, still, int(reach[-1]) if n else mark, len(held) + np.cumsum(change), int((~stay).sum()))


class Attribution(StatefulProcessor):
    """Buffers rows by household and settles those that Spark's watermark has passed.

    A row of kind END closes its household: what waits is released against what
    is held. With `dedup` a re-sent exposure or conversion counts once, at its
    first arrival; the ids seen are kept for good.
    """

    def __init__(self, window: int = HOT_WINDOW, lateness: int = ALLOWED_LATENESS, dedup: bool = True):
        self.window, self.lateness, self.dedup = window * 1_000_000, lateness * 1_000_000, dedup

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book = handle.getValueState("book", BOOK)
        self.buffer = handle.getListState("buffer", BUFFERED)
        self.held = handle.getListState("held", HELD)
        self.waiting = handle.getListState("waiting", WAITING)
        self.seen = handle.getListState("seen", SEEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))
        self.buffer.appendList(list(came[BUFFERED.names].itertuples(index=False, name=None)))
        self.handle.registerTimer(int(came["ingest_us"].min()) // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = pd.DataFrame(list(self.buffer.get()), columns=BUFFERED.names)
        ready, later = rows[rows["ingest_us"] < passed], rows[rows["ingest_us"] >= passed]
        if not len(ready):
            return
        if len(later):
            self.buffer.put(list(later.itertuples(index=False, name=None)))
            self.handle.registerTimer(int(later["ingest_us"].min()) // 1000 + 1)
        else:
            self.buffer.clear()
        yield self._settled(key[0], ready.sort_values(["ingest_us", "kind", "id", "event_us"], kind="stable"))

    def _settled(self, household: str, rows: pd.DataFrame) -> pd.DataFrame:
        if self.dedup:
            names = rows["kind"] + ":" + rows["id"]
            known = {i for (i,) in self.seen.get()}
            rows = rows[(rows["kind"] == END) | ~(names.duplicated() | names.isin(known))]
            new = [(f"{r.kind}:{r.id}",) for r in rows.itertuples(index=False) if r.kind != END]
            if new:
                self.seen.appendList(new)
        mark, _, peak, evicted = self.book.get() if self.book.exists() else (NO_MARK, 0, 0, 0)
        kinds = rows["kind"].to_numpy(object)
        done = settle(kinds, rows["id"].to_numpy(object), rows["event_us"].to_numpy(np.int64), rows["certain"].to_numpy(bool), list(self.held.get()), list(self.waiting.get()), mark, self.window, self.lateness)
        peak, evicted = max(peak, int(done.live.max(initial=0))), evicted + done.evicted
        self.book.update((done.mark, len(done.held), peak, evicted))
        self.held.put(done.held) if done.held else self.held.clear()
        self.waiting.put(done.waiting) if done.waiting else self.waiting.clear()
        out = [(c, household, best, assists, best is not None, 0, 0, 0) for c, best, assists in done.decisions]
        out += [(None, household, None, [], False, peak, evicted, len(done.held))] * int((kinds == END).any())
        return pd.DataFrame(out, columns=["conversion_id", "household_id", "exposure_id", "assists", "attributed", "peak", "evicted", "final"])

    def close(self) -> None:
        pass


class Progress(StreamingQueryListener):
    """Collects a row for each trigger: rows read, state rows and bytes, watermark, milliseconds."""

    def __init__(self):
        self.rows: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        self.rows.append({"batch": p.batchId, "rows": p.numInputRows, "state_rows": sum(s.numRowsTotal for s in state), "state_bytes": sum(s.memoryUsedBytes for s in state), "watermark": (p.eventTime or {}).get("watermark"), "ms": (p.durationMs or {}).get("triggerExecution")})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def tagged(exposures: DataFrame, one_row: DataFrame, disorder: int = DISORDER) -> DataFrame:
    """Both inputs as EVENTS, with an END row for each household, and one TAIL row
    that lets the watermark pass all of them."""
    at = [F.unix_micros("event_time").alias("event_us"), F.unix_micros("ingest_time").alias("ingest_us")]
    shown = exposures.select("household_id", F.lit("exp").alias("kind"), F.col("exposure_id").alias("id"), *at, F.lit(True).alias("certain"))
    asked = one_row.select("household_id", F.lit("res").alias("kind"), F.col("conversion_id").alias("id"), *at, (F.col("candidate_count") == 1).alias("certain"))
    rows = shown.unionByName(asked)
    last = rows.groupBy("household_id").agg(F.max("event_us").alias("event_us"), F.max("ingest_us").alias("ingest_us"))
    ends = last.select("household_id", F.lit(END).alias("kind"), F.lit("").alias("id"), "event_us", (F.col("ingest_us") + 1).alias("ingest_us"), F.lit(True).alias("certain"))
    tail = rows.agg(F.max("event_us").alias("event_us"), (F.max("ingest_us") + (disorder + 10) * 1_000_000).alias("ingest_us")).where("ingest_us is not null")
    return rows.unionByName(ends).unionByName(tail.select(F.lit("").alias("household_id"), F.lit(TAIL).alias("kind"), F.lit("").alias("id"), "event_us", "ingest_us", F.lit(True).alias("certain")))


def attributed_stream(stream: DataFrame, window: int = HOT_WINDOW, lateness: int = ALLOWED_LATENESS, disorder: int = DISORDER, dedup: bool = True) -> DataFrame:
    """A stream of EVENTS as a stream of OUT; needs the RocksDB state store.

    The processor is sent with its code: the process that prepares it beside
    the driver's JVM does not see the files added to the session."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    timed = stream.withColumn("arrived", F.timestamp_micros("ingest_us")).withWatermark("arrived", f"{disorder} seconds")
    return timed.groupBy("household_id").transformWithStateInPandas(Attribution(window, lateness, dedup), OUT, "append", "EventTime")


def run_to_end(spark: SparkSession, source: str, work: str, window: int = HOT_WINDOW, lateness: int = ALLOWED_LATENESS, disorder: int = DISORDER, files_per_trigger: int | None = None, progress: Progress | None = None) -> DataFrame:
    """Drains the event files under `source` through the operator; rows as read back."""
    from ..sources.files import drained

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    if progress:
        spark.streams.addListener(progress)
    try:
        reader = spark.readStream.schema(EVENTS)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return drained(attributed_stream(reader.parquet(source), window, lateness, disorder), f"{work}/out", f"{work}/checkpoint")
    finally:
        if progress:
            spark.streams.removeListener(progress)
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)
