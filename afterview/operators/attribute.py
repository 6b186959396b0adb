"""Last-touch attribution: the plain interval join, and the exact form of the
stream engine as window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ATTRIBUTED

HOT_WINDOW = 7 * 86400
LONG_WINDOW = 90 * 86400
ALLOWED_LATENESS = 6 * 3600
NEVER = (1 << 62) - 1


def _seconds(n: int) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {n})")


def touches(conversions: DataFrame, exposures: DataFrame, window: int, extra: Column | None = None) -> DataFrame:
    """The conversions' columns with `touch_time`, `exposure_id` and `assists`.

    An exposure is eligible from `window` seconds before the conversion up to
    it, both inclusive. The latest wins, ties by id; the other distinct ids are
    assists. Time is cut into spans of one window and a conversion looks into
    its own and the one before, so a household with a long history joins only
    what can match. Where both sides have a `household_bucket`, it is a key too.
    """
    names = conversions.columns
    home = ["household_bucket", "household_id"] if {"household_bucket"} <= {*names} & {*exposures.columns} else ["household_id"]
    span = lambda t: F.floor(F.unix_seconds(t) / window)
    wanted = conversions.withColumn("_span", F.explode(F.array(span(F.col("event_time")), span(F.col("event_time")) - 1)))
    keep = [c for c in ("ix", "gone") if c in exposures.columns]
    offered = exposures.select(*home, F.col("event_time").alias("_time"), F.col("exposure_id").alias("_id"), *(F.col(c).alias(f"_{c}") for c in keep)).withColumn("_span", span(F.col("_time")))
    fits = F.col("_time").between(F.col("event_time") - _seconds(window), F.col("event_time"))
    pairs = wanted.join(offered, [*home, "_span"]).where(fits if extra is None else fits & extra)
    won = pairs.groupBy("conversion_id", "household_id").agg(F.max(F.struct("_time", "_id")).alias("_best"), F.collect_set("_id").alias("_ids"))
    won = won.select("conversion_id", "household_id", F.col("_best._time").alias("touch_time"), F.col("_best._id").alias("exposure_id"), F.array_sort(F.array_except("_ids", F.array("_best._id"))).alias("assists"))
    return conversions.join(won, ["conversion_id", "household_id"], "left").select(*names, "touch_time", "exposure_id", F.coalesce("assists", F.array().cast("array<string>")).alias("assists"))


def decided(rows: DataFrame, path: str, processed_at: Column) -> DataFrame:
    """Rows of `touches` as attributed conversions."""
    hit = F.col("exposure_id").isNotNull()
    reason = F.when(~hit, F.when(F.col("candidate_count") > 1, "ambiguous_ip").otherwise("state_miss"))
    return rows.withColumns({"attributed": hit, "path": F.lit(path), "processed_at": processed_at, "reason": reason}).select(*ATTRIBUTED.names)


def attribute(exposures: DataFrame, one_row: DataFrame, window: int = HOT_WINDOW) -> DataFrame:
    """Attribution against complete state. Ambiguous conversions are not guessed."""
    certain, ambiguous = one_row.where("candidate_count = 1"), one_row.where("candidate_count > 1")
    none = ambiguous.withColumns({"touch_time": F.lit(None).cast("timestamp"), "exposure_id": F.lit(None).cast("string"), "assists": F.array().cast("array<string>")})
    return decided(touches(certain, exposures, window).unionByName(none), "hot", F.col("ingest_time"))


def arrivals(exposures: DataFrame, one_row: DataFrame, window: int = HOT_WINDOW, lateness: int = ALLOWED_LATENESS) -> tuple[DataFrame, DataFrame]:
    """Exposures with arrival number `ix` and the tick at which they are `gone`;
    conversions with ix and the tick of their `release`.

    Arrivals of a household are numbered in the order of ingestion; the
    household's watermark is the greatest event time so far less the lateness.
    A conversion is released when the watermark reaches its time, an exposure is
    evicted when the watermark passes its time plus the window; release comes
    before eviction within an arrival, and what is left pending is released at
    the end of the input (NEVER).

    The watermark never falls, so the first arrival that reaches a time comes
    right behind all those with a lower mark. Each arrival is therefore put down
    twice, as a mark and as a question, both are sorted by time, and the marks
    before a question are counted. Rows carry their payload along: one exchange
    by household and two sorts, no join. A household is one task's sort, which
    spills; its arrivals are never held in memory together.
    """
    own = F.struct(*exposures.columns)
    asked = F.struct(*one_row.columns)
    rows = exposures.select("household_id", F.lit("exp").alias("kind"), F.col("exposure_id").alias("id"), "event_time", "ingest_time", own.alias("shown"), F.lit(None).cast(_row_type(one_row)).alias("asked"))
    rows = rows.unionByName(one_row.select("household_id", F.lit("res").alias("kind"), F.col("conversion_id").alias("id"), "event_time", "ingest_time", F.lit(None).cast(_row_type(exposures)).alias("shown"), asked.alias("asked")))
    home = Window.partitionBy("household_id")
    order = home.orderBy("ingest_time", "kind", "id")
    ticks = rows.select(
        "household_id", "kind", "event_time", "shown", "asked", F.row_number().over(order).cast("long").alias("ix"), F.count(F.lit(1)).over(home).alias("all"),
        (F.max("event_time").over(order.rowsBetween(Window.unboundedPreceding, 0)) - _seconds(lateness)).alias("mark"),
    )
    # at one time: releases do not count the marks that reach them, evictions do
    is_exp = F.col("kind") == "exp"
    target = F.when(is_exp, F.col("event_time") + _seconds(window)).otherwise(F.col("event_time"))
    two = F.array(F.struct(F.col("mark").alias("at"), F.lit(1).alias("side")), F.struct(target.alias("at"), F.when(is_exp, 2).otherwise(0).alias("side")))
    both = ticks.select("household_id", "kind", "ix", "all", "shown", "asked", F.explode(two).alias("p")).select("household_id", "kind", "ix", "all", F.when(F.col("p.side") != 1, F.col("shown")).alias("shown"), F.when(F.col("p.side") != 1, F.col("asked")).alias("asked"), "p.at", "p.side")
    below = F.sum((F.col("side") == 1).cast("long")).over(home.orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0))
    counted = both.withColumn("below", below).where("side <> 1")
    tick = F.when(F.col("below") >= F.col("all"), F.lit(NEVER)).otherwise(F.greatest("ix", F.col("below") + 1))
    gone = counted.where("kind = 'exp'").select("shown.*", "ix", tick.alias("gone"))
    release = counted.where("kind = 'res'").select("asked.*", "ix", tick.alias("release"))
    return gone, release


def _row_type(df: DataFrame):
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])


def engine(exposures: DataFrame, one_row: DataFrame, window: int = HOT_WINDOW, lateness: int = ALLOWED_LATENESS) -> DataFrame:
    """What the stream operator emits, lateness and eviction included."""
    held, asked = arrivals(exposures, one_row, window, lateness)
    certain, ambiguous = asked.where("candidate_count = 1"), asked.where("candidate_count > 1")
    present = (F.col("_ix") <= F.col("release")) & (F.col("_gone") >= F.col("release"))
    none = ambiguous.withColumns({"touch_time": F.lit(None).cast("timestamp"), "exposure_id": F.lit(None).cast("string"), "assists": F.array().cast("array<string>")})
    return decided(touches(certain, held, window, present).unionByName(none), "hot", F.col("ingest_time"))


def join_state(exposures: DataFrame, one_row: DataFrame, window: int = HOT_WINDOW, lateness: int = ALLOWED_LATENESS) -> DataFrame:
    """(household_id, peak, evicted, final): exposures held by the stream operator."""
    held, _ = arrivals(exposures, one_row, window, lateness)
    change = held.select("household_id", F.col("ix").alias("tick"), F.lit(1).alias("n")).unionByName(held.where(F.col("gone") < NEVER).select("household_id", F.col("gone").alias("tick"), F.lit(-1).alias("n")))
    live = change.groupBy("household_id", "tick").agg(F.sum("n").alias("n"))
    live = live.withColumn("live", F.sum("n").over(Window.partitionBy("household_id").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)))
    ends = held.groupBy("household_id").agg(F.count_if(F.col("gone") < NEVER).alias("evicted"), F.count_if(F.col("gone") >= NEVER).alias("final"))
    return live.groupBy("household_id").agg(F.greatest(F.max("live"), F.lit(0)).alias("peak")).join(ends, "household_id").select("household_id", "peak", "evicted", "final")


def peak_lateness(exposures: DataFrame, resolved: DataFrame) -> DataFrame:
    """The longest time between event and arrival, in seconds."""
    late = [d.select((F.unix_micros("ingest_time") - F.unix_micros("event_time")).alias("late")) for d in (exposures, resolved)]
    return late[0].unionByName(late[1]).agg(F.coalesce(F.max("late") / 1e6, F.lit(0.0)).alias("peak_lateness_seconds"))
