"""The engine's queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import exact_sum, joined, micros, millis
from .operators import attribute as att
from .operators.accuracy import accuracy, eval_spread, false_positive_rate
from .operators.reconcile import open_rows, recover
from .operators.resolve import one_per_conversion, resolve
from .operators.rollup import changed_keys, hourly, recorded
from .operators.versions import collapse_versions, current, suppressed
from .plans import reports
from .plans import cost
from .plans.passes import hot_pass, incremental
from .plans.probes import probe
from .plans.serving import Served, Serving, key_rows, served
from .session import shared_dir
from .sources.lake import LAYOUT, LakeTable, lake_days
from .sources.tables import domain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _stored(spark, d):
    """The hot pass and the current rows, from the stored tables of the data set."""
    s = served(spark, d)
    return s.hot, s.versions


def _decisions(df: DataFrame) -> DataFrame:
    """In the order of their ids."""
    return df.orderBy("conversion_id").select("conversion_id", "household_id", "exposure_id", joined(F.col("assists")).alias("assists"), "attributed", "path", millis(F.col("processed_at")).alias("processed_ms"), "reason", joined(F.col("candidate_households")).alias("candidate_households"))


@query
def resolve_conversions(spark, d):
    t = domain(spark, d)
    return resolve(t.conversions, t.graph).select("conversion_id", "household_id", "resolution", "ambiguous", "candidate_count").distinct()


@query
def resolve_counts(spark, d):
    t = domain(spark, d)
    return resolve(t.conversions, t.graph).groupBy("resolution", "candidate_count").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("conversion_id").alias("conversions"))


@query
def dedup_suppressed(spark, d):
    t = domain(spark, d)
    a = t.exposures.agg(suppressed(t.exposures, ["exposure_id"]).alias("n")).select(F.lit("exposures").alias("stream"), "n")
    r = resolve(t.conversions, t.graph)
    return a.unionByName(r.agg(suppressed(r, ["conversion_id", "household_id"]).alias("n")).select(F.lit("resolved").alias("stream"), "n"))


@query
def candidate_households(spark, d):
    t = domain(spark, d)
    return one_per_conversion(resolve(t.conversions, t.graph)).where("ambiguous").select("conversion_id", "household_id", joined(F.col("candidate_households")).alias("candidates"))


@query
def hot_complete_state(spark, d):
    hot = hot_pass(domain(spark, d))
    return _decisions(att.attribute(hot.exposures, hot.one_row))


@query
def hot_attributed(spark, d):
    return _decisions(hot_pass(domain(spark, d)).attributed)


@query
def join_state(spark, d):
    hot = hot_pass(domain(spark, d))
    return att.join_state(hot.exposures, hot.one_row)


@query
def peak_lateness(spark, d):
    hot = hot_pass(domain(spark, d))
    return att.peak_lateness(hot.exposures, hot.resolved)


@query
def unattributed_reasons(spark, d):
    return _stored(spark, d)[0].attributed.where("not attributed").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def reconcile_candidates(spark, d):
    return open_rows(_stored(spark, d)[0].attributed).select("conversion_id", "reason", "candidate_count")


@query
def reconcile_recovered(spark, d):
    hot, _ = _stored(spark, d)
    return _decisions(recover(hot.attributed, hot.exposures))


@query
def current_rows(spark, d):
    return _decisions(current(_stored(spark, d)[1]))


def _metrics(df: DataFrame) -> DataFrame:
    return df.select("campaign", "spend", "exposures", "conversions", "purchases", "revenue", *(F.round(c, 6).alias(c) for c in ("roas", "cpa", "cvr", "site_visit_rate")))


@query
def report_hot(spark, d):
    hot, _ = _stored(spark, d)
    return _metrics(reports.report(hot.exposures, hot.attributed))


@query
def report_post(spark, d):
    hot, versions = _stored(spark, d)
    return _metrics(reports.report(hot.exposures, versions))


def _hourly(df: DataFrame) -> DataFrame:
    return df.select("campaign_id", millis(F.col("hour")).alias("hour_ms"), "spend", "exposures", "attributed_conversions", "purchases", "site_visits", "revenue", millis(F.col("reported_at")).alias("reported_ms"))


@query
def rollup_hourly(spark, d):
    hot, versions = _stored(spark, d)
    return _hourly(hourly(hot.exposures, versions))


@query
def rollup_incremental(spark, d):
    return _hourly(incremental(*_stored(spark, d))[1])


@query
def report_from_rollup(spark, d):
    hot, versions = _stored(spark, d)
    return _metrics(reports.report_from_rollup(hourly(hot.exposures, versions)))


@query
def rollup_changed_keys(spark, d):
    hot, versions = _stored(spark, d)
    return changed_keys(hourly(hot.exposures, hot.attributed), hourly(hot.exposures, versions)).select("campaign_id", millis(F.col("hour")).alias("hour_ms"))


@query
def dirty_keys(spark, d):
    return incremental(*_stored(spark, d))[0].select("campaign_id", millis(F.col("hour")).alias("hour_ms"), millis(F.col("version")).alias("version_ms"))


@query
def dirty_recorded_day(spark, d):
    import datetime

    hot, versions = _stored(spark, d)
    day = spark.read.parquet(f"{d}/events.parquet").agg(F.min(F.to_date("ts")).alias("d")).first()["d"] + datetime.timedelta(days=10)
    return recorded(hot.exposures, versions, [day]).select("campaign_id", millis(F.col("hour")).alias("hour_ms"), millis(F.col("version")).alias("version_ms"))


@query
def report_snapshots(spark, d):
    s = served(spark, d).serving.snapshots()
    return s.select(millis(F.col("reported_at")).alias("reported_ms"), "campaign_id", "period", "spend", "revenue", "conversions", "purchases", "exposures", F.round("roas", 6).alias("roas"), F.round("cpa", 6).alias("cpa"), millis(F.col("snapshot_version")).alias("version_ms"))


def _restated(df: DataFrame) -> DataFrame:
    return df.select("campaign_id", F.round("roas_as_reported", 6).alias("roas_as_reported"), F.round("roas_now", 6).alias("roas_now"), "roas_delta", "conversions_as_reported", "conversions_now", "revenue_delta")


@query
def restatement(spark, d):
    return _restated(reports.restatement(served(spark, d).serving.snapshots()))


@query
def campaign_restatement(spark, d):
    hot, versions = _stored(spark, d)
    return _restated(probe("campaign_restatement", hot.exposures, versions, served(spark, d).serving.snapshots(), campaign_id="camp-02"))


@query
def match_rate_by_day(spark, d):
    return reports.match_rate_by_day(_stored(spark, d)[1]).select(F.col("day").cast("string").alias("day"), "processed", "attributed_count")


@query
def window_edge_lags(spark, d):
    hot, versions = _stored(spark, d)
    return reports.window_edge_lags(versions, hot.exposures)


@query
def window_edge_histogram(spark, d):
    hot, versions = _stored(spark, d)
    return reports.window_edge_histogram(versions, hot.exposures)


@query
def window_edge_distribution(spark, d):
    hot, versions = _stored(spark, d)
    return probe("window_edge_distribution", hot.exposures, versions)


@query
def ip_cluster_overall(spark, d):
    return reports.ip_clusters(_stored(spark, d)[1])


@query
def ip_cluster_top(spark, d):
    return reports.ip_cluster_top(_stored(spark, d)[1])


@query
def ip_cluster_detail(spark, d):
    hot, versions = _stored(spark, d)
    return probe("ip_cluster_detail", hot.exposures, versions, ip="100-2")


@query
def campaign_attributed_by_day(spark, d):
    hot, versions = _stored(spark, d)
    return probe("campaign_attributed_by_day", hot.exposures, versions, campaign_id="camp-01")


@query
def genre_exposures(spark, d):
    return reports.genre_exposures(domain(spark, d).exposures)


@query
def genre_conversions(spark, d):
    hot, versions = _stored(spark, d)
    return reports.genre_conversions(versions, hot.exposures)


@query
def genre_reach(spark, d):
    hot, versions = _stored(spark, d)
    return reports.genre_reach(versions, hot.exposures).withColumn("conversions_per_exposure", F.round("conversions_per_exposure", 6))


@query
def genre_reach_detail(spark, d):
    hot, versions = _stored(spark, d)
    return probe("genre_reach_detail", hot.exposures, versions, genre="sports")


@query
def accuracy_post(spark, d):
    t = domain(spark, d)
    hot, versions = _stored(spark, d)
    return _scored(accuracy(versions, t.truth, hot.exposures))


@query
def accuracy_hot(spark, d):
    t = domain(spark, d)
    hot, _ = _stored(spark, d)
    return _scored(accuracy(hot.attributed, t.truth, hot.exposures))


def _scored(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1", "exact_exposure_match_rate")})


@query
def alerts(spark, d):
    hot, versions = _stored(spark, d)
    serving = served(spark, d).serving
    backlog, parts = serving.dirty().count(), max(n for name, n, _ in serving.storage() if name.startswith("lake_"))
    return reports.alerts(versions, serving.snapshots(), hot.exposures, backlog, parts).withColumn("value", F.round("value", 4))


def _bounds(spark, d):
    """Midnight of the first day of the events."""
    import datetime as dt

    first = spark.read.parquet(f"{d}/events.parquet").agg(F.min(F.to_date("ts")).alias("d")).first()["d"]
    return dt.datetime.combine(first, dt.time(), dt.UTC)


def _days_from(spark, d, *offsets: int):
    import datetime as dt

    return [(_bounds(spark, d) + dt.timedelta(days=k)).date() for k in offsets]


@query
def lever_date_slice(spark, d):
    """All versions of one day: from the days' folders of the lake alone."""
    rows = served(spark, d).attributed.for_days(_days_from(spark, d, 9, 40))
    return rows.where("attributed").agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("revenue")).alias("revenue"))


@query
def lever_latest_agg(spark, d):
    versions = served(spark, d).attributed.read()
    rows = collapse_versions(versions.select("conversion_id", "revenue", "attributed", "processed_at"), ["conversion_id"], "processed_at")
    return rows.where("attributed").agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("revenue")).alias("revenue"))


@query
def lever_equality(spark, d):
    shown = served(spark, d).hot.exposures
    one = lambda name, where: shown.where(where).agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("spend")).alias("spend")).select(F.lit(name).alias("filter"), "n", "spend")
    return one("genre", "program_genre = 'sports'").unionByName(one("ip", "ip = '10-7'"))


@query
def lever_wide_read(spark, d):
    """The filter and the five columns reach the Parquet scan."""
    rows = served(spark, d).hot.attributed.where("attributed")
    size = lambda c, name: F.sum(F.char_length(c)).alias(name)
    return rows.agg(F.count(F.lit(1)).alias("n"), size("device_id", "device_chars"), size("ip", "ip_chars"), size("order_id", "order_chars"), size(F.array_join("assists", ""), "assist_chars"))


@query
def busiest_ip(spark, d):
    return served(spark, d).hot.exposures.groupBy("ip").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ip").limit(1)


@query
def exposures_by_household(spark, d):
    shown = domain(spark, d).exposures.distinct()
    wanted = shown.where("campaign_id = 'camp-03' and app_id = 'app-1'").select("household_id").distinct()
    return shown.join(wanted, "household_id", "left_semi").groupBy("household_id").agg(F.count(F.lit(1)).alias("n"), micros(F.min("event_time")).alias("first_us"), micros(F.max("event_time")).alias("last_us"))


@query
def lake_household_range(spark, d):
    """Some households' exposures of days 3 to 12, by bucket and day."""
    import datetime as dt

    s, first = served(spark, d), _bounds(spark, d)
    homes = s.hot.exposures.where("campaign_id = 'camp-03' and app_id = 'app-1'")
    shown = s.exposures.for_households(homes, first + dt.timedelta(days=3), first + dt.timedelta(days=13))
    return shown.groupBy("household_id").agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("spend")).alias("spend"))


@query
def lake_days_exposures(spark, d):
    """Two days' exposures, and those of no days."""
    s = served(spark, d)
    one = lambda rows, name: rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(exact_sum(F.col("spend")), F.lit(0.0)).alias("spend")).select(F.lit(name).alias("days"), "n", "spend")
    return one(s.exposures.for_days(_days_from(spark, d, 2, 5)), "two").unionByName(one(s.exposures.for_days([]), "none"))


@query
def lake_current_days(spark, d):
    """Current rows of three days."""
    return _decisions(served(spark, d).attributed.current(_days_from(spark, d, 1, 4, 8)))


@query
def lake_known_days(spark, d):
    s = served(spark, d)
    return spark.createDataFrame([(str(x),) for x in lake_days(s.exposures, s.attributed)], "day string").orderBy("day")


@query
def lake_day_counts(spark, d):
    s = served(spark, d)
    days = s.exposures.read().select("event_day").unionByName(s.hot_only.read().select("event_day"))
    return days.groupBy(F.col("event_day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query
def lake_reconciled(spark, d):
    """Corrections as the lake holds them, found bucket by bucket."""
    return _decisions(served(spark, d).attributed.read().where("path = 'reconciled'"))


def _copy(spark, d, name: str) -> tuple[Served, LakeTable]:
    """A copy of the attributed table in two commits, for what changes a table."""
    import uuid

    s = served(spark, d)
    table = LakeTable(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", s.attributed.schema)
    for part in ("hot", "reconciled"):
        table.append(s.attributed.read().where(F.col("path") == part).drop(*LAYOUT))
    return s, table


@query
def lake_compacted(spark, d):
    """After a compaction each day lies in one commit and no row has changed."""
    _, table = _copy(spark, d, "compacted")
    table.compact()
    commits = spark.createDataFrame([(day, n) for day, n, _, _ in table.storage()], "day string, commits long")
    return table.read().groupBy(F.col("event_day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("rows")).join(commits, "day")


@query
def lake_migrated(spark, d):
    """A copy under a changed schema."""
    import uuid

    s = served(spark, d)
    new = s.exposures.migrate(f"{shared_dir(spark)}/migrated-{uuid.uuid4().hex}", lambda x: x.selectExpr("* except (spend)", "spend * 2 as spend", "'v2' as note"))
    return new.read().groupBy("note", "campaign_id").agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("spend")).alias("spend"))


def _fresh(spark, d, days) -> Serving:
    import uuid

    s = served(spark, d)
    return Serving(spark, f"{shared_dir(spark)}/serving-{uuid.uuid4().hex}", s.exposures, s.attributed, s.serving.calendar)


@query
def serving_loaded_days(spark, d):
    """Two days loaded into empty serving tables, one of them twice: rows and dirty keys."""
    days = _days_from(spark, d, 10, 11)
    new = _fresh(spark, d, days)
    new.load(days)
    new.load_day(days[0])
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
    return one(new.exposures(), "exposures_landed").unionByName(one(new.attributed(), "attributed_conversions")).unionByName(one(new.dirty(), "dirty"))


@query
def serving_reloaded(spark, d):
    """All derived tables emptied and loaded again from the lake, then merged: the rollup."""
    new = _fresh(spark, d, None)
    new.rebuild()
    new.rebuild()
    new.merge()
    return _hourly(new.rollup())


@query
def serving_finalized(spark, d):
    """The day-wise path by hand: load the hot days, finalize twice; the rollup's changed keys and the days corrected."""
    import uuid

    s = served(spark, d)
    path = f"{shared_dir(spark)}/finalized-{uuid.uuid4().hex}"
    table = LakeTable(spark, path, s.attributed.schema)
    table.append(s.hot_only.read().drop(*LAYOUT))
    new = Serving(spark, f"{path}-serving", s.exposures, table, s.serving.calendar)
    new.load(lake_days(s.exposures, table))
    first, again = new.finalize(), new.finalize()
    rows = [(str(x), 1) for x in first] + [(str(x), 2) for x in again]
    return spark.createDataFrame(rows, "day string, pass int")


@query
def serving_decisions(spark, d):
    rows = served(spark, d).serving.decisions()
    return rows.withColumn("assists", joined(F.col("assists")))


@query
def serving_credited(spark, d):
    s = served(spark, d).serving
    homes = s.exposure_households().withColumnRenamed("household_id", "exposure_household")
    return s.credited().join(homes, "exposure_id")


@query
def serving_marker(spark, d):
    """The marker that scoring checks first."""
    serving = served(spark, d).serving
    serving.check_marker(d)
    return spark.createDataFrame([(serving.marker() == d,)], "right boolean")


@query
def rollup_report_stored(spark, d):
    return _metrics(reports.report_from_rollup(served(spark, d).serving.rollup()))


@query
def rollup_for_keys(spark, d):
    """Some keys of the rollup, given as a list of campaign and epoch seconds."""
    first = int(_bounds(spark, d).timestamp())
    keys = key_rows(spark, [(f"camp-{c:02d}", first + h * 3600) for c in range(5) for h in range(24, 72, 5)])
    hot, versions = _stored(spark, d)
    return _hourly(hourly(hot.exposures, versions, keys))


@query
def touched_days(spark, d):
    """Days of the conversions corrected, and of the exposures that they were credited to."""
    s = served(spark, d)
    rows = s.attributed.read().where("path = 'reconciled'")
    shown = s.hot.exposures.select("exposure_id", F.to_date("event_time").alias("day"))
    days = rows.select(F.to_date("event_time").alias("day")).union(rows.join(shown, "exposure_id").select("day")).distinct()
    return days.select(F.col("day").cast("string").alias("day")).orderBy("day")


@query
def query_cost(spark, d):
    """Three report queries, run and priced from the metrics of their tasks."""
    import uuid

    s = served(spark, d)
    runs = {
        "report": lambda: reports.report(s.hot.exposures, s.versions), "report_rollup": lambda: reports.report_from_rollup(s.serving.rollup()),
        "restatement": lambda: reports.restatement(s.serving.snapshots()),
    }
    log = cost.logged(spark, runs, f"{shared_dir(spark)}/log-{uuid.uuid4().hex}", times=2)
    priced = cost.costs(log, 0.5)
    last = cost.last_run(log, "report").select("query_tag", F.lit(True).alias("logged_last"))
    right = F.abs(F.col("usd") - 0.5 * F.col("cpu_seconds")) < 1e-9
    out = priced.join(last, "query_tag", "left")
    return out.select("query_tag", (F.col("read_rows") > 0).alias("read"), (F.col("cpu_seconds") > 0).alias("ran"), right.alias("priced"), F.coalesce("logged_last", F.lit(False)).alias("logged_last"))


@query
def storage_state(spark, d):
    """Commits of the lake's tables on their most divided day, and how many a compaction would take away."""
    return spark.createDataFrame([x for x in served(spark, d).serving.storage() if x[0].startswith("lake_")], "table string, parts long, unmerged long")


def _results(spark, d):
    """A table of evaluation results, made of the events by rule."""
    e = spark.read.parquet(f"{d}/events.parquet")
    kind = "if(event_type in ('view', 'click'), 'control', 'lift')"
    return e.selectExpr("event_type scenario", f"{kind} kind", "element_at(array('correct', 'correct_silence', 'false_positive', 'miss'), cast(event_id % 4 as int) + 1) outcome", "element_at(array('yes', 'no', 'abstain'), cast(event_id % 3 as int) + 1) verdict")


@query
def eval_results(spark, d):
    return eval_spread(_results(spark, d))


@query
def eval_false_positives(spark, d):
    return false_positive_rate(_results(spark, d))


@query
def attribution_context(spark, d):
    """The nested context, its numbers listed by section, row and name."""
    hot, versions = _stored(spark, d)
    c = reports.context(hot.exposures, versions, served(spark, d).serving.snapshots())
    keys = {"match_rate": "day", "window_edge": "bin", "ip_clusters": None, "ip_top": "ip", "genres": "genre", "campaigns": "campaign", "restatements": "campaign_id"}
    out = None
    for section, key in keys.items():
        item = c.select(F.explode(section).alias("i")).select("i.*")
        names = [n for n in item.columns if n != key]
        listed = item.select(F.lit(section).alias("section"), (F.col(key).cast("string") if key else F.lit("all")).alias("row"), F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.round(F.col(n).cast("double"), 4).alias("value")) for n in names))).alias("v")).select("section", "row", "v.name", "v.value")
        out = listed if out is None else out.unionByName(listed)
    return out


def _streamed(spark, d):
    """The keyed streaming operator over the raw exposures, re-sent ones included, from as many files as there are."""
    import uuid

    from .streaming.attribution import run_to_end, tagged

    t = domain(spark, d)
    work = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    tagged(t.exposures, hot_pass(t).one_row).write.parquet(f"{work}/in")
    return run_to_end(spark, f"{work}/in", work)


@query
def streaming_attributed(spark, d):
    return _streamed(spark, d).where("conversion_id is not null").select("conversion_id", "household_id", "exposure_id", joined(F.col("assists")).alias("assists"), "attributed")


@query
def streaming_state(spark, d):
    """What the streaming operator held by household, at most and at the end."""
    return _streamed(spark, d).where("conversion_id is null").select("household_id", "peak", "evicted", "final").where("peak > 0")
