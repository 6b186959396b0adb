"""The lake, files, streaming and the driver contract."""

import datetime as dt
from pathlib import Path

import pytest

from afterview.operators.rollup import changed_keys, hourly
from afterview.plans.passes import full_pass, hot_pass, incremental, reconcile_lake
from afterview.plans.probes import probe
from afterview.plans.serving import ProfileMismatch, Serving, UnknownDay
from afterview.schemas import ATTRIBUTED, CONVERSION, EXPOSURE
from afterview.sources.files import PoisonedInput, compacted, read_strict, write_canonical
from afterview.sources.generate import simulated
from afterview.sources.lake import EmptyLake, LakeTable, LayoutMismatch, lake_days


@pytest.fixture(scope="module")
def tables(spark):
    return simulated(spark, "long_delay")


def test_lake_reconciles_in_place_and_once(spark, tables, tmp_path):
    hot = hot_pass(tables)
    shown, rows = LakeTable(spark, f"{tmp_path}/exposures", EXPOSURE), LakeTable(spark, f"{tmp_path}/attributed", ATTRIBUTED)
    with pytest.raises(EmptyLake):
        rows.rebuild(f"{tmp_path}/serving")
    days = shown.append(hot.exposures)
    rows.append(hot.attributed)
    assert lake_days(shown) == days == shown.days()
    assert shown.for_days([]).isEmpty() and shown.for_days(days).count() == hot.exposures.count()
    assert reconcile_lake(shown, rows) and reconcile_lake(shown, rows) == []
    want = {r["conversion_id"]: r["exposure_id"] for r in full_pass(tables)[1].where("attributed").collect()}
    assert {r["conversion_id"]: r["exposure_id"] for r in rows.current().where("attributed").collect()} == want
    before = sorted(map(str, rows.read().drop("household_bucket").collect()))
    assert rows.compact() > 0 and rows.compact() == 0
    assert sorted(map(str, rows.read().drop("household_bucket").collect())) == before
    assert rows.vacuum() == 0 and {c for _, c, _, _ in rows.storage()} == {1}
    assert rows.rebuild(f"{tmp_path}/serving").count() == hot.attributed.count()
    with pytest.raises(LayoutMismatch):
        LakeTable(spark, f"{tmp_path}/exposures", EXPOSURE, buckets=4)
    start = dt.datetime(2026, 8, 3, tzinfo=dt.UTC)
    one = shown.for_households(hot.exposures.where("household_id = 'h-0003'"), start, start + dt.timedelta(days=2))
    assert one.count() == hot.exposures.where("household_id = 'h-0003' and event_time >= '2026-08-03' and event_time < '2026-08-05'").count()
    more = rows.migrate(f"{tmp_path}/v2", lambda d: d.selectExpr("*", "cast(null as string) note"))
    assert more.read().count() == rows.read().count()


def test_pruning_reaches_the_scan(spark, tables, tmp_path):
    table = LakeTable(spark, f"{tmp_path}/t", EXPOSURE)
    table.append(tables.exposures)
    files = table.for_days([dt.date(2026, 8, 2)]).inputFiles()
    assert files and all("event_day=2026-08-02" in f for f in files) and len(files) < len(table.read().inputFiles())
    plan = table.read().where("spend > 0.2").select("campaign_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(spend,0.2)" in plan and "ReadSchema: struct<campaign_id:string,spend:double>" in plan


def test_a_crash_leaves_the_table_as_it_was(spark, tables, tmp_path, monkeypatch):
    """A commit without a manifest does not count, before or after a compaction, and vacuum removes it."""
    table = LakeTable(spark, f"{tmp_path}/t", EXPOSURE)
    table.append(tables.exposures)
    table.append(tables.exposures.limit(50))
    before = sorted(map(str, table.read().collect()))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(LakeTable, "_publish", crash)
        for step in (lambda: table.append(tables.exposures), table.compact):
            with pytest.raises(OSError):
                step()
    again = LakeTable(spark, f"{tmp_path}/t", EXPOSURE)
    assert sorted(map(str, again.read().collect())) == before
    assert again.vacuum() > 0 and sorted(map(str, again.read().collect())) == before
    assert again.compact() > 0 and sorted(map(str, again.read().collect())) == before and again.compact() == 0


def test_serving_loads_reloads_and_refuses(spark, tables, tmp_path):
    hot = hot_pass(tables)
    shown, rows = LakeTable(spark, f"{tmp_path}/e", EXPOSURE), LakeTable(spark, f"{tmp_path}/a", ATTRIBUTED)
    new = Serving(spark, f"{tmp_path}/s", shown, rows)
    with pytest.raises(EmptyLake):
        new.rebuild()
    days = sorted({*shown.append(hot.exposures), *rows.append(hot.attributed)})
    new = Serving(spark, f"{tmp_path}/s", shown, rows, (days[0], days[-1]))
    with pytest.raises(UnknownDay):
        new.load([days[0], days[-1] + dt.timedelta(days=1)])
    with pytest.raises(ProfileMismatch):
        new.check_marker("long_delay")
    new.mark("long_delay")
    new.check_marker("long_delay")
    with pytest.raises(ProfileMismatch):
        new.check_marker("tiny")
    got = new.load(days[::-1])
    assert got["exposures"] == hot.exposures.count() and got["attributed"] == hot.attributed.count() and got["rollup_keys"] > 0
    for day in days[:3]:
        assert new.load_day(day)["rollup_keys"] == 0  # nothing moved
    numbers = ("campaign_id", "hour", "spend", "exposures", "attributed_conversions", "purchases", "revenue")
    same = lambda a, b: sorted(map(str, a.select(*numbers).collect())) == sorted(map(str, b.select(*numbers).collect()))
    assert same(new.rollup(), hourly(hot.exposures, hot.attributed))
    assert new.finalize() and new.dirty().isEmpty()
    _, versions = full_pass(tables)
    full = hourly(hot.exposures, versions)
    assert same(new.rollup(), full)
    taken = sorted(map(str, new.snapshots().collect()))
    assert new.finalize() == [] and same(new.rollup(), full) and sorted(map(str, new.snapshots().collect())) == taken
    new.merge()
    assert same(new.rollup(), full) and dict((n, p) for n, p, _ in new.storage())["campaign_hourly"] == 1
    new.rebuild()
    assert same(new.rollup(), full) and sorted(map(str, new.snapshots().collect())) == taken and new.marker() is None
    assert new.credited().count() == new.decisions().where("attributed").count() > 0


def test_costs_come_from_the_metrics_and_the_rate(spark, tables, tmp_path, monkeypatch):
    from afterview.plans import cost

    tables.exposures.write.parquet(f"{tmp_path}/e")
    read = lambda: spark.read.parquet(f"{tmp_path}/e").groupBy("campaign_id").count()
    log = cost.logged(spark, {"a": read, "b": lambda: read().where("count > 1")}, f"{tmp_path}/log", times=3)
    first = cost.last_run(log, "a").first()
    log = cost.logged(spark, {"a": read}, f"{tmp_path}/log")
    assert cost.last_run(log, "a").first()["event_time"] > first["event_time"] and log.count() == 3
    monkeypatch.setenv("COST_USD_PER_CPU_SECOND", "2.5")
    rows = {r["query_tag"]: r for r in cost.costs(log).collect()}
    last = cost.last_run(log, "a").first()
    assert set(rows) == {"a", "b"} and rows["a"]["read_rows"] == tables.exposures.count()
    assert rows["a"]["cpu_seconds"] == last["events"]["executor_cpu_us"] / 1e6 > 0 and rows["a"]["usd"] == pytest.approx(2.5 * rows["a"]["cpu_seconds"])


def test_produce_writes_all_or_nothing(spark, tables, tmp_path):
    from afterview.schemas import violations
    from afterview.sources.files import produce

    n = produce(tables.conversions, f"{tmp_path}/in", CONVERSION, violations)
    assert n == read_strict(spark, f"{tmp_path}/in", CONVERSION, CONVERSION.names).count()
    bad = tables.conversions.withColumn("revenue", tables.conversions["revenue"] - 1e6)
    for wrong in (lambda: produce(bad, f"{tmp_path}/no", CONVERSION, violations), lambda: produce(bad.drop("ip"), f"{tmp_path}/no", CONVERSION)):
        with pytest.raises(PoisonedInput):
            wrong()
    assert not Path(tmp_path, "no").exists()


def test_incremental_rollup_equals_full(spark, tables):
    hot, versions = full_pass(tables)
    keys, refreshed = incremental(hot, versions)
    full = hourly(hot.exposures, versions)
    assert changed_keys(refreshed, full).isEmpty()
    assert 0 < keys.count() < full.count()


def test_probes_bind_and_refuse(spark, tables):
    hot, versions = full_pass(tables)
    assert probe("genre_reach_detail", hot.exposures, versions, genre="x' or '1'='1").first()["exposures"] == 0
    with pytest.raises(ValueError):
        probe("ip_cluster_detail", hot.exposures, versions)
    with pytest.raises(KeyError):
        probe("nothing", hot.exposures, versions)


def test_strict_lines_round_trip(spark, tables, tmp_path):
    write_canonical(tables.conversions, f"{tmp_path}/c")
    back = read_strict(spark, f"{tmp_path}/c", CONVERSION, CONVERSION.names)
    assert sorted(map(str, back.collect())) == sorted(map(str, tables.conversions.collect()))
    for line in ("not json", '{"conversion_id": "c", "surprise": 1}', '{"conversion_id": "c"}'):
        Path(tmp_path, "bad.jsonl").write_text(line + "\n")
        with pytest.raises(PoisonedInput):
            read_strict(spark, f"{tmp_path}/bad.jsonl", CONVERSION, CONVERSION.names)
    log = spark.createDataFrame([("a", 1, 1), ("a", 2, 9), ("b", 1, 5)], "k string, at int, v int")
    assert sorted(map(tuple, compacted(log, "k", "at").select("k", "v").collect())) == [("a", 9), ("b", 5)]


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DATA).exists(), reason="no driver tables")
@pytest.mark.parametrize("name", ["report_post", "current_rows", "join_state", "rollup_hourly", "dirty_keys", "accuracy_post", "genre_reach"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.sql(f"create view events as select * from '{DATA}/events.parquet'")
    got = entry.queries()[name](spark, DATA).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda d: sorted(str([None if x != x else round(float(x), 6) if isinstance(x, float) else x if isinstance(x, str) or x is None else int(x) for x in r]) for r in d[sorted(d.columns)].itertuples(index=False))
    assert key(got) == key(want)
