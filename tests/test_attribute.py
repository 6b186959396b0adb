"""Hand-built cases of resolution, attribution and reconciliation."""

import datetime as dt

import pytest

from afterview.operators import attribute as att
from afterview.operators.reconcile import open_rows, recover
from afterview.operators.resolve import one_per_conversion, resolve
from afterview.operators.versions import current, first_arrivals
from afterview.schemas import ATTRIBUTED, CONVERSION, EXPOSURE, GRAPH, RESOLVED, backward_compatible, columns, violations

T0 = dt.datetime(2026, 8, 1, tzinfo=dt.UTC)


def at(hours: float) -> dt.datetime:
    return T0 + dt.timedelta(hours=hours)


def exp(spark, *rows):
    """(id, hour, arrival or None, household)"""
    return spark.createDataFrame([(i, at(t), at(t if g is None else g), "camp-0", h, "ip", "app", "news", 1.0) for i, t, g, h in rows], EXPOSURE)


def res(spark, *rows):
    """(id, hour, arrival or None, household, candidates)"""
    return spark.createDataFrame([(i, at(t), at(t if g is None else g), "d", "ip", "purchase", 5.0, "o", h, "device", n > 1, n) for i, t, g, h, n in rows], RESOLVED)


def decided(df):
    return {r["conversion_id"]: (r["exposure_id"], r["assists"], r["reason"]) for r in df.collect()}


def both(spark, e, r):
    one = one_per_conversion(r)
    return decided(att.attribute(e, one)), decided(att.engine(e, one))


def test_window_is_inclusive_on_both_ends(spark):
    e = exp(spark, ("e0", 0, None, "h"), ("e1", 168, None, "h"))
    for got in both(spark, e, res(spark, ("a", 168, None, "h", 1), ("b", 168.001, None, "h", 1), ("c", -0.001, None, "h", 1))):
        assert got["a"] == ("e1", ["e0"], None)
        assert got["b"] == ("e1", [], None)
        assert got["c"] == (None, [], "state_miss")


def test_ties_go_to_the_greater_id_and_a_resent_winner_is_no_assist(spark):
    e = exp(spark, ("e1", 1, None, "h"), ("e2", 1, None, "h"), ("e2", 1, None, "h"))
    assert decided(att.attribute(e, one_per_conversion(res(spark, ("a", 2, None, "h", 1)))))["a"] == ("e2", ["e1"], None)


def test_ambiguous_rows_are_not_guessed(spark):
    e = exp(spark, ("e1", 1, None, "h1"), ("e2", 1.5, None, "h2"))
    r = res(spark, ("a", 2, None, "h1", 2), ("a", 2, None, "h2", 2))
    for got in both(spark, e, r):
        assert got["a"] == (None, [], "ambiguous_ip")
    hot = att.attribute(e, one_per_conversion(r))
    assert hot.first()["candidate_households"] == ["h1", "h2"] and hot.first()["household_id"] == "h1"
    assert violations(hot).isEmpty()
    got = recover(hot, e).first()
    assert (got["household_id"], got["exposure_id"], got["path"]) == ("h2", "e2", "reconciled")


def test_late_exposures_wait_within_the_grace_and_miss_beyond(spark):
    """An exposure that arrives 5 h late is still seen; one that comes after the release is a miss."""
    later = ("x", 30, None, "h", 1)
    e = exp(spark, ("e1", 1, 6, "h"))
    assert both(spark, e, res(spark, ("a", 2, None, "h", 1), later))[1]["a"] == ("e1", [], None)
    e = exp(spark, ("e1", 1, 40, "h"))
    plain, exact = both(spark, e, res(spark, ("a", 2, None, "h", 1), later))
    assert plain["a"] == ("e1", [], None) and exact["a"] == (None, [], "state_miss")


def test_eviction_is_strict_and_after_release(spark):
    """At watermark = exposure + window the exposure is still there; a tick later it is gone."""
    e = exp(spark, ("e0", 0, None, "h"), ("e1", 174, None, "h"), ("e2", 175, None, "h"))
    one = one_per_conversion(res(spark, ("a", 168, None, "h", 1)))
    assert decided(att.engine(e, one))["a"][0] == "e0"
    state = att.join_state(e, one).first()
    assert (state["peak"], state["evicted"], state["final"]) == (2, 1, 2)


def test_reconciliation_reaches_90_days_and_is_a_no_op_after(spark):
    e = exp(spark, ("e0", 0, None, "h"), ("e1", 0, None, "g"))
    hot = att.attribute(e, one_per_conversion(res(spark, ("a", 90 * 24, None, "h", 1), ("b", 90 * 24 + 0.01, None, "g", 1))))
    found = recover(hot, e)
    assert [r["conversion_id"] for r in found.collect()] == ["a"]
    every = hot.unionByName(found)
    assert recover(every, e).isEmpty()
    assert [r["conversion_id"] for r in open_rows(every).collect()] == ["b"]
    assert {r["conversion_id"]: r["path"] for r in current(every).collect()} == {"a": "reconciled", "b": "hot"}


def test_resolution(spark):
    graph = spark.createDataFrame([("h1", [("d1", "tv"), ("dd", "phone")], ["i1", "s"]), ("h2", [("d2", "tv"), ("dd", "phone")], ["i2", "s"])], GRAPH).selectExpr("*", "if(household_id = 'h1', 0, 1) seen_at")
    rows = [("a", "d1", "i2"), ("b", "dd", "i1"), ("c", "?", "i1"), ("d", "?", "s"), ("e", "?", "nobody")]
    got = resolve(spark.createDataFrame([(c, T0, T0, d, i, "purchase", 1.0, "o") for c, d, i in rows], CONVERSION), graph)
    assert sorted((r["conversion_id"], r["household_id"], r["resolution"], r["candidate_count"]) for r in got.collect()) == [("a", "h1", "device", 1), ("b", "h2", "device", 1), ("c", "h1", "ip", 1), ("d", "h1", "ip", 2), ("d", "h2", "ip", 2)]
    assert first_arrivals(got.unionByName(got), ["conversion_id", "household_id"]).count() == 5


def test_contracts(spark):
    rows = res(spark, ("a", 1, None, "h", 1)).selectExpr("*", "cast(null as string) exposure_id", "array() assists", "true attributed", "'hot' path", "ingest_time processed_at", "'ambiguous_ip' reason", "array('x') candidate_households")
    assert [r["violation"] for r in violations(rows.select(*ATTRIBUTED.names)).collect()] == ["candidates of a certain row"]
    assert backward_compatible(CONVERSION, columns("extra string", CONVERSION))
    assert not backward_compatible(columns("revenue string"), CONVERSION)


@pytest.mark.parametrize("seed", range(3))
def test_the_window_form_equals_a_search_for_each_conversion(spark, seed):
    """By definition: the release of each conversion is looked for among the arrivals of its household."""
    import random

    rng = random.Random(seed)
    e, r = [], []
    for i in range(150):
        home, t = f"h{rng.randrange(4)}", round(rng.uniform(0, 600), 2)
        g = t + (rng.uniform(0, 0.1) if rng.random() < 0.7 else rng.uniform(0, 400))
        (e if rng.random() < 0.6 else r).append((f"{'e' if len(e) + len(r) == i else 'x'}{i:03d}", t, g, home))
    shown, asked = exp(spark, *e), one_per_conversion(res(spark, *((*c, 1) for c in r)))
    want = {}
    for name, t, _, home in r:
        line = sorted([(x[2], 0, x[0], x[1]) for x in e if x[3] == home] + [(x[2], 1, x[0], x[1]) for x in r if x[3] == home])
        mark = [max(x[3] for x in line[: k + 1]) - 6 for k in range(len(line))]
        own = next(k for k, x in enumerate(line) if x[2] == name)
        tick = next((k for k in range(own, len(line)) if mark[k] >= t), None)
        there = [
            (u, n) for k, (_, kind, n, u) in enumerate(line)
            if not kind and t - 168 <= u <= t + 1e-9 and (tick is None or k <= tick) and not any(mark[j] > u + 168 for j in range(k, len(line) if tick is None else tick))
        ]
        want[name] = max(there)[1] if there else None
    assert {c: x[0] for c, x in decided(att.engine(shown, asked)).items()} == want
