"""Seeded simulations end to end: credited, true and correct links before and after reconciliation."""

import pytest

from afterview.operators.accuracy import accuracy
from afterview.plans import reports
from afterview.plans.passes import full_pass, hot_pass, snapshots
from afterview.sources.generate import simulated

#: Credited, true, correct (hot), then the same after reconciliation.
PINS = {"tiny": ((47, 35, 32), (52, 35, 35)), "medium": ((129, 92, 91), (130, 92, 92)), "long_delay": ((80, 75, 44), (112, 75, 73)), "shared_ip_spike": ((94, 80, 61), (119, 80, 69)), "late_burst": ((93, 68, 62), (108, 68, 68))}


@pytest.mark.parametrize("profile", PINS)
def test_pinned_counts(spark, profile):
    tables = simulated(spark, profile)
    hot, versions = full_pass(tables)
    for rows, pin in zip((hot.attributed, versions), PINS[profile], strict=True):
        r = accuracy(rows, tables.truth, hot.exposures).first()
        assert (r["credited"], r["truth_links"], r["household_correct"]) == pin
    if profile == "shared_ip_spike":
        assert r["caused_wrong_household"] == 11


def test_tiny_report_grid_and_resolution(spark):
    tables = simulated(spark, "tiny")
    hot = hot_pass(tables)
    grid = [(r["campaign"], round(r["spend"], 2), r["exposures"], r["conversions"], r["purchases"], round(r["revenue"], 2), round(r["roas"], 4), round(r["cpa"], 4), round(r["cvr"], 4), round(r["site_visit_rate"], 4)) for r in reports.report(hot.exposures, hot.attributed).collect()]
    assert grid == [
        ("camp-00", 4.48, 47, 15, 7, 431.99, 96.4263, 0.64, 0.3191, 0.1702),
        ("camp-01", 4.86, 56, 22, 8, 592.95, 122.0062, 0.6075, 0.3929, 0.25),
        ("camp-02", 4.36, 47, 10, 4, 268.05, 61.4794, 1.09, 0.2128, 0.1277),
    ]
    counts = {(r["resolution"], r["ambiguous"]): r["count"] for r in hot.resolved.groupBy("resolution", "ambiguous").count().collect()}
    assert tables.conversions.count() == 62 and sum(counts.values()) <= 68
    assert {r["reason"]: r["count"] for r in hot.attributed.where("not attributed").groupBy("reason").count().collect()} == {"ambiguous_ip": 5, "state_miss": 3}


def test_snapshots_restate_and_repeat(spark):
    tables = simulated(spark, "long_delay")
    hot, versions = full_pass(tables)
    first = snapshots(hot, versions)
    rows = reports.restatement(first).collect()
    assert all(r["conversions_now"] >= r["conversions_as_reported"] for r in rows) and any(r["roas_delta"] > 0 for r in rows)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, snapshots(hot, versions).collect()))
    assert first.select("snapshot_version").distinct().count() == 2
