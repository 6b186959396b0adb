"""The streaming operator: many files, several triggers, re-sent rows; and its settling against plain search."""

import random

import numpy as np
import pytest

from afterview.operators import attribute as att
from afterview.plans.passes import hot_pass
from afterview.sources.generate import simulated
from afterview.streaming.attribution import END, NO_MARK, Progress, run_to_end, settle, tagged


@pytest.mark.parametrize("seed", range(30))
def test_settling_in_parts_equals_a_search_for_each_conversion(seed):
    """Each release is found by looking at every arrival; the state may be cut anywhere."""
    rng = random.Random(seed)
    n, window, lateness = rng.randrange(1, 40), 20, 5
    kinds = np.array([rng.choice(["exp", "res"]) for _ in range(n - 1)] + [END], object)
    times = np.array([max(0, int(i * 2 + rng.uniform(-25, 3))) for i in range(n)], np.int64)
    ids, sure = np.array([f"r{i:02d}" for i in range(n)], object), np.array([rng.random() < 0.9 for _ in range(n)])
    mark = [max(int(t) - lateness for t, k in zip(times[: i + 1], kinds) if k != END) if i < n - 1 or n > 1 else NO_MARK for i in range(n)]
    gone = {i: next((k for k in range(i, n) if mark[k] > times[i] + window), n) for i in range(n) if kinds[i] == "exp"}
    want = {}
    for c in np.flatnonzero(kinds == "res"):
        tick = next(k for k in range(c, n) if mark[k] >= times[c] or kinds[k] == END)
        own = sorted((times[i], ids[i]) for i, k in gone.items() if i <= tick <= k and times[c] - window <= times[i] <= times[c]) if sure[c] else []
        want[ids[c]] = (own[-1][1] if own else None, sorted(i for _, i in own[:-1]))
    live = [sum(i <= k < g for i, g in gone.items()) for k in range(n)]
    for cuts in ([], sorted(rng.sample(range(n), min(n, 4)))):
        held, waiting, at, got, peak, evicted, state = [], [], 0, {}, 0, 0, NO_MARK
        for to in [*cuts, n]:
            s = settle(kinds[at:to], ids[at:to], times[at:to], sure[at:to], held, waiting, state, window, lateness)
            held, waiting, state, at = s.held, s.waiting, s.mark, to
            got |= {c: (best, assists) for c, best, assists in s.decisions}
            peak, evicted = max(peak, int(s.live.max(initial=0))), evicted + s.evicted
        assert got == want and not waiting
        assert (peak, evicted, len(held)) == (max(live), sum(g < n for g in gone.values()), live[-1])


@pytest.mark.parametrize("per_trigger", [None, 4])
def test_many_files_in_any_order(spark, tmp_path, per_trigger):
    """Twenty files; in several triggers, the files being out of order by up to the disorder allowed."""
    tables = simulated(spark, "long_delay")
    hot = hot_pass(tables)
    disorder = 30 * 86400 if per_trigger else 6 * 3600
    rows = tagged(tables.exposures, hot.one_row.unionByName(hot.one_row), disorder)  # re-sent rows included
    if per_trigger is None:
        rows.repartition(20).write.parquet(f"{tmp_path}/in")
    else:
        import os

        held = rows.toPandas().sort_values("ingest_us", kind="stable").reset_index(drop=True)
        rng, cut = random.Random(1), np.array_split(np.arange(len(held)), 20)
        for k in range(0, 18, 3):  # neighbours change places
            cut[k], cut[k + 2] = cut[k + 2], cut[k]
        for k, part in enumerate(cut):
            at = part.tolist()
            rng.shuffle(at)
            spark.createDataFrame(held.iloc[at], rows.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            for f in (tmp_path / "in").glob("part-*"):
                if f.stat().st_mtime > 1_600_000_000 + 1000:
                    os.utime(f, (1_600_000_000 + k, 1_600_000_000 + k))
    seen = Progress()
    out = run_to_end(spark, f"{tmp_path}/in", str(tmp_path), disorder=disorder, files_per_trigger=per_trigger, progress=seen)
    want = {r["conversion_id"]: (r["exposure_id"], r["assists"]) for r in hot.attributed.collect()}
    decided = out.where("conversion_id is not null").collect()
    assert len(decided) == len(want) and {r["conversion_id"]: (r["exposure_id"], r["assists"]) for r in decided} == want
    state = {r["household_id"]: (r["peak"], r["evicted"], r["final"]) for r in out.where("conversion_id is null").collect()}
    of_batch = {r["household_id"]: (r["peak"], r["evicted"], r["final"]) for r in att.join_state(hot.exposures, hot.one_row).collect()}
    assert {h: s for h, s in state.items() if h in of_batch} == of_batch
    assert sum(r["rows"] for r in seen.rows) >= rows.count() and (per_trigger is None or len(seen.rows) >= 5)
