"""Named, parameterised probes: SQL text with bound parameters, never spliced."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.versions import current, current_exposures
from .reports import restatement


@dataclass(frozen=True)
class Probe:
    name: str
    description: str
    sql: str
    parameters: tuple[str, ...] = field(default=())


_CREDITS = "current_rows a join shown e on a.exposure_id = e.exposure_id where a.attributed"
PROBES = {p.name: p for p in (
    Probe("ip_cluster_detail", "households credited through one address", "select household_id, count(*) attributed_conversions, max(candidate_count) max_candidate_count from current_rows where attributed and resolution = 'ip' and ip = :ip group by household_id order by attributed_conversions desc, household_id", ("ip",)),
    Probe("campaign_attributed_by_day", "one campaign's credited conversions by day", f"select cast(to_date(a.event_time) as string) day, count(*) attributed, cast(sum(cast(cast(a.revenue as string) as decimal(18,4))) as double) revenue from {_CREDITS} and e.campaign_id = :campaign_id group by 1 order by day", ("campaign_id",)),
    Probe("campaign_restatement", "one campaign, as reported and now", "select * from restated where campaign_id = :campaign_id", ("campaign_id",)),
    Probe("window_edge_distribution", "days between exposure and credited conversion", f"select (unix_seconds(a.event_time) - unix_seconds(e.event_time)) div 86400 day_bucket, count(*) n from {_CREDITS} and a.path = 'hot' and a.event_time >= e.event_time group by 1 order by 1"),
    Probe("genre_reach_detail", "exposures and credited conversions of one genre", f"select (select count(*) from shown where program_genre = :genre) exposures, (select count(*) from {_CREDITS} and e.program_genre = :genre) attributed_conversions", ("genre",)),
)}


def probe(name: str, exposures: DataFrame, attributed: DataFrame, snapshots: DataFrame | None = None, **parameters: str) -> DataFrame:
    """Runs a probe; unknown names and wrong parameters are refused."""
    if name not in PROBES:
        raise KeyError(f"no probe {name!r}; there are {', '.join(sorted(PROBES))}")
    found = PROBES[name]
    if set(parameters) != set(found.parameters):
        raise ValueError(f"{name} takes {found.parameters}, not {tuple(parameters)}")
    spark = exposures.sparkSession
    views = {"current_rows": current(attributed), "shown": current_exposures(exposures)}
    if snapshots is not None:
        views["restated"] = restatement(snapshots)
    sql = found.sql
    for view in views:
        sql = sql.replace(f"from {view} ", f"from {{{view}}} ").replace(f"join {view} ", f"join {{{view}}} ")
    used = {k: v for k, v in views.items() if f"{{{k}}}" in sql}
    return spark.sql(sql, args=parameters or None, **used)
