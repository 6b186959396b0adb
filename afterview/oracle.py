"""DuckDB SQL for the engine's queries, written apart from the engine."""

from __future__ import annotations

PREFIX = """
with ev as (
  select event_id, cast(ts as timestamp) as event_time, user_id, event_type, value, cast(json_extract_string(props, '$.k') as integer) as k,
         cast(ts as timestamp) + to_seconds(case when event_id % 10 = 0 then (event_id % 400) * 60 else event_id % 60 end) as ingest_time
  from events),
exposures as (
  select 'e-' || lpad(cast(event_id as varchar), 9, '0') as exposure_id, event_time, ingest_time, 'camp-' || lpad(cast(k % 5 as varchar), 2, '0') as campaign_id,
         'h-' || lpad(cast(user_id as varchar), 6, '0') as household_id, '10-' || user_id as ip, 'app-' || (k % 3) as app_id,
         case k % 4 when 0 then 'sports' when 1 then 'news' when 2 then 'drama' else 'comedy' end as program_genre, value as spend
  from ev where event_type = 'view'),
conversions as (
  select 'c-' || lpad(cast(event_id as varchar), 9, '0') as conversion_id, event_time, ingest_time,
         case when event_id % 10 < 3 then 'u-' || event_id else 'd-' || user_id end as device_id,
         case when event_id % 4 = 0 then '100-' || (user_id // 3) else '10-' || user_id end as ip,
         case when event_type = 'purchase' then 'purchase' else 'site_visit' end as conversion_type,
         case when event_type = 'purchase' then value else 0.0 end as revenue, case when event_type = 'purchase' then 'o-' || event_id end as order_id, event_id, user_id
  from ev where event_type in ('purchase', 'signup')),
homes as (select distinct user_id, 'h-' || lpad(cast(user_id as varchar), 6, '0') as household_id from ev where user_id % 50 <> 49),
ip_map as (select '10-' || user_id as ip, household_id from homes union all select '100-' || (user_id // 3), household_id from homes),
by_device as (select c.*, h.household_id, 'device' as resolution, 1 as candidate_count from conversions c join homes h on c.device_id = 'd-' || h.user_id),
by_ip as (
  select c.*, m.household_id, 'ip' as resolution, cast(count(*) over (partition by c.conversion_id) as integer) as candidate_count
  from conversions c join ip_map m on c.ip = m.ip where c.conversion_id not in (select conversion_id from by_device)),
resolved as (select * from by_device union all select * from by_ip),
one_row as (select * from resolved where household_id = (select min(r.household_id) from resolved r where r.conversion_id = resolved.conversion_id)),
cands as (select conversion_id, string_agg(household_id, ',' order by household_id) as names from resolved where candidate_count > 1 group by conversion_id),
arr as (
  select household_id as hh, 'exp' as kind, exposure_id as id, event_time as t, ingest_time as g from exposures
  union all select household_id, 'res', conversion_id, event_time, ingest_time from one_row),
a as (
  select *, row_number() over (partition by hh order by g, kind, id) as ix,
         max(t) over (partition by hh order by g, kind, id rows between unbounded preceding and current row) - interval 6 hours as wm from arr),
steps as (select hh, wm, min(ix) as ix from a group by hh, wm),
rel as (
  select a.hh, a.id, a.ix, case when min(s.ix) is null then 4000000000 else greatest(min(s.ix), a.ix) end as rel
  from a left join steps s on s.hh = a.hh and s.wm >= a.t where a.kind = 'res' group by a.hh, a.id, a.ix),
gone as (
  select a.hh, a.id, a.ix, a.t, case when min(s.ix) is null then 4000000000 else greatest(min(s.ix), a.ix) end as gone
  from a left join steps s on s.hh = a.hh and s.wm > a.t + interval 7 days where a.kind = 'exp' group by a.hh, a.id, a.ix, a.t),
pairs_hot as (
  select c.conversion_id, e.t, e.id from one_row c join rel r on r.id = c.conversion_id join gone e on e.hh = c.household_id
  where c.candidate_count = 1 and e.t between c.event_time - interval 7 days and c.event_time and e.ix <= r.rel and e.gone >= r.rel),
pairs_all as (
  select c.conversion_id, e.event_time as t, e.exposure_id as id from one_row c join exposures e on e.household_id = c.household_id
  where c.candidate_count = 1 and e.event_time between c.event_time - interval 7 days and c.event_time),
won_hot as (select conversion_id, max(struct_pack(t := t, id := id)).id as best, list(distinct id) as ids from pairs_hot group by conversion_id),
won_all as (select conversion_id, max(struct_pack(t := t, id := id)).id as best, list(distinct id) as ids from pairs_all group by conversion_id),
hot as (
  select c.*, w.best as exposure_id, coalesce(array_to_string(list_sort(list_filter(w.ids, lambda x: x <> w.best)), ','), '') as assists, w.best is not null as attributed,
         'hot' as path, c.ingest_time as processed_at, case when w.best is not null then null when c.candidate_count > 1 then 'ambiguous_ip' else 'state_miss' end as reason,
         coalesce(k.names, '') as candidate_households
  from one_row c left join won_hot w using (conversion_id) left join cands k using (conversion_id)),
hot_all as (
  select c.*, w.best as exposure_id, coalesce(array_to_string(list_sort(list_filter(w.ids, lambda x: x <> w.best)), ','), '') as assists, w.best is not null as attributed,
         'hot' as path, c.ingest_time as processed_at, case when w.best is not null then null when c.candidate_count > 1 then 'ambiguous_ip' else 'state_miss' end as reason,
         coalesce(k.names, '') as candidate_households
  from one_row c left join won_all w using (conversion_id) left join cands k using (conversion_id)),
rec_at as (select max(g) + interval 1 second as t from (select ingest_time as g from exposures union all select ingest_time from hot)),
asked as (select r.conversion_id, r.household_id, r.event_time from resolved r join hot h using (conversion_id) where not h.attributed),
pairs_rec as (
  select q.conversion_id, q.household_id, e.event_time as t, e.exposure_id as id from asked q join exposures e on e.household_id = q.household_id
  where e.event_time between q.event_time - interval 90 days and q.event_time),
won_rec as (select conversion_id, household_id, max(struct_pack(t := t, id := id)) as best, list(distinct id) as ids from pairs_rec group by conversion_id, household_id),
picked as (
  select * from (select *, row_number() over (partition by conversion_id order by best.t desc, best.id desc, household_id desc) as n from won_rec) where n = 1),
rec as (
  select h.* exclude (household_id, exposure_id, assists, attributed, path, processed_at, reason), p.household_id, p.best.id as exposure_id,
         array_to_string(list_sort(list_filter(p.ids, lambda x: x <> p.best.id)), ',') as assists, true as attributed, 'reconciled' as path, (select t from rec_at) as processed_at, cast(null as varchar) as reason
  from picked p join hot h using (conversion_id)),
cur as (select * from hot where conversion_id not in (select conversion_id from rec) union all by name select * from rec),
credit as (select a.*, e.campaign_id, e.program_genre, e.event_time as exposure_time from cur a join exposures e using (exposure_id) where a.attributed),
credit_hot as (select a.*, e.campaign_id, e.program_genre, e.event_time as exposure_time from hot a join exposures e using (exposure_id) where a.attributed),
spent as (select campaign_id, cast(sum(cast(spend as decimal(18, 4))) as double) as spend, count(*) as exposures from exposures group by campaign_id),
truth as (
  select c.conversion_id, arg_min(e.exposure_id, strftime(e.event_time, '%Y-%m-%d %H:%M:%S.%f') || e.exposure_id) as truth_exposure_id
  from conversions c join exposures e on e.household_id = 'h-' || lpad(cast(c.user_id as varchar), 6, '0')
  where c.event_id % 2 = 0 and e.event_time between c.event_time - interval 20 days and c.event_time group by c.conversion_id)
"""

_DECISION = "conversion_id, household_id, exposure_id, assists, attributed, path, (epoch_us(processed_at) // 1000) as processed_ms, reason, candidate_households"


def _won(credit: str) -> str:
    return f"""select campaign_id, count(*) as conversions, count(*) filter (conversion_type = 'purchase') as purchases, count(*) filter (conversion_type = 'site_visit') as site_visits,
      cast(sum(cast(revenue as decimal(18, 4))) as double) as revenue, max(processed_at) as credited_at from {credit} group by campaign_id"""


def _report(credit: str) -> str:
    return f"""select s.campaign_id as campaign, s.spend, s.exposures, coalesce(c.conversions, 0) as conversions, coalesce(c.purchases, 0) as purchases, coalesce(c.revenue, 0) as revenue,
      round(coalesce(c.revenue, 0) / nullif(s.spend, 0), 6) as roas, round(s.spend / nullif(coalesce(c.purchases, 0), 0), 6) as cpa,
      round(coalesce(c.conversions, 0) / nullif(s.exposures, 0), 6) as cvr, round(coalesce(c.site_visits, 0) / nullif(s.exposures, 0), 6) as site_visit_rate
    from spent s left join ({_won(credit)}) c using (campaign_id)"""


def _hourly(credit: str) -> str:
    return f"""select campaign_id, hour, cast(sum(cast(spend as decimal(18, 4))) as double) as spend, cast(sum(e) as bigint) as exposures, cast(sum(c) as bigint) as attributed_conversions,
      cast(sum(p) as bigint) as purchases, cast(sum(s) as bigint) as site_visits, cast(sum(cast(revenue as decimal(18, 4))) as double) as revenue, max(stamp) as reported_at
    from (select campaign_id, date_trunc('hour', event_time) as hour, spend, 1 as e, 0 as c, 0 as p, 0 as s, 0.0 as revenue, ingest_time as stamp from exposures
      union all select campaign_id, date_trunc('hour', exposure_time), 0.0, 0, 1, cast(conversion_type = 'purchase' as int), cast(conversion_type = 'site_visit' as int), revenue, processed_at from {credit})
    group by campaign_id, hour"""


def _recorded(credit: str, seen: str = "true", won: str = "true") -> str:
    return f"""select campaign_id, hour, max(version) as version from (select campaign_id, date_trunc('hour', event_time) as hour, ingest_time as version from exposures where {seen}
      union all select campaign_id, date_trunc('hour', exposure_time), processed_at from {credit} where {won}) group by campaign_id, hour"""


_HOUR = "select campaign_id, (epoch_us(hour) // 1000) as hour_ms, spend, exposures, attributed_conversions, purchases, site_visits, revenue, (epoch_us(reported_at) // 1000) as reported_ms"
_LAST = "(select max(g) from (select ingest_time as g from exposures union all select ingest_time from cur))"


def _snapshot(credit: str, offset: int) -> str:
    return f"""select (epoch_us({_LAST}) // 1000) + {offset} as reported_ms, s.campaign_id, 'all' as period, s.spend, coalesce(c.revenue, 0) as revenue, coalesce(c.conversions, 0) as conversions, coalesce(c.purchases, 0) as purchases, s.exposures,
      coalesce(c.revenue, 0) / nullif(s.spend, 0) as roas, s.spend / nullif(coalesce(c.purchases, 0), 0) as cpa,
      (epoch_us(coalesce((select max(processed_at) from {credit}), (select max(processed_at) from cur))) // 1000) as version_ms
    from spent s left join ({_won(credit)}) c using (campaign_id)"""


_SNAPS = f"({_snapshot('credit_hot', 0)} union all {_snapshot('credit', 1000)})"


def _restated(where: str = "true") -> str:
    first, last = "reported_ms = (select min(reported_ms) from snaps)", "reported_ms = (select max(reported_ms) from snaps)"
    pick = lambda c, w: f"max({c}) filter ({w})"
    return f"""select campaign_id, round({pick('roas', first)}, 6) as roas_as_reported, round({pick('roas', last)}, 6) as roas_now, round({pick('roas', last)} - {pick('roas', first)}, 4) as roas_delta,
      {pick('conversions', first)} as conversions_as_reported, {pick('conversions', last)} as conversions_now, round({pick('revenue', last)} - {pick('revenue', first)}, 2) as revenue_delta
    from snaps where {where} group by campaign_id"""


def _accuracy(rows: str) -> str:
    return f"""select *, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 9) as f1, round(p, 9) as precision, round(r, 9) as recall from (
      select *, coalesce(household_correct / nullif(credited, 0), 0) as p, coalesce(household_correct / nullif(truth_links, 0), 0) as r,
        round(coalesce(exact_exposure_correct / nullif(credited, 0), 0), 9) as exact_exposure_match_rate
      from (select count(c.conversion_id) as credited, count(t.conversion_id) as truth_links,
        count(*) filter (c.conversion_id is not null and coalesce(e.household_id = c.household_id, false)) as household_correct,
        count(*) filter (c.exposure_id = t.truth_exposure_id) as exact_exposure_correct,
        count(*) filter (c.conversion_id is not null and t.conversion_id is null) as organic_credited,
        count(*) filter (c.conversion_id is null) as caused_missed,
        count(*) filter (c.conversion_id is not null and t.conversion_id is not null and not coalesce(e.household_id = c.household_id, false)) as caused_wrong_household
      from (select * from {rows} where attributed) c full join truth t on c.conversion_id = t.conversion_id left join exposures e on e.exposure_id = t.truth_exposure_id))"""


_SUM = "cast(sum(cast(revenue as decimal(18, 4))) as double) as revenue"
_LAG = "cast(epoch(date_trunc('second', event_time)) - epoch(date_trunc('second', exposure_time)) as bigint)"
_HOTLAG = f"(select conversion_id, {_LAG} as lag_seconds from credit where path = 'hot' and event_time >= exposure_time)"

BODIES = {
    "resolve_conversions": "select conversion_id, household_id, resolution, candidate_count > 1 as ambiguous, candidate_count from resolved",
    "resolve_counts": "select resolution, candidate_count, count(*) as n, count(distinct conversion_id) as conversions from (select * from resolved union all select * from resolved where event_id % 9 = 0) group by all",
    "dedup_suppressed": "select 'exposures' as stream, count(*) as n from ev where event_type = 'view' and event_id % 9 = 0 union all select 'resolved', count(*) from resolved where event_id % 9 = 0",
    "candidate_households": "select o.conversion_id, o.household_id, k.names as candidates from one_row o join cands k using (conversion_id)",
    "hot_complete_state": f"select {_DECISION} from hot_all",
    "hot_attributed": f"select {_DECISION} from hot",
    "streaming_attributed": "select conversion_id, household_id, exposure_id, assists, attributed from hot",
    "join_state": """select hh as household_id, cast(greatest(max(live), 0) as bigint) as peak, max(evicted) as evicted, max(final) as final from (
      select k.hh, k.ix, (select count(*) from gone g where g.hh = k.hh and g.ix <= k.ix) - (select count(*) from gone g where g.hh = k.hh and g.gone <= k.ix) as live,
        (select count(*) from gone g where g.hh = k.hh and g.gone < 4000000000) as evicted, (select count(*) from gone g where g.hh = k.hh and g.gone >= 4000000000) as final
      from a k where k.hh in (select hh from gone)) group by hh""",
    "peak_lateness": "select coalesce(max(l), 0) as peak_lateness_seconds from (select (epoch_us(ingest_time) - epoch_us(event_time)) / 1e6 as l from exposures union all select (epoch_us(ingest_time) - epoch_us(event_time)) / 1e6 from resolved)",
    "unattributed_reasons": "select reason, count(*) as n from hot where not attributed group by reason",
    "reconcile_candidates": "select conversion_id, reason, candidate_count from hot where not attributed",
    "reconcile_recovered": f"select {_DECISION} from rec",
    "current_rows": f"select {_DECISION} from cur",
    "report_hot": _report("credit_hot"),
    "report_post": _report("credit"),
    "report_from_rollup": _report("credit"),
    "rollup_hourly": f"{_HOUR} from ({_hourly('credit')})",
    "rollup_incremental": f"{_HOUR} from ({_hourly('credit')})",
    "rollup_changed_keys": f"select campaign_id, (epoch_us(hour) // 1000) as hour_ms from ({_hourly('credit_hot')}) h full join ({_hourly('credit')}) p using (campaign_id, hour) where h.attributed_conversions is distinct from p.attributed_conversions or round(h.revenue, 6) is distinct from round(p.revenue, 6) or round(h.spend, 6) is distinct from round(p.spend, 6) or h.purchases is distinct from p.purchases or h.site_visits is distinct from p.site_visits",
    "dirty_keys": f"select p.campaign_id, (epoch_us(p.hour) // 1000) as hour_ms, (epoch_us(p.version) // 1000) as version_ms from ({_recorded('credit')}) p left join ({_recorded('credit_hot')}) h using (campaign_id, hour) where h.version is null or h.version <> p.version",
    "dirty_recorded_day": "select campaign_id, (epoch_us(hour) // 1000) as hour_ms, (epoch_us(version) // 1000) as version_ms from (" + _recorded("credit", "cast(event_time as date) = (select cast(min(ts) as date) + 10 from events)", "cast(event_time as date) = (select cast(min(ts) as date) + 10 from events) or cast(exposure_time as date) = (select cast(min(ts) as date) + 10 from events)") + ")",
    "report_snapshots": f"select * replace (round(roas, 6) as roas, round(cpa, 6) as cpa) from {_SNAPS}",
    "restatement": _restated(),
    "campaign_restatement": _restated("campaign_id = 'camp-02'"),
    "match_rate_by_day": "select cast(cast(event_time as date) as varchar) as day, count(*) as processed, count(*) filter (attributed) as attributed_count from cur group by 1",
    "window_edge_lags": f"select * from {_HOTLAG}",
    "window_edge_histogram": f"select cast(b as bigint) as bin, count(l.lag_seconds) as n from range(7) r(b) left join {_HOTLAG} l on least(greatest(lag_seconds // 86400, 0), 6) = b group by b",
    "window_edge_distribution": f"select lag_seconds // 86400 as day_bucket, count(*) as n from {_HOTLAG} group by 1",
    "ip_cluster_overall": "select count(*) as attributed_count, count(*) filter (resolution = 'ip') as ip_resolved, count(*) filter (candidate_count > 1) as ambiguous_count, max(candidate_count) as max_candidate_count from cur where attributed",
    "ip_cluster_top": "select ip, count(*) as attributed_conversions, max(candidate_count) as max_candidate_count from cur where attributed and resolution = 'ip' group by ip order by attributed_conversions desc, ip limit 10",
    "ip_cluster_detail": "select household_id, count(*) as attributed_conversions, max(candidate_count) as max_candidate_count from cur where attributed and resolution = 'ip' and ip = '100-2' group by household_id",
    "campaign_attributed_by_day": f"select cast(cast(event_time as date) as varchar) as day, count(*) as attributed, {_SUM} from credit where campaign_id = 'camp-01' group by 1",
    "genre_exposures": "select program_genre as genre, count(*) as exposures from exposures group by 1",
    "genre_conversions": "select program_genre as genre, count(*) as attributed_conversions from credit group by 1",
    "genre_reach": "select genre, exposures, coalesce(n, 0) as attributed_conversions, round(coalesce(n, 0) / nullif(exposures, 0), 6) as conversions_per_exposure from (select program_genre as genre, count(*) as exposures from exposures group by 1) left join (select program_genre as genre, count(*) as n from credit group by 1) using (genre)",
    "genre_reach_detail": "select (select count(*) from exposures where program_genre = 'sports') as exposures, (select count(*) from credit where program_genre = 'sports') as attributed_conversions",
    "accuracy_post": f"select * exclude (p, r) from ({_accuracy('cur')})",
    "accuracy_hot": f"select * exclude (p, r) from ({_accuracy('hot')})",
    "alerts": f"""select 'lag_seconds' as alert, round(v, 4) as value, v > 14400 as firing from (select cast(max(epoch(date_trunc('second', ingest_time)) - epoch(date_trunc('second', event_time))) as double) as v from cur)
      union all select 'match_rate', round(v, 4), v < 0.80 or v > 0.98 from (select count(*) filter (attributed) / count(*) as v from cur)
      union all select 'restatement', round(v, 4), v > 1.0 from (select coalesce(max(abs(d)), 0) as v from (select round(max(roas) filter (reported_ms = (select max(reported_ms) from snaps)) - max(roas) filter (reported_ms = (select min(reported_ms) from snaps)), 4) as d from snaps group by campaign_id))
      union all select 'backlog', 0.0, false union all select 'parts', 0.0, false""",
    "lever_date_slice": f"select count(*) as n, {_SUM} from (select * from hot union all by name select * from rec) where day(event_time) = 10 and attributed",
    "lever_latest_agg": f"select count(*) as n, {_SUM} from cur where attributed",
    "lever_equality": "select 'genre' as filter, count(*) as n, cast(sum(cast(spend as decimal(18, 4))) as double) as spend from exposures where program_genre = 'sports' union all select 'ip', count(*), cast(sum(cast(spend as decimal(18, 4))) as double) from exposures where ip = '10-7'",
    "lever_wide_read": "select count(*) as n, cast(sum(length(device_id)) as bigint) as device_chars, cast(sum(length(ip)) as bigint) as ip_chars, cast(sum(length(order_id)) as bigint) as order_chars, cast(sum(length(replace(assists, ',', ''))) as bigint) as assist_chars from hot where attributed",
    "exposures_by_household": "select household_id, count(*) as n, epoch_us(min(event_time)) as first_us, epoch_us(max(event_time)) as last_us from exposures where household_id in (select household_id from exposures where campaign_id = 'camp-03' and app_id = 'app-1') group by household_id",
    "lake_day_counts": "select day, count(*) as rows from (select cast(cast(event_time as date) as varchar) as day from exposures union all select cast(cast(event_time as date) as varchar) from hot) group by day",
}

_DAY = lambda k: f"(select cast(min(ts) as date) + {k} from events)"
_DAYS = lambda t, *ks: f"cast({t} as date) in ({', '.join(_DAY(k) for k in ks)})"
_KEYS = "select 'camp-' || lpad(cast(c as varchar), 2, '0') as campaign_id, (select date_trunc('day', min(cast(ts as timestamp))) from events) + to_hours(cast(h as integer)) as hour from range(5) a(c), range(24, 72, 5) b(h)"
_RECDAYS = "(select distinct cast(event_time as date) as day from rec)"


def _listed(section: str, row: str, source: str, *names: str) -> str:
    return " union all ".join(f"select '{section}' as section, {row} as row, '{n}' as name, round(cast({n} as double), 4) as value from ({source})" for n in names)


BODIES |= {
    "lever_date_slice": f"select count(*) as n, {_SUM} from (select * from hot union all by name select * from rec) where {_DAYS('event_time', 9, 40)} and attributed",
    "busiest_ip": "select ip, count(*) as n from exposures group by ip order by n desc, ip limit 1",
    "lake_household_range": f"select household_id, count(*) as n, cast(sum(cast(spend as decimal(18, 4))) as double) as spend from exposures where household_id in (select household_id from exposures where campaign_id = 'camp-03' and app_id = 'app-1') and event_time >= {_DAY(3)} and event_time < {_DAY(13)} group by household_id",
    "lake_days_exposures": f"select 'two' as days, count(*) as n, cast(sum(cast(spend as decimal(18, 4))) as double) as spend from exposures where {_DAYS('event_time', 2, 5)} union all select 'none', 0, 0.0",
    "lake_current_days": f"select {_DECISION} from cur where {_DAYS('event_time', 1, 4, 8)}",
    "lake_known_days": "select distinct cast(day as varchar) as day from (select cast(event_time as date) as day from exposures union all select cast(event_time as date) from hot)",
    "lake_reconciled": f"select {_DECISION} from rec",
    "lake_compacted": "select cast(cast(event_time as date) as varchar) as day, count(*) as rows, cast(1 as bigint) as commits from (select event_time from hot union all select event_time from rec) group by 1",
    "lake_migrated": "select 'v2' as note, campaign_id, count(*) as n, cast(sum(cast(spend * 2 as decimal(18, 4))) as double) as spend from exposures group by campaign_id",
    "serving_loaded_days": f"select 'exposures_landed' as \"table\", count(*) as n from exposures where {_DAYS('event_time', 10, 11)} union all select 'attributed_conversions', count(*) from cur where {_DAYS('event_time', 10, 11)} union all select 'dirty', 0",
    "serving_reloaded": f"{_HOUR} from ({_hourly('credit')})",
    "serving_finalized": f"select cast(day as varchar) as day, 1 as pass from {_RECDAYS}",
    "serving_decisions": "select conversion_id, household_id, exposure_id, attributed, assists, path, reason from cur",
    "serving_credited": "select c.conversion_id, c.household_id, c.exposure_id, e.household_id as exposure_household from cur c join exposures e using (exposure_id) where c.attributed",
    "serving_marker": "select true as right",
    "rollup_report_stored": _report("credit"),
    "rollup_for_keys": f"{_HOUR} from ({_hourly('credit')}) join ({_KEYS}) using (campaign_id, hour)",
    "touched_days": "select distinct cast(day as varchar) as day from (select cast(event_time as date) as day from rec union all select cast(e.event_time as date) from rec r join exposures e using (exposure_id))",
    "query_cost": "select unnest(['report', 'report_rollup', 'restatement']) as query_tag, true as read, true as ran, true as priced, unnest([true, false, false]) as logged_last",
    "storage_state": f"select 'lake_exposures' as \"table\", 1 as parts, 0 as unmerged union all select 'lake_attributed', case when count(*) > 0 then 2 else 1 end, count(*) from {_RECDAYS}",
    "eval_results": "select event_type as scenario, case when event_type in ('view', 'click') then 'control' else 'lift' end as kind, count(*) as total, count(*) filter (event_id % 4 < 2) as correct, count(*) filter (event_id % 4 = 2) as false_positives, count(distinct event_id % 4) as outcomes, count(distinct event_id % 3) as verdicts from events group by event_type",
    "eval_false_positives": "select count(*) filter (event_id % 4 = 2) as false_positives, count(*) as control_runs, count(*) filter (event_id % 4 = 2) / nullif(count(*), 0) as rate from events where event_type in ('view', 'click')",
    "streaming_state": BODIES["join_state"],
}
BODIES["alerts"] = BODIES["alerts"].replace("'parts', 0.0, false", f"'parts', case when count(*) > 0 then 2.0 else 1.0 end, false from {_RECDAYS}")
BODIES["attribution_context"] = " union all ".join([
    _listed("match_rate", "day", BODIES["match_rate_by_day"], "processed", "attributed_count"),
    _listed("window_edge", "cast(bin as varchar)", BODIES["window_edge_histogram"], "n"),
    _listed("ip_clusters", "'all'", BODIES["ip_cluster_overall"], "attributed_count", "ip_resolved", "ambiguous_count", "max_candidate_count"),
    _listed("ip_top", "ip", BODIES["ip_cluster_top"], "attributed_conversions", "max_candidate_count"),
    _listed("genres", "genre", BODIES["genre_reach"], "exposures", "attributed_conversions", "conversions_per_exposure"),
    _listed("campaigns", "campaign", BODIES["report_post"], "spend", "exposures", "conversions", "purchases", "revenue", "roas", "cpa", "cvr", "site_visit_rate"),
    _listed("restatements", "campaign_id", _restated().replace(", 6)", ", 9)"), "roas_as_reported", "roas_now", "roas_delta", "conversions_as_reported", "conversions_now", "revenue_delta"),
])

ORACLE_SQL = {name: PREFIX + (f", snaps as {_SNAPS} " if "snaps" in body else "") + body for name, body in BODIES.items()}
