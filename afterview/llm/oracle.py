r"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_DOCS = f"d as (select doc_id, row_number() over () as r, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {_WORD}) as ws from documents)"
_SPREAD = "w as (select doc_id, r, unnest(ws) as word, generate_subscripts(ws, 1) as i from d)"

OP3 = f"""
with {_DOCS}, {_SPREAD},
win as (select doc_id, r, i, word, string_agg(word, ' ') over f as s, count(*) over f as n from w window f as (partition by r order by i rows between current row and 49 following)),
first as (select s, min(doc_id) as m from win where n = 50 group by s),
hit as (select win.r, win.i, win.word, win.n = 50 and win.doc_id > first.m as again from win left join first using (s)),
marked as (select r, i, word, coalesce(max(case when again then 1 end) over (partition by r order by i rows between 49 preceding and current row), 0) as gone from hit),
done as (select r, sum(gone) as removed, string_agg(word, ' ' order by i) filter (gone = 0) as kept from marked group by r)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join done using (r)
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP1 = f"""
with d as (select doc_id, row_number() over () as r, regexp_extract_all({_LOW}, {_NORMAL}) as ws from documents),
b as (select item_id, regexp_extract_all({_LOW}, {_NORMAL}) as ws from benchmark where item_id is not null),
v as (select item_id, list_slice(ws, k, k + 12) as win from (select item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 12))) as k from b where len(ws) > 0)),
w as (select r, unnest(ws) as word, generate_subscripts(ws, 1) as i from d),
hit as (select w.r, w.i, v.item_id, len(v.win) as n from w join v on w.word = v.win[1] join d on d.r = w.r where list_slice(d.ws, w.i, w.i + len(v.win) - 1) = v.win),
covered as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(i, i + n - 1)) as p from hit) group by r),
items as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, cast(item_id as varchar) as id from hit) group by r)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join covered using (r) left join items using (r)
"""

_RULES = {"short": "n_words < 10", "repetitive": "100 * n_repeat_words > 20 * n_words", "dup_lines": "n_dup_lines * 100 > n_lines * 30", "symbols": "n_symbols * 10 > n_words"}


def _rate(rule: str) -> str:
    """The shrunken rate of one rule; h are the hosts with their counts."""
    n, f = "(select sum(docs) from h)", f"(select sum(fail_{rule}) from h)"
    mean = f"(({f} + 0.5) / ({n} + 1))"
    spread = f"greatest((select sum(fail_{rule} * fail_{rule} / docs) from h) / {n} - ({f} / {n}) * ({f} / {n}), 0)"
    weight = f"least(greatest({mean} * (1 - {mean}) / greatest({spread} - {mean} * (1 - {mean}) * (select count(*) from h) / {n}, 1e-9) - 1, 1), 1000)"
    return f"(fail_{rule} + {mean} * {weight}) / (docs + {weight})"


OP10 = f"""
with d as (select doc_id, source, row_number() over () as r, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {_WORD}) as ws from documents), {_SPREAD},
win as (select r, i, string_agg(word, ' ') over f as s, count(*) over f as n from w window f as (partition by r order by i rows between current row and 4 following)),
often as (select r, i, count(*) over (partition by r, s) > 1 as twice from win where n = 5),
marked as (select w.r, w.i, max(case when twice then 1 else 0 end) over (partition by w.r order by w.i rows between 4 preceding and current row) as inside from w left join often using (r, i)),
repeats as (select r, sum(inside) as n from marked group by r),
f as (select doc_id, source, cast(len(ws) as bigint) as n_words, cast(len(array_to_string(ws, '')) as bigint) as word_chars, cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
    cast(len(lines) as bigint) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(repeats.n, 0) as bigint) as n_repeat_words
  from (select *, list_filter(string_split(t, chr(10)), lambda x: len(regexp_extract_all(x, {_WORD})) > 0) as lines from d) left join repeats using (r)),
h as (select source, count(*) as docs, {', '.join(f'count(*) filter ({rule}) as fail_{k}' for k, rule in _RULES.items())} from f group by source),
ok as (select source, greatest({', '.join(_rate(k) for k in _RULES)}) <= 0.5 as host_ok from h)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_RULES['short']} or {_RULES['repetitive']} as base_failed,
  not ({_RULES['short']} or {_RULES['repetitive']}) and host_ok as kept
from f join ok on f.source is not distinct from ok.source
"""

ORACLE_SQL = {"op1_decontamination": OP1, "op3_substrings": OP3, "op10_host_rules": OP10}
