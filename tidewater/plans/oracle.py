"""DuckDB SQL giving the same rows as each registered query (the oracle).

Column names and types follow the Spark results: sums of measurements are
exact decimals cast to DOUBLE, counts BIGINT, means rounded half-up to six
places by integer arithmetic, windows as ``window_start``/``window_end``.
"""

from __future__ import annotations

RUN = "rows between unbounded preceding and current row"
BEFORE = "rows between unbounded preceding and 1 preceding"
KEYED = "partition by user_id order by ts, event_id"
DEC = "cast(value as decimal(18,2))"


def _mean6(total: str, n: str) -> str:
    return (f"cast((cast({total} * 100 as hugeint) * 20000 + {n}) // ({n} * 2) as double)"
            " / 1000000.0")


def _words(text: str) -> str:
    return (f"case when {text} = '' then [''] "
            f"when rtrim({text}, ' ') = '' then []::varchar[] "
            f"else string_split(rtrim({text}, ' '), ' ') end")


def _simple_final(agg: str) -> str:
    return f"""
select user_id, cast({agg}({DEC}) as double) as value,
       first(ts order by ts, event_id) as ts,
       first(event_type order by ts, event_id) as event_type
from events group by user_id"""


def _simple_roll(agg: str) -> str:
    return f"""
select user_id, ts, event_id,
       cast({agg}({DEC}) over w as double) as value,
       first_value(ts) over w as first_ts,
       first_value(event_type) over w as first_event_type
from events window w as ({KEYED} {RUN})"""


def _extreme_final(desc: bool) -> str:
    d = "desc" if desc else "asc"
    return f"""
select user_id, event_id, ts, event_type, value from events
qualify row_number() over (partition by user_id order by value {d}, ts, event_id) = 1"""


def _extreme_roll(desc: bool) -> str:
    fn = "arg_max" if desc else "arg_min"
    sign = "-" if desc else ""
    rank = f"(value, {sign}epoch_us(ts), {sign}event_id)"
    pick = f"{fn}({{'event_id': event_id, 'ts': ts, 'event_type': event_type, 'value': value}}, {rank}) over w"
    return f"""
select user_id, at_ts, at_event_id, r.event_id, r.ts, r.event_type, r.value from (
  select user_id, ts as at_ts, event_id as at_event_id, {pick} as r
  from events window w as ({KEYED} {RUN}))"""


_TTL_RW = f"""
with g as (
  select user_id, ts, event_id, value,
         lag(ts) over (partition by user_id order by ts, event_id) as prev_ts
  from events),
b as (
  select *, sum(case when prev_ts is null or ts - prev_ts >= interval 6 hour then 1 else 0 end)
            over ({KEYED} {RUN}) as grp
  from g)
select user_id, ts, event_id, value,
       last_value(case when value > 10 then value end ignore nulls)
         over (partition by user_id, grp order by ts, event_id {BEFORE}) as state
from b"""

_TTL_W = f"""
with s as (
  select user_id, ts, event_id, value,
         last_value(case when value > 10 then ts end ignore nulls) over w as wt,
         last_value(case when value > 10 then value end ignore nulls) over w as wv
  from events window w as ({KEYED} {BEFORE}))
select user_id, ts, event_id, value,
       case when wt is not null and ts - wt < interval 6 hour then wv end as state
from s"""


def _sliding_counts(key: str) -> str:
    # 5 h windows every 3 h: starts at multiples of 3 h, a row is in the
    # windows starting at floor(t/3h)*3h and 3 h before, if it is < start + 5h.
    return f"""
select {key}, to_timestamp(st)::timestamp as window_start,
       to_timestamp(st + 18000)::timestamp as window_end, count(*) as cnt
from (
  select {key}, (floor(epoch_us(ts) / 10800000000) - i) * 10800 as st, epoch_us(ts) as us
  from events, (values (0), (1)) t(i))
where us < (st + 18000) * 1000000
group by all"""


def _topn(desc: bool) -> str:
    d = "desc" if desc else "asc"
    return f"""
select window_start, window_end,
       row_number() over (partition by window_end order by cnt {d}, event_type) as rank,
       event_type, cnt
from ({_sliding_counts('event_type')})
qualify rank <= 3"""


def _late(side: int) -> str:
    return f"""
with a as (
  select event_id, user_id, ts, (event_id // 100) * 100 + (event_id * 37) % 100 as arrival
  from events where event_id % 2 = {side}),
m as (
  select *, max(ts) over (order by arrival {BEFORE}) - interval 3600001 milliseconds as watermark from a)
select event_id, user_id, ts, arrival, watermark from m where ts < watermark"""


def _late_join(side: int) -> str:
    return f"""
with a as (
  select event_id, user_id, ts, (event_id // 100) * 100 + (event_id * 37) % 100 as arrival from events),
m as (
  select *, max(case when event_id % 2 = 0 then ts end) over (order by arrival {BEFORE}) as l,
         max(case when event_id % 2 = 1 then ts end) over (order by arrival {BEFORE}) as r from a),
w as (
  select *, case when l is not null and r is not null
                 then least(l, r) - interval 3600001 milliseconds end as watermark from m)
select event_id, user_id, ts, arrival, watermark from w where ts < watermark and event_id % 2 = {side}"""


HOLES = """(select event_id, case when event_id % 11 <> 3 then ts end as ts,
               case when event_id % 7 <> 0 then user_id end as user_id, event_type,
               case when event_id % 5 <> 2 then value end as value from events)"""


_ORDERED = f"""
with recursive e as (
  select user_id, ts, event_id, event_type, cast(round(value * 100) as bigint) as cents, row_number() over ({KEYED}) as rn
  from events),
r as (
  select * from e where rn = 1
  union all
  select e.user_id, e.ts, e.event_id, e.event_type, (2 * r.cents + e.cents) % 1000003 as cents, e.rn
  from r join e on e.user_id = r.user_id and e.rn = r.rn + 1)"""


ORACLE: dict[str, str] = {
    "src_datagen": "select event_id as index, 'Number:' || cast(event_id as varchar) as value, event_type from events",
    "parse_sensor": """
select cast(user_id as varchar) as id, event_id as ts, cast(floor(value) as integer) as vc
from events""",
    "parse_pair": """
select event_id, event_type as k, make_timestamp(event_id * 1500000) as at from events""",
    "map_project": "select event_id, cast(user_id as varchar) as id from events",
    "filter_eq": "select event_id, user_id, event_type, value from events where event_type = 'click'",
    "flatmap_words": f"select doc_id, unnest({_words('text')}) as word from documents",
    "wordcount": f"""
select word, count(*) as cnt from (select unnest({_words('text')}) as word from documents)
group by word""",
    "rich_map_inc": "select event_id, cast(user_id as integer) + 1 as inc, 1 as opened from events",
    "connect_comap": """
select '来源于数字流:' || cast(user_id as varchar) as value from events
union all
select '来源于字母流:' || event_type as value from events""",
    "side_s1": "select event_id, user_id, event_type, value from events where event_type = 'click'",
    "side_s2": "select event_id, user_id, event_type, value from events where event_type = 'purchase'",
    "side_main": """
select event_id, user_id, event_type, value from events
where event_type is null or event_type not in ('click', 'purchase')""",
    "part_broadcast": """
select event_id, cast(s as integer) as subtask, cast(s as integer) as placed
from (select event_id, unnest(range(4)) as s from events)""",
    "part_custom": "select event_id, user_id, true as placed_ok from events",
    "part_keyby": """
select user_id, cast(1 as bigint) as n_parts, count(*) as n_rows from events group by user_id""",
    "agg_sum": _simple_final("sum"),
    "agg_sum_roll": _simple_roll("sum"),
    "agg_max": _simple_final("max"),
    "agg_max_roll": _simple_roll("max"),
    "agg_min": _simple_final("min"),
    "agg_min_roll": _simple_roll("min"),
    "agg_maxby": _extreme_final(True),
    "agg_maxby_roll": _extreme_roll(True),
    "agg_minby": _extreme_final(False),
    "agg_minby_roll": _extreme_roll(False),
    "reduce_final": f"""
select user_id, cast(sum({DEC}) as double) as value, max(ts) as ts from events group by user_id""",
    "reduce_roll": f"""
select user_id, ts, event_id, cast(sum({DEC}) over ({KEYED} {RUN}) as double) as value
from events""",
    "state_agg_avg": f"""
select user_id, {_mean6(f'sum({DEC})', 'count(value)')} as mean from events group by user_id""",
    "state_agg_avg_roll": f"""
select user_id, ts, event_id, {_mean6('s', 'n')} as mean from (
  select user_id, ts, event_id, sum({DEC}) over w as s, count(value) over w as n
  from events window w as ({KEYED} {RUN}))""",
    "state_reduce_sum": f"""
select user_id, ts, event_id, cast({DEC} as double) as value,
       cast(sum({DEC}) over ({KEYED} {RUN}) as double) as run_sum
from events""",
    "state_map_counts": """
select user_id, event_type, count(*) as cnt from events group by user_id, event_type""",
    "state_map_counts_roll": f"""
select user_id, event_type, ts, event_id,
       count(*) over (partition by user_id, event_type order by ts, event_id {RUN}) as cnt
from events""",
    "state_map_rowcount": f"""
select user_id, ts, event_id, count(*) over ({KEYED} {RUN}) as cnt from events""",
    "state_value_delta": f"""
select user_id, ts, event_id, value, prev from (
  select user_id, ts, event_id, value,
         coalesce(lag(value) over ({KEYED}), 0.0) as prev
  from events)
where abs(value - prev) > 10""",
    "state_list_top3": f"""
select user_id, ts, event_id, value, t[1] as top1, t[2] as top2, t[3] as top3 from (
  select user_id, ts, event_id, value,
         list_reverse_sort(list(value) over ({KEYED} {RUN})) as t
  from events)""",
    "state_list_top3_final": """
select user_id, row_number() over (partition by user_id order by value desc, ts, event_id) as rank,
       value
from events qualify rank <= 3""",
    "state_ttl_rw": _TTL_RW,
    "state_ttl_w": _TTL_W,
    "win_tumbling_sum": f"""
select user_id, time_bucket(interval 1 hour, ts) as window_start,
       time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
       cast(sum({DEC}) as double) as total, count(*) as cnt
from events group by all""",
    "win_sliding_count": _sliding_counts("event_type"),
    "win_session": f"""
with g as (
  select user_id, ts, value,
         case when lag(ts) over (partition by user_id order by ts, event_id) is null
                or ts > lag(ts) over (partition by user_id order by ts, event_id)
                        + interval 30 minute then 1 else 0 end as brk, event_id
  from events),
s as (select *, sum(brk) over ({KEYED} {RUN}) as sid from g)
select user_id, min(ts) as window_start, max(ts) + interval 30 minute as window_end,
       count(*) as cnt, cast(sum({DEC}) as double) as total
from s group by user_id, sid""",
    "win_count_tumbling": f"""
select user_id, window_index, total from (
  select user_id, (rn - 1) // 5 as window_index, count(*) as n,
         cast(sum({DEC}) as double) as total
  from (select *, row_number() over ({KEYED}) as rn from events)
  group by all)
where n = 5""",
    "win_count_sliding": f"""
select user_id, rn as fire_at, total, cnt from (
  select user_id, row_number() over ({KEYED}) as rn,
         cast(sum({DEC}) over ({KEYED} rows between 4 preceding and current row) as double)
           as total,
         count(*) over ({KEYED} rows between 4 preceding and current row) as cnt
  from events)
where rn % 2 = 0""",
    "win_global": f"""
select user_id, rn as fire_at, total from (
  select user_id, row_number() over ({KEYED}) as rn,
         cast(sum({DEC}) over ({KEYED} {RUN}) as double) as total
  from events)
where rn % 5 = 0""",
    "win_all": f"""
select time_bucket(interval 1 hour, ts) as window_start,
       time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
       count(*) as cnt, cast(sum({DEC}) as double) as total
from events group by all""",
    "win_accumulate": """
select user_id, time_bucket(interval 1 hour, ts) as window_start,
       time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
       cast(sum(cast(round(value * 100) as bigint)) as varchar) as total
from events group by all""",
    "win_full_process": """
select event_type, time_bucket(interval 1 day, ts) as window_start,
       time_bucket(interval 1 day, ts) + interval 1 day as window_end,
       round(median(value), 4) as median_value
from events group by all""",
    "join_window": """
select l.user_id, time_bucket(interval 1 day, l.ts) as window_start,
       time_bucket(interval 1 day, l.ts) + interval 1 day as window_end,
       l.event_id as l_event_id, l.ts as l_ts, r.event_id as r_event_id, r.ts as r_ts
from events l join events r
  on l.user_id = r.user_id
 and time_bucket(interval 1 day, l.ts) = time_bucket(interval 1 day, r.ts)
where l.event_id % 2 = 0 and r.event_id % 2 = 1""",
    "join_cogroup": f"""
with l as (
  select user_id, time_bucket(interval 1 day, ts) as window_start, count(*) as l_cnt,
         cast(sum({DEC}) as double) as l_total
  from events where event_id % 2 = 0 group by all),
r as (
  select user_id, time_bucket(interval 1 day, ts) as window_start, count(*) as r_cnt,
         cast(sum({DEC}) as double) as r_total
  from events where event_id % 2 = 1 group by all)
select coalesce(l.user_id, r.user_id) as user_id,
       coalesce(l.window_start, r.window_start) as window_start,
       coalesce(l.window_start, r.window_start) + interval 1 day as window_end,
       l_cnt, l_total, r_cnt, r_total
from l full outer join r on l.user_id = r.user_id and l.window_start = r.window_start""",
    "join_interval": """
select l.user_id, l.event_id as l_event_id, l.ts as l_ts, r.event_id as r_event_id, r.ts as r_ts
from events l join events r
  on l.user_id = r.user_id
 and r.ts between l.ts - interval 1 hour and l.ts + interval 1 hour
where l.event_id % 2 = 0 and r.event_id % 2 = 1""",
    "join_connect": """
select o_orderkey as orderkey, o_orderstatus, l_linenumber, l_quantity
from orders join lineitem on o_orderkey = l_orderkey""",
    "late_left": _late(0),
    "late_right": _late(1),
    "late_join_left": _late_join(0),
    "late_join_right": _late_join(1),
    "agg_minby_nulls": f"""
select user_id, event_id, value from {HOLES}
qualify row_number() over (partition by user_id order by value asc nulls last, event_id) = 1""",
    "agg_sum_roll_nulls": f"""
select user_id, event_id, cast(sum({DEC}) over w as double) as run_sum, count(value) over w as n,
       cast(max({DEC}) over w as double) as hi
from {HOLES} window w as (partition by user_id order by event_id {RUN})""",
    "quantile_nulls": f"""
select user_id, round(median(value), 4) as median_value from {HOLES} group by user_id""",
    "win_session_nulls": f"""
with h as (select * from {HOLES} where ts is not null),
g as (select *, case when lag(ts) over w is null or ts > lag(ts) over w + interval 30 minute then 1 else 0 end as brk
      from h window w as (partition by user_id order by ts, event_id)),
s as (select *, sum(brk) over (partition by user_id order by ts, event_id {RUN}) as sid from g)
select user_id, min(ts) as window_start, max(ts) + interval 30 minute as window_end, count(*) as cnt
from s group by user_id, sid""",
    "state_list_top2_nulls": f"""
select user_id, event_id, t[1] as top1, t[2] as top2 from (
  select user_id, event_id,
         list_reverse_sort(list(value) filter (where value is not null)
           over (partition by user_id order by event_id {RUN})) as t
  from {HOLES})""",
    "accumulate_nulls": f"""
select user_id, cast(coalesce(sum(cast(round(value * 100) as bigint)), 0) as varchar) as total
from {HOLES} group by user_id""",
    "reduce_custom": f"""
select user_id, ts, event_id, max(event_type) over ({KEYED} {RUN}) as top_type,
       cast(sum({DEC}) over ({KEYED} {RUN}) as double) as total
from events""",
    "win_full_custom": """
select event_type, time_bucket(interval 1 day, ts) as window_start,
       time_bucket(interval 1 day, ts) + interval 1 day as window_end,
       count(*) as cnt, max(value) as hi, round(median(value), 4) as mid
from events group by all""",
    "win_global_pred": f"""
select user_id, ts, event_id, rn as fire_at, total from (
  select user_id, ts, event_id, event_type, row_number() over ({KEYED}) as rn,
         cast(sum({DEC}) over ({KEYED} {RUN}) as double) as total
  from events)
where event_type = 'purchase'""",
    "reduce_ordered": f"""
{_ORDERED}
select user_id, event_type, cents from r qualify row_number() over (partition by user_id order by rn desc) = 1""",
    "reduce_ordered_roll": f"""
{_ORDERED}
select user_id, ts as at_ts, event_id as at_event_id, event_type, cents from r""",
    "win_process_trimmed": """
with e as (
  select event_type, time_bucket(interval 1 day, ts) as window_start, cast(round(value * 100) as bigint) as cents, event_id
  from events),
n as (
  select *, row_number() over (partition by event_type, window_start order by cents, event_id) as rn,
         count(*) over (partition by event_type, window_start) as cnt from e)
select event_type, window_start, window_start + interval 1 day as window_end, count(*) filter (where k) as n,
       cast(coalesce(sum(cents) filter (where k), 0) as bigint) as total_cents,
       cast(1000 * sum(cents) filter (where k) // count(*) filter (where k) as bigint) as mean_milli
from (select *, rn > 2 and rn <= cnt - 2 as k from n) group by event_type, window_start""",
    "join_cogroup_process": """
with g as (
  select user_id, time_bucket(interval 1 day, ts) as window_start,
         list(event_id order by ts, event_id) filter (where event_id % 2 = 0) as l,
         list(event_id order by event_id) filter (where event_id % 2 = 1) as r
  from events group by all)
select user_id, window_start, window_start + interval 1 day as window_end,
       coalesce(len(l), 0) as l_cnt, coalesce(len(r), 0) as r_cnt,
       list_reduce(list_concat([7::bigint], coalesce(l, []), coalesce(r, [])), lambda s, x: (31 * s + x) % 1000003) as chain
from g""",
    "win_session_accumulate": f"""
with g as (
  select *, case when lag(ts) over w is null or ts > lag(ts) over w + interval 30 minute then 1 else 0 end as brk
  from events window w as (partition by user_id order by ts, event_id)),
s as (select *, sum(brk) over ({KEYED} {RUN}) as sid from g)
select user_id, min(ts) as window_start, max(ts) + interval 30 minute as window_end,
       cast(sum(cast(round(value * 100) as bigint)) as varchar) as total
from s group by user_id, sid""",
    "state_map_snapshots": f"""
with t as (select distinct event_type as t from events),
c as (
  select user_id, ts, event_id, t, count(*) filter (where event_type = t) over (partition by user_id, t order by ts, event_id {RUN}) as n
  from events, t)
select user_id, ts, event_id, string_agg(t || '=' || n, ',' order by t) as entries
from c where n > 0 group by user_id, ts, event_id""",
    "topn_window": _topn(True),
    "bottomn_window": _topn(False),
}
