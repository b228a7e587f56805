"""The same results as plain SQL (DuckDB dialect) over the same tables.

Written apart from the DataFrame code and kept simple: windows, self-joins and
distinct counts as SQL states them, without regard to cost.

Epoch milliseconds are whole microseconds divided by 1000 and cut off;
``epoch_ms`` is not used because it rounds in some versions of the engine.
"""

from __future__ import annotations

from ..codes import CODES

BOUNCE_MS = 2 * 3600 * 1000

# --- shared table expressions ---------------------------------------------------

CTE: dict[str, str] = {}

CTE["log"] = """
  select event_id, cast(user_id as varchar) as mid, 'v' || (user_id % 3) as vc, 'ch' || (user_id % 5) as ch,
         cast(user_id % 7 as varchar) as ar, case when event_id % 2 = 0 then '1' else '0' end as is_new,
         case event_type when 'view' then 'good_detail' when 'click' then 'home' when 'purchase' then 'trade'
              when 'signup' then 'login' when 'error' then 'good_list' end as page_id,
         case when event_type in ('signup', 'view') then null when event_type = 'error' then 'search'
              else 'home' end as last_page_id,
         case event_type when 'view' then cast(event_id % (select greatest(count(*), 1) from part) as varchar)
              when 'error' then 'red phone case ' || (event_id % 9) end as item,
         case event_type when 'view' then 'sku_id' when 'error' then 'keyword' end as item_type,
         cast(round(value * 1000) as bigint) as during_time,
         cast(json_extract_string(props, '$.k') as int) % 4 as shown,
         case when event_id % 17 = 0 then 'icon' end as start,
         (epoch_us(ts) // 1000) as ts, ts as ets
  from events"""

CTE["fixed"] = """
  select * replace (case when is_new = '1' and row_number() over (partition by mid, is_new order by ts, event_id) > 1
                         then '0' else is_new end as is_new)
  from log"""

CTE["open_fixed"] = """
  select * replace (case when is_new = '1' and row_number() over (partition by mid, is_new order by ts, event_id) > 1
                         then '0' else is_new end as is_new)
  from log where event_id % 50 not in (0, 1, 2)"""

CTE["pages"] = "select * from fixed where start is null"

CTE["displays"] = """
  select event_id, mid, page_id, start, ts, ets, cast((event_id + i) % (select greatest(count(*), 1) from part) as varchar) as item,
         case when i % 2 = 0 then 'sku_id' else 'activity_id' end as item_type
  from log, lateral (select unnest(range(0, shown)) as i)"""

_VISIT = """
  select * exclude (rn) from (
    select *, row_number() over (partition by mid, ts // 86400000 order by ts, event_id) as rn
    from {src} where last_page_id is null) where rn = 1"""

_JUMP = f"""
  select * exclude (next_ts, next_last),
         case when next_ts is null or next_ts >= ts + {BOUNCE_MS} then 'timeout'
              when next_last is null then 'matched' else 'killed' end as fate
  from (select *, lead(ts) over w as next_ts, lead(last_page_id) over w as next_last
        from {{src}} window w as (partition by mid order by ts, event_id))
  where last_page_id is null"""

CTE["visits"] = _VISIT.format(src="log")
CTE["page_visits"] = _VISIT.format(src="pages")
CTE["fates"] = _JUMP.format(src="log")
CTE["page_fates"] = _JUMP.format(src="pages")

CTE["oi"] = """
  select o_orderkey as id, cast(c_nationkey as bigint) as province_id, o_orderstatus as order_status,
         o_custkey as user_id, cast(o_totalprice as decimal(16,2)) as total_amount, o_orderdate as ots,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time
  from orders join customer on o_custkey = c_custkey"""

CTE["od"] = """
  select l_orderkey * 10 + l_linenumber as detail_id, l_orderkey as order_id, l_partkey as sku_id,
         cast(l_extendedprice as decimal(16,2)) as order_price, cast(l_quantity as bigint) as sku_num,
         cast(l_extendedprice as decimal(16,2)) as split_total_amount,
         cast(l_discount as decimal(16,2)) as split_activity_amount,
         cast(l_tax as decimal(16,2)) as split_coupon_amount, l_shipdate as dts
  from lineitem"""

CTE["pairs"] = """
  select oi.id as order_id, od.* exclude (order_id), oi.* exclude (id),
         strftime(ots, '%Y-%m-%d') as create_date, strftime(ots, '%H') as create_hour
  from oi join od on oi.id = od.order_id
  where dts >= ots - interval 5 day and dts <= ots + interval 5 day"""

CTE["usr"] = """
  select c_custkey as uid, strftime(date '1960-01-01' + cast(c_custkey % 14000 as int), '%Y-%m-%d') as birthday,
         cast(c_custkey % 2 as varchar) as user_gender,
         cast(date_diff('day', date '1960-01-01' + cast(c_custkey % 14000 as int), date '2021-12-31') // 365 as int)
           as user_age
  from customer"""

CTE["prov"] = """
  select n_nationkey as pid, n_name as province_name, cast(n_nationkey as varchar) as province_area_code,
         n_name as province_iso_code, r_name as province_3166_2_code
  from nation join region on n_regionkey = r_regionkey"""

CTE["sku"] = """
  select p_partkey as sid, p_name as sku_name, cast(p_retailprice as decimal(16,2)) as sku_price,
         cast(p_size as bigint) as spu_id, cast(regexp_extract(p_brand, '(\\d+)', 1) as bigint) as tm_id,
         dense_rank() over (order by p_type) as category3_id, 'SPU ' || p_size as spu_name, p_brand as tm_name,
         p_type as category3_name
  from part"""

CTE["ow"] = """
  select pairs.*, prov.* exclude (pid), usr.user_age, usr.user_gender, sku.* exclude (sid, sku_price)
  from pairs join usr on user_id = uid join prov on province_id = pid join sku on sku_id = sid"""

CTE["pay"] = """
  select o_orderkey + 1000000000 as payment_id, o_orderkey as order_id, o_custkey as user_id,
         cast(o_totalprice as decimal(16,2)) as total_amount, 'order ' || o_orderkey as subject,
         o_orderpriority as payment_type, o_orderdate + to_days(cast(o_orderkey % 20 as int)) as pts
  from orders where o_orderstatus <> 'O'"""

CTE["pw"] = """
  select pay.payment_id, pay.order_id, pay.user_id, pay.total_amount, pay.subject, pay.payment_type, pay.pts,
         strftime(pay.pts, '%Y-%m-%d %H:%M:%S') as payment_create_time,
         strftime(pay.pts, '%Y-%m-%d %H:%M:%S') as callback_time, ow.create_time as order_create_time,
         ow.* exclude (order_id, user_id, total_amount, create_time, create_date, create_hour, ots, dts)
  from pay join ow on pay.order_id = ow.order_id
  where ow.ots >= pay.pts - interval 15 day and ow.ots <= pay.pts + interval 5 day"""


def _bucket(width: str, ts: str) -> str:
    return f"time_bucket(interval '{width}', {ts}, timestamp '1970-01-01')"


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _win(width: str, ts: str) -> str:
    start = _bucket(width, ts)
    return f"{_text(start)} as stt, {_text(f'{start} + interval {chr(39)}{width}{chr(39)}')} as edt"


def _visitor_cte(width: str, jumps: str = "fate <> 'killed'") -> str:
    return f"""
  select {_win(width, 'ets')}, vc, ch, ar, is_new, sum(uv)::bigint as uv_ct, sum(pv)::bigint as pv_ct,
         sum(sv)::bigint as sv_ct, sum(uj)::bigint as uj_ct, sum(dur)::bigint as dur_sum, min(ts) as ts
  from (
    select ets, ts, vc, ch, ar, is_new, 0 as uv, 1 as pv, case when last_page_id is null then 1 else 0 end as sv,
           0 as uj, coalesce(during_time, 0) as dur from pages
    union all select ets, ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 from page_visits
    union all select ets, ts, vc, ch, ar, is_new, 0, 0, 0, 1, 0 from page_fates where {jumps})
  group by all"""


CTE["vstats"] = _visitor_cte("1 days")
CTE["vstats_hour"] = _visitor_cte("1 hours")
CTE["vstats_10s"] = _visitor_cte("10 seconds")

_ZERO = {m: "0" for m in (
    "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct",
    "order_amount", "payment_amount", "refund_amount")}
_OIDS = {o: "null" for o in ("o1", "o2", "o3")}


def _prow(src: str, sku: str, ts: str, **measures: str) -> str:
    cols = {**_ZERO, **_OIDS, **measures}
    return f"select cast({sku} as bigint) as sku_id, {ts} as t, " + ", ".join(
        f"{v} as {k}" for k, v in cols.items()) + f" from {src}"


_SHIFT = "ts - interval 27 year"
_EVENT_SKU = "event_id % (select greatest(count(*), 1) from part)"
_PAGE_ROWS = [
    _prow("log where start is null and page_id = 'good_detail' and item_type = 'sku_id'", "item",
          "make_timestamp(ts * 1000)", click_ct="1"),
    _prow("displays where start is null and item_type = 'sku_id'", "item", "make_timestamp(ts * 1000)",
          display_ct="1"),
]
_ORDER_ROWS = [_prow("ow", "sku_id", "ots", order_sku_num="sku_num", order_amount="split_total_amount", o1="order_id")]
_PAID_ROWS = [_prow("pw", "sku_id", "pts", payment_amount="split_total_amount", o2="order_id")]
_REFUND_ROWS = [_prow("lineitem where l_returnflag = 'R'", "l_partkey", "l_shipdate",
                      refund_amount="cast(l_extendedprice as decimal(16,2))", o3="l_orderkey")]
_OTHER_ROWS = [
    _prow("events where event_type = 'click'", _EVENT_SKU, f"date_trunc('second', {_SHIFT})", favor_ct="1"),
    _prow("events where event_type = 'purchase'", _EVENT_SKU, f"date_trunc('second', {_SHIFT})", cart_ct="1"),
    _prow("events where event_type = 'error'", _EVENT_SKU, f"date_trunc('second', {_SHIFT})", comment_ct="1",
          good_comment_ct="case when value > 50 then 1 else 0 end"),
]
_LINE_ROWS = [_prow("od", "sku_id", "dts", order_sku_num="sku_num", order_amount="split_total_amount", o1="order_id")]


def _product_cte(rows: list[str], width: str = "30 days") -> str:
    counts = ", ".join(f"sum({m})::bigint as {m}" for m in _ZERO if not m.endswith("amount"))
    amounts = ", ".join(f"sum(cast({m} as decimal(26,2))) as {m}" for m in _ZERO if m.endswith("amount"))
    return f"""
  select {_win(width, 't')}, sku_id, {counts}, {amounts}, count(distinct o1) as order_ct,
         count(distinct o2) as paid_order_ct, count(distinct o3) as refund_order_ct, (epoch_us(min(t)) // 1000) as ts
  from ({' union all '.join(rows)}) group by stt, edt, sku_id"""


CTE["pstats"] = _product_cte(_PAGE_ROWS + _ORDER_ROWS + _PAID_ROWS + _REFUND_ROWS + _OTHER_ROWS)
CTE["pstats_lines"] = _product_cte(_LINE_ROWS + _REFUND_ROWS)
CTE["pwide"] = "select pstats.*, sku.* exclude (sid) from pstats join sku on sku_id = sid"

CTE["prstats"] = f"""
  select {_win('30 days', 'ots')}, province_id, province_name, province_area_code, province_iso_code,
         province_3166_2_code, sum(split_total_amount) as order_amount, count(distinct order_id) as order_count,
         (epoch_us(min(ots)) // 1000) as ts
  from ow group by all"""

CTE["kstats"] = f"""
  select keyword, count(*) as ct, 'search' as source, {_win('1 days', 'ets')}, min(ts) as ts
  from (select unnest(regexp_extract_all(lower(item), '([a-z0-9]+|\\p{{Han}})')) as keyword, ets, ts
        from log where last_page_id = 'search' and item is not null)
  group by keyword, stt, edt"""

CTE["changes"] = """
  select 'customer' as t, 'insert' as op, 'read' as raw, 1 as seq, c_custkey as key, 0 as nb, 5 as na,
         c_mktsegment as seg, c_name as name, null as price, null as cust, null as dt from customer
  union all select 'customer', 'update', 'update', 2, c_custkey, 5, 5, 'UPDATED', c_name, null, null, null
    from customer where c_custkey % 3 = 0
  union all select 'customer', 'delete', 'delete', 3, c_custkey, 5, 0, null, c_name, null, null, null
    from customer where c_custkey % 7 = 0
  union all select 'orders', 'insert', 'create', 1, o_orderkey, 0, 6, null, null, o_totalprice, o_custkey,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') from orders
  union all select 'part', 'insert', 'create', 1, p_partkey, 0, 6, null, null, null, null, null from part
  union all select 'supplier', 'insert', 'read', 1, s_suppkey, 0, 4, null, null, null, null, null from supplier"""

# What each expression reads, to put the needed ones in order before a query.
ORDER = list(CTE)


def _uses(text: str) -> set[str]:
    import re

    words = set(re.findall(r"[a-z_0-9]+", text))
    return {name for name in CTE if name in words}


def _with(sql: str) -> str:
    need, todo = set(), _uses(sql)
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo |= _uses(CTE[name]) - need - {name}
    parts = [f"{name} as ({CTE[name]})" for name in ORDER if name in need]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + sql


ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = _with(sql)


# --- parsing and change records ---------------------------------------------------

oracle("parse_dirty_split", """
select event_id, cast(bad as int) as dirty, case when not bad then mid end as mid,
       case when not bad then page_id end as page_id, case when not bad then item end as item,
       case when not bad then shown end as n_displays, case when not bad then start end as start,
       case when not bad then ts end as ts
from (select *, event_id % 50 in (0, 1) as bad from log)""")

oracle("open_parse_split", """
select event_id, cast(bad as int) as dirty, case when not bad then mid end as mid,
       case when not bad then during_time end as during_time, case when not bad then ts end as ts
from (select *, event_id % 50 in (0, 1, 2) as bad from log)""")

oracle("open_log_topics", """
select event_id, case when start is null then 'dwd_page_log' else 'dwd_start_log' end as sink_table, is_new,
       'model ' || (event_id % 6) as md, 'promotion' as source_type, case when event_id % 5 = 0 then event_id % 9 end as err_code,
       case when start is not null then 7 end as loading_time, null::bigint as pos_id, null::varchar as shown_on,
       null::varchar as item, during_time || case when event_id % 3 = 1 then '.5' else '' end as during_text
from open_fixed
union all
select event_id, 'dwd_display_log', null, null, null, null, null, i, page_id, cast((event_id + i) % (select greatest(count(*), 1) from part) as varchar), null
from open_fixed, lateral (select unnest(range(0, shown)) as i) where start is null""")

oracle("json_roundtrip", """
select id, province_id, order_status, user_id, total_amount::double as total_amount,
       0.0::double as activity_reduce_amount, 0.0::double as coupon_reduce_amount,
       total_amount::double as original_total_amount, 0.0::double as feight_fee, null::varchar as expire_time,
       create_time, null::varchar as operate_time
from oi""")

oracle("cdc_normalize", """
select 'shop' as database, t as table_name, op as type, nb as n_before, na as n_after, key,
       case when na > 0 then seg end as segment
from changes""")

oracle("cdc_flat", """
select raw as operation, 'shop' as database, t as table_name, na as n_data, key from changes where na > 0""")

oracle("cdc_route_fact", """
select 'dwd_orders' as sink_table, op as type, 4 as n_columns, key as o_orderkey, cust as o_custkey,
       price as o_totalprice, dt as o_orderdate, null::varchar as o_orderstatus
from changes where t = 'orders'""")

oracle("cdc_route_dim", """
select 'dim_customer' as sink_table, 'c_custkey' as sink_pk, op as type, 3 as n_columns, key as c_custkey,
       name as c_name, seg as c_mktsegment, null::varchar as c_acctbal
from changes where t = 'customer' and op <> 'delete'""")

_DIM = """
select cast(c_custkey as varchar) as c_custkey, c_name,
       case when c_custkey % 3 = 0 then 'UPDATED' else c_mktsegment end as c_mktsegment
from customer"""
oracle("dim_upsert", _DIM)
oracle("dim_upsert_buckets", _DIM)
oracle("stream_dim_upsert", _DIM)

oracle("stream_dim_partial", """
select cast(c_custkey as varchar) as c_custkey, c_name, case when c_custkey % 3 = 0 then 'UPDATED' else c_mktsegment end as c_mktsegment,
       case when c_custkey % 6 = 0 then c_acctbal::double end as c_acctbal
from customer""")

oracle("stream_route_fact", """
select 'dwd_orders' as sink_table, 4 as n_columns, key as o_orderkey, cust as o_custkey, price as o_totalprice,
       dt as o_orderdate
from changes where t = 'orders'""")

# --- app log ------------------------------------------------------------------------

oracle("new_flag_repair", "select event_id, mid, is_new, ts from fixed")
oracle("stream_new_flag", "select event_id, mid, is_new, ts from fixed")

_FLAT = "event_id, mid, vc, ch, ar, is_new, page_id, last_page_id, item, item_type, during_time, ts"
oracle("log_split_page", f"select {_FLAT} from log where start is null")
oracle("log_split_start", f"select {_FLAT}, start from log where start is not null")
oracle("log_split_display", "select item, item_type, page_id from displays where start is null")

_TOPICS = """
select 'dwd_page_log' as sink_table, count(*) as records, 0 as sku_records from log where start is null
union all select 'dwd_start_log', count(*), 0 from log where start is not null
union all select 'dwd_display_log', count(*), count(*) filter (item_type = 'sku_id') from displays where start is null"""
oracle("log_routed_topics", _TOPICS)
oracle("stream_log_topics", _TOPICS)

_SHORT = "event_id, mid, is_new, page_id, ts"
oracle("unique_visit", f"select {_SHORT} from visits")
oracle("stream_unique_visit", f"select {_SHORT} from visits")
oracle("stream_unique_visit_live", f"select {_SHORT} from visits")
oracle("user_jump_detail", f"select {_SHORT} from fates where fate <> 'killed'")
oracle("user_jump_matched", f"select {_SHORT} from fates where fate = 'matched'")
oracle("user_jump_timeout", f"select {_SHORT} from fates where fate = 'timeout'")
oracle("stream_user_jump", f"select {_SHORT} from fates where fate <> 'killed'")

# --- wide records ---------------------------------------------------------------------

_PAIR = """
select order_id, detail_id, sku_id, sku_num, user_id, province_id, order_status, create_time, create_date, create_hour,
       total_amount::double as total_amount, split_total_amount::double as split_total_amount
from pairs"""
oracle("order_interval_join", _PAIR)
oracle("stream_order_interval_join", _PAIR)

oracle("payment_interval_join", """
select payment_id, pay.order_id, detail_id, sku_id, payment_type, strftime(pts, '%Y-%m-%d %H:%M:%S') as payment_create_time,
       create_time as order_create_time, pay.total_amount::double as total_amount,
       split_total_amount::double as split_total_amount
from pay join pairs on pay.order_id = pairs.order_id
where ots >= pts - interval 15 day and ots <= pts + interval 5 day""")

oracle("order_shipment_window", """
select oi.id as order_id, count(*) as details, sum(split_total_amount)::double as amount
from oi join od on oi.id = od.order_id
where dts >= ots + interval 30 day and dts <= ots + interval 90 day
group by oi.id""")

_ENRICHED = """sku_name, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name, province_name,
       province_area_code, province_iso_code, province_3166_2_code, user_age, user_gender,
       0.0::double as activity_reduce_amount, 0.0::double as coupon_reduce_amount, 0.0::double as feight_fee,
       order_price::double as order_price, split_activity_amount::double as split_activity_amount,
       split_coupon_amount::double as split_coupon_amount, split_total_amount::double as split_total_amount"""

oracle("order_wide", f"""
select order_id, detail_id, sku_id, sku_num, province_id, order_status, user_id, create_time, create_date, create_hour,
       total_amount::double as total_amount, total_amount::double as original_total_amount, {_ENRICHED}
from ow""")

_PAYW = f"""
select payment_id, order_id, user_id, detail_id, sku_id, sku_num, province_id, order_status, subject, payment_type,
       payment_create_time, callback_time, order_create_time, total_amount::double as total_amount,
       total_amount::double as original_total_amount, {_ENRICHED}
from pw"""
oracle("payment_wide", _PAYW)
oracle("stream_payment_wide", _PAYW)

oracle("order_wide_merge", """
select order_id, detail_id, order_status, create_time, total_amount::double as total_amount, user_id,
       split_total_amount::double as split_total_amount
from pairs""")

oracle("province_rows", """
select '' as stt, '' as edt, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
       split_total_amount::double as order_amount, 1::bigint as order_count, (epoch_us(ots) // 1000) as ts
from ow""")

# --- statistics -------------------------------------------------------------------------

oracle("visitor_stats", "select * from vstats")
oracle("visitor_stats_10s", "select * from vstats_10s")

_COUNTS = ", ".join(m for m in _ZERO if not m.endswith("amount"))
_AMOUNTS = ", ".join(f"{m}::double as {m}" for m in _ZERO if m.endswith("amount"))
_PCOLS = f"stt, edt, sku_id, {_COUNTS}, {_AMOUNTS}, order_ct, paid_order_ct, refund_order_ct, ts"
oracle("product_stats", f"select {_PCOLS} from pstats")
oracle("product_stats_wide", f"""
select {_PCOLS}, sku_name, sku_price::double as sku_price, spu_id, spu_name, tm_id, tm_name, category3_id, category3_name
from pwide""")
oracle("product_stats_all_lines", """
select stt, edt, sku_id, order_sku_num, order_amount::double as order_amount, order_ct, refund_order_ct,
       refund_amount::double as refund_amount
from pstats_lines""")

def _monthly(group: str, src: str) -> str:
    return f"""
select cast(strftime(l_shipdate, '%Y%m') as int) as month, {group}, count(distinct l_orderkey) as order_ct,
       count(distinct case when l_returnflag = 'R' then l_orderkey end) as refund_order_ct
from {src} where l_shipdate is not null group by all"""


oracle("product_orders_by_month", _monthly("l_partkey as sku_id", "lineitem"))
oracle("brand_orders_by_month", _monthly("tm_id", "lineitem join sku on l_partkey = sid"))

_PRCOLS = """stt, edt, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
       order_amount::double as order_amount, order_count, ts"""
oracle("province_stats", f"select {_PRCOLS} from prstats")
oracle("keyword_stats", "select * from kstats")
oracle("keyword_stats_days", "select * from kstats")

_SEARCHED = f"""
with recursive dictionary as (
  select distinct unnest([lower(p_name), split_part(lower(p_name), ' ', -1), split_part(lower(p_name), ' ', -1) || ' red',
                          'red phone', 'phone case', 'phone case 3']) as word from part where p_name is not null),
asked as (
  select event_id, ts as ets, (epoch_us(ts) // 1000) as ms,
         case when p_name is null then [item] else [lower(p_name) || ' ' || item, lower(p_name)] end as runs
  from (select event_id, ts, user_id, 'red phone case ' || (event_id % 9) as item from events where event_type = 'error')
  left join part on p_partkey = user_id),
run_of as (select event_id, ets, ms, unnest(runs) as run, unnest(range(len(runs))) as r from asked),
cut as (select *, string_split(run, ' ') as w from run_of),
hit as (
  select c.event_id, c.r, i, n, word from cut c, lateral (select unnest(range(1, len(w) + 1)) as i) a, lateral (select unnest(range(1, 6)) as n) b
  join dictionary on word = array_to_string(w[i:i + n - 1], ' ') where i + n - 1 <= len(w)),
"""
_COUNTED = f"""
select word as keyword, count(*) as ct, 'search' as source, {_win('1 days', 'ets')}, min(ms) as ts
from found join cut using (event_id, r) group by word, stt, edt"""
oracle("keyword_stats_dictionary", _SEARCHED + """
found as (
  select event_id, r, word from hit
  union all
  select event_id, r, w[j] from cut, lateral (select unnest(range(1, len(w) + 1)) as j) a
  where not exists (select 1 from hit h where h.event_id = cut.event_id and h.r = cut.r and j between h.i and h.i + h.n - 1))
""" + _COUNTED)
oracle("keyword_stats_longest", _SEARCHED + """
step as (select event_id, r, i, max(n) as n from hit group by all),
path as (
  select event_id, r, w, 1 as i from cut
  union all
  select p.event_id, p.r, p.w, p.i + coalesce(s.n, 1) from path p left join step s on s.event_id = p.event_id and s.r = p.r and s.i = p.i
  where p.i <= len(p.w)),
found as (
  select p.event_id, p.r, array_to_string(p.w[p.i:p.i + coalesce(s.n, 1) - 1], ' ') as word
  from path p left join step s on s.event_id = p.event_id and s.r = p.r and s.i = p.i where p.i <= len(p.w))
""" + _COUNTED)

# Streams end with records of a far time, so they show every window.
oracle("stream_visitor_stats", "select * from vstats")
oracle("stream_product_stats", f"select {_PCOLS} from pstats")
oracle("stream_province_stats", f"select {_PRCOLS} from prstats")
oracle("stream_keyword_stats", "select * from kstats")

# --- reports ------------------------------------------------------------------------------

_ON_ORDER_DATE = "stt[1:10] = '1998-05-04'"
_ON_VISIT_DATE = "stt[1:10] = '2024-01-05'"
_DT = "cast(replace(stt[1:10], '-', '') as int) as dt"


def _top_sql(src: str, keys: str, order: str, limit: int, where: str | None, having: str = "having sum(order_amount) > 0",
             more: str = "") -> str:
    if where:
        return f"""
select {keys}, sum(order_amount)::double as order_amount{more} from {src} where {where} group by {keys} {having}
order by sum(order_amount) desc, {order} limit {limit}"""
    return f"""
select * exclude (rn) from (
  select {_DT}, {keys}, sum(order_amount)::double as order_amount{more},
         row_number() over (partition by dt order by sum(order_amount) desc, {order}) as rn
  from {src} group by dt, {keys} {having})
where rn <= {limit}"""


oracle("report_gmv", f"select sum(order_amount)::double as gmv from pwide where {_ON_ORDER_DATE}")
oracle("report_gmv_today", """
select sum(order_amount)::double as gmv from pwide
where stt[1:10] = strftime(now() at time zone 'UTC', '%Y-%m-%d')""")
oracle("report_gmv_by_day", f"select {_DT}, sum(order_amount)::double as gmv from pwide group by dt")
_BRAND = _top_sql("pwide", "tm_id, tm_name", "tm_name, tm_id", 10, _ON_ORDER_DATE)
oracle("report_brand", _BRAND)
oracle("report_brand_by_day", _top_sql("pwide", "tm_id, tm_name", "tm_name, tm_id", 10, None))
oracle("report_brand_all", _top_sql("pwide", "tm_name", "tm_name", 5, _ON_ORDER_DATE, having=""))
oracle("report_brand_series", f"""
select string_agg(tm_name, ',' order by order_amount desc, tm_name) as categories,
       string_agg(cast(cast(order_amount as decimal(16,2)) as varchar), ',' order by order_amount desc, tm_name) as series
from ({_BRAND})""")
oracle("report_category3", _top_sql("pwide", "category3_id, category3_name", "category3_name, category3_id", 10,
                                    _ON_ORDER_DATE))
oracle("report_category3_by_day", _top_sql("pwide", "category3_id, category3_name", "category3_name, category3_id", 10,
                                           None))
_ORDERS = ", sum(order_ct)::bigint as order_ct"
oracle("report_spu", _top_sql("pwide", "spu_id, spu_name", "spu_name, spu_id", 10, _ON_ORDER_DATE, more=_ORDERS))
oracle("report_spu_by_day", _top_sql("pwide", "spu_id, spu_name", "spu_name, spu_id", 10, None, more=_ORDERS))
oracle("report_province", f"""
select province_name as name, sum(order_amount)::double as value from prstats where {_ON_ORDER_DATE}
group by province_id, province_name""")
oracle("report_province_by_day", f"""
select {_DT}, province_name, sum(order_amount)::double as order_amount from prstats
group by dt, province_id, province_name""")

# Half-up rounding of a quotient of whole numbers to n decimals, in whole numbers.
_RATE = "((uj_ct * 100 * 100 * 2 + sv_ct) // (2 * sv_ct)) / 100.0"
_PAGES = "((pv_ct * 100 * 2 + sv_ct) // (2 * sv_ct)) / 100.0"
_SECONDS = "((((dur_sum * 2 + sv_ct) // (2 * sv_ct)) * 10 * 2 + 1000) // 2000) / 10.0"


def _ratio(expr: str) -> str:
    return f"(case when uv_ct <> 0 and sv_ct <> 0 then {expr} else 0 end)::double"


_SUMS = ", ".join(f"sum({m})::bigint as {m}" for m in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"))
oracle("report_visitor_new", f"""
select *, {_ratio(_RATE)} as uj_rate, {_ratio(_SECONDS)} as dur_per_sv, {_ratio(_PAGES)} as pv_per_sv
from (select {_DT}, is_new, {_SUMS} from vstats group by dt, is_new)""")

_METRICS = [("visitors", "uv_ct::double"), ("pages", "pv_ct::double"), ("bounce_rate", _ratio(_RATE)),
            ("seconds_per_visit", _ratio(_SECONDS)), ("pages_per_visit", _ratio(_PAGES))]
oracle("report_visitor_new_old", " union all ".join(f"""
select '{name}' as type, coalesce(max({expr}) filter (fresh), 0) as new, coalesce(max({expr}) filter (not fresh), 0) as old
from (select is_new = '1' as fresh, {_SUMS} from vstats where {_ON_VISIT_DATE} group by fresh)""" for name, expr in _METRICS))

_HOURLY = """sum(case when is_new = '1' then uv_ct else 0 end)::bigint as new_uv, sum(uv_ct)::bigint as uv_ct,
         sum(pv_ct)::bigint as pv_ct, sum(uj_ct)::bigint as uj_ct"""
oracle("report_visitor_hour", f"""
select lpad(cast(h as varchar), 2, '0') as hr, coalesce(new_uv, 0) as new_uv, coalesce(uv_ct, 0) as uv_ct,
       coalesce(pv_ct, 0) as pv_ct, coalesce(uj_ct, 0) as uj_ct
from (select unnest(range(0, 24)) as h) left join
     (select cast(stt[12:13] as int) as hr, {_HOURLY} from vstats_hour where {_ON_VISIT_DATE} group by hr) on h = hr""")
oracle("report_visitor_hour_by_day", f"""
select {_DT}, cast(stt[12:13] as int) as hr, {_HOURLY} from vstats_hour group by dt, hr""")

oracle("report_keyword", f"""
select keyword as name, (sum(ct) * 10)::bigint as value from kstats where {_ON_VISIT_DATE} group by keyword
order by sum(ct) desc, keyword limit 20""")
oracle("report_keyword_by_day", f"""
select * exclude (rn) from (
  select {_DT}, keyword, (sum(ct) * 10)::bigint as ct,
         row_number() over (partition by dt order by sum(kstats.ct) desc, keyword) as rn
  from kstats group by dt, keyword)
where rn <= 20""")

# --- scalar functions ---------------------------------------------------------------------

oracle("code_decode", f"""
select {_EVENT_SKU} as sku_id, {_text(_SHIFT)} as create_time,
       case when value > 50 then '1201' else '1202' end as appraise,
       case when value > 50 then 'GOOD' else 'SOSO' end as appraise_name
from events where event_type = 'error'""")

_LISTED = ", ".join(f"('{kind}', '{code}', '{name}')" for kind, names in CODES.items() for code, name in names.items())
oracle("code_counts", f"""
with listed(kind, code, name) as (values {_LISTED}),
kinds as (select kind, min(code::int) as first, count(*) as n from listed group by kind),
met as (select kind, cast(first + l_orderkey % (n + 1) as varchar) as code, count(*) as lines from lineitem, kinds group by all)
select kind, code, name, case when lines is not null then name end as decoded, coalesce(lines, 0) as lines
from met full join listed using (kind, code)""")

oracle("time_functions", f"""
select event_id, cast(strftime(ts, '%Y%m%d') as int) as yyyymmdd, cast(hour(ts) as int) as hr, {_text('ts')} as stamp,
       (epoch_us(ts) // 1000) as millis, {_text('ts')} as stamp_of_millis, (epoch_us(date_trunc('second', ts)) // 1000) as millis_of_stamp,
       (epoch_us(date_trunc('second', ts)) // 1000) - 8 * 3600000 as millis_at_8, strftime(ts, '%Y-%m-%d') as day,
       strftime(ts, '%H') as hour_text, strftime(ts, '%Y-%m-%d 00:00:00') as day_start
from events""")

oracle("user_age", "select cast(uid as varchar) as id, birthday, user_gender as gender, user_age from usr")

# --- sources and sinks --------------------------------------------------------------------

oracle("stream_topic_table", """
select page_id, count(*) as records, count(item) as with_item, min(ts) as first_ts from log where start is null group by page_id""")

oracle("stream_snapshot_then_log", """
select c_custkey, case when c_custkey % 3 = 0 then 'update' else 'insert' end as type,
       case when c_custkey % 3 = 0 then 'UPDATED' else c_mktsegment end as segment
from customer where c_custkey % 7 <> 0""")

oracle("stream_log_only", "select raw_op as op, c_custkey from (select case when r = 2 then 'UPDATE' else 'DELETE' end as raw_op, c_custkey "
       "from customer, (values (2), (3)) v(r) where (r = 2 and c_custkey % 3 = 0) or (r = 3 and c_custkey % 7 = 0))")

oracle("stream_restart", """
select sink, count(*) as records, count(distinct event_id) as different, sum(event_id)::bigint as ids, count(*) as listed
from (select event_id, unnest(['ods_log', case when start is null then 'page' else 'start' end]) as sink from log) group by sink""")

oracle("stream_enrich", "select id as order_id, user_id, user_gender, user_age from oi join usr on user_id = uid")
_AS_OF = """
select id as order_id, user_id, user_age,
       cast((user_id + case when user_id % 3 = 0 and ots >= '1999-01-01' and not (user_id % 6 = 0 and ots >= '2000-07-01') then 1 else 0 end) % 2
            as varchar) as user_gender
from oi join usr on user_id = uid"""
oracle("stream_enrich_as_of", _AS_OF)
oracle("order_user_as_of", _AS_OF)

oracle("stream_config_as_of", """
select case when d < '1997-01-01' then 'dwd_orders' when d < '1999-06-01' then 'dwd_orders_priced' else 'dim_orders' end as sink_table,
       case when d < '1997-01-01' then 2 when d < '1999-06-01' then 3 else 2 end as n_columns, o_orderkey,
       case when d < '1997-01-01' then o_custkey end as o_custkey,
       case when d >= '1997-01-01' and d < '1999-06-01' then o_totalprice::double end as o_totalprice,
       case when d >= '1997-01-01' then strftime(d, '%Y-%m-%d %H:%M:%S') end as o_orderdate
from (select *, o_orderdate as d from orders) where d < '1999-06-01' or d >= '2000-01-01'""")
oracle("dim_lookup", "select cast(uid as varchar) as id, birthday, user_gender as gender from usr where uid = 7")

oracle("stream_late_data", f"""
select stt, count(*) as records from (select {_win('1 days', 'ets')} from log where start is null) group by stt""")

# Lines are cut short, left empty or whole; both copies hold all of them.
oracle("stream_tee", """
select unnest(['ods', 'daily']) as copy, n as lines, empty from (select count(*) as n, count(*) filter (event_id % 50 = 1) as empty from log)""")
