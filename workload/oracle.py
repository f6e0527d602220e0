"""The same results as :mod:`workload.queries`, as plain SQL (DuckDB)."""

from __future__ import annotations

# Building blocks ------------------------------------------------------------

_ORDERS_TARGET = """
    select * from orders
    where cast(o_orderdate as date) >= date '1995-01-01'
      and cast(o_orderdate as date) < date '1999-01-01'
"""
_ORDERS_BATCH = """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice,
           o_orderdate, o_orderpriority
    from orders
    where cast(o_orderdate as date) >= date '1998-01-01'
      and cast(o_orderdate as date) < date '2002-01-01'
"""
_ORDERS_UPSERTED = f"""
    select * from ({_ORDERS_BATCH}) b
    union all
    select * from ({_ORDERS_TARGET}) t
    where not exists (select 1 from ({_ORDERS_BATCH}) b where b.o_orderkey = t.o_orderkey)
"""

_LINES = """
    select (l_orderkey * 8 + l_linenumber) * 64 + row_number() over (
               partition by l_orderkey, l_linenumber
               order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
           ) - 1 as line_key, l_orderkey, l_linenumber,
           l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
    from lineitem
"""
_KNOWN_CUSTOMERS = """
    select c.*, f.known_since
    from customer c
    left join (
        select o_custkey, min(o_orderdate) as known_since from orders group by o_custkey
    ) f on f.o_custkey = c.c_custkey
"""
_KNOWN_NATIONS = f"""
    select n.*, f.known_since
    from nation n
    left join (
        select c_nationkey, min(known_since) as known_since
        from ({_KNOWN_CUSTOMERS}) c group by c_nationkey
    ) f on f.c_nationkey = n.n_nationkey
"""
_LINE_VIEW = f"""
    select l.*, o.o_custkey, c.c_nationkey, cast(o.o_orderdate as date) as ordered_on
    from ({_LINES}) l
    join orders o on l.l_orderkey = o.o_orderkey
    join customer c on o.o_custkey = c.c_custkey
"""


def _counts(start: str, end: str, prefix: str) -> str:
    def count(rows: str, watermark: str) -> str:
        return (
            f"(select count(*) from ({rows}) r where cast({watermark} as date) >= date '{start}'"
            f" and cast({watermark} as date) < date '{end}')"
        )

    return f"""
        select {count(_KNOWN_NATIONS, "known_since")} as {prefix}nation,
               {count(_KNOWN_CUSTOMERS, "known_since")} as {prefix}customer,
               {count("select * from orders", "o_orderdate")} as "{prefix}order",
               {count(_LINE_VIEW, "ordered_on")} as {prefix}line
    """


# What the two loads leave.  A row moved if it was in the later window, which
# starts in 1998 (see workload.model.revised).
def _moved(column: str, watermark: str) -> str:
    return (
        f"{column} + case when cast({watermark} as date) >= date '1998-01-01' then 1 else 0 end"
    )


def _line_mart(view: str, customers: str) -> str:
    return f"""
        select l.line_key as id, l.line_quantity, l.l_orderkey as order_id,
               l.o_custkey as customer_id, c.c_name as name, c.balance,
               l.c_nationkey as nation_id, n.n_name as nation_name, n.n_regionkey as region_id
        from ({view}) l
        join ({customers}) c on c.c_custkey = l.o_custkey
        join nation n on n.n_nationkey = l.c_nationkey
    """


_BACKFILL_MART = _line_mart(
    f"select v.*, l_quantity as line_quantity from ({_LINE_VIEW}) v"
    " where ordered_on < date '1999-01-01'",
    "select *, c_acctbal as balance from customer",
)


def _sales_mart(lines: str, parts: str) -> str:
    return f"""
        select l.line_key as id, l.l_quantity as line_quantity, l.l_extendedprice as price,
               l.l_shipdate as ship_date, l.l_partkey as part_id, p.p_name as name,
               p.p_size as size, l.l_suppkey as supplier_id, s.s_name as supplier_name,
               s.s_acctbal as supplier_balance
        from ({lines}) l
        join ({parts}) p on p.p_partkey = l.l_partkey
        join supplier s on s.s_suppkey = l.l_suppkey
    """


# The batch writes all columns, NULL included.
_PARTS_UPSERTED = """
    select * from part where p_type not in ('PROMO', 'LARGE')
    union all
    select p_partkey, p_name || ' +', null, p_type, p_size + 1, p_retailprice
    from part where p_type in ('PROMO', 'LARGE')
"""


_VIEW = """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           l_shipdate, o_custkey as customer_id, c_nationkey as nation_id,
           cast(o_orderdate as date) as updated_at
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
"""


def _rounded(ts: str) -> str:
    """By the part below the second: up from the half on, before 2000 above it."""
    part = f"(date_part('microsecond', {ts}) % 1000000)"
    return f"""
        date_trunc('second', {ts}) + case
            when {part} > 500000 then interval 1 second
            when {part} = 500000 and date_part('year', {ts}) >= 2000 then interval 1 second
            else interval 0 second end
    """


_HALF = f"({_rounded('ts')} + interval 500 milliseconds)"


# One statement per query ------------------------------------------------------

ORACLE = {
    "extract_window_orders": """
        select * from orders
        where cast(o_orderdate as date) >= date '1998-01-01'
          and cast(o_orderdate as date) < date '1999-01-01'
    """,
    "extract_window_events": "select * from events where cast(ts as date) = date '2024-01-10'",
    "default_window": "select * from events where cast(ts as date) = date '2024-01-10'",
    "null_watermark": """
        select o_orderkey, o_orderdate as updated_at from orders
        where o_orderstatus <> 'P'
          and cast(o_orderdate as date) >= date '1998-01-01'
          and cast(o_orderdate as date) < date '1999-01-01'
    """,
    "extract_counts": _counts("1998-01-01", "1999-01-01", ""),
    "extract_default_counts": _counts("1998-07-01", "1998-07-02", ""),
    "lesson_view": _VIEW,
    "lesson_view_window": f"""
        select * from ({_VIEW}) v
        where updated_at >= date '1998-01-01' and updated_at < date '1999-01-01'
    """,
    "rename_key": """
        select c_custkey as customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment
        from customer
    """,
    "rename_key_inner": """
        select o_custkey as customer_id, o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
               o_orderpriority
        from orders
    """,
    "prune_columns": "select c_custkey, c_name, c_acctbal, c_mktsegment from customer",
    "positional_map": """
        select o_orderkey as id, o_custkey as customer_id, o_orderdate as ordered_at,
               o_totalprice as total, o_orderstatus as status
        from orders
    """,
    "type_conformity": """
        select cast(o_orderkey as integer) as id, cast(o_custkey as integer) as customer_id,
               o_orderdate + case when o_orderdate >= timestamp '2000-01-01'
                   then interval 1 second else interval 0 second end as ordered_at,
               rpad(o_orderpriority, 16, ' ') as priority
        from orders
    """,
    "upsert_dim_rows": _ORDERS_UPSERTED,
    "upsert_dim_stream": """
        select * from customer where c_mktsegment not in ('MACHINERY', 'BUILDING')
        union all
        select c_custkey, c_name || ' +', null, c_acctbal + 1, c_mktsegment
        from customer where c_mktsegment in ('MACHINERY', 'BUILDING')
    """,
    "upsert_dim_module": _PARTS_UPSERTED,
    "upsert_fact_rows": f"""
        select line_key as id, l_orderkey as order_id, c_nationkey as nation_id,
               o_custkey as customer_id, l_linenumber as line_number, l_quantity as quantity,
               l_extendedprice as price, l_shipdate as ship_date
        from ({_LINE_VIEW}) v where l_shipdate < timestamp '1998-01-01'
        union all
        select line_key, l_orderkey, null, o_custkey, l_linenumber, l_quantity + 1, null, l_shipdate
        from ({_LINE_VIEW}) v where l_shipdate >= timestamp '1998-01-01'
    """,
    "upsert_fact_events": """
        select * from events where ts < timestamp '2024-01-15'
        union all
        select event_id, ts, user_id, 'late', value + 1, null
        from events where ts >= timestamp '2024-01-15'
    """,
    "upsert_row_count": f"select count(*) as affected_rows from ({_ORDERS_BATCH}) b",
    "upsert_insert_update_split": f"""
        select count(*) filter (where t.o_orderkey is null) as inserted,
               count(*) filter (where t.o_orderkey is not null) as updated
        from ({_ORDERS_BATCH}) b
        left join ({_ORDERS_TARGET}) t on t.o_orderkey = b.o_orderkey
    """,
    "key_violations": """
        select l_orderkey, l_linenumber, count(*) as "rows" from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1
    """,
    "key_violations_null": """
        select event_key, count(*) as "rows"
        from (select case when event_type <> 'error' then event_id end as event_key from events)
        group by event_key having count(*) > 1 or event_key is null
    """,
    "fk_violations": """
        select c_nationkey, count(*) as "rows" from customer
        where c_nationkey not in (
            select n_nationkey from nation join region on n_regionkey = r_regionkey
            where r_name <> 'AFRICA'
        )
        group by c_nationkey
    """,
    "fk_violations_orders": """
        select o_custkey, count(*) as "rows" from orders
        where o_custkey not in (select user_id from events)
        group by o_custkey
    """,
    "fk_null_passes": """
        select c_nationkey + 1000 as c_nationkey, count(*) as "rows" from customer
        where c_mktsegment = 'BUILDING' group by 1
    """,
    "varchar_violations": """
        select c_custkey, c_mktsegment from customer where length(rtrim(c_mktsegment)) > 8
    """,
    "varchar_blank_excess": """
        select c_custkey,
               case when length(c_mktsegment) <= 9 then rpad(c_mktsegment, 9, ' ')
                    else rpad(c_mktsegment, 14, ' ') end as segment,
               length(c_mktsegment) > 9 as too_long
        from customer
    """,
    "batch_profile": """
        select cast(sum(n) as bigint) as "rows",
               cast(coalesce(sum(n) filter (where user_id is null), 0) as bigint) as null_keys,
               count(*) filter (where n > 1 and user_id is not null) as duplicate_keys,
               cast(sum(over_long) as bigint) as event_type_too_long
        from (
            select user_id, count(*) as n,
                   count(*) filter (where length(rtrim(event_type)) > 5) as over_long
            from events group by user_id
        )
    """,
    "cast_text_date": """
        select event_id, cast(cast(ts as varchar) as date) as from_timestamp_text,
               cast(strftime(ts, '%Y-%m-%d') as date) as from_date_text
        from events
    """,
    "cast_text_timestamp": """
        select event_id,
               cast(case when event_type <> 'view' then cast(ts as varchar) end as timestamp)
                   as deleted_at
        from events
    """,
    "round_seconds": f"""
        select event_id, {_rounded("ts")} as rounded, {_rounded(_HALF)} as half,
               {_rounded("(ts - interval 360 month)")} as old_rounded,
               {_rounded(f"({_HALF} - interval 360 month)")} as old_half
        from events
    """,
    "interval_arith": """
        select event_id, ts - interval 1 day as day_before, ts + interval 1 month as month_later,
               ts + interval 5 month as five_months_later,
               ts + interval 6 month as six_months_later, ts - interval 2 day as two_days_before
        from events
    """,
    "inline_values": """
        select o_orderstatus, o_orderkey, status_title, is_open from orders
        join (values ('O', 'Open', true), ('F', 'Fulfilled', false), ('P', null, true))
            as s(o_orderstatus, status_title, is_open) using (o_orderstatus)
    """,
    "mart_star_join": _sales_mart(
        "select *, l_orderkey * 8 + l_linenumber as line_key from lineitem",
        "select * from part",
    ),
    "mart_after_upsert": _sales_mart(
        f"select * replace ({_moved('l_quantity', 'l_shipdate')} as l_quantity)"
        f" from ({_LINES}) u where l_orderkey in (select o_orderkey from orders)",
        _PARTS_UPSERTED,
    ),
    "order_view": """
        select o.*, c.c_name as customer_name, c.c_mktsegment as segment,
               c.c_nationkey as nation_id, n.n_name as nation_name
        from orders o
        join customer c on c.c_custkey = o.o_custkey
        join nation n on n.n_nationkey = c.c_nationkey
    """,
    "stage_roundtrip": f"""
        select o_orderkey as order_id, * exclude (o_orderkey) from ({_ORDERS_BATCH}) b
    """,
    "upsert_all_counts": _counts("1998-01-01", "2002-01-01", "affected_rows_"),
    "backfill_counts": _counts("1995-01-01", "1999-01-01", "affected_rows_"),
    "load_backfill_mart": _BACKFILL_MART,
    "load_nations": f"""
        select n_nationkey as nation_id, n_name, n_regionkey from ({_KNOWN_NATIONS}) n
        where known_since is not null
    """,
    "load_customers": f"""
        select c_custkey as customer_id, c_name, {_moved("c_acctbal", "known_since")} as c_acctbal,
               c_mktsegment
        from ({_KNOWN_CUSTOMERS}) c where known_since is not null
    """,
    "load_orders": f"""
        select o_orderkey as order_id, o_orderstatus,
               {_moved("o_totalprice", "o_orderdate")} as o_totalprice, o_orderdate,
               o_orderpriority
        from orders
    """,
    "load_lines": f"""
        select line_key as id, l_orderkey as order_id, c_nationkey as nation_id,
               o_custkey as customer_id, l_linenumber as line_number,
               {_moved("l_quantity", "ordered_on")} as quantity, l_extendedprice as price,
               l_shipdate as ship_date
        from ({_LINE_VIEW}) v
    """,
    "load_mart": _line_mart(
        f"select v.*, {_moved('l_quantity', 'ordered_on')} as line_quantity"
        f" from ({_LINE_VIEW}) v",
        f"select *, {_moved('c_acctbal', 'known_since')} as balance"
        f" from ({_KNOWN_CUSTOMERS}) c",
    ),
    "load_rerun_mart": _BACKFILL_MART,
    "load_recreated_lines": f"""
        select line_key as id, l_orderkey as order_id, c_nationkey as nation_id,
               o_custkey as customer_id, l_linenumber as line_number, l_quantity as quantity,
               l_extendedprice as price, l_shipdate as ship_date
        from ({_LINE_VIEW}) v where ordered_on >= date '1999-01-01'
    """,
    "load_small_increment": f"""
        select line_key as id, l_orderkey as order_id, c_nationkey as nation_id,
               o_custkey as customer_id, l_linenumber as line_number,
               l_quantity + case when l_orderkey between 1000 and 1019 then 1 else 0 end
                   as quantity,
               l_extendedprice as price, l_shipdate as ship_date
        from ({_LINE_VIEW}) v
    """,
    "load_small_increment_mart": _line_mart(
        f"select *, l_quantity + case when l_orderkey between 1000 and 1019 then 1 else 0 end"
        f" as line_quantity from ({_LINE_VIEW}) v",
        "select *, c_acctbal as balance from customer",
    ),
    "load_dimension_change": f"""
        select m.* replace (
            case when customer_id = 7 then name || ' +' else name end as name,
            case when nation_id = 3 then nation_name || ' +' else nation_name end as nation_name
        ) from ({_line_mart(
            f"select *, l_quantity + case when l_orderkey between 1000 and 1019 then 1 else 0 end"
            f" as line_quantity from ({_LINE_VIEW}) v",
            "select *, c_acctbal as balance from customer",
        )}) m
    """,
    "load_sparse_keys": """
        select ((c_custkey * 40503) % 65536 - 32768) * 281474976710656 + c_custkey as customer_id,
               case when hit then null else c_name end as c_name,
               c_acctbal + case when hit then 1 else 0 end as c_acctbal, c_mktsegment
        from (select *, c_mktsegment in ('MACHINERY', 'BUILDING') as hit from customer)
    """,
}
ORACLE |= {
    "extract_window_sql": ORACLE["extract_window_orders"],
    "session_now": """
        select event_id, cast(ts as date) < current_date as is_over,
               date_diff('day', cast(ts as date), current_date) as days_ago
        from events
    """,
    "lesson_view_by_month": ORACLE["lesson_view_window"],
    "upsert_bucketed": ORACLE["upsert_dim_rows"],
    "key_violations_bitmap": """
        select odd_key, count(*) as "rows" from (
            select case o_orderstatus when 'P' then -o_custkey
                when 'O' then o_orderkey * 1099511627776 + o_custkey % 5
                else case when o_orderpriority = '1-URGENT' then null else o_orderkey end
                end as odd_key
            from orders
        ) group by odd_key having count(*) > 1 or odd_key is null
    """,
    "fk_violations_bitmap": ORACLE["fk_violations_orders"],
    "varchar_accepted": """
        select c_custkey, rpad(c_mktsegment, 9, ' ') as c_mktsegment from customer
        where length(c_mktsegment) <= 9
    """,
    "mart_delta_refresh": ORACLE["mart_after_upsert"],
    "sql_upsert_counts": ORACLE["upsert_all_counts"],
    "sql_upserted_orders": ORACLE["load_orders"],
}
