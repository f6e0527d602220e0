"""One query per operator, over the shared test tables.

Each takes a session and the folder of the tables and reads them whole.  Date
windows are literal, so results repeat.  The "later" source (see
``workload.model.revised``) stands for changes between two loads: a target
holds what was dated before 1999, a batch is the window [1998, 2002), so 1998
is updated, later years are inserted and earlier ones stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import FrameSource, LoadResult, Warehouse, load, run
from tidemark.functions import (
    drop_blank_excess,
    exceeds,
    round_to_second,
    shift,
    text_to_date,
    text_to_timestamp,
)
from tidemark.operators import (
    affected_rows,
    apply_delta,
    batch_profile,
    changed_between,
    changed_between_sql,
    changed_keys,
    conform,
    denormalise,
    insert_update_split,
    integer_key_violations,
    integer_reference_violations,
    key_violations,
    map_by_position,
    mart_delta,
    prune,
    reference_violations,
    rename_key,
    star_join,
    text_violations,
    transform,
    upsert,
)
from tidemark.plans.extract import extract, extract_counts, window
from tidemark.plans.files import delete_tree
from tidemark.plans.sql_functions import create_functions
from tidemark.session import shared_folder
from tidemark.sources import (
    declared_columns,
    empty_table,
    inline_rows,
    read,
    write_bucketed,
    write_by_column,
)
from tidemark.specs import StarMart, TargetSpec, columns
from workload.model import (
    D_CUSTOMER,
    D_ORDER,
    F_LINE,
    LINE_KEY,
    LINES,
    line_ancestors,
    line_model,
    source,
    source_tables,
    table,
)

START, CUT, END = "1998-01-01", "1999-01-01", "2002-01-01"
HISTORY = "1995-01-01"


# -- extract ----------------------------------------------------------------


def extract_window_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_between(table(spark, sf_dir, "orders"), "o_orderdate", START, CUT)


def extract_window_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_between(table(spark, sf_dir, "events"), "ts", "2024-01-10", "2024-01-11")


def extract_window_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, the table named to SQL by a parameter."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_of_sql")
    return changed_between_sql(spark, "orders_of_sql", "o_orderdate", START, CUT)


def session_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default window's end is today, by the session's clock."""
    _, today = window(None, None)
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select(
        "event_id",
        (day < F.lit(today)).alias("is_over"),
        F.date_diff(F.lit(today), day).cast("bigint").alias("days_ago"),
    )


def default_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = window(None, "2024-01-11 09:00:00")
    return changed_between(table(spark, sf_dir, "events"), "ts", start, end)


def null_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    orders = table(spark, sf_dir, "orders").withColumn("updated_at", known)
    return changed_between(orders, "updated_at", START, CUT).select("o_orderkey", "updated_at")


def extract_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_counts(extract(LINES, source(spark, sf_dir), START, CUT))


def extract_default_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_counts(extract(LINES, source(spark, sf_dir), as_of="1998-07-02 09:00:00"))


# -- view -------------------------------------------------------------------


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over the table as it is, repeated keys included."""
    ancestors = line_ancestors(lambda name: table(spark, sf_dir, name))
    return _visible(denormalise(table(spark, sf_dir, "lineitem"), ancestors, "l_orderkey"))


def _visible(view: DataFrame) -> DataFrame:
    return view.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_shipdate",
        F.col("o_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("ordered_on").alias("updated_at"),
    )


def lesson_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir)


def lesson_view_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_between(_view(spark, sf_dir), "updated_at", START, CUT)


def lesson_view_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window of the view over lines laid out by the month of their order: the
    orders in the window tell, at run time, which months of lines to read."""
    month = F.date_format("o_orderdate", "yyyyMM").cast("int").alias("month")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", month)
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    root = _new_root(spark)
    lines = write_by_column(lines, f"{root}/lines_by_month", "month")
    ancestors = line_ancestors(lambda name: table(spark, sf_dir, name)).withColumn(
        "month", F.date_format("ordered_on", "yyyyMM").cast("int")
    )
    changed_between(ancestors, "ordered_on", START, CUT).write.parquet(f"{root}/ancestors")
    # Stored, their size is known; filtered, they prune.
    known = spark.read.schema(ancestors.schema).parquet(f"{root}/ancestors")
    in_window = changed_between(known, "ordered_on", START, CUT)
    return _visible(denormalise(lines, in_window, "l_orderkey", "month"))


# -- shape ------------------------------------------------------------------


def rename_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_key(table(spark, sf_dir, "customer"), "c_custkey", "customer_id")


def rename_inner_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the second column, and comes to the front."""
    return rename_key(table(spark, sf_dir, "orders"), "o_custkey", "customer_id")


def prune_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return prune(customer, [c for c in customer.columns if c != "c_nationkey"])


def positional_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = prune(
        table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"],
    )
    return map_by_position(ordered, ["id", "customer_id", "ordered_at", "total", "status"])


_TYPED_ORDER = TargetSpec(
    name="typed_order",
    key="id",
    schema=columns(
        "id int, customer_id int, ordered_at timestamp_ntz, priority string"
    ),
    staged_as=("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
    text_limits={"priority": 16},
    whole_seconds=frozenset({"ordered_at"}),
)


def type_conformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = table(spark, sf_dir, "orders").withColumns(
        {
            "o_orderdate": F.concat(F.col("o_orderdate").cast("string"), F.lit(".500")),
            "o_orderpriority": F.rpad("o_orderpriority", 20, " "),
        }
    )
    return conform(staged, _TYPED_ORDER)


# -- upsert -----------------------------------------------------------------


def _orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_between(table(spark, sf_dir, "orders"), "o_orderdate", HISTORY, CUT)


def _orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = changed_between(table(spark, sf_dir, "orders"), "o_orderdate", START, END)
    return batch.withColumn("o_totalprice", F.col("o_totalprice") + 1)


def upsert_dim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(_orders_target(spark, sf_dir), _orders_batch(spark, sf_dir), ["o_orderkey"])


def upsert_dim_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    target = customer.where("c_mktsegment <> 'MACHINERY'")
    batch = customer.where("c_mktsegment in ('MACHINERY', 'BUILDING')").withColumns(
        {
            "c_name": F.concat("c_name", F.lit(" +")),
            "c_nationkey": F.lit(None).cast("int"),
            "c_acctbal": F.col("c_acctbal") + 1,
        }
    )
    return upsert(target, batch, ["c_custkey"])


def upsert_dim_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    target = part.where("p_type <> 'PROMO'")
    batch = part.where("p_type in ('PROMO', 'LARGE')").withColumns(
        {
            "p_name": F.concat("p_name", F.lit(" +")),
            "p_brand": F.lit(None).cast("string"),
            "p_size": F.col("p_size") + 1,
        }
    )
    return upsert(target, batch, ["p_partkey"])


def upsert_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = read(LINES, source(spark, sf_dir), "line_view")
    lines = conform(rename_key(view, "line_key", "line_id"), F_LINE)
    target = changed_between(lines, "ship_date", HISTORY, CUT)
    batch = changed_between(lines, "ship_date", START, END).withColumns(
        {
            "nation_id": F.lit(None).cast("int"),
            "quantity": F.col("quantity") + 1,
            "price": F.lit(None).cast("double"),
        }
    )
    return upsert(target, batch, ["id"])


def upsert_fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    target = changed_between(events, "ts", "2024-01-01", "2024-01-16")
    batch = changed_between(events, "ts", "2024-01-15", "2024-02-01").withColumns(
        {
            "event_type": F.lit("late"),
            "value": F.col("value") + 1,
            "props": F.lit(None).cast("string"),
        }
    )
    return upsert(target, batch, ["event_id"])


def upsert_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affected_rows(_orders_batch(spark, sf_dir))


def upsert_insert_update_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insert_update_split(
        _orders_target(spark, sf_dir), _orders_batch(spark, sf_dir), ["o_orderkey"]
    )


def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and batch stored in buckets by key, so that neither is shuffled."""
    root, tag = _new_root(spark), uuid.uuid4().hex
    frames = {"target": _orders_target(spark, sf_dir), "batch": _orders_batch(spark, sf_dir)}
    stored = {
        name: write_bucketed(df, f"{name}_{tag}", f"{root}/{name}", "o_orderkey", 8)
        for name, df in frames.items()
    }
    return upsert(stored["target"], stored["batch"], ["o_orderkey"])


# -- checks -----------------------------------------------------------------


def key_violations_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def key_violations_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("event_type") != "error", F.col("event_id")).alias("event_key")
    return key_violations(table(spark, sf_dir, "events").select(key), ["event_key"])


# Dense, sparse, negative, NULL and repeated keys.  The sparse ones are decimals (BD):
# beyond some eight million orders they do not fit into 64 bits.
_ODD_KEY = """
    case o_orderstatus when 'P' then -o_custkey
        when 'O' then o_orderkey * 1099511627776BD + o_custkey % 5
        else if(o_orderpriority = '1-URGENT', null, o_orderkey) end
"""


def key_violations_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select(F.expr(_ODD_KEY).alias("odd_key"))
    found = integer_key_violations(keys, "odd_key")
    return found.select(F.col("odd_key").cast("bigint"), "rows")


def fk_violations_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integer_reference_violations(
        table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "events"), "user_id"
    )


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").where("r_name <> 'AFRICA'")
    nation = table(spark, sf_dir, "nation")
    known = nation.join(region, nation.n_regionkey == region.r_regionkey, "left_semi")
    return reference_violations(
        table(spark, sf_dir, "customer"), "c_nationkey", known, "n_nationkey"
    )


def fk_violations_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_violations(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        table(spark, sf_dir, "events").select("user_id").distinct(),
        "user_id",
    )


def fk_null_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    customer = table(spark, sf_dir, "customer").withColumn(
        "c_nationkey",
        F.when(segment == "BUILDING", F.col("c_nationkey") + 1000).when(
            segment != "FURNITURE", F.col("c_nationkey")
        ),
    )
    nation = table(spark, sf_dir, "nation")
    return reference_violations(customer, "c_nationkey", nation, "n_nationkey")


def varchar_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return text_violations(customer, {"c_mktsegment": 8})


def varchar_blank_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.rpad("c_mktsegment", 14, " ")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        drop_blank_excess(padded, 9).alias("segment"),
        exceeds(padded, 9).alias("too_long"),
    )


def varchar_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a declared table takes: too long a text would fail the write, so those
    rows are left out; blanks beyond the limit go by the write itself."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    padded = customer.withColumn("c_mktsegment", F.rpad("c_mktsegment", 14, " "))
    name, path = f"declared_{uuid.uuid4().hex}", f"{_new_root(spark)}/declared"
    declared = declared_columns(padded.schema, {"c_mktsegment": 9})
    spark.sql(f"create table {name} ({declared}) using parquet location '{path}'")
    padded.where(~exceeds(F.col("c_mktsegment"), 9)).write.insertInto(name)
    return spark.table(name)


def batch_profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_profile(table(spark, sf_dir, "events"), ["user_id"], {"event_type": 5})


# -- scalar functions -------------------------------------------------------


def cast_text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("ts").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        text_to_date(text).alias("from_timestamp_text"),
        text_to_date(F.date_format("ts", "yyyy-MM-dd")).alias("from_date_text"),
    )


def cast_text_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_type") != "view", F.col("ts").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id", text_to_timestamp(text).alias("deleted_at")
    )


def round_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    half = round_to_second(ts) + F.expr("interval 500 milliseconds")
    return table(spark, sf_dir, "events").select(
        "event_id",
        round_to_second(ts).alias("rounded"),
        round_to_second(half).alias("half"),
        round_to_second(shift(ts, months=-360)).alias("old_rounded"),
        round_to_second(shift(half, months=-360)).alias("old_half"),
    )


def interval_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        shift(ts, days=-1).alias("day_before"),
        shift(ts, months=1).alias("month_later"),
        shift(ts, months=5).alias("five_months_later"),
        shift(ts, months=6).alias("six_months_later"),
        shift(ts, days=-2).alias("two_days_before"),
    )


def inline_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    statuses = inline_rows(
        spark,
        columns("o_orderstatus string, status_title string, is_open boolean"),
        [("O", "Open", True), ("F", "Fulfilled", False), ("P", None, True)],
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(statuses, "o_orderstatus")


# -- mart -------------------------------------------------------------------

_SALES_MART = StarMart(
    name="sales_dm",
    fact="line",
    key="id",
    joins=(("part", "part_id"), ("supplier", "supplier_id")),
    columns=(
        ("line", "id", "id"),
        ("line", "quantity", "line_quantity"),
        ("line", "price", "price"),
        ("line", "ship_date", "ship_date"),
        ("line", "part_id", "part_id"),
        ("part", "name", "name"),
        ("part", "size", "size"),
        ("line", "supplier_id", "supplier_id"),
        ("supplier", "name", "supplier_name"),
        ("supplier", "balance", "supplier_balance"),
    ),
)


def _sales_mart(lines: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """Lines joined to the two tables they reference directly."""
    return star_join(_SALES_MART, _sales_tables(lines, part, supplier))


def _sales_tables(
    lines: DataFrame, part: DataFrame, supplier: DataFrame
) -> dict[str, DataFrame]:
    fact = prune(
        lines, ["line_key", "l_quantity", "l_extendedprice", "l_shipdate", "l_partkey", "l_suppkey"]
    )
    return {
        "line": map_by_position(
            fact, ["id", "quantity", "price", "ship_date", "part_id", "supplier_id"]
        ),
        "part": map_by_position(
            prune(part, ["p_partkey", "p_name", "p_size"]), ["part_id", "name", "size"]
        ),
        "supplier": map_by_position(
            prune(supplier, ["s_suppkey", "s_name", "s_acctbal"]),
            ["supplier_id", "name", "balance"],
        ),
    }


def mart_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("line_key", F.expr(LINE_KEY))
    return _sales_mart(lines, table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier"))


def mart_after_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(LINES, source(spark, sf_dir), "line_view")
    target = changed_between(lines, "l_shipdate", HISTORY, CUT)
    batch = changed_between(lines, "l_shipdate", START, END).withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    return _sales_mart(
        upsert(target, batch, ["line_key"]),
        upsert_dim_module(spark, sf_dir),
        table(spark, sf_dir, "supplier"),
    )


# Lines of one bucket: some ten MB as stored, sorted in memory by the task that reads it.
BUCKET_ROWS = 500_000


def mart_delta_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of earlier lines and parts, changed by what came since.

    The view is stored once, in buckets by the lines' key: each step compares lines by
    that key, and would else join the view anew and move it by the key again.
    """
    view = read(LINES, source(spark, sf_dir), "line_view").select(
        "line_key", "l_quantity", "l_extendedprice", "l_shipdate", "l_partkey", "l_suppkey"
    )
    buckets = -(-table(spark, sf_dir, "lineitem").count() // BUCKET_ROWS) or 1
    lines = write_bucketed(
        view, f"lines_{uuid.uuid4().hex}", f"{_new_root(spark)}/lines", "line_key", buckets
    )
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    old_part, new_part = part.where("p_type <> 'PROMO'"), upsert_dim_module(spark, sf_dir)
    target = changed_between(lines, "l_shipdate", HISTORY, CUT)
    batch = changed_between(lines, "l_shipdate", START, END).withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    before = _sales_tables(target, old_part, supplier)
    after = _sales_tables(upsert(target, batch, ["line_key"]), new_part, supplier)
    changed = {
        name: changed_keys(before[name], after[name], key, _SALES_MART.looked_at(name))
        for name, key in (("line", "id"), ("part", "part_id"))
    }
    return apply_delta(star_join(_SALES_MART, before), mart_delta(_SALES_MART, after, changed))


def order_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with columns of their customer and nation."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    ancestors = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("n_name").alias("nation_name"),
    )
    return denormalise(table(spark, sf_dir, "orders"), ancestors, "o_custkey")


# -- warehouse: the whole job, stored ---------------------------------------


# Folders that queries have made; their results read them.
_ROOTS: list[tuple[SparkSession, str]] = []


def _new_root(spark: SparkSession) -> str:
    root = f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"
    _ROOTS.append((spark, root))
    return root


def _new_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """An empty warehouse that will have some tens of fact partitions."""
    return Warehouse.create(spark, _new_root(spark), line_model(spark, sf_dir))


def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = rename_key(_orders_batch(spark, sf_dir), "o_orderkey", "order_id")
    return Warehouse.create(spark, _new_root(spark), LINES).stage(D_ORDER.name, batch)[0]


def _run(warehouse: Warehouse, tables, start: str, end: str) -> LoadResult:
    return run(warehouse.model, tables, warehouse, start, end)


def load_once(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, LoadResult]:
    """A warehouse after a backfill up to 1999."""
    warehouse = _new_warehouse(spark, sf_dir)
    return warehouse, _run(warehouse, source(spark, sf_dir), HISTORY, CUT)


def load_twice(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, LoadResult]:
    """The same after a later load from 1998 on."""
    warehouse, _ = load_once(spark, sf_dir)
    return warehouse, _run(warehouse, source(spark, sf_dir, later=True), START, END)


def forget_loads() -> None:
    """Delete what queries have stored.  Earlier results cannot be read any more."""
    while _ROOTS:
        delete_tree(*_ROOTS.pop())


def whole_load(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse after one load of all there is."""
    warehouse = _new_warehouse(spark, sf_dir)
    _run(warehouse, source(spark, sf_dir), HISTORY, END)
    return warehouse


def small_increment(spark: SparkSession, sf_dir: str, warehouse: Warehouse):
    """Load what has happened to twenty neighbouring orders since."""
    tables, moved = source_tables(spark, sf_dir), "{0} between 1000 and 1019"
    orders, lines = tables["orders"], tables["lineitem"]
    hit_order, hit_line = (F.expr(moved.format(c)) for c in ("o_orderkey", "l_orderkey"))
    day = F.lit(END).cast("timestamp_ntz")
    tables |= {
        "orders": orders.withColumn(
            "o_orderdate", F.when(hit_order, day).otherwise(F.col("o_orderdate"))
        ),
        "lineitem": lines.withColumn(
            "l_quantity", F.col("l_quantity") + F.when(hit_line, 1).otherwise(0)
        ),
    }
    return _run(warehouse, FrameSource(tables), END, "2002-02-01")


def dimension_change(spark: SparkSession, sf_dir: str, warehouse: Warehouse):
    """Load a renamed customer and a renamed nation, and no order."""
    tables, day = source_tables(spark, sf_dir), F.lit("2002-03-01").cast("timestamp_ntz")

    def renamed(name: str, key: str, value: int, column: str) -> DataFrame:
        hit = F.col(key) == value
        return tables[name].withColumns(
            {
                column: F.when(hit, F.concat(column, F.lit(" +"))).otherwise(F.col(column)),
                "known_since": F.when(hit, day).otherwise(F.col("known_since")),
            }
        )

    tables |= {
        "customer": renamed("customer", "c_custkey", 7, "c_name"),
        "nation": renamed("nation", "n_nationkey", 3, "n_name"),
    }
    return _run(warehouse, FrameSource(tables), "2002-03-01", "2002-04-01")


def _after_small_increment(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse = whole_load(spark, sf_dir)
    small_increment(spark, sf_dir, warehouse)
    return warehouse


def load_small_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_small_increment(spark, sf_dir).table(F_LINE.name)


def load_small_increment_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_small_increment(spark, sf_dir).table(LINES.mart.name)


def load_dimension_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _after_small_increment(spark, sf_dir)
    dimension_change(spark, sf_dir, warehouse)
    return warehouse.table(LINES.mart.name)


def load_recreated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, create the tables again, load another window."""
    first, _ = load_once(spark, sf_dir)
    again = Warehouse.create(spark, first.root, first.model)
    # Customers and nations of earlier years are needed by later orders.
    frames = transform(extract(LINES, source(spark, sf_dir), HISTORY, END), LINES.entities)
    late = transform(extract(LINES, source(spark, sf_dir), CUT, END), LINES.entities)
    load(again.model, frames | {"line": late["line"]}, again)
    return again.table(F_LINE.name)


def load_sparse_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys spread over all of ``bigint``, loaded and then upserted."""
    model = LINES.with_bucket_bits({D_CUSTOMER.name: 59})
    warehouse = Warehouse.create(spark, _new_root(spark), model)
    customer = table(spark, sf_dir, "customer")
    key = F.expr("(c_custkey * 40503 % 65536 - 32768) * 281474976710656 + c_custkey")
    hit = "c_mktsegment in ('MACHINERY', 'BUILDING')"
    batches = (
        customer.where("c_mktsegment <> 'MACHINERY'"),
        customer.where(hit).withColumns(
            {"c_name": F.lit(None).cast("string"), "c_acctbal": F.col("c_acctbal") + 1}
        ),
    )
    for batch in batches:
        frames = {
            e.name: empty_table(spark, e.target.schema).toDF(*e.target.staged_columns)
            for e in LINES.entities
        }
        frames["customer"] = batch.select(key.alias("customer_id"), *D_CUSTOMER.columns[1:])
        load(model, frames, warehouse)
    return warehouse.table(D_CUSTOMER.name)


def upsert_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_twice(spark, sf_dir)[1].frame()


def backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_once(spark, sf_dir)[1].frame()


def load_backfill_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_once(spark, sf_dir)[0].table(LINES.mart.name)


def load_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_twice(spark, sf_dir)[0].table("d_nation")


def load_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_twice(spark, sf_dir)[0].table("d_customer")


def load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_twice(spark, sf_dir)[0].table("d_order")


def load_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_twice(spark, sf_dir)[0].table("f_line")


def load_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_twice(spark, sf_dir)[0].table(LINES.mart.name)


def sql_upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_functions(load_twice(spark, sf_dir)[0])
    return spark.sql("select * from upsert_all()")


def sql_upserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later window is staged over a backfill, and not written."""
    warehouse, _ = load_once(spark, sf_dir)
    later = extract(LINES, source(spark, sf_dir, later=True), START, END)
    warehouse.stage(D_ORDER.name, transform(later, LINES.entities)["order"])
    create_functions(warehouse)
    return spark.sql("select * from upserted_d_order()")


def load_rerun_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same window loaded twice in a row."""
    warehouse, _ = load_once(spark, sf_dir)
    _run(warehouse, source(spark, sf_dir), HISTORY, CUT)
    return warehouse.table(LINES.mart.name)


QUERIES = {
    "extract_window_sql": extract_window_sql,
    "session_now": session_now,
    "lesson_view_by_month": lesson_view_by_month,
    "upsert_bucketed": upsert_bucketed,
    "key_violations_bitmap": key_violations_bitmap,
    "fk_violations_bitmap": fk_violations_bitmap,
    "varchar_accepted": varchar_accepted,
    "mart_delta_refresh": mart_delta_refresh,
    "sql_upsert_counts": sql_upsert_counts,
    "sql_upserted_orders": sql_upserted_orders,
    "extract_window_orders": extract_window_orders,
    "extract_window_events": extract_window_events,
    "default_window": default_window,
    "null_watermark": null_watermark,
    "extract_counts": extract_all_counts,
    "extract_default_counts": extract_default_counts,
    "lesson_view": lesson_view,
    "lesson_view_window": lesson_view_window,
    "rename_key": rename_keys,
    "rename_key_inner": rename_inner_key,
    "prune_columns": prune_columns,
    "positional_map": positional_map,
    "type_conformity": type_conformity,
    "upsert_dim_rows": upsert_dim_rows,
    "upsert_dim_stream": upsert_dim_stream,
    "upsert_dim_module": upsert_dim_module,
    "upsert_fact_rows": upsert_fact_rows,
    "upsert_fact_events": upsert_fact_events,
    "upsert_row_count": upsert_row_count,
    "upsert_insert_update_split": upsert_insert_update_split,
    "key_violations": key_violations_lines,
    "key_violations_null": key_violations_null,
    "fk_violations": fk_violations,
    "fk_violations_orders": fk_violations_orders,
    "fk_null_passes": fk_null_passes,
    "varchar_violations": varchar_violations,
    "varchar_blank_excess": varchar_blank_excess,
    "batch_profile": batch_profile_events,
    "cast_text_date": cast_text_date,
    "cast_text_timestamp": cast_text_timestamp,
    "round_seconds": round_seconds,
    "interval_arith": interval_arith,
    "inline_values": inline_values,
    "mart_star_join": mart_star_join,
    "mart_after_upsert": mart_after_upsert,
    "order_view": order_view,
    "stage_roundtrip": stage_roundtrip,
    "upsert_all_counts": upsert_all_counts,
    "backfill_counts": backfill_counts,
    "load_backfill_mart": load_backfill_mart,
    "load_nations": load_nations,
    "load_customers": load_customers,
    "load_orders": load_orders,
    "load_lines": load_lines,
    "load_mart": load_mart,
    "load_rerun_mart": load_rerun_mart,
    "load_recreated_lines": load_recreated_lines,
    "load_small_increment": load_small_increment,
    "load_small_increment_mart": load_small_increment_mart,
    "load_dimension_change": load_dimension_change,
    "load_sparse_keys": load_sparse_keys,
}
