"""The plans behind the operators: what is pushed, shuffled, split, broadcast."""

import contextlib
import dataclasses
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import COURSES, FrameSource, ParquetSource, Warehouse, extract, run
from tidemark.operators import (
    facts_showing,
    insert_update_split,
    integer_reference_violations,
    reference_violations,
    star_join,
    upsert,
)
from tidemark.operators.bitmaps import unknown_ranges
from tidemark.sources import read, write_by_column
from tidemark.sources.sample import create_source
from tidemark.specs import columns
from workload import queries as q
from workload.model import LINE_KEY, LINES, line_model, source, source_tables, table

SF_DIR = "/root/testdata/sf0.01"
# These run jobs when called.
STORED = {
    n
    for n in q.QUERIES
    if n.startswith(("load_", "upsert_all", "backfill", "stage_", "sql_"))
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    explain = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "formatted")


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def no_broadcast(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
    )


def test_window_reaches_the_scan(spark):
    pushed = re.search(r"PushedFilters: (.*)", formatted(q.extract_window_orders(spark, SF_DIR)))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in pushed[1]
    assert "LessThan(o_orderdate,1999-01-01T00:00)" in pushed[1]


def test_window_on_the_view_reaches_the_parent_scan(spark):
    plan = formatted(q.lesson_view_window(spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan)
    orders = next(s for s in schemas if "o_orderdate" in s)
    assert "o_totalprice" not in orders, "only the needed columns are read"


def test_parquet_source_scans_only_the_window(spark, tmp_path, as_of):
    create_source(spark, str(tmp_path), as_of)
    frames = extract(COURSES, ParquetSource(spark, str(tmp_path), COURSES.sources), as_of=as_of)
    for name in ["course", "stream", "stream_module", "lesson"]:
        plan = formatted(frames[name])
        assert "GreaterThanOrEqual(updated_at,2024-03-14T00:00)" in plan
        assert "LessThan(updated_at,2024-03-15T00:00)" in plan


def test_view_shuffles_the_detail_rows_once(spark):
    with no_broadcast(spark):
        plan = plan_of(q.lesson_view(spark, SF_DIR))
    # Both sides of either join; a second one over the lines would make five.
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", plan)) == 2
    assert plan.count("Exchange hashpartitioning") == 4


def test_lines_move_once_for_their_key_and_the_view(spark):
    with no_broadcast(spark):
        plan = plan_of(read(LINES, source(spark, SF_DIR), "line_view"))
    assert "Window" in plan and "l_linenumber#" in plan
    # The lines and the orders; numbering the lines would make three.
    moved = re.findall(r"Exchange hashpartitioning\([lo]_orderkey#\d+L?, .*", plan)
    assert len(moved) == 2 and not any("l_linenumber" in m for m in moved)


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - STORED))
def test_all_work_is_built_in_expressions_without_products(spark, name):
    plan = plan_of(q.QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|CartesianProduct|NestedLoop|ExistingRDD", plan)


def test_stored_ancestors_spare_the_detail_rows_a_shuffle(spark, new_root):
    """Orders alone exceed the limit, those of one window do not."""
    warehouse = Warehouse.create(spark, new_root(), LINES)
    tables = {n: table(spark, SF_DIR, n) for n in ["nation", "customer", "orders", "lineitem"]}
    lines = tables["lineitem"].withColumn("line_key", F.expr(LINE_KEY))
    tables["lineitem"] = lines.select(*LINES.sources["lineitem"].fieldNames())
    for name in ["nation", "customer"]:
        tables[name] = tables[name].withColumn("known_since", F.lit(None))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=60_000,
        spark__sql__adaptive__autoBroadcastJoinThreshold=60_000,
    ):
        january = (LINES, FrameSource(tables), "1998-01-01", "1998-02-01")
        lazy = extract(*january)["line"]
        stored = extract(*january, lambda name, df: warehouse.store(name, df)[0])
        plans = [plan_of(lazy), plan_of(stored["line"])]
    shuffled = r"Exchange hashpartitioning\(l_orderkey"
    assert re.search(shuffled, plans[0]) and not re.search(shuffled, plans[1])
    assert stored["line"].count() == lazy.count() > 500


def test_small_batch_does_not_shuffle_the_parent(spark):
    orders = table(spark, SF_DIR, "orders")
    nations = table(spark, SF_DIR, "nation").select(F.col("n_nationkey").alias("fk"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=20_000,
        spark__sql__adaptive__autoBroadcastJoinThreshold=20_000,
    ):
        found = reference_violations(nations, "fk", orders, "o_orderkey")
        plan = plan_of(found)
    assert "LeftSemi, BuildRight" in plan
    assert not re.search(r"Exchange hashpartitioning\(o_orderkey", plan)
    assert found.count() == 0


def test_hot_parent_is_split_among_tasks(spark, rows):
    """A third of the facts reference one part; neither side may be broadcast.
    AQE must split that part's partition, also without the forcing setting."""
    lines = table(spark, SF_DIR, "lineitem").repartition(8)
    lines = lines.withColumn("line_key", F.expr(LINE_KEY)).withColumn(
        "l_partkey",
        F.when(F.col("l_returnflag") == "R", F.lit(7)).otherwise(F.col("l_partkey")),
    )
    with (
        no_broadcast(spark),
        settings(
            spark,
            spark__sql__adaptive__forceOptimizeSkewedJoin="false",
            spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes=50_000,
            spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
            spark__sql__adaptive__advisoryPartitionSizeInBytes=50_000,
        ),
    ):
        mart = q._sales_mart(
            lines, table(spark, SF_DIR, "part"), table(spark, SF_DIR, "supplier")
        )
        found = mart.groupBy("part_id").count()
        counts = dict(rows(found))
        plan = plan_of(found)
    assert "skew=true" in plan
    expected = dict(rows(lines.groupBy("l_partkey").count()))
    assert counts == expected and counts[7] > 15_000


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """All there is, in a warehouse; tests that change it make their own."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    warehouse = Warehouse.create(spark, root, line_model(spark, SF_DIR))
    run(warehouse.model, source(spark, SF_DIR), warehouse, "1995-01-01", "2002-01-01")
    return warehouse


def data_files(warehouse, name):
    return set(warehouse.spark.table(warehouse.name_of(name)).inputFiles())


def test_files_are_compressed_in_order_of_the_key(loaded, spark):
    for name in ("f_line", "line_dm", "d_order"):
        for file in sorted(data_files(loaded, name))[:3]:
            assert file.endswith(".zstd.parquet")
            ids = [r[0] for r in spark.read.parquet(file).select(loaded.model.key_of(name)).collect()]
            assert ids == sorted(ids)


def test_hot_partition_is_written_by_several_tasks(spark, new_root):
    """All keys of the load fall into one partition; its rows are split."""
    warehouse = Warehouse.create(spark, new_root(), LINES)
    tables = source_tables(spark, SF_DIR)
    # As many tasks read a large source.
    tables["orders"] = tables["orders"].repartition(8)
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=50_000,
        spark__sql__adaptive__coalescePartitions__minPartitionSize=50_000,
    ):
        run(LINES, FrameSource(tables), warehouse, "1995-01-01", "2002-01-01")
    assert warehouse.buckets("d_order") == {0}
    assert len(data_files(warehouse, "d_order")) > 2
    assert warehouse.table("d_order").count() == table(spark, SF_DIR, "orders").count()


def test_upsert_reads_and_writes_the_touched_partitions_only(loaded, spark):
    bits = loaded.model.bucket_bits("d_order")
    low = 3 << bits
    old = loaded.table("d_order")
    batch = old.where(f"order_id between {low + 5} and {low + 40}").withColumn(
        "o_totalprice", F.lit(0.0)
    )
    batch, _ = loaded.store("batch", batch)
    before = data_files(loaded, "d_order")
    # Partitions are chosen when the plan is made.
    plan = formatted(upsert(loaded.rows("d_order", [3]), batch, ["order_id"]))
    assert re.search(r"PartitionFilters: \[.*key_bucket#\d+L? = 3", plan)
    loaded.upsert("d_order", batch, [3])
    after = data_files(loaded, "d_order")
    assert {f.split("key_bucket=")[1].split("/")[0] for f in before ^ after} == {"3"}
    found = loaded.table("d_order")
    assert found.where("o_totalprice = 0").count() == batch.count() == 36
    assert found.count() == table(spark, SF_DIR, "orders").count()


def test_small_batch_is_broadcast_and_old_rows_move_once(loaded, rows):
    old = loaded.rows("d_order")
    some = loaded.table("d_order").where("order_id % 500 = 3")
    batch, _ = loaded.store("batch", some.withColumn("o_totalprice", F.lit(1.0)))
    assert "Exchange hashpartitioning" not in plan_of(upsert(old, batch, ["order_id"]))
    with no_broadcast(loaded.spark):
        large = upsert(old, batch, ["order_id"])
        assert plan_of(large).count("Exchange hashpartitioning") == 2
        assert rows(large) == rows(upsert(old, batch, ["order_id"]))


def test_small_dimensions_are_broadcast_to_the_facts(loaded):
    """By the size of their files, which the plan knows."""
    mart = loaded.model.mart
    tables = {name: loaded.rows(name) for name in [mart.fact, *(n for n, _ in mart.joins)]}
    assert "Exchange hashpartitioning" not in plan_of(star_join(mart, tables))


def test_facts_of_changed_dimensions_are_found_in_one_pass(loaded):
    mart, facts = loaded.model.mart, loaded.rows("f_line")
    changed = {
        "d_customer": loaded.rows("d_customer").where("customer_id = 7").select("customer_id"),
        "d_nation": loaded.rows("d_nation").where("nation_id = 3").select("nation_id"),
    }
    plan = plan_of(facts_showing(mart, facts, changed))
    scans = re.findall(r"FileScan parquet \S*f_line\[(.*?)\]", plan)
    assert len(scans) == 1 and "quantity" not in scans[0] and "price" not in scans[0]


def test_a_load_runs_few_jobs(spark, new_root):
    warehouse = Warehouse.create(spark, new_root(), line_model(spark, SF_DIR))
    run(warehouse.model, source(spark, SF_DIR), warehouse, "1995-01-01", "2002-01-01")
    spark.sparkContext.setJobGroup("increment", "a small increment")
    try:
        q.small_increment(spark, SF_DIR, warehouse)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("increment")
    # Four of them read the schemas of the test tables.
    assert 0 < len(jobs) <= 36


def test_reference_check_counts_the_child_once(spark):
    """Both uses of the counted references are one exchange."""
    with no_broadcast(spark):
        found = q.fk_violations_orders(spark, SF_DIR)
        found.collect()
        plan = plan_of(found).split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet \[o_custkey", plan)) == 1


def test_split_narrows_the_target_to_the_batch(spark):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=200_000,
        spark__sql__adaptive__autoBroadcastJoinThreshold=200_000,
    ):
        orders = table(spark, SF_DIR, "orders")
        batch = spark.range(5).select(F.col("id").alias("o_orderkey"))
        plan = plan_of(insert_update_split(orders, batch, ["o_orderkey"]))
    assert "LeftSemi, BuildRight" in plan and "Exchange hashpartitioning" not in plan


def test_bucketed_sides_of_an_upsert_are_not_shuffled(spark, rows):
    with no_broadcast(spark):
        found = q.upsert_bucketed(spark, SF_DIR)
        assert "Exchange" not in plan_of(found) and "SortMergeJoin" in plan_of(found)
        assert "Bucketed: true" in formatted(found)
        assert rows(found) == rows(q.upsert_dim_rows(spark, SF_DIR))


def small_tables(spark, folder, orders=40):
    """The tables a line view and a mart need: an order a month from June 1997 on, of four
    lines, two with one number, and an order and a part that are not there."""
    day = "timestamp_ntz'1997-06-01' + make_interval(0, o_orderkey % 60)"
    named = {
        "nation": "select cast(id as int) n_nationkey, 'N' n_name, 1 n_regionkey from range(3)",
        "customer": "select id c_custkey, 'C' c_name, cast(id % 3 as int) c_nationkey, 1d c_acctbal,"
        " 'BUILDING' c_mktsegment from range(5)",
        "supplier": "select id s_suppkey, 'S' s_name, 1 s_nationkey, 2d s_acctbal from range(4)",
        "part": "select id p_partkey, 'P' p_name, 'B' p_brand,"
        " element_at(array('PROMO', 'LARGE', 'SMALL'), cast(id % 3 as int) + 1) p_type,"
        " cast(id as int) p_size from range(7)",
        "orders": f"select o_orderkey, o_orderkey % 5 o_custkey, 'O' o_orderstatus,"
        f" 3d o_totalprice, {day} o_orderdate, '1-URGENT' o_orderpriority"
        f" from (select id o_orderkey from range({orders}))",
        "lineitem": f"select o_orderkey l_orderkey, o_orderkey % 8 l_partkey, o_orderkey % 4 l_suppkey,"
        f" greatest(n, 2) l_linenumber, cast(n as double) l_quantity, 5d l_extendedprice, {day} l_shipdate"
        f" from (select id o_orderkey, explode(array(1, 2, 3, 4)) n from range({orders + 1}))",
    }
    for name, sql in named.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_delta_refresh_joins_the_view_once_and_moves_no_line_by_its_key(spark, tmp_path, rows):
    folder = small_tables(spark, tmp_path)
    with no_broadcast(spark):
        refreshed = q.mart_delta_refresh(spark, folder)
        plan = plan_of(refreshed)
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan
    assert not re.search(r"Exchange hashpartitioning\(line_key", plan)
    assert rows(refreshed) == rows(q.mart_after_upsert(spark, folder)) != []


def test_few_ancestors_narrow_the_details_before_the_source_numbers_them(
    spark, tmp_path, rows, monkeypatch
):
    tables = source(spark, small_tables(spark, tmp_path))
    months = (LINES, tables, "1997-08-01", "1998-03-01")

    def store(name, df):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}"), told

    # As if the keys were far apart.
    told = {"rows": 7, "low": 2, "high": 8000}
    plain, few = extract(*months)["line"], extract(*months, store)["line"]
    # The scan's side of the shuffle is further down.
    narrowed = r"REPARTITION_BY_COL[\s\S]*BroadcastHashJoin .* LeftSemi"
    assert re.search(narrowed, plan_of(few)) and not re.search(narrowed, plan_of(plain))
    assert rows(few) == rows(plain) and len(rows(few)) == 7 * 4
    told = {"rows": 7, "low": 2, "high": 8}
    near = extract(*months, store)["line"]
    assert "LessThanOrEqual(l_orderkey,8)" in formatted(near) and rows(near) == rows(plain)
    monkeypatch.setattr("tidemark.plans.extract.FEW_ANCESTORS", 6)
    many = extract(*months, store)["line"]
    assert not re.search("LeftSemi", plan_of(many)) and rows(many) == rows(plain)


def scans_of(df):
    """The file scans of a plan that has run, with how many partitions they read."""
    df.collect()
    found, waiting = {}, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif kind == "FileSourceScanExec":
            metrics = node.metrics()
            parts = metrics.get("numPartitions")
            files = metrics.apply("numFiles").value()
            found[node.toString()] = (files, parts.get().value() if parts.isDefined() else None)
        else:
            children = node.children()
            waiting += [children.apply(i) for i in range(children.size())]
    return found


def test_months_without_orders_in_the_window_are_not_read(spark):
    found = q.lesson_view_by_month(spark, SF_DIR)
    scans = scans_of(found)
    detail, (_, months) = next((k, v) for k, v in scans.items() if "l_shipdate" in k)
    assert "dynamicpruning" in detail.lower()
    assert months == 12
    assert found.count() == q.lesson_view_window(spark, SF_DIR).count() > 0


def test_extract_prunes_details_laid_out_by_month(spark, tmp_path, rows):
    """Also where the load has stored the ancestors of the window."""
    month = F.date_format("ordered_on", "yyyyMM").cast("int")
    view = LINES.views["line_view"]
    model = dataclasses.replace(
        LINES,
        sources={
            **LINES.sources,
            "lineitem": T.StructType([*LINES.sources["lineitem"], *columns("month int")]),
        },
        views={
            "line_view": dataclasses.replace(
                view,
                ancestors=lambda table: view.ancestors(table).withColumn("month", month),
                laid_out_by="month",
            )
        },
    )
    tables = source_tables(spark, SF_DIR)
    months = view.ancestors(tables.__getitem__).select("l_orderkey", month.alias("month"))
    lines = tables["lineitem"]
    lines = lines.join(months, "l_orderkey").select(*lines.columns, "month")
    tables["lineitem"] = write_by_column(lines, str(tmp_path / "lines"), "month")

    def store(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    window = ("1998-02-01", "1998-04-01")
    found = extract(model, FrameSource(tables), *window, store)["line"]
    scans = scans_of(found)
    assert [parts for k, (_, parts) in scans.items() if "l_shipdate" in k] == [2]
    plain = extract(LINES, source(spark, SF_DIR), *window)["line"]
    assert rows(found.select(*plain.columns)) == rows(plain)


def test_a_reference_check_by_bitmaps_moves_ranges_and_not_keys(spark):
    """What leaves the tasks is a row for each range of 32,768 keys."""
    child = spark.range(0, 1_000_000, 1, 4).select((F.col("id") + 5).alias("f"))
    parent = spark.range(0, 1_000_000, 1, 4)
    with no_broadcast(spark):
        by_keys = reference_violations(child, "f", parent, "id")
        by_bits = integer_reference_violations(child, "f", parent, "id")
        values, known = child.toDF("value"), parent.toDF("value")
        moved = shuffled(unknown_ranges(values, known)) + shuffled(by_bits)
        assert moved * 5 < shuffled(by_keys)
        found = sorted(map(tuple, by_bits.collect()))
        assert found == sorted(map(tuple, by_keys.collect()))
        assert found == [(1_000_000 + i, 1) for i in range(5)]


def shuffled(df):
    """Bytes that the exchanges of a plan have written."""
    df.collect()
    total, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleBytesWritten").value()
            children = node.children()
            waiting += [children.apply(i) for i in range(children.size())]
    return total
