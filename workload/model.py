"""A second warehouse model, over the shared test tables.

The tables have the same snowflake shape as the course model: order lines
belong to orders, orders to customers, customers to nations.  Lines become
the fact, the other three the dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import to_date
from tidemark.sources import FrameSource
from tidemark.specs import (
    DetailView,
    Entity,
    Model,
    Reference,
    StarMart,
    TableReader,
    TargetSpec,
    columns,
)

# Line numbers run from 1 to 7, so this packs a line's two-part key into one.
LINE_KEY = "l_orderkey * 8 + l_linenumber"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A line's two-part key repeats in the generated table, so lines that share one
# are numbered; with room for this many.
SHARING = 64


def keyed_lines(lineitem: DataFrame) -> DataFrame:
    """Every line, with a key of its own.  Lines that share order and line number
    are few; their order among themselves is that of their other columns."""
    key = ["l_orderkey", "l_linenumber"]
    others = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    number = F.row_number().over(Window.partitionBy(*key).orderBy(*others))
    own = F.expr(LINE_KEY) * SHARING + number - 1
    # By order, as the view's join with the orders needs them: they move once.
    return lineitem.repartition("l_orderkey").select(own.alias("line_key"), *key, *others)


def first_orders(orders: DataFrame) -> DataFrame:
    """Per customer the day of the first order: when the customer became known."""
    return orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("known_since")
    )


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The test tables as a source database: unique keys, and a watermark on
    the two tables that have no date of their own."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").join(first_orders(orders), "c_custkey", "left")
    nation_since = customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.min("known_since").alias("known_since")
    )
    return {
        "nation": table(spark, sf_dir, "nation").join(nation_since, "n_nationkey", "left"),
        "customer": customer,
        "orders": orders,
        "lineitem": keyed_lines(table(spark, sf_dir, "lineitem")),
    }


def revised(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The source at a later time: one value of every row has moved."""
    moved = {"customer": "c_acctbal", "orders": "o_totalprice", "lineitem": "l_quantity"}
    return tables | {
        name: tables[name].withColumn(column, F.col(column) + 1)
        for name, column in moved.items()
    }


def source(spark: SparkSession, sf_dir: str, later: bool = False) -> FrameSource:
    tables = source_tables(spark, sf_dir)
    return FrameSource(revised(tables) if later else tables)


def line_ancestors(table: TableReader) -> DataFrame:
    """Per order what its lines inherit: customer, nation, and the day of the
    order, which is the lines' watermark."""
    orders, customer = table("orders"), table("customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        "c_nationkey",
        to_date(F.col("o_orderdate")).alias("ordered_on"),
    )


SOURCE_TABLES = {
    "nation": columns(
        "n_nationkey int, n_name string, n_regionkey int, known_since timestamp_ntz"
    ),
    "customer": columns(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
        " c_mktsegment string, known_since timestamp_ntz"
    ),
    "orders": columns(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": columns(
        "line_key bigint, l_orderkey bigint, l_linenumber int, l_partkey bigint,"
        " l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    ),
}

D_NATION = TargetSpec(
    name="d_nation",
    key="nation_id",
    schema=columns("nation_id int, n_name string, n_regionkey int"),
    text_limits={"n_name": 25},
)

D_CUSTOMER = TargetSpec(
    name="d_customer",
    key="customer_id",
    schema=columns("customer_id bigint, c_name string, c_acctbal double, c_mktsegment string"),
    text_limits={"c_name": 25, "c_mktsegment": 10},
)

D_ORDER = TargetSpec(
    name="d_order",
    key="order_id",
    schema=columns(
        "order_id bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    text_limits={"o_orderstatus": 1, "o_orderpriority": 15},
    whole_seconds=frozenset({"o_orderdate"}),
)

F_LINE = TargetSpec(
    name="f_line",
    key="id",
    schema=columns(
        "id bigint, order_id bigint, nation_id int, customer_id bigint, line_number int,"
        " quantity double, price double, ship_date timestamp_ntz"
    ),
    staged_as=(
        "line_id",
        "l_orderkey",
        "c_nationkey",
        "o_custkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_shipdate",
    ),
    references=(
        Reference("order_id", "d_order"),
        Reference("nation_id", "d_nation"),
        Reference("customer_id", "d_customer"),
    ),
)

LINE_MART = StarMart(
    name="line_dm",
    fact="f_line",
    key="id",
    joins=(("d_customer", "customer_id"), ("d_nation", "nation_id")),
    columns=(
        ("f_line", "id", "id"),
        ("f_line", "quantity", "line_quantity"),
        ("f_line", "order_id", "order_id"),
        ("f_line", "customer_id", "customer_id"),
        ("d_customer", "c_name", "name"),
        ("d_customer", "c_acctbal", "balance"),
        ("f_line", "nation_id", "nation_id"),
        ("d_nation", "n_name", "nation_name"),
        ("d_nation", "n_regionkey", "region_id"),
    ),
)

LINES = Model(
    sources=SOURCE_TABLES,
    views={"line_view": DetailView("lineitem", "l_orderkey", line_ancestors)},
    entities=(
        Entity("nation", "nation", D_NATION, "n_nationkey", "known_since"),
        Entity("customer", "customer", D_CUSTOMER, "c_custkey", "known_since"),
        Entity("order", "orders", D_ORDER, "o_orderkey", "o_orderdate"),
        Entity("line", "line_view", F_LINE, "line_key", "ordered_on"),
    ),
    mart=LINE_MART,
)


def line_model(spark: SparkSession, sf_dir: str) -> Model:
    """``LINES`` with partitions for the keys these tables have: some tens of the
    fact, fewer of the larger dimensions."""

    def bits(name: str, key: str, parts: int) -> int:
        last = table(spark, sf_dir, name).agg(F.max(F.expr(key)).cast("bigint")).first()[0]
        return max(1, (last or 0) // parts).bit_length()

    return LINES.with_bucket_bits(
        {
            F_LINE.name: bits("lineitem", f"({LINE_KEY}) * {SHARING}", 24),
            D_ORDER.name: bits("orders", "o_orderkey", 12),
            D_CUSTOMER.name: bits("customer", "c_custkey", 4),
        }
    )
