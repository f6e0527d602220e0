"""The warehouse: plain parquet tables in one database, and their stages.

    <root>/<table>/key_bucket=<n>/     a target or the mart
    <root>/<table>_stage/              what the last load extracted

A table is partitioned by the upper bits of its key (``TargetSpec.bucket_bits``), so
that new keys of a sequence fall into the last partitions.  A load writes the
partitions its batch touches, whole, by a dynamic partition overwrite; all others
keep their files.  Text limits are declared as ``VARCHAR(n)``, so that a write of
longer text is refused however it is made.  Versions, isolation of readers and
upkeep of files belong to the table format in use: plain parquet has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import upsert
from tidemark.plans.files import delete_tree, make_folder
from tidemark.sources import declared_columns, empty_table
from tidemark.specs import Model

BUCKET = "key_bucket"

# Of the files written; what they hold in order of its key shrinks most.
COMPRESSION = "zstd"


def write_observed(writer, df: DataFrame, metrics: Collection[Column]) -> dict:
    """Write ``df`` and return the values that ``metrics`` (named aggregates) have over
    its rows, from the write itself."""
    if not metrics:
        writer(df)
        return {}
    observation = Observation()
    writer(df.observe(observation, *metrics))
    return observation.get


class Warehouse:
    """The tables of ``model`` below ``root``.  They are made where they are missing,
    and found again by a new session."""

    def __init__(self, spark: SparkSession, root: str, model: Model, empty: bool = False):
        if model.mart.key != model.targets[model.mart.fact].key:
            raise ValueError("the mart must be keyed like its fact")
        self.spark, self.root, self.model = spark, root.rstrip("/"), model
        self.database = f"warehouse_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"
        # An insert replaces the partitions it has rows for, and no others.
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        spark.sql(f"create database if not exists {self.database} location '{self.root}'")
        for name in self.tables:
            if empty:
                spark.sql(f"drop table if exists {self.name_of(name)}")
                delete_tree(spark, self._path(name))
            elif spark.catalog.tableExists(self.name_of(name)):
                continue
            make_folder(spark, self._path(name))
            spark.sql(self._declaration(name))
            if not empty:
                spark.sql(f"alter table {self.name_of(name)} recover partitions")

    @classmethod
    def create(cls, spark: SparkSession, root: str, model: Model) -> Warehouse:
        """(Re)create every table empty."""
        return cls(spark, root, model, empty=True)

    @property
    def tables(self) -> list[str]:
        return [*self.model.targets, self.model.mart.name]

    def name_of(self, table: str) -> str:
        """The name of a table in SQL."""
        return f"{self.database}.{table}"

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _declaration(self, name: str) -> str:
        target = self.model.targets.get(name)
        columns = declared_columns(self.model.schema_of(name), target.text_limits if target else {})
        return (
            f"create table {self.name_of(name)} ({columns}, {BUCKET} bigint) using parquet "
            f"options (compression '{COMPRESSION}') partitioned by ({BUCKET}) location '{self._path(name)}'"
        )

    # -- reading ----------------------------------------------------------

    def bucket_of(self, name: str, key: Column) -> Column:
        """The partition that a row of a table with this key belongs to."""
        return F.shiftright(key.cast("bigint"), self.model.bucket_bits(name)).alias(BUCKET)

    def buckets(self, name: str) -> set[int]:
        """The partitions a table has; the catalog knows them."""
        found = self.spark.sql(f"show partitions {self.name_of(name)}").collect()
        return {int(row[0].split("=")[1]) for row in found}

    def rows(self, name: str, buckets: Collection[int] | None = None) -> DataFrame:
        """A table's rows, or those of some partitions."""
        # Filtered by partition, a scan has the size of its files for the planner.
        part = F.col(BUCKET)
        wanted = part.isNotNull() if buckets is None else part.isin(sorted(buckets))
        return self.spark.table(self.name_of(name)).where(wanted).drop(BUCKET)

    def table(self, name: str) -> DataFrame:
        """A target table or the mart."""
        # Without the declared lengths, which a scan tells as metadata.
        names = self.model.schema_of(name).fieldNames()
        return self.rows(name).select(*[F.col(c).alias(c, metadata={}) for c in names])

    def register_views(self) -> None:
        """Make every table known to ``spark.sql`` by its bare name."""
        for name in self.tables:
            self.table(name).createOrReplaceTempView(name)

    # -- writing ----------------------------------------------------------

    def store(self, name: str, df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
        """Replace a table of the load's own (a stage); its rows as stored, and the
        values of ``metrics`` over them."""

        def write(rows: DataFrame) -> None:
            options = rows.write.mode("overwrite").option("path", self._path(name))
            options.option("compression", COMPRESSION).saveAsTable(self.name_of(name))

        found = write_observed(write, df, metrics)
        # By its files, whose size the planner knows.
        return self.spark.read.schema(df.schema).parquet(self._path(name)), found

    def stage(self, table: str, df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
        """Replace a table's stage.  What follows reads that, so the extract runs once
        and later changes at the source do not show."""
        return self.store(self.model.targets[table].stage_name, df, *metrics)

    def staged(self, table: str) -> DataFrame:
        """The rows the last load staged for a table, also if it then failed."""
        return self.spark.read.parquet(self._path(self.model.targets[table].stage_name))

    def replace(self, name: str, rows: DataFrame, buckets: Collection[int]) -> None:
        """``rows`` become the whole content of the partitions ``buckets``.  Each
        partition's rows come together, in order of the key; AQE joins small ones and
        splits large."""
        key = F.col(self.model.key_of(name))
        placed = (
            rows.select(*self.model.schema_of(name).fieldNames(), self.bucket_of(name, key))
            .hint("rebalance", F.col(BUCKET))
            .sortWithinPartitions(BUCKET, self.model.key_of(name))
        )

        def write(placed: DataFrame) -> None:
            placed.write.insertInto(self.name_of(name), overwrite=True)

        # At most one number for each partition written.
        written = write_observed(write, placed, [F.collect_set(BUCKET).alias("buckets")])
        for bucket in sorted(set(buckets) & self.buckets(name) - set(written["buckets"])):
            self._empty(name, bucket)

    def _empty(self, name: str, bucket: int) -> None:
        """An overwrite has no rows that would replace this partition's."""
        schema = self.model.schema_of(name)
        view = f"no_rows_of_{self.database}_{name}"
        empty_table(self.spark, schema).createOrReplaceTempView(view)
        table, partition = self.name_of(name), f"partition ({BUCKET} = {bucket})"
        self.spark.sql(f"insert overwrite table {table} {partition} select * from {view}")
        self.spark.sql(f"alter table {table} drop if exists {partition}")

    def upsert(self, name: str, batch: DataFrame, buckets: Collection[int]) -> None:
        """Write ``batch`` over a table.  Its keys must be unique and not NULL, lie in
        ``buckets``, and it must be cheap to read again."""
        if buckets:
            old = self.rows(name, buckets)
            self.replace(name, upsert(old, batch, [self.model.key_of(name)]), buckets)
