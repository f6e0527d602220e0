"""The upserts as SQL table functions, over a warehouse and its stages.

    select * from upsert_d_course()             how many rows it inserts or updates
    select * from upserted_d_course()           the table's rows after it
    select * from upsert_all()                  all counts, in one row

A function of SQL has no side effects: these tell what staged rows would do, and the
load writes them.
"""

from __future__ import annotations

from tidemark.operators import conform
from tidemark.plans.warehouse import Warehouse


def _columns(schema) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def create_functions(warehouse: Warehouse) -> list[str]:
    """Make the functions known to ``spark.sql``; their names.  They read the tables
    and the last stages when they are called, which must be there now."""
    spark, model, names = warehouse.spark, warehouse.model, []
    warehouse.register_views()

    def create(name: str, returns: str, query: str) -> None:
        spark.sql(
            f"create or replace temporary function {name}() "
            f"returns table ({returns}) return {query}"
        )
        names.append(name)

    for table, target in model.targets.items():
        batch, key = f"{table}_batch", f"`{target.key}`"
        conform(warehouse.staged(table), target).createOrReplaceTempView(batch)
        create(f"upsert_{table}", "row_cnt bigint", f"select count(*) from {batch}")
        create(
            f"upserted_{table}",
            _columns(target.schema),
            f"select * from {batch} union all "
            f"select t.* from {table} t left anti join {batch} b on t.{key} = b.{key}",
        )
    counts = [f"affected_rows_{entity.name}" for entity in model.entities]
    calls = [f"(select row_cnt from upsert_{entity.target.name}())" for entity in model.entities]
    create("upsert_all", ", ".join(f"`{c}` bigint" for c in counts), f"select {', '.join(calls)}")
    return names
