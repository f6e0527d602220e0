"""What the caller declares: tables, keys, references, the mart.

These are plain values.  The operators read them and build DataFrame plans;
nothing here touches Spark beyond its types.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_KINDS = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def columns(lines: str) -> T.StructType:
    """A schema from ``name type`` lines (or commas), without needing a
    session.  Every column may be NULL; keys are checked per batch."""
    pairs = [line.split() for line in lines.replace(",", "\n").strip().splitlines()]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Reference:
    """``column`` must be NULL or a key of the target table ``parent``."""

    column: str
    parent: str


@dataclass(frozen=True)
class TargetSpec:
    """A warehouse table: declared columns, one integer key, and its rules."""

    name: str
    schema: T.StructType
    key: str
    references: tuple[Reference, ...] = ()
    text_limits: Mapping[str, int] = field(default_factory=dict)
    whole_seconds: frozenset[str] = frozenset()
    # Names of the same columns in the staged batch, in the target's order.
    # None: they carry the target's names.
    staged_as: tuple[str, ...] | None = None
    # The stored table is cut into partitions of 2**bucket_bits consecutive keys:
    # by default of 2 Mi keys, about 512 MB of 250-byte rows.  Sparse keys want more.
    bucket_bits: int = 21

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def staged_columns(self) -> list[str]:
        return list(self.staged_as or self.columns)

    @property
    def stage_name(self) -> str:
        return f"{self.name}_stage"


@dataclass(frozen=True)
class Entity:
    """One extract: where its rows come from and where they go."""

    name: str
    source: str
    target: TargetSpec
    source_key: str = "id"
    watermark: str = "updated_at"
    staged_key: str | None = None

    @property
    def key(self) -> str:
        """Name of the key once extracted."""
        return self.staged_key or f"{self.name}_id"


@dataclass(frozen=True)
class StarMart:
    """A fact joined to some dimensions, stored, one row per joined fact.

    ``joins`` are (dimension, column both sides share); ``columns`` are
    (table, column, name in the mart).  The mart keeps the fact's key.
    """

    name: str
    fact: str
    key: str
    joins: tuple[tuple[str, str], ...]
    columns: tuple[tuple[str, str, str], ...]

    def visible(self, table: str) -> list[str]:
        """Columns of ``table`` that show in the mart."""
        return [column for owner, column, _ in self.columns if owner == table]

    def looked_at(self, table: str) -> list[str]:
        """Columns that decide how the mart looks: visible ones, and a fact's
        references."""
        references = [column for _, column in self.joins] if table == self.fact else []
        shown = self.visible(table)
        return [*shown, *[column for column in references if column not in shown]]


TableReader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class DetailView:
    """Rows of the table ``detail`` with columns of their ancestors.

    ``ancestors`` joins the parent tables into one row per parent: the parent's
    key, named like the column ``reference`` of the detail rows that holds it,
    and the columns those rows inherit.

    ``laid_out_by`` names a column that detail rows and ancestors share and that the
    detail table's folders follow (such as the ancestor's month): a scan of details
    then skips, at run time, the folders of no ancestor in the window.
    """

    detail: str
    reference: str
    ancestors: Callable[[TableReader], DataFrame]
    laid_out_by: str | None = None


@dataclass(frozen=True)
class Model:
    """Everything one warehouse needs."""

    sources: Mapping[str, T.StructType]
    views: Mapping[str, DetailView]
    entities: tuple[Entity, ...]
    mart: StarMart

    def load_order(self) -> list[list[Entity]]:
        """Entities in groups: a table's group comes after those of all
        tables it references, and tables of one group are independent."""
        groups, loaded, waiting = [], set(), list(self.entities)
        while waiting:
            ready = [
                e for e in waiting if {r.parent for r in e.target.references} <= loaded
            ]
            if not ready:
                raise ValueError(f"unknown or circular references: {[e.name for e in waiting]}")
            groups.append(ready)
            loaded |= {e.target.name for e in ready}
            waiting = [e for e in waiting if e not in ready]
        return groups

    @property
    def targets(self) -> dict[str, TargetSpec]:
        return {e.target.name: e.target for e in self.entities}

    @property
    def mart_schema(self) -> T.StructType:
        targets = self.targets
        return T.StructType(
            [
                T.StructField(name, targets[table].schema[column].dataType)
                for table, column, name in self.mart.columns
            ]
        )

    def schema_of(self, table: str) -> T.StructType:
        return self.mart_schema if table == self.mart.name else self.targets[table].schema

    def key_of(self, table: str) -> str:
        return self.mart.key if table == self.mart.name else self.targets[table].key

    def bucket_bits(self, table: str) -> int:
        """Those of a target; the mart lies like its fact."""
        return self.targets[self.mart.fact if table == self.mart.name else table].bucket_bits

    def with_bucket_bits(self, bits: Mapping[str, int]) -> Model:
        """The same model, some targets in partitions of another size."""
        entities = tuple(
            replace(e, target=replace(e.target, bucket_bits=bits[e.target.name]))
            if e.target.name in bits
            else e
            for e in self.entities
        )
        return replace(self, entities=entities)
