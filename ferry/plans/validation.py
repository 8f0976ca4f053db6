"""Validation plan (target-authoritative): which metrics each table gets.

Per target table: the row count; the sum of every exact numeric column (tinyint..bigint,
decimal) at the target's scale; the smallest and largest value of every integer
primary-key column, in column order. Approximate types (float, double) are never summed
on either side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..manifest import INTEGRAL_TYPES, Manifest, TableSet

SUMMABLE_TYPES = (*INTEGRAL_TYPES, T.DecimalType)
# Fixed report labels of the metric kinds.
ROWCOUNT, SUM, LOW, HIGH = "rowcount", "sum", "pkmin", "pkmax"


@dataclass(frozen=True)
class Metric:
    kind: str
    column: str | None = None
    scale: int = 0

    @property
    def label(self) -> str:
        return self.kind if self.column is None else f"{self.kind}:{self.column}"


@dataclass(frozen=True)
class TablePlan:
    table: str
    metrics: tuple[Metric, ...]     # in report order

    def columns(self) -> list[str]:
        return list(dict.fromkeys(m.column for m in self.metrics if m.column is not None))


def is_summable(dt: T.DataType) -> bool:
    return isinstance(dt, SUMMABLE_TYPES)


def table_plan(name: str, schema: T.StructType, primary_key) -> TablePlan:
    keys = [f.name for f in schema.fields if f.name in set(primary_key) and isinstance(f.dataType, INTEGRAL_TYPES)]
    return TablePlan(name, (
        Metric(ROWCOUNT),
        *(Metric(SUM, f.name, getattr(f.dataType, "scale", 0)) for f in schema.fields if is_summable(f.dataType)),
        *(Metric(kind, key) for key in keys for kind in (LOW, HIGH)),
    ))


def build_plan(target: TableSet, manifest: Manifest) -> list[TablePlan]:
    """Plan from the target side: its actual column types, the manifest's keys. A target
    table that cannot even be opened has its row count planned."""
    def schema_of(name):
        try:
            return target[name].schema
        except Exception:
            return T.StructType([])

    return [table_plan(n, schema_of(n), manifest[n].primary_key if n in manifest else ()) for n in sorted(target)]


PLAN_SCHEMA = ("table_name string, column_name string, ordinal int, "
               "check_name string, scale int")
METRIC_SCHEMA = "table_name string, metric string, kind string, column_name string, scale int"


def plan_frame(spark: SparkSession, target: TableSet, manifest: Manifest) -> DataFrame:
    """The plan as rows (table_name, column_name, ordinal, check_name, scale)."""
    rows = []
    for tp in build_plan(target, manifest):
        place = {c: i + 1 for i, c in enumerate(target[tp.table].columns)} if tp.columns() else {}
        rows += [(tp.table, m.column, place.get(m.column), m.kind, m.scale) for m in tp.metrics]
    return spark.createDataFrame(rows, PLAN_SCHEMA)


def plan_metrics_frame(spark: SparkSession, plan: list[TablePlan]) -> DataFrame:
    """Every planned metric; bounded by the schemas' size."""
    return spark.createDataFrame([(tp.table, m.label, m.kind, m.column, m.scale) for tp in plan for m in tp.metrics], METRIC_SCHEMA)
