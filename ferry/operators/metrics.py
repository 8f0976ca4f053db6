"""Metric reports (rowcount, exact sums, key ranges) for one side.

Every metric of a table comes from ONE aggregate over that table, so the
scan is shared and Spark aggregates partially per partition before moving a
single row. Values are text rendered from decimal(38, target scale), so
text equality between the two sides is value equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ansi_enabled, exact_sum_text, key_bound_text, rowcount_text
from ..manifest import TableSet
from ..plans.validation import HIGH, LOW, ROWCOUNT, SUM, TablePlan

REPORT_SCHEMA = "table_name string, metric string, value string"
ERROR_METRIC = "ERROR"


def metric_columns(tp: TablePlan, schema=None, ansi: bool = False) -> list[tuple[str, Column]]:
    """(label, expression) of each planned metric; ``schema`` (the side's own) lets casts
    that cannot fail skip their per-value check and shows key bounds of other types as
    they are, ``ansi`` (the session's mode) lets Spark's own overflow errors stand in."""
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}

    def value(m) -> Column:
        if m.kind == ROWCOUNT:
            return rowcount_text()
        if m.kind == SUM:
            return exact_sum_text(m.column, m.scale, types.get(m.column), ansi)
        return key_bound_text({LOW: F.min, HIGH: F.max}[m.kind], m.column, types.get(m.column), ansi)

    return [(m.label, value(m)) for m in tp.metrics]


def table_metrics(df: DataFrame, tp: TablePlan) -> DataFrame:
    """Lazy long report (table_name, metric, value) of one table."""
    cols = metric_columns(tp, df.schema, ansi_enabled(df))
    wide = df.agg(*[e.alias(f"m{i}") for i, (_, e) in enumerate(cols)])
    pairs = []
    for i, (label, _) in enumerate(cols):
        pairs += [F.lit(label), F.col(f"m{i}")]
    return wide.select(F.lit(tp.table).alias("table_name"),
                       F.stack(F.lit(len(cols)), *pairs).alias("metric", "value"))


def metrics_report(tables: TableSet, plan: list[TablePlan]) -> DataFrame:
    """Lazy report of every planned table present in ``tables``."""
    parts = [table_metrics(tables[tp.table], tp) for tp in plan if tp.table in tables]
    if not parts:
        raise ValueError("no planned table is present")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def error_text(exc: BaseException) -> str:
    """The whole message; a display may shorten it."""
    return str(exc).strip() or type(exc).__name__


def missing_columns(df: DataFrame, names) -> list[str]:
    """Planned columns the frame lacks (by the session's case rule)."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    have = set(df.columns) if sensitive else {c.lower() for c in df.columns}
    return [n for n in names if (n if sensitive else n.lower()) not in have]


def one_table_rows(df: DataFrame, tp: TablePlan) -> list[tuple[str, str, str]]:
    """Report rows of one table (one small job), or a single ERROR row where it cannot be
    opened, lacks a planned column or fails."""
    try:
        cols = metric_columns(tp, df.schema, ansi_enabled(df))
        if lost := missing_columns(df, tp.columns()):
            raise ValueError(f"[MISSING_COLUMN] table lacks planned column(s) {', '.join(lost)}")
        row = df.agg(*[e.alias(f"m{i}") for i, (_, e) in enumerate(cols)]).collect()[0]
    except Exception as exc:
        return [(tp.table, ERROR_METRIC, error_text(exc))]
    return [(tp.table, label, row[i]) for i, (label, _) in enumerate(cols)]
