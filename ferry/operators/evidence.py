"""Evidence sink: the detail report as one CSV file with a header, UTF-8."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(detail: DataFrame, path: str) -> str:
    """Write ``detail`` (bounded: one row per planned metric) as a single
    CSV part under ``path``; sorted by table and metric for reading."""
    (detail.orderBy("table_name", "metric").coalesce(1).write.mode("overwrite")
     .option("header", True).option("encoding", "UTF-8").csv(path))
    return path
