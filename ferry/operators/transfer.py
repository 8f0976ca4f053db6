"""``migrate``: load, then prove the load (the whole run in one call)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..manifest import Manifest, TableSet
from .load import identity_high_water, load
from .reconcile import Reconciliation, reconcile


@dataclass
class MigrationResult:
    load_report: DataFrame          # rows per table, total, NOT_FOUND names
    high_water: DataFrame           # identity counters of the written target
    reconciliation: Reconciliation  # source against what was written


def migrate(spark: SparkSession, source: TableSet, manifest: Manifest, sink, tables=None,
            mode: str = "overwrite", strings: bool = True, parallelism: int = 8) -> MigrationResult:
    """Load ``tables`` (default: all) into ``sink``, derive the identity
    high-water marks from what was written (every identity table the sink
    holds, not only the loaded ones), and reconcile the source with the
    written target over the loaded tables."""
    res = load(spark, source, manifest, sink, tables=tables, mode=mode, parallelism=parallelism)
    written = {n: sink.read(n) for n in sorted(manifest) if sink.exists(n)}
    loaded = sorted(res.counts)
    return MigrationResult(
        load_report=res.report,
        high_water=identity_high_water(spark, written, manifest),
        reconciliation=reconcile(spark, {n: source[n] for n in loaded},
                                 {n: written[n] for n in loaded}, manifest,
                                 strings=strings, parallelism=parallelism),
    )
