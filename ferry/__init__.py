"""ferry: load a table set into a target and prove nothing was lost, on Spark.

    from ferry import reconcile, load, ParquetSink, parquet_tables, Manifest, TableSpec
"""

from .manifest import ForeignKey, Manifest, TableSet, TableSpec, UniqueKey
from .operators.audit import (column_audit, fk_audit, length_audit, not_null_audit, pk_audit,
                              unique_audit)
from .operators.damage import damage_summary, text_damage
from .operators.fingerprint import fingerprints
from .operators.load import (CatalogSink, LoadError, ParquetSink, RunLedger, append_conflicts,
                             identity_high_water, load)
from .operators.metric_state import MetricState
from .operators.subset import closed_subset
from .operators.transfer import MigrationResult, migrate
from .operators.parity import string_parity
from .operators.reconcile import Reconciliation, reconcile
from .operators.tree import tree_differences, tree_parity
from .operators.views import catalog_view, locale_sorted, register_views, totals_view
from .sources.ranges import key_ranges, range_predicates
from .sources.tables import catalog_tables, jdbc_table, jdbc_tables, parquet_tables

__all__ = [
    "ForeignKey", "Manifest", "TableSet", "TableSpec", "UniqueKey",
    "column_audit", "fk_audit", "length_audit", "not_null_audit", "pk_audit", "unique_audit",
    "CatalogSink", "LoadError", "ParquetSink", "append_conflicts", "identity_high_water", "load",
    "MigrationResult", "migrate", "string_parity", "Reconciliation", "reconcile",
    "catalog_view", "locale_sorted", "register_views", "totals_view",
    "damage_summary", "text_damage", "fingerprints", "RunLedger", "MetricState", "closed_subset",
    "tree_differences", "tree_parity", "key_ranges", "range_predicates",
    "catalog_tables", "jdbc_table", "jdbc_tables", "parquet_tables",
]
