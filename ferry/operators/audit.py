"""Constraint audits for tables that carry no constraints (Parquet, session
tables, loads that ran with foreign keys off).

All audits aggregate before they shuffle: key counts are partially combined
per partition, so a key or foreign-key value holding a third of all rows
becomes one row per map task, never one giant task or pair list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import named
from ..manifest import Manifest, TableSet

PK_AUDIT_SCHEMA = "table_name string, dup_keys bigint, null_keys bigint"
UNIQUE_AUDIT_SCHEMA = "table_name string, column_name string, collation string, dup_values bigint"
FK_AUDIT_SCHEMA = "child string, column_name string, parent string, orphans bigint"
COLUMN_AUDIT_SCHEMA = "table_name string, column_name string, violations bigint"


def _union(spark: SparkSession, parts: list[DataFrame], schema: str) -> DataFrame:
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], schema))


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [named(c).isNull() for c in cols])


def key_audit(df: DataFrame, key) -> DataFrame:
    """One row (dup_keys, null_keys): key values held by more than one row
    (keys with a null part excluded) and rows with a null key part."""
    key = list(key)
    counts = df.groupBy(*[named(k) for k in key]).agg(F.count(F.lit(1)).alias("_n"),
                                  _any_null(key).alias("_null"))
    return counts.agg(
        F.count_if(~F.col("_null") & (F.col("_n") > 1)).alias("dup_keys"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).cast("bigint")
        .alias("null_keys"))


def pk_audit(spark: SparkSession, tables: TableSet, manifest: Manifest,
             keys: dict | None = None) -> DataFrame:
    """Duplicate and null primary keys of every table with a key. ``keys``
    adds or overrides keys (e.g. a candidate key of a table without one)."""
    keys = dict(keys or {})
    for n in manifest.names():
        if n in tables and manifest[n].primary_key and n not in keys:
            keys[n] = manifest[n].primary_key
    parts = [key_audit(tables[n], k).select(F.lit(n).alias("table_name"), "dup_keys", "null_keys")
             for n, k in sorted(keys.items()) if n in tables]
    return _union(spark, parts, PK_AUDIT_SCHEMA)


def unique_values(df: DataFrame, cols, collation: str | None = None) -> DataFrame:
    """One row (dup_values): values (under ``collation``) held by more than
    one row; rows with a null part are ignored, as a UNIQUE rule does."""
    cols = list(cols)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    keyed = [(F.collate(named(c), collation) if collation and c in text else named(c)).alias(f"_u{i}")
             for i, c in enumerate(cols)]
    counts = (df.where(~_any_null(cols)).select(*keyed)
              .groupBy(*[f"_u{i}" for i in range(len(cols))]).agg(F.count(F.lit(1)).alias("_n")))
    return counts.agg(F.count_if(F.col("_n") > 1).alias("dup_values"))


def unique_audit(spark: SparkSession, tables: TableSet, manifest: Manifest,
                 collation: str | None = "declared") -> DataFrame:
    """Every UNIQUE rule; ``collation`` "declared" uses each rule's own,
    None forces byte comparison, a name forces that collation."""
    parts = []
    for n in manifest.names():
        if n not in tables:
            continue
        for u in manifest[n].unique:
            coll = u.collation if collation == "declared" else collation
            parts.append(unique_values(tables[n], u.columns, coll).select(
                F.lit(n).alias("table_name"), F.lit(",".join(u.columns)).alias("column_name"),
                F.lit(coll or "UTF8_BINARY").alias("collation"), "dup_values"))
    return _union(spark, parts, UNIQUE_AUDIT_SCHEMA)


def orphan_count(child: DataFrame, cols, parent: DataFrame | None, parent_cols) -> DataFrame:
    """One row (orphans): child rows whose non-null foreign key has no parent.

    Child keys are counted per distinct value first (partial aggregation
    absorbs hot values) and parent keys are made distinct; the two keyed
    sides then meet in a left outer join whose unmatched rows are the
    orphans. Both aggregates hash-partition by the key, so the join adds no
    exchange and its size is bounded by distinct keys, not child rows. (An
    anti join would be pushed below the child aggregate by the optimizer,
    shuffling every child row instead.)"""
    keys = [f"_f{i}" for i in range(len(cols))]
    keyed = (child.where(~_any_null(cols)).groupBy(*[named(c).alias(k) for c, k in zip(cols, keys, strict=True)])
             .agg(F.count(F.lit(1)).alias("_n")))
    if parent is not None:
        pk = (parent.where(~_any_null(parent_cols)).select(*[named(p).alias(k) for p, k in zip(parent_cols, keys, strict=True)])
              .distinct().withColumn("_hit", F.lit(True)))
        keyed = keyed.join(pk, keys, "left").where(F.col("_hit").isNull())
    return keyed.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphans"))


def fk_audit(spark: SparkSession, tables: TableSet, manifest: Manifest) -> DataFrame:
    """Orphans of every declared foreign key whose child table is present.
    A missing parent table makes every non-null reference an orphan."""
    parts = []
    for n, fk in manifest.foreign_keys():
        if n not in tables:
            continue
        parts.append(orphan_count(tables[n], fk.columns, tables.get(fk.parent),
                                  fk.parent_columns).select(
            F.lit(n).alias("child"), F.lit(",".join(fk.columns)).alias("column_name"),
            F.lit(fk.parent).alias("parent"), "orphans"))
    return _union(spark, parts, FK_AUDIT_SCHEMA)


def _column_checks(spark: SparkSession, tables: TableSet, manifest: Manifest,
                   checks) -> DataFrame:
    """One pass per table: ``checks(spec)`` gives (column, violation predicate)."""
    parts = []
    for n in manifest.names():
        if n not in tables:
            continue
        items = checks(manifest[n])
        if not items:
            continue
        wide = tables[n].agg(*[F.count_if(p).alias(f"v{i}") for i, (_, p) in enumerate(items)])
        pairs = []
        for i, (c, _) in enumerate(items):
            pairs += [F.lit(c), F.col(f"v{i}")]
        parts.append(wide.select(F.lit(n).alias("table_name"),
                                 F.stack(F.lit(len(items)), *pairs).alias("column_name", "violations")))
    return _union(spark, parts, COLUMN_AUDIT_SCHEMA)


def not_null_audit(spark: SparkSession, tables: TableSet, manifest: Manifest) -> DataFrame:
    """Nulls in every NOT NULL column, all columns of a table in one pass."""
    return _column_checks(spark, tables, manifest,
                          lambda s: [(c, named(c).isNull()) for c in s.not_null])


def length_audit(spark: SparkSession, tables: TableSet, manifest: Manifest) -> DataFrame:
    """Texts longer (in characters) than the column's declared limit."""
    return _column_checks(spark, tables, manifest,
                          lambda s: [(c, F.char_length(named(c)) > n) for c, n in sorted(s.max_len.items())])


def column_audit(spark: SparkSession, tables: TableSet, manifest: Manifest) -> DataFrame:
    """NOT NULL and length rules together, one pass per table."""
    def both(s):
        return ([(f"{c}:not_null", named(c).isNull()) for c in s.not_null]
                + [(f"{c}:max_len", F.char_length(named(c)) > n) for c, n in sorted(s.max_len.items())])
    return _column_checks(spark, tables, manifest, both)
