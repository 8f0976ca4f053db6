"""Subsets of a table set that are closed under its foreign keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import named
from ..manifest import ForeignKey, Manifest, TableSet
from ..session import shared_dir


def _saved(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _match(a: DataFrame, left: list[str], b: DataFrame, right: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[f"`{c}`"] == b[f"`{d}`"] for c, d in zip(left, right, strict=True)])


def _renamed(df: DataFrame, columns, prefix: str) -> DataFrame:
    return df.select(*[named(c).alias(f"{prefix}{i}") for i, c in enumerate(columns)])


def closed_subset(spark: SparkSession, source: TableSet, manifest: Manifest, seeds: dict[str, Column | str],
                  max_rounds: int = 1000) -> TableSet:
    """The rows that the predicates in ``seeds`` pick, and every row that these reach over
    foreign keys, as frames over ``source``: a subset without orphans that was not one in
    the source. Tables that nothing reaches are left out.

    A fixpoint of semi joins, cycles and self references included. A round follows the
    foreign keys of the rows found in the round before only: their distinct values meet
    the parent's keys, and those not found before go on. Keys stay distributed and are
    written once a round; the driver sees only whether a round found any. A null part of a
    foreign key refers to nothing. Tables that are referred to need a primary key."""
    if unknown := sorted(set(seeds) - set(source)):
        raise ValueError(f"no such table: {', '.join(unknown)}")
    fks = {n: [fk for fk in manifest[n].foreign_keys if fk.parent in source] for n in source if n in manifest}
    picked = {n: source[n].where(p) for n, p in seeds.items()}
    keys = {n: _renamed(picked[n], manifest[n].primary_key, "k") for n in picked if n in manifest and manifest[n].primary_key}
    found: dict[str, list[DataFrame]] = {n: [_saved(df.distinct())] for n, df in keys.items()}
    fresh = dict(picked)
    for _ in range(max_rounds):
        reached: dict[str, list[DataFrame]] = {}
        for child, rows in fresh.items():
            for fk in fks.get(child, ()):
                if fk.parent not in manifest or not manifest[fk.parent].primary_key:
                    raise ValueError(f"table {fk.parent} is referred to and has no primary key")
                reached.setdefault(fk.parent, []).append(_parents(rows, fk, source[fk.parent], manifest[fk.parent].primary_key))
        fresh = {}
        for parent, parts in reached.items():
            new = reduce(DataFrame.union, parts).distinct()
            names = new.columns
            for known in found.get(parent, ()):
                new = new.join(known, names, "left_anti")
            new = _saved(new)
            if new.head(1):
                found.setdefault(parent, []).append(new)
                fresh[parent] = _having(source[parent], manifest[parent].primary_key, new)
        if not fresh:
            break
    else:
        raise RuntimeError(f"the subset did not close in {max_rounds} rounds")
    out = {n: _having(source[n], manifest[n].primary_key, reduce(DataFrame.union, parts)) for n, parts in found.items()}
    return out | {n: df for n, df in picked.items() if n not in out}


def _having(df: DataFrame, key, keys: DataFrame) -> DataFrame:
    """The rows whose key is among ``keys`` (k0, k1, ...)."""
    return df.join(keys, _match(df, list(key), keys, keys.columns), "left_semi")


def _parents(rows: DataFrame, fk: ForeignKey, parent: DataFrame, key) -> DataFrame:
    """Keys (k0, ...) of the parent rows that ``rows`` refer to. The values are made
    distinct before they move, so a value that most rows hold is one row a task."""
    values = _renamed(rows, fk.columns, "v").dropna().distinct()
    if tuple(fk.parent_columns) == tuple(key):
        own = _renamed(parent, key, "k")
        return own.join(values, _match(own, own.columns, values, values.columns), "left_semi")
    held = parent.select(*[named(c).alias(f"p{i}") for i, c in enumerate(fk.parent_columns)], *[named(c).alias(f"k{i}") for i, c in enumerate(key)])
    return held.join(values, _match(held, [f"p{i}" for i in range(len(fk.parent_columns))], values, values.columns), "left_semi").select(
        *[f"k{i}" for i in range(len(key))])
