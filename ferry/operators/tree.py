"""Text parity over a tree of key ranges: only what differs is paired.

Keys are cut into ranges, and these into finer ones, by quantiles of a bounded sample.
Each side sums its rows' hashes per coarse range (one row per range leaves a task); the
ranges whose sums differ are read again, now by finer range; and only the rows of finer
ranges that still differ are shuffled and paired by key. Two equal tables cost one scan a
side and shuffle a row per range. A range of an integer, date or text key is a predicate on the
key column, so the second and third pass read the row groups of those ranges only.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import named
from ..manifest import Manifest, TableSet, TableSpec
from .fingerprint import added, row_hashes
from .parity import NO_ENTRY, KEY_ROW, PARITY_SCHEMA, _skipped, conformed, paired_columns, parity_tables, table_parity

#: Coarse ranges, finer ranges of each, and sampled keys for each of those.
COARSE, FINE, SAMPLED = 64, 32, 16
ROWS_SCHEMA = "table_name string, key string, state string, columns array<string>"
#: The range of rows with a null in their key, which pair with nothing.
NO_KEY = -1
ONLY_SOURCE, ONLY_TARGET, DIFFERS = "only_source", "only_target", "differs"


def key_bounds(df: DataFrame, key: list[str], ranges: int, sampled: int = SAMPLED) -> list[tuple]:
    """Ascending first keys of ``ranges`` ranges of about equal depth, without the first
    range's; fewer where there are few keys. The keys of the least hashes are an even
    sample of them, whatever their type, gaps or skew; its size is ``ranges * sampled``."""
    if any(f.name in key and isinstance(f.dataType, T.BinaryType) for f in df.schema.fields):
        return []  # bytes that are no uuid: the whole table is one range
    own = df.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(key)]).dropna()
    names = own.columns
    some = own.withColumn("_h", F.xxhash64(*names)).orderBy("_h", *names).limit(ranges * sampled).drop("_h").distinct().orderBy(*names).collect()
    step = len(some) / ranges
    cuts = sorted({int(i * step) for i in range(1, ranges)} - {0})
    return [tuple(some[i]) for i in cuts]


def range_of(df: DataFrame, key: list[str], bounds: list[tuple], fine: int) -> tuple[Column, Column]:
    """(coarse, leaf): the range of a row's key among ``bounds``; every ``fine``-th bound
    begins a coarse range. A null key is in range ``NO_KEY``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    fields = [f"_k{i}" for i in range(len(key))]
    own = F.struct(*[named(k).alias(x) for k, x in zip(key, fields, strict=True)])
    known = reduce(lambda a, b: a & b, [named(k).isNotNull() for k in key])

    def array(rows: list[tuple]) -> Column:  # one literal, once folded
        text = json.dumps([dict(zip(fields, map(str, r), strict=True)) for r in rows])
        return F.from_json(F.lit(text), "array<struct<" + ",".join(f"{x}:string" for x in fields) + ">>").cast(
            "array<struct<" + ",".join(f"{x}:{types[k]}" for x, k in zip(fields, key, strict=True)) + ">>")

    if not bounds:
        return (F.when(known, 0).otherwise(NO_KEY),) * 2
    starts = bounds[fine - 1 :: fine]
    coarse = F.size(F.filter(array(starts), lambda b: b <= own)) if starts else F.lit(0)
    within = F.size(F.filter(F.slice(array(bounds), coarse * fine + 1, F.lit(fine - 1)), lambda b: b <= own))
    return F.when(known, coarse).otherwise(NO_KEY), F.when(known, coarse * fine + within).otherwise(NO_KEY)


def _between(key: list[str], bounds: list[tuple], fine: int, coarse: list[int]) -> Column | None:
    """The coarse ranges as a predicate on a single key column, for the reader to prune by;
    neighbouring ranges are one."""
    if len(key) != 1 or not bounds:
        return None
    k, starts = named(key[0]), [None, *bounds[fine - 1 :: fine], None]
    out, i = [k.isNull()] * (NO_KEY in coarse), 0
    coarse = [c for c in coarse if c != NO_KEY]
    while i < len(coarse):
        j = i
        while j + 1 < len(coarse) and coarse[j + 1] == coarse[j] + 1:
            j += 1
        low, high = starts[coarse[i]], starts[coarse[j] + 1]
        part = F.lit(True)
        if low is not None:
            part = part & (k >= F.lit(low[0]))
        if high is not None:
            part = part & (k < F.lit(high[0]))
        out.append(part)
        i = j + 1
    return reduce(lambda a, b: a | b, out)


def node_digests(src: DataFrame, tgt: DataFrame, columns: list[str], nodes: list[Column]) -> DataFrame:
    """(node, side, n, h0, h1): rows and added hashes by range, of both sides in one job."""
    both = [df.select(node.alias("node"), F.lit(side).alias("side"), *[h.alias(f"x{k}") for k, h in enumerate(row_hashes([named(c) for c in columns]))])
            for side, (df, node) in enumerate(zip((src, tgt), nodes, strict=True))]
    return both[0].unionByName(both[1]).groupBy("node", "side").agg(F.count("*").alias("n"), *added((F.col("x0"), F.col("x1")), "h"))


@dataclass
class TreeResult:
    nodes: list[tuple]         # (level, node, source_rows, target_rows) of ranges that differ
    equal_rows: int            # rows in ranges that are equal
    source: DataFrame          # rows of the differing leaves
    target: DataFrame


def descend(src: DataFrame, tgt: DataFrame, key: list[str], columns: list[str], coarse: int = COARSE, fine: int = FINE) -> TreeResult:
    """The rows of both sides whose key ranges differ. ``src`` and ``tgt`` hold the same
    key and ``columns`` in the same form."""
    bounds = key_bounds(src, key, coarse * fine)
    used = [*key, *columns]
    nodes, equal, sides = [], 0, [src, tgt]
    for level in (0, 1):
        found = ({}, {})
        for r in node_digests(*sides, used, [range_of(df, key, bounds, fine)[level] for df in sides]).collect():
            found[r["side"]][r["node"]] = (r["n"], r["h0"], r["h1"])
        differ = sorted(x for x in set(found[0]) | set(found[1]) if x == NO_KEY or found[0].get(x) != found[1].get(x))
        equal += sum(v[0] for x, v in found[0].items() if x not in set(differ))
        nodes += [(level, x, *[f.get(x, (0,))[0] for f in found]) for x in differ]
        prune = _between(key, bounds, fine, differ) if level == 0 and differ else None
        sides = [df.where(F.lit(False) if not differ else range_of(df, key, bounds, fine)[level].isin(differ)) for df in sides]
        sides = [df.where(prune) for df in sides] if prune is not None else sides
        if not differ:
            break
    return TreeResult(nodes, equal, *sides)


def _tree(spec: TableSpec, src: DataFrame, tgt: DataFrame, coarse: int, fine: int) -> tuple[TreeResult, list[str], list[str]]:
    key, columns = list(spec.primary_key), paired_columns(spec, spec.primary_key)
    sides = [conformed(df, [*key, *columns], spec.schema, spec.logical) for df in (src, tgt)]
    return descend(*sides, key, columns, coarse, fine), key, columns


def _each(names: list[str], one, empty: DataFrame, parallelism: int) -> DataFrame:
    """``one`` of every table, whose descents run side by side."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return reduce(DataFrame.unionByName, list(pool.map(one, names)), empty)


def tree_parity(spark: SparkSession, source: TableSet, target: TableSet, manifest: Manifest, tables=None,
                coarse: int = COARSE, fine: int = FINE, parallelism: int = 8) -> DataFrame:
    """The rows of ``string_parity``, paired within differing ranges only. A key that
    repeats alike on both sides is not noticed there (``pk_audit`` finds it); one that
    makes its range differ gives SKIPPED, as in ``string_parity``."""
    def one(n: str) -> DataFrame:
        if n not in manifest:
            return _skipped(spark, n, [KEY_ROW], NO_ENTRY)
        if not manifest[n].primary_key:
            return _skipped(spark, n, paired_columns(manifest[n], ()) or [KEY_ROW], "no primary key")
        tree, key, columns = _tree(manifest[n], source[n], target[n], coarse, fine)
        return table_parity(spark, n, tree.source, tree.target, key, columns, alike=tree.equal_rows)

    return _each([n for n in parity_tables(source, target) if tables is None or n in tables], one, spark.createDataFrame([], PARITY_SCHEMA), parallelism)


def differing_rows(table: str, src: DataFrame, tgt: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(table_name, key, state, columns): keys that one side lacks or whose ``columns``
    differ, which are named. Several rows of a key count as one with all their values. A
    null key is on its own side only."""
    def side(df: DataFrame, tag: int) -> DataFrame:
        return df.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(key)], F.lit(tag).alias("_side"),
                         *[F.xxhash64(F.lit(1), named(c).isNull(), named(c)).alias(f"_a{i}") for i, c in enumerate(columns)],
                         *[F.xxhash64(F.lit(2), named(c).isNull(), named(c)).alias(f"_b{i}") for i, c in enumerate(columns)])

    keys = [f"_k{i}" for i in range(len(key))]
    sums = [F.sum(F.when(F.col("_side") == tag, F.col(f"_{h}{i}").cast("decimal(38,0)"))).alias(f"_{h}{i}_{tag}")
            for i in range(len(columns)) for h in "ab" for tag in (0, 1)]
    both = side(src, 0).unionByName(side(tgt, 1)).groupBy(*keys).agg(
        F.count_if(F.col("_side") == 0).alias("_ns"), F.count_if(F.col("_side") == 1).alias("_nt"), *sums)
    differ = F.filter(F.array(*[F.when(~(F.col(f"_a{i}_0").eqNullSafe(F.col(f"_a{i}_1")) & F.col(f"_b{i}_0").eqNullSafe(F.col(f"_b{i}_1"))), F.lit(c))
                                for i, c in enumerate(columns)]).cast("array<string>"), lambda c: c.isNotNull())
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    shown = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    sides = F.when(~known, F.array_compact(F.array(F.when(F.col("_ns") > 0, ONLY_SOURCE), F.when(F.col("_nt") > 0, ONLY_TARGET)))).when(
        F.col("_nt") == 0, F.array(F.lit(ONLY_SOURCE))).when(F.col("_ns") == 0, F.array(F.lit(ONLY_TARGET))).when(
        (F.size(differ) > 0) | (F.col("_ns") != F.col("_nt")), F.array(F.lit(DIFFERS))).otherwise(F.array().cast("array<string>"))
    return both.select(F.lit(table).alias("table_name"), shown.alias("key"), F.explode(sides).alias("state"), differ.alias("columns")).withColumn(
        "columns", F.when(F.col("state") == DIFFERS, F.col("columns")).otherwise(F.array().cast("array<string>")))


def tree_differences(spark: SparkSession, source: TableSet, target: TableSet, manifest: Manifest, tables=None,
                     coarse: int = COARSE, fine: int = FINE, parallelism: int = 8) -> DataFrame:
    """``differing_rows`` of every common table with a key, from differing ranges only."""
    def one(n: str) -> DataFrame:
        tree, key, columns = _tree(manifest[n], source[n], target[n], coarse, fine)
        return differing_rows(n, tree.source, tree.target, key, columns)

    names = [n for n in parity_tables(source, target) if (tables is None or n in tables) and n in manifest and manifest[n].primary_key]
    return _each(names, one, spark.createDataFrame([], ROWS_SCHEMA), parallelism)
