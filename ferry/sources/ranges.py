"""Equi-depth key ranges: how a read of a large table is split."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import named
from ..operators.ranking import places
from .tables import sql_column


def key_ranges(df: DataFrame, key: list[str], batch: int) -> DataFrame:
    """(ordinal, low, high, n_rows): consecutive ranges of ``batch`` rows each, the last of
    fewer; ``low`` and ``high`` are the smallest and greatest key (structs) in the range.

    The bounds are exact for keys of any type, however sparse or skewed: rows take their
    places from a range partitioning of the key columns alone, so gaps cost nothing and no
    task holds more than its share. Rows of one key keep together in the range where the
    first of them falls; so only a key that repeats can overfill a range. Null keys are
    the smallest."""
    if batch < 1:
        raise ValueError("batch must be at least 1")
    own = F.struct(*[named(k).alias(f"k{i}") for i, k in enumerate(key)])
    rows = places(df.select(own.alias("key")), [F.col("key")])
    keys = rows.groupBy("key").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    return keys.groupBy(F.expr(f"place div {int(batch)}").alias("ordinal")).agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.sum("n").alias("n_rows"))


def literal(value, text_quote: str = "'") -> str:
    """``value`` as a SQL literal."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    if isinstance(value, (datetime, date)):
        return f"{'TIMESTAMP' if isinstance(value, datetime) else 'DATE'} '{value}'"
    return text_quote + str(value).replace(text_quote, text_quote * 2) + text_quote


def _from(columns: list[str], low: list[str]) -> str:
    """Keys at or after ``low`` (SQL values) in the order of the columns."""
    parts = []
    for i, c in enumerate(columns):
        same = [f"{x} = {v}" for x, v in zip(columns[:i], low[:i], strict=True)]
        last = i == len(columns) - 1
        parts.append("(" + " AND ".join([*same, f"{c} {'>=' if last else '>'} {low[i]}"]) + ")")
    return "(" + " OR ".join(parts) + ")"


def range_predicates(ranges: DataFrame, key: list[str], quote: str = '"') -> list[str]:
    """A predicate for each range, for a reader that takes predicates; together they hold for
    every row once, rows with a null in their key included. A row a task: as many as the
    read gets partitions."""
    columns = [sql_column(k, quote) for k in key]
    lows = [tuple(r["low"]) for r in ranges.orderBy("ordinal").select("low").collect()]
    known = [[literal(v) for v in x] for x in lows[1:] if None not in x]
    if len(known) < len(lows) - 1:
        raise ValueError("more null keys than a range holds")
    missing = " OR ".join(f"{c} IS NULL" for c in columns)
    if not known:
        return ["1 = 1"]
    out = [f"(NOT {_from(columns, known[0])} OR {missing})"]
    for low, high in zip(known, [*known[1:], None], strict=True):
        out.append(_from(columns, low) + ("" if high is None else f" AND NOT {_from(columns, high)}"))
    # a null in a later key column makes the comparison unknown; such a row is in the first range
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return [out[0], *[f"({x}) AND {whole}" for x in out[1:]]]


def read_ranges(df: DataFrame, predicates: list[str]) -> DataFrame:
    """``df`` as the union of its ranges, as a reader by predicates sees it: a scan for each,
    so for few ranges; ``in_ranges`` reads any number in one."""
    return reduce(DataFrame.unionByName, [df.where(p) for p in predicates])


#: Places that a task of ``in_ranges`` takes.
CHUNK = 1 << 16


def in_ranges(df: DataFrame, ranges: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with ``ordinal``, the place (from 0) of the predicate of ``range_predicates``
    that a row meets; a row that meets none is left out.

    One scan for any number of ranges: rows and the ranges' bounds take their places in the
    order of the keys, a row belongs to the last bound at or before it, and is held to that
    range's predicate, whose values come from the bounds. Rows with a null in their key are
    in the first range."""
    if clash := {"ordinal", "overall", "place", "group_size"} & set(df.columns):
        raise ValueError(f"columns already exist: {sorted(clash)}")
    own = F.struct(*[named(k).alias(f"k{i}") for i, k in enumerate(key)])
    rows = df.select(own.alias("key"), F.struct(*[named(c) for c in df.columns]).alias("row"))
    # keys that repeat leave gaps in the ranges' own ordinals
    ranges = places(ranges.select("low", F.col("ordinal").alias("at")), [F.col("at")]).select("low", F.col("overall").alias("ordinal"))
    bounds = ranges.where("ordinal > 0").select("ordinal", F.col("low").alias("key"))
    both = places(rows.unionByName(bounds, allowMissingColumns=True), [F.col("key"), F.col("ordinal").asc_nulls_last()])
    both = both.withColumn("chunk", F.expr(f"overall div {CHUNK}"))
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = both.groupBy("chunk").agg(F.max("ordinal").alias("top")).select("chunk", F.coalesce(F.max("top").over(before), F.lit(0)).alias("before"))
    last = F.max("ordinal").over(Window.partitionBy("chunk").orderBy("overall"))
    values = [f"key.k{i}" for i in range(len(key))]
    missing = " OR ".join(f"{v} IS NULL" for v in values)
    found = (both.withColumn("last", last).where("row IS NOT NULL").join(tops, "chunk")
             .select("key", "row", F.expr(f"CASE WHEN {missing} THEN 0 ELSE coalesce(last, before) END").alias("ordinal")))
    ends = ranges.select("ordinal", "low").join(bounds.select((F.col("ordinal") - 1).alias("ordinal"), F.col("key").alias("next")), "ordinal", "left")
    low, end = (_from(values, [f"{x}.k{i}" for i in range(len(key))]) for x in ("low", "next"))
    within = f"(ordinal = 0 OR {low}) AND (next IS NULL OR NOT {end})"
    return found.join(ends, "ordinal").where(f"(ordinal = 0 AND ({missing})) OR ({within})").select("row.*", "ordinal")
