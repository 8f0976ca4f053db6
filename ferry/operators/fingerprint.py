"""Multiset fingerprints of whole rows and of single columns.

A row's hash covers every column in the target's canonical form, so that doubles,
timestamps, booleans, dates, uuids and arrays are compared too, which the sums and key
ranges of the metrics leave out. The hashes of a table are added up, which does not depend on
the order of its rows and, unlike an exclusive or, counts repeated ones. One aggregate
per table and side: partial sums move, never rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import named
from ..manifest import Manifest, TableSet, TableSpec
from .compare import DIFF, OK
from .parity import conformed

#: The report's name for a whole row.
ROW = "(row)"
#: Nulls of so many columns fit one mask.
MASK_BITS = 60


def row_hashes(columns: list[Column]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. A mask of the nulls goes first, as the hash function
    skips them; it takes 0.0 and -0.0, and all NaN, for equal."""
    masks = []
    for i in range(0, len(columns), MASK_BITS):
        part = columns[i : i + MASK_BITS]
        masks.append(reduce(lambda a, b: a + b, [F.when(c.isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, c in enumerate(part)]))
    return tuple(F.xxhash64(F.lit(salt), *masks, *columns) for salt in (1, 2))


def added(hashes: tuple[Column, Column], prefix: str) -> list[Column]:
    """The exact sums of both hashes; 10**18 rows fit."""
    return [F.coalesce(F.sum(h.cast("decimal(20,0)").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias(f"{prefix}{k}") for k, h in enumerate(hashes)]


def comparable(schema: T.StructType) -> list[str]:
    """Columns that can be hashed; a map has no order and is left out."""
    return [f.name for f in schema.fields if not isinstance(f.dataType, T.MapType)]


def side_fingerprint(df: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """One row: n, and per entry (the whole row, then each column beside the key) two sums."""
    sums = [c for i, names in enumerate(entries(columns, key)) for c in added(row_hashes([named(x) for x in names]), f"h{i}_")]
    return df.agg(F.count("*").alias("n"), *sums)


def entries(columns: list[str], key: list[str]) -> list[list[str]]:
    return [columns, *[[*key, c] for c in columns if c not in key]]


def table_fingerprint(table: str, src: DataFrame, tgt: DataFrame, spec: TableSpec) -> DataFrame:
    """(table_name, column_name, source_rows, target_rows, status): the row ``(row)`` for
    whole rows, and one for each column outside the key. With a key, a column's values
    are tied to it, so two rows that swapped values differ; without one they are a multiset.

    Both sides are hashed as the target holds them, so one that a conversion alone sets
    apart is equal."""
    key = [k for k in spec.primary_key]
    columns = comparable(spec.schema)
    sides = [side_fingerprint(conformed(df, columns, spec.schema, spec.logical), columns, key) for df in (src, tgt)]
    s, t = (df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns]) for df, p in zip(sides, "st", strict=True))
    names = [ROW, *[c for c in columns if c not in key]]

    def same(i: int) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"s_{x}") == F.col(f"t_{x}") for x in ("n", f"h{i}_0", f"h{i}_1")])

    cells = [x for i, c in enumerate(names) for x in (F.lit(c), F.when(same(i), OK).otherwise(DIFF))]
    # one row on either side
    return s.join(t, F.lit(True)).select(F.lit(table).alias("table_name"), F.col("s_n").alias("source_rows"), F.col("t_n").alias("target_rows"),
                                         F.stack(F.lit(len(names)), *cells).alias("column_name", "status")).select(
        "table_name", "column_name", "source_rows", "target_rows", "status")


SCHEMA = "table_name string, column_name string, source_rows bigint, target_rows bigint, status string"


def one_table_fingerprint(name: str, src: DataFrame, tgt: DataFrame, spec: TableSpec) -> list[tuple]:
    """Fingerprint rows of one table (one small job); a failure gives one ERROR row."""
    try:
        return [tuple(r) for r in table_fingerprint(name, src, tgt, spec).collect()]
    except Exception:
        return [(name, ROW, None, None, "ERROR")]


def fingerprints(spark: SparkSession, source: TableSet, target: TableSet, manifest: Manifest, tables=None) -> DataFrame:
    """``table_fingerprint`` of every table (of ``tables``) on both sides and in the manifest."""
    names = [n for n in sorted(set(source) & set(target) & set(manifest)) if tables is None or n in tables]
    empty = spark.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, [table_fingerprint(n, source[n], target[n], manifest[n]) for n in names], empty)
