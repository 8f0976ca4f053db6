"""Row-by-row text parity paired on the full primary key.

For each table with a key, both sides are projected to (key, side tag,
digest of every text column), unioned, and grouped by the key in ONE
shuffle. The group carries each side's row count and digests, so the same
pass pairs rows, finds one-sided keys and detects duplicate keys: no join is
ever formed, so a duplicated (even hot) key cannot fan out into pairs, and
partial aggregation collapses it map-side. A second, global aggregate then
counts per column how many paired rows carry identical text.

Both sides are first brought to the target's types, as a load brings them: a uuid key
held as bytes or in upper case pairs with its canonical text, and a number or date that
the target keeps as text is compared as that text. Text travels as ``text_digest`` (SHA-256), so a 100 KB document shuffles as 32 bytes.

Decisions the documentation leaves open: null = null is identical, null vs
text is not; rows on one side only are never identical; status OK needs
identical = paired and no one-sided row. A row with a null in its key pairs
with nothing and counts as one-sided. A table whose only text is its key, or
that has no text, is paired all the same: one row for the column ``(key)``.
A table without a key or without a manifest entry, or whose key repeats on
either side, is SKIPPED, never failed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import ansi_enabled, canonical_json, named, target_value, text_digest
from ..manifest import Manifest, TableSet, TableSpec
from .compare import DIFF, OK, SKIPPED
from .metrics import error_text, missing_columns

PARITY_SCHEMA = ("table_name string, column_name string, paired bigint, only_source bigint, "
                 "only_target bigint, identical bigint, status string, reason string")


#: The row of a table paired on its key alone, and the reason where no entry names a key.
KEY_ROW, NO_ENTRY = "(key)", "no manifest entry"


def _skipped(spark: SparkSession, table: str, columns: list[str], reason: str) -> DataFrame:
    rows = [(table, c, None, None, None, None, SKIPPED, reason) for c in columns]
    return spark.createDataFrame(rows, PARITY_SCHEMA)


def conformed(df: DataFrame, columns: list[str], schema: T.StructType, logical: dict) -> DataFrame:
    """``columns`` of one side as the target holds them, by the casts that a load applies:
    uuids in canonical text, numbers and dates rendered where the target's column is text;
    and JSON in its canonical form, as the target's type keeps no key order."""
    own = {f.name: f.dataType for f in df.schema.fields}
    to = {f.name: f.dataType for f in schema.fields}
    ansi = ansi_enabled(df)

    def value(c: str):
        out = target_value(c, own[c], to[c], logical.get(c), ansi) if c in own and c in to else named(c)
        return canonical_json(out) if logical.get(c) == "json" and isinstance(to.get(c), T.StringType) else out

    return df.select(*[value(c).alias(c) for c in columns])


def pair_counts(src: DataFrame, tgt: DataFrame, key: list[str], columns: list[str],
                digest: bool = True) -> DataFrame:
    """One row: dup_keys, paired, only_source, only_target, and per text
    column ``c{i}`` the number of paired rows whose text is identical.
    ``digest=False`` shuffles the raw text bytes instead of digests."""
    def value(c: str):
        return text_digest(c) if digest else named(c).cast("binary")

    def side(df: DataFrame, tag: int) -> DataFrame:
        return df.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(key)], F.lit(tag).alias("_side"),
                         *[value(c).alias(f"_d{i}") for i, c in enumerate(columns)])

    keys = [f"_k{i}" for i in range(len(key))]
    is_s, is_t = F.col("_side") == 0, F.col("_side") == 1
    per_key = side(src, 0).unionByName(side(tgt, 1)).groupBy(*keys).agg(
        F.count_if(is_s).alias("_ns"), F.count_if(is_t).alias("_nt"),
        *[F.max(F.when(is_s, F.col(f"_d{i}"))).alias(f"_s{i}") for i in range(len(columns))],
        *[F.max(F.when(is_t, F.col(f"_d{i}"))).alias(f"_t{i}") for i in range(len(columns))],
    )
    ns, nt = F.col("_ns"), F.col("_nt")
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    both = keyed & (ns == 1) & (nt == 1)

    def alone(own, other):
        return F.coalesce(F.sum(F.when(~keyed, own).when((own >= 1) & (other == 0), 1)), F.lit(0)).cast("bigint")

    return per_key.agg(
        F.count_if(keyed & ((ns > 1) | (nt > 1))).alias("dup_keys"),
        F.count_if(both).alias("paired"),
        alone(ns, nt).alias("only_source"),
        alone(nt, ns).alias("only_target"),
        *[F.count_if(both & F.col(f"_s{i}").eqNullSafe(F.col(f"_t{i}"))).alias(f"c{i}")
          for i in range(len(columns))],
    )


def table_parity(spark: SparkSession, table: str, src: DataFrame, tgt: DataFrame,
                 key, columns: list[str], digest: bool = True, spec: TableSpec | None = None,
                 alike: int = 0) -> DataFrame:
    """Lazy parity rows for one table: one per text column, or one for the key. Both sides
    are compared as the target holds them: by ``spec``, else by the target's own types.
    ``alike`` rows are known to be paired and identical and are not in the frames."""
    key = list(key or [])
    if not key:
        return _skipped(spark, table, columns or [KEY_ROW], "no primary key")
    schema, logical = (spec.schema, spec.logical) if spec else (tgt.schema, {})
    src, tgt = (conformed(df, [*key, *columns], schema, logical) for df in (src, tgt))
    counts = pair_counts(src, tgt, key, columns, digest)
    if alike:
        counts = counts.withColumns({c: F.col(c) + F.lit(alike) for c in ("paired", *[f"c{i}" for i in range(len(columns))])})
    cells = [(F.lit(c), F.col(f"c{i}")) for i, c in enumerate(columns)] or [(F.lit(KEY_ROW), F.col("paired"))]
    long = counts.select("dup_keys", "paired", "only_source", "only_target",
                         F.stack(F.lit(len(cells)), *[x for cell in cells for x in cell]).alias("column_name", "identical"))
    dup = F.col("dup_keys") > 0
    ok = ((F.col("identical") == F.col("paired")) & (F.col("only_source") == 0)
          & (F.col("only_target") == 0))

    def unless_dup(c: str):
        return F.when(~dup, F.col(c))

    return long.select(
        F.lit(table).alias("table_name"), "column_name",
        unless_dup("paired").alias("paired"), unless_dup("only_source").alias("only_source"),
        unless_dup("only_target").alias("only_target"), unless_dup("identical").alias("identical"),
        F.when(dup, SKIPPED).when(ok, OK).otherwise(DIFF).alias("status"),
        F.when(dup, F.lit("duplicate key")).alias("reason"),
    )


def string_parity(spark: SparkSession, source: TableSet, target: TableSet, manifest: Manifest,
                  tables=None, keys: dict | None = None, digest: bool = True) -> DataFrame:
    """Lazy parity of every common table (or ``tables``). ``keys`` may
    override a table's pairing key."""
    keys = keys or {}
    parts = []
    for n in parity_tables(source, target):
        if tables is not None and n not in tables:
            continue
        if n not in manifest:
            parts.append(_skipped(spark, n, [KEY_ROW], NO_ENTRY))
            continue
        key = keys.get(n, manifest[n].primary_key)
        parts.append(table_parity(spark, n, source[n], target[n], key, paired_columns(manifest[n], key), digest, manifest[n]))
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], PARITY_SCHEMA))


def paired_columns(spec, key) -> list[str]:
    """Text columns outside the key, and JSON ones."""
    held = {*spec.text_columns(), *(c for c, kind in spec.logical.items() if kind == "json")}
    return [f.name for f in spec.schema.fields if f.name in held and isinstance(f.dataType, T.StringType) and f.name not in key]


def parity_tables(source: TableSet, target: TableSet) -> list[str]:
    return sorted(set(source) & set(target))


def one_table_parity(spark: SparkSession, name: str, src: DataFrame, tgt: DataFrame,
                     spec, digest: bool = True) -> list[tuple]:
    """Parity rows of one table (one small job); a failure gives ERROR rows."""
    if spec is None:
        return [(name, KEY_ROW, None, None, None, None, SKIPPED, NO_ENTRY)]
    cols = paired_columns(spec, spec.primary_key)
    try:
        needed = [*spec.primary_key, *cols]
        if lost := sorted({*missing_columns(src, needed), *missing_columns(tgt, needed)}):
            raise ValueError(f"[MISSING_COLUMN] table lacks column(s) {', '.join(lost)}")
        return [tuple(r) for r in
                table_parity(spark, name, src, tgt, spec.primary_key, cols, digest, spec).collect()]
    except Exception as exc:
        return [(name, c, None, None, None, None, "ERROR", error_text(exc)) for c in cols or [KEY_ROW]]
