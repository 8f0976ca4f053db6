"""Load a table set into a sink with keys preserved and types conformed.

Per table: project to the target's column order (extra source columns are
dropped, a missing one is an error), cast to the target types (casts fail
loud and never lose a part of a value), write to a staging place, check the
target's rules there, count and publish. Staged rows are counted from
Parquet row-group metadata. Executors read and write in parallel; nothing
passes through the driver. Keys are copied as they are, never regenerated.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import audit
from ..functions.exprs import ansi_enabled, named, target_value
from ..manifest import Manifest, TableSet, TableSpec
from ..sources.tables import data_files

LOADED, NOT_FOUND, TOTAL = "LOADED", "NOT_FOUND", "TOTAL"
REPORT_SCHEMA = "table_name string, n_rows bigint, status string"


class LoadError(RuntimeError):
    """A table failed to load; tables loaded before stay. ``violations`` lists
    (rule, column, rows) where the target's rules refused the rows; ``others`` the errors
    of further tables that were already under way."""

    def __init__(self, table: str, message: str, violations: list | None = None):
        super().__init__(f"loading table {table}: {message}")
        self.table, self.violations, self.others = table, violations or [], []


def select_tables(available, requested=None) -> tuple[list[str], list[str]]:
    """(tables to load, requested names that do not exist), both sorted. No request
    asks for every table; it is an error if nothing is left to load."""
    available = set(available)
    asked = {name.strip() for name in requested or () if name} - {""} or available
    if not asked & available:
        raise LoadError("*", "no tables to load")
    return sorted(asked & available), sorted(asked - available)


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Target columns in target order; extra source columns are dropped."""
    missing = [c for c in spec.columns if c not in df.columns]
    if missing:
        raise LoadError(spec.name, f"source lacks target column(s) {', '.join(missing)}")
    return df.select(*[named(c) for c in spec.columns])


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast every column to the target type. A value that does not fit, or that would
    lose its fraction or time of day, raises at run time (also with ANSI mode off);
    fewer decimals round, as a decimal target does. A uuid column of either physical
    form becomes its canonical text; any other binary is never turned into text."""
    current = {f.name: f.dataType for f in df.schema.fields}
    ansi = ansi_enabled(df)

    def cast(f) -> Column:
        try:
            return target_value(f.name, current[f.name], f.dataType, spec.logical.get(f.name), ansi)
        except ValueError as exc:
            raise LoadError(spec.name, str(exc)) from exc

    return df.select(*[cast(f).alias(f.name) for f in spec.schema.fields])


def row_rules(spec: TableSpec) -> list[tuple[str, str, Column]]:
    """(rule, column, broken) for the NOT NULL and length rules."""
    return ([("not_null", c, named(c).isNull()) for c in spec.not_null]
            + [("max_len", c, F.coalesce(F.char_length(named(c)) > n, F.lit(False))) for c, n in sorted(spec.max_len.items())])


def enforced(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` that raises at the first row that breaks a NOT NULL or length rule."""
    broken = F.lit(None).cast("string")
    for rule, c, bad in row_rules(spec):
        broken = F.coalesce(broken, F.when(bad, F.lit(f"{spec.name}.{c} breaks {rule}")))
    return df.where(F.when(broken.isNotNull(), F.raise_error(broken).cast("boolean")).otherwise(True))


def key_rules(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, int]]:
    """(rule, columns, keys held by more than one row) of the primary key and the UNIQUE
    rules that are broken; each key is counted before it is shuffled."""
    found = []
    if spec.primary_key:
        found.append(("primary_key", spec.primary_key, audit.key_audit(df, spec.primary_key).first()["dup_keys"]))
    for u in spec.unique:
        found.append(("unique", u.columns, audit.unique_values(df, u.columns, u.collation).first()["dup_values"]))
    return [(rule, ",".join(columns), n) for rule, columns, n in found if n]


def append_conflicts(incoming: DataFrame, existing: DataFrame, key) -> DataFrame:
    """Incoming keys already present in the target (a left semi join)."""
    own = incoming.select(*[named(k) for k in key])
    held = existing.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(key)])
    same = reduce(lambda a, b: a & b, [own[f"`{k}`"] == held[f"_k{i}"] for i, k in enumerate(key)])
    return own.join(held, same, "left_semi")


def unique_conflicts(incoming: DataFrame, existing: DataFrame, spec: TableSpec) -> list[tuple[str, str, int]]:
    """(rule, columns, incoming rows) of the UNIQUE rules whose values, under the rule's
    collation, the target already holds; a null part equals nothing."""
    found = []
    for u in spec.unique:
        text = {f.name for f in spec.schema.fields if isinstance(f.dataType, T.StringType)}
        parts = [F.collate(named(c), u.collation) if u.collation and c in text else named(c) for c in u.columns]
        own, held = (df.select(*[c.alias(f"_{side}{i}") for i, c in enumerate(parts)]) for df, side in ((incoming, "u"), (existing, "k")))
        same = reduce(lambda a, b: a & b, [own[f"_u{i}"] == held[f"_k{i}"] for i in range(len(parts))])
        found.append(("unique", ",".join(u.columns), own.join(held, same, "left_semi").count()))
    return [x for x in found if x[2]]


class ParquetSink:
    """One Parquet folder per table under ``root``.

    Every load first writes a staging folder. A replacement is then swapped in with
    file-system renames, and the previous table is moved back if that fails; an append
    moves the staged files in, as a write's own commit does, and takes them out again if
    that fails. So a failed load never leaves a half-written table or loses the previous one.
    The swap is atomic where renames are (HDFS and similar); on an object store a rename
    is a copy, so there a table format or a committer should hold the target."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return bool(self._fs.exists(self._Path(self.path(table))))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def stage(self, df: DataFrame, table: str) -> str:
        """Where the rows were written, apart from the tables."""
        staged = f"{self.root}/_staging/{table}-{uuid.uuid4().hex[:12]}"
        try:
            df.write.mode("errorifexists").parquet(staged)
        except Exception:
            self.discard(staged)
            raise
        return staged

    def staged(self, staged: str) -> DataFrame:
        return self.spark.read.parquet(staged)

    def discard(self, staged: str) -> None:
        self._fs.delete(self._Path(staged), True)

    def append(self, staged: str, table: str) -> None:
        """Move the staged files, whose names are unique, beside the table's: rows are
        written once. If a move fails, those moved before go back out."""
        final, moved = self._Path(self.path(table)), []
        self._fs.mkdirs(final)
        for status in self._fs.listStatus(self._Path(staged)):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            target = self._Path(f"{self.path(table)}/{name}")
            if not self._moved(status.getPath(), target):
                for path in moved:
                    self._fs.delete(path, True)
                raise LoadError(table, f"could not move {name} into place; the table is as it was")
            moved.append(target)

    def replace(self, staged: str, table: str) -> None:
        final, old = self._Path(self.path(table)), self._Path(f"{self.root}/_old/{table}-{uuid.uuid4().hex[:12]}")
        held = self._fs.exists(final)
        if held:
            self._fs.mkdirs(old.getParent())
            if not self._fs.rename(final, old):
                raise LoadError(table, "could not move the previous table aside")
        self._fs.mkdirs(final.getParent())
        if not self._moved(self._Path(staged), final):
            if held and not self._fs.rename(old, final):
                raise LoadError(table, f"could not move the staged table into place; the previous one is at {old}")
            raise LoadError(table, "could not move the staged table into place; the previous one is back")
        if held:
            self._fs.delete(old, True)

    def _moved(self, source, target) -> bool:
        try:
            return bool(self._fs.rename(source, target))
        except Exception:
            return False


class CatalogSink:
    """Session-catalog tables; with ``buckets`` the table is bucketed and sorted by its
    key so later key joins and groupings skip the shuffle. Rows are staged in a table of
    their own, which is renamed into place; the previous table is renamed back if that
    fails."""

    def __init__(self, spark: SparkSession, database: str | None = None, buckets: int = 0,
                 manifest: Manifest | None = None):
        self.spark, self.database, self.buckets, self.manifest = spark, database, buckets, manifest

    def name(self, table: str) -> str:
        return ".".join("`" + x.replace("`", "``") + "`" for x in (self.database, table) if x)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def _write(self, df: DataFrame, table: str, name: str, mode: str) -> None:
        w = df.write.mode(mode).format("parquet")
        key = list(self.manifest[table].primary_key) if self.manifest and table in self.manifest else []
        if self.buckets and key:
            w = w.bucketBy(self.buckets, *key).sortBy(*key)
        w.saveAsTable(self.name(name))

    def stage(self, df: DataFrame, table: str) -> str:
        staged = f"{table}__staged_{uuid.uuid4().hex[:12]}"
        try:
            self._write(df, table, staged, "errorifexists")
        except Exception:
            self.discard(staged)
            raise
        return staged

    def staged(self, staged: str) -> DataFrame:
        return self.read(staged)

    def discard(self, staged: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(staged)}")

    def append(self, staged: str, table: str) -> None:
        self._write(self.staged(staged), table, table, "append")

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(old)} RENAME TO {self.name(new)}")

    def replace(self, staged: str, table: str) -> None:
        old = f"{table}__old_{uuid.uuid4().hex[:12]}" if self.exists(table) else None
        if old:
            self._rename(table, old)
        try:
            self._rename(staged, table)
        except Exception:
            if old:
                self._rename(old, table)
            raise
        if old:
            self.discard(old)


@dataclass
class LoadResult:
    report: DataFrame
    counts: dict
    skipped: tuple = ()     # tables that the ledger shows as loaded and unchanged


class RunLedger:
    """What was loaded from which input, by table, under ``path`` (shared by all runs).

    An entry is written after its table is published, so a run after a failure loads the
    tables that failed or were not reached, and those whose input, rules or target
    changed. An input is known by its files' paths, sizes and times of change, the plan
    over them and the target's spec; one that reads no files is always loaded again."""

    SCHEMA = "table_name string, input string, mode string, n_rows bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def input_of(self, df: DataFrame, spec: TableSpec) -> str | None:
        files = sorted(df.inputFiles())
        if not files:
            return None
        stamps = [x for f in files for x in data_files(self.spark, unquote(f))]
        if len(stamps) != len(files):
            return None
        plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
        return hashlib.sha256(repr((stamps, plan, spec)).encode()).hexdigest()

    def entry(self, table: str):
        if not data_files(self.spark, f"{self.path}/{table}"):
            return None
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{table}").first()

    def loaded(self, table: str, df: DataFrame, spec: TableSpec, sink, mode: str) -> int | None:
        """The table's rows if this input was loaded and the target still holds as many."""
        old = self.entry(table)
        if old is None or old["mode"] != mode or old["input"] != self.input_of(df, spec) or not sink.exists(table):
            return None
        held = sink.read(table).count()
        return old["n_rows"] if held == old["n_rows"] or mode == "append" and held >= old["n_rows"] else None

    def record(self, table: str, key: str | None, mode: str, n: int) -> None:
        if key is not None:
            self.spark.createDataFrame([(table, key, mode, n)], self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{table}")


def load_table(spec: TableSpec, df: DataFrame, sink, mode: str, enforce: bool = True) -> int:
    """Project, conform, stage, check, publish; returns the row count of what was staged.

    The row rules are counted while the rows are written, the key rules on the staged
    key columns alone. A table that breaks a rule is refused as a whole: its staged rows
    go and the target stays as it was."""
    name = spec.name
    try:
        out = conform(project(df, spec), spec)
        if mode == "append" and spec.primary_key and sink.exists(name):
            if not append_conflicts(out, sink.read(name), spec.primary_key).isEmpty():
                raise LoadError(name, "incoming keys already exist in the target")
        rules = row_rules(spec) if enforce else []
        seen = Observation(f"load_{uuid.uuid4().hex[:12]}")
        counts = [F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(rules)]
        staged = sink.stage(out.observe(seen, *counts) if rules else out, name)
        try:
            broken = [(rule, c, seen.get[f"v{i}"]) for i, (rule, c, _) in enumerate(rules) if seen.get[f"v{i}"]]
            rows = sink.staged(staged)
            broken += key_rules(rows, spec) if enforce else []
            if enforce and mode == "append" and spec.unique and sink.exists(name):
                broken += unique_conflicts(rows, sink.read(name), spec)
            if broken:
                told = ", ".join(f"{rule} of {c} ({n})" for rule, c, n in broken)
                raise LoadError(name, f"rows break {told}", broken)
            n = rows.count()
            if mode == "overwrite":
                sink.replace(staged, name)
            else:
                sink.append(staged, name)
            return int(n)
        finally:
            sink.discard(staged)
    except LoadError:
        raise
    except Exception as exc:
        raise LoadError(name, str(exc).strip() or repr(exc)) from exc


def load(spark: SparkSession, source: TableSet, manifest: Manifest, sink, tables=None,
         mode: str = "overwrite", parallelism: int = 8, enforce: bool = True, ledger: RunLedger | None = None) -> LoadResult:
    """Load the selected tables (target = manifest) from ``source`` into ``sink``.

    ``mode`` "overwrite" replaces each table; "append" adds rows and first refuses a
    table whose incoming keys, or values under a UNIQUE rule, the target already holds. Rows that break the target's
    NOT NULL, length, primary-key or UNIQUE rules refuse their table (``enforce=False``
    leaves that to the audits); foreign keys are never enforced, as parents may load later.
    Up to ``parallelism`` tables load at once as independent Spark jobs that share the
    executors. After a failure no further table is started; the first ``LoadError`` is
    raised with those of tables already under way in ``others``, and tables already
    loaded stay. With a ``ledger`` the next run skips them while their input is unchanged."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    selected, missing = select_tables(manifest.keys(), tables)
    for name in selected:
        if name not in source:
            raise LoadError(name, "table not found in the source")
    counts: dict[str, int] = {}
    failures: list[LoadError] = []
    waiting, running, skipped = list(selected), {}, []
    keys = {n: ledger.input_of(source[n], manifest[n]) for n in selected} if ledger else {}
    for name in selected if ledger else ():
        n = ledger.loaded(name, source[name], manifest[name], sink, mode)
        if n is not None:
            counts[name] = n
            waiting.remove(name)
            skipped.append(name)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        while running or (waiting and not failures):
            while waiting and not failures and len(running) < max(1, parallelism):
                name = waiting.pop(0)
                running[pool.submit(load_table, manifest[name], source[name], sink, mode, enforce)] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if isinstance(error := future.exception(), LoadError):
                    failures.append(error)
                elif error is not None:
                    raise error
                else:
                    counts[name] = future.result()
                    if ledger:
                        ledger.record(name, keys[name], mode, counts[name])
    if failures:
        failures[0].others = failures[1:]
        raise failures[0]
    return LoadResult(load_report(spark, counts, missing), counts, tuple(skipped))


def load_report(spark: SparkSession, counts: dict, missing=()) -> DataFrame:
    """Rows per loaded table, a TOTAL row (rollup), and NOT_FOUND rows."""
    loaded = spark.createDataFrame(sorted(counts.items()), "table_name string, n_rows bigint")
    rolled = (loaded.rollup("table_name").agg(F.sum("n_rows").cast("bigint").alias("n_rows"),
                                              F.grouping_id().alias("_g"))
              .select(F.when(F.col("_g") == 1, F.lit("(total)")).otherwise(F.col("table_name"))
                      .alias("table_name"), "n_rows",
                      F.when(F.col("_g") == 1, TOTAL).otherwise(LOADED).alias("status")))
    absent = spark.createDataFrame([(m, None, NOT_FOUND) for m in missing], REPORT_SCHEMA)
    return rolled.unionByName(absent)


def identity_high_water(spark: SparkSession, tables: TableSet, manifest: Manifest) -> DataFrame:
    """For every identity column (all tables, not only those loaded):
    max_id = max or 0; counter = greatest(max_id, 1); is_used = max_id > 0;
    next_id = max_id + 1, or 1 for an empty table or non-positive keys."""
    parts = []
    for name, col in manifest.identity_columns():
        if name not in tables:
            continue
        m = F.coalesce(F.max(named(col)).cast("bigint"), F.lit(0).cast("bigint"))
        parts.append(tables[name].agg(m.alias("max_id")).select(
            F.lit(name).alias("table_name"), F.lit(col).alias("column_name"), "max_id",
            F.greatest(F.col("max_id"), F.lit(1).cast("bigint")).alias("counter"),
            F.when(F.col("max_id") > 0, F.col("max_id") + 1).otherwise(F.lit(1).cast("bigint"))
            .alias("next_id"),
            (F.col("max_id") > 0).alias("is_used")))
    out = spark.createDataFrame([], "table_name string, column_name string, max_id bigint, "
                                    "counter bigint, next_id bigint, is_used boolean")
    for p in parts:
        out = out.unionByName(p)
    return out
