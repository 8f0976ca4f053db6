"""Metric reports that are kept up to date file by file.

Counts, exact sums and key bounds merge, so each source file's partial aggregates are
stored once, with the file's size and time of change. A refresh lists the files, reads
those that are new or changed, in one job, and merges the stored rows of the files there are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import EMPTY, _limb_text, _limbs, ansi_enabled, decimal_type, exact_cast, named, strict_cast
from ..plans.validation import LOW, ROWCOUNT, SUM, TablePlan
from ..sources.tables import data_files

SCHEMA = "file string, stamp string, metric string, n bigint, high decimal(38,0), low decimal(38,0), bound bigint"


@dataclass
class Refresh:
    report: DataFrame      # table_name, metric, value
    read: list[str]        # files scanned by this refresh
    kept: int              # files whose stored aggregates served
    gone: int              # stored files that are no longer there, or have changed


class MetricState:
    """Partial metrics per file under ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _stored(self, table: str) -> DataFrame | None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return None
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{table}")

    def refresh(self, plan: TablePlan, folder: str) -> Refresh:
        """The report of the table in ``folder``, equal to ``metrics_report`` over all of it.

        A file is known by its path, size, time of change and the plan. Rows of files that
        went or changed stay in the state and are passed over. The new rows are appended
        in one commit, so a failed refresh leaves the state as it was and is repeated."""
        salt = hashlib.sha256(repr(plan).encode()).hexdigest()[:12]
        files = {f: f"{size}:{time}:{salt}" for f, size, time in data_files(self.spark, folder)}
        listing = self.spark.createDataFrame(sorted(files.items()), "file string, stamp string")
        stored = self._stored(plan.table)
        known = {}
        if stored is not None:
            known = {(r.file, r.stamp) for r in stored.where(F.col("metric") == ROWCOUNT).select("file", "stamp").distinct().collect()}
        fresh = sorted(f for f, stamp in files.items() if (f, stamp) not in known)
        if fresh:
            self._partials(plan, fresh).join(listing, "file").select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.mode("append").parquet(f"{self.path}/{plan.table}")
            stored = self._stored(plan.table)
        rows = stored.join(listing, ["file", "stamp"], "left_semi") if stored is not None else self.spark.createDataFrame([], SCHEMA)
        current = {x for x in known if files.get(x[0]) == x[1]}
        return Refresh(self._merged(plan, rows), fresh, len(current), len(known) - len(current))

    def _partials(self, plan: TablePlan, files: list[str]) -> DataFrame:
        """A row per file and metric."""
        df = self.spark.read.parquet(*map(unquote, files))
        types = {f.name: f.dataType for f in df.schema.fields}
        ansi = ansi_enabled(df)
        zero = F.lit(0).cast("decimal(38,0)")
        cells = []
        for m in plan.metrics:
            if m.kind == ROWCOUNT:
                parts = (F.count(F.lit(1)), zero, zero, F.lit(None).cast("bigint"))
            elif m.kind == SUM:
                value = (named(m.column).cast(decimal_type(m.scale)) if ansi else strict_cast(named(m.column), decimal_type(m.scale)))
                limbs = _limbs(F.replace(F.substring_index(value.cast("string"), "E", 1), F.lit("."), F.lit("")))
                parts = (F.count(named(m.column)), *[F.coalesce(F.sum(limbs[x]), zero) for x in ("high", "low")], F.lit(None).cast("bigint"))
            else:
                key = exact_cast(named(m.column), types[m.column], T.LongType(), ansi)
                parts = (F.count(named(m.column)), zero, zero, (F.min if m.kind == LOW else F.max)(key))
            cells.append((m.label, parts))
        one = df.groupBy(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("file")).agg(
            *[F.struct(*[p.alias(x) for p, x in zip(parts, ("n", "high", "low", "bound"), strict=True)]).alias(f"m{i}") for i, (_, parts) in enumerate(cells)])
        rows = F.array(*[F.struct(F.lit(label).alias("metric"), F.col(f"m{i}").alias("v")) for i, (label, _) in enumerate(cells)])
        # a file without rows is known too
        none = self.spark.createDataFrame([(f, ROWCOUNT, 0) for f in files], "file string, metric string, n bigint")
        found = one.select("file", F.explode(rows).alias("x")).select("file", "x.metric", "x.v.*")
        return found.unionByName(none.join(one.select("file"), "file", "left_anti"), allowMissingColumns=True)

    def _merged(self, plan: TablePlan, rows: DataFrame) -> DataFrame:
        kinds = self.spark.createDataFrame([(m.label, m.kind, m.scale) for m in plan.metrics], "metric string, kind string, scale int")
        zero = F.lit(0).cast("decimal(38,0)")
        one = kinds.join(rows, "metric", "left").groupBy("metric", "kind", "scale").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("high"), zero).alias("high"), F.coalesce(F.sum("low"), zero).alias("low"),
            F.min("bound").alias("least"), F.max("bound").alias("most"))
        bound = F.coalesce(F.when(F.col("kind") == LOW, F.col("least")).otherwise(F.col("most")).cast("string"), F.lit(EMPTY))
        value = F.when(F.col("kind") == ROWCOUNT, F.col("n").cast("string")).when(
            F.col("kind") == SUM, _limb_text(F.col("high"), F.col("low"), F.col("scale"))).otherwise(bound)
        return one.select(F.lit(plan.table).alias("table_name"), "metric", value.alias("value"))
