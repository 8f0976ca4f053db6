"""Comparison of two metric reports: table-set difference, detail rows,
mismatches with reasons, per-table summary and the verdict.

Reports are small (one row per planned metric), so these joins are cheap;
they stay DataFrames so every result can be queried, written or joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import ABSENT, EMPTY, abs_difference_text
from ..plans.validation import HIGH, LOW, ROWCOUNT, SUM
from .metrics import ERROR_METRIC

# Fixed status names.
OK, DIFF, MISSING = "OK", "DIFF", "MISSING"
SOURCE_ERROR, TARGET_ERROR = "SOURCE_ERROR", "TARGET_ERROR"
SKIPPED = "SKIPPED"


def table_set_diff(spark: SparkSession, source_names, target_names) -> DataFrame:
    """(table_name, side) with side in both / source_only / target_only.

    Set algebra on the two catalogues' table names, which the driver holds
    already (metadata, one row per table)."""
    s, t = set(source_names), set(target_names)
    rows = [(n, "both" if n in s and n in t else "source_only" if n in s else "target_only")
            for n in sorted(s | t)]
    return spark.createDataFrame(rows, "table_name string, side string")


def joined(plan_metrics: DataFrame, src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Every planned metric (kind, column, scale) beside both sides' values and each
    side's table error, if any; and one row of metric ERROR for each failed table. One
    grouping of the plan and both reports, whose size is bounded by the plan."""
    none = F.lit(None).cast("string")
    rows = plan_metrics.select("*", none.alias("_sv"), none.alias("_tv"), F.lit(True).alias("_planned"))
    for report, value, other in ((src, "_sv", "_tv"), (tgt, "_tv", "_sv")):
        rows = rows.unionByName(report.select("table_name", "metric", F.col("value").alias(value), none.alias(other)), allowMissingColumns=True)
    one = rows.groupBy("table_name", "metric").agg(*[F.max(c).alias(c) for c in ("kind", "column_name", "scale", "_planned", "_sv", "_tv")])
    table = Window.partitionBy("table_name")
    failed = F.col("metric") == ERROR_METRIC
    one = one.withColumns({e: F.max(F.when(failed, F.col(v))).over(table) for e, v in (("_se", "_sv"), ("_te", "_tv"))})
    return one.where(F.col("_planned") | failed)


def _status():
    return (F.when(F.col("_se").isNotNull(), SOURCE_ERROR)
            .when(F.col("_te").isNotNull(), TARGET_ERROR)
            .when(F.col("_sv").isNull() | F.col("_tv").isNull(), MISSING)
            .when(F.col("_sv") == F.col("_tv"), OK)
            .otherwise(DIFF))


def detail(j: DataFrame) -> DataFrame:
    """Every planned metric with its status; precedence SOURCE_ERROR,
    TARGET_ERROR, MISSING, OK, DIFF. Absent values show as ``-``."""
    return j.where("_planned").select(
        "table_name", "metric", F.coalesce("_sv", F.lit(ABSENT)).alias("source_value"),
        F.coalesce("_tv", F.lit(ABSENT)).alias("target_value"), _status().alias("status"))


def mismatches(j: DataFrame, common: list[str]) -> DataFrame:
    """Metrics that differ between the sides of common tables, with a reason, ordered by
    table and metric. A table that failed on a side contributes one error row only."""
    in_common = F.col("table_name").isin(list(common)) if common else F.lit(False)
    numeric = (F.col("_sv") != EMPTY) & (F.col("_tv") != EMPTY)
    se, te = F.col("_se").isNotNull(), F.col("_te").isNotNull()
    difference = F.coalesce(abs_difference_text(F.col("_sv"), F.col("_tv")), F.lit("more than 56 digits"))
    reason = (F.when(se & te, "source and target error").when(se, "source error").when(te, "target error")
              .when(F.col("_sv").isNull(), "missing in source")
              .when(F.col("_tv").isNull(), "missing in target")
              .when(numeric, F.concat(F.lit("diff="), difference))
              .otherwise("text differs"))
    is_error = F.col("metric") == ERROR_METRIC
    differing = is_error | (~(se | te) & ~F.col("_sv").eqNullSafe(F.col("_tv")))
    return (j.where(in_common & differing)
            .select("table_name", "metric", F.coalesce("_sv", F.lit(ABSENT)).alias("source_value"),
                    F.coalesce("_tv", F.lit(ABSENT)).alias("target_value"), reason.alias("reason"))
            .orderBy("table_name", "metric"))


def parity_status(parity: DataFrame) -> DataFrame:
    """Per table: DIFF if any text column differs or failed, SKIPPED if
    pairing was skipped, else OK."""
    return parity.groupBy("table_name").agg(
        F.when(F.max(F.col("status").isin(DIFF, "ERROR").cast("int")) == 1, DIFF)
        .when(F.max((F.col("status") == SKIPPED).cast("int")) == 1, SKIPPED)
        .otherwise(OK).alias("parity_status"))


def table_summary(j: DataFrame, source_names, parity: DataFrame | None = None) -> DataFrame:
    """One row per target table: row counts, sums matched/total, key ranges,
    status, in one grouping of the planned metrics.

    ``key_range`` is the target's range of every integer key column as
    ``col=min..max`` joined by ", " in column-name order; null when the
    table has no such key or the target is empty. ``parity_status`` is OFF
    when text parity did not run, NONE for a table it has nothing to pair in. A
    SKIPPED parity never fails a table."""
    rows = j.where("_planned").withColumn("status", _status())
    shown = F.coalesce("_tv", F.lit(ABSENT))
    bounds = rows.where(F.col("kind").isin(LOW, HIGH)).groupBy("table_name", "column_name").agg(
        F.max(F.when(F.col("kind") == LOW, shown)).alias("lo"), F.max(F.when(F.col("kind") == HIGH, shown)).alias("hi"))
    bounds = bounds.where(~F.col("lo").isin(EMPTY, ABSENT)).groupBy("table_name").agg(F.array_sort(F.collect_list(
        F.struct("column_name", F.concat("column_name", F.lit("="), "lo", F.lit(".."), "hi").alias("range")))).alias("r"))
    is_sum = F.col("kind") == SUM
    g = rows.groupBy("table_name").agg(
        F.max(F.when(F.col("kind") == ROWCOUNT, F.coalesce("_sv", F.lit(ABSENT)))).alias("source_rows"),
        F.max(F.when(F.col("kind") == ROWCOUNT, shown)).alias("target_rows"),
        F.count_if(is_sum & (F.col("status") == OK)).alias("sums_ok"),
        F.count_if(is_sum).alias("sums_total"),
        F.max((F.col("status") != OK).cast("int")).alias("_bad"),
    ).join(bounds, "table_name", "left").withColumn("key_range", F.array_join("r.range", ", "))
    in_source = F.col("table_name").isin(sorted(source_names)) if source_names else F.lit(False)
    if parity is None:
        g = g.withColumn("parity_status", F.lit("OFF"))
    else:
        g = (g.join(parity_status(parity), "table_name", "left")
             .withColumn("parity_status", F.coalesce("parity_status", F.lit("NONE"))))
    status = (F.when(~in_source, MISSING)
              .when((F.col("_bad") == 1) | (F.col("parity_status") == DIFF), DIFF)
              .otherwise(OK))
    return g.select("table_name", "source_rows", "target_rows", "sums_ok", "sums_total",
                    "key_range", "parity_status", status.alias("status"))


def verdict(summary: DataFrame, names: DataFrame, mismatch_rows: DataFrame,
            common: list[str]) -> DataFrame:
    """One row: common, ok, bad, one-sided counts, mismatches and ``passed``.

    Built as one aggregate over a union of small fact rows (no join);
    ``common`` names the tables both sides have."""
    in_common = F.col("table_name").isin(list(common)) if common else F.lit(False)
    facts = (summary.where(in_common).select(F.lit("table").alias("kind"), F.col("status"))
             .unionByName(names.select(F.col("side").alias("kind"), F.lit(None).cast("string").alias("status")))
             .unionByName(mismatch_rows.select(F.lit("mismatch").alias("kind"),
                                               F.lit(None).cast("string").alias("status"))))
    kind = F.col("kind")
    out = facts.agg(
        F.count_if(kind == "table").alias("common"),
        F.count_if((kind == "table") & (F.col("status") == OK)).alias("ok"),
        F.count_if((kind == "table") & (F.col("status") != OK)).alias("bad"),
        F.count_if(kind == "source_only").alias("only_source"),
        F.count_if(kind == "target_only").alias("only_target"),
        F.count_if(kind == "mismatch").alias("mismatches"),
    )
    passed = ((F.col("bad") == 0) & (F.col("mismatches") == 0)
              & (F.col("only_source") == 0) & (F.col("only_target") == 0))
    return out.select("*", passed.alias("passed"))
