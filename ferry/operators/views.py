"""View shapes: a catalogue (child joined to its parent) and per-parent
totals (left join + group), locale-aware ordering, and view registration.
Views hold no data and never enter a ``TableSet``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import ansi_enabled, decimal_type, strict_cast
from .ranking import places


def catalog_view(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                 child_columns: list[str], parent_columns: dict[str, str]) -> DataFrame:
    """Inner equi-join child -> parent with a renamed projection.

    No broadcast hint: the parent is a dimension whose size Spark checks
    (static statistics, then AQE at run time) before broadcasting it."""
    p = parent.select(F.col(parent_key).alias("_pk"),
                      *[F.col(c).alias(a) for c, a in parent_columns.items()])
    return (child.join(p, child[child_key] == p["_pk"], "inner")
            .select(*child_columns, *parent_columns.values()))


def totals_view(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                parent_columns: list[str], count_column: str, sum_column: str,
                count_alias: str = "order_count", sum_alias: str = "total_spent",
                sum_scale: int = 2) -> DataFrame:
    """Per parent row: number of children (count of the child's non-null
    ``count_column``) and the null-safe sum of ``sum_column``.

    Children are aggregated per key BEFORE the left join, so a parent with a
    third of all children costs one row per map task; the result equals
    grouping after the join because ``parent_key`` is the parent's key."""
    t = decimal_type(sum_scale)
    value = F.col(sum_column).cast(t) if ansi_enabled(child) else strict_cast(sum_column, t)
    per_key = child.groupBy(F.col(child_key).alias("_ck")).agg(
        F.count(count_column).alias("_cnt"), F.sum(value).alias("_sum"))
    j = parent.join(per_key, parent[parent_key] == per_key["_ck"], "left")
    return j.select(*parent_columns,
                    F.coalesce("_cnt", F.lit(0)).cast("bigint").alias(count_alias),
                    F.coalesce("_sum", F.lit(0).cast(t)).alias(sum_alias))


def locale_sorted(df: DataFrame, column: str, locale: str = "es") -> DataFrame:
    """Rows ordered by ``column`` under a locale collation (Spanish by
    default: accents are secondary, ñ sorts after n). Rows are never merged
    or changed; only the order uses the collation, with the raw value as
    the tie-break. The sort is Spark's range-partitioned global sort."""
    return df.orderBy(*locale_order(column, locale))


def locale_rank(df: DataFrame, column: str, group: Column, locale: str = "es") -> DataFrame:
    """``df`` with ``group_key`` and the row's ``place`` in its group under the locale's
    order. Places come from one range partitioning of all rows (``places``), so a group
    that holds most of them spreads over many tasks."""
    rows = places(df.withColumn("group_key", group), locale_order(column, locale), ["group_key"])
    return rows.withColumn("place", F.col("place") + 1).drop("overall", "group_size")


def locale_places(df: DataFrame, column: str, locale: str = "es") -> DataFrame:
    """``df`` with the row's ``place``, from 1, in the locale's order of all rows."""
    rows = places(df, locale_order(column, locale))
    return rows.withColumn("place", F.col("place") + 1).drop("overall", "group_size")


def locale_order(column: str, locale: str) -> list[Column]:
    return [F.collate(F.col(column), locale), F.col(column)]


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Register view DataFrames as temp views after their tables exist."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
