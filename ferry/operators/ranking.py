"""Places of rows in a sorted order without a window over a small key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

#: Offsets are broadcast up to so many rows; more are joined by shuffle.
BROADCAST_ROWS = 100_000


def places(df: DataFrame, order: list[Column], group: list[str] = ()) -> DataFrame:
    """``df`` with ``overall`` and ``place``, both from 0: a row's place in the order of all
    rows, by ``group`` columns first and ``order`` then, and its place in its group; and
    ``group_size``. Nulls come first. Rows equal in the whole order take neighbouring
    places.

    The rows are range partitioned and sorted, so a group that holds most rows spreads over
    many tasks. They are written once, since a place is the row's number in its partition
    plus the rows of the partitions before, counted from what was written. Columns of the
    added names raise.
    """
    if clash := {"overall", "place", "group_size", "__seq", "__part"} & set(df.columns):
        raise ValueError(f"columns already exist: {sorted(clash)}")
    shared_dir(df.sparkSession)
    keys = [*[F.col(f"`{c}`") for c in group], *order]
    rows = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
            .withColumn("__seq", F.monotonically_increasing_id()).checkpoint())
    rows = rows.withColumn("__part", F.shiftright("__seq", 33))
    held = rows.groupBy("__part", *[F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(group)]).agg(
        F.count("*").alias("__n"), F.min("__seq").alias("__first"))
    own = [f"__g{i}" for i in range(len(group))]
    # at most one row per partition and group that begins or ends there
    before = Window.orderBy("__part", "__first").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    whole = Window.partitionBy(*own) if own else Window.partitionBy()
    held = held.withColumn("group_size", F.sum("__n").over(whole)).withColumn("__start", F.min("__before").over(whole)).checkpoint()
    few = held.count() <= BROADCAST_ROWS
    held = held.withColumnRenamed("__part", "__p")
    on = rows["__part"] == held["__p"]
    for i, c in enumerate(group):
        on = on & rows[f"`{c}`"].eqNullSafe(held[f"__g{i}"])
    joined = rows.join(F.broadcast(held) if few else held, on)
    overall = F.col("__before") + F.col("__seq") - F.col("__first")
    return joined.select(*[rows[f"`{c}`"] for c in df.columns], overall.alias("overall"),
                         (overall - F.col("__start")).alias("place"), "group_size")
