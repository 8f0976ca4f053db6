"""Incremental load: the bounded-batch copy as a Structured Streaming job.

New Parquet files under a source folder are read in micro-batches bounded by bytes (or
by files), projected and conformed to the target spec exactly like the batch ``load``,
and appended to a Parquet file sink. The sink's commit log and the checkpoint make each
file land exactly once, also across restarts and lost executors. Casts, NOT NULL and
length rules are enforced per row: a row that breaks one fails the query. Keys are not:
a repeat may be batches away, so audit the sink (``pk_audit``) after the copy, or use
``start_keyed_stream_load``, which refuses rows whose key the sink holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import named
from ..manifest import TableSpec
from ..operators.load import conform, enforced, project
from ..session import shared_dir
from ..sources.tables import data_files


def start_stream_load(spark: SparkSession, source_dir: str, spec: TableSpec, sink_dir: str,
                      checkpoint_dir: str, source_schema=None, max_bytes_per_trigger: int = 16 << 30,
                      max_files_per_trigger: int | None = None, available_now: bool = False,
                      interval: str = "10 seconds") -> StreamingQuery:
    """Start the copy of ``source_dir`` into ``sink_dir`` for table ``spec``.

    ``source_schema`` is the source files' schema (default: the target's). A batch holds
    at most ``max_bytes_per_trigger`` of files (one file at least), or
    ``max_files_per_trigger`` files if that is given instead. With ``available_now`` the
    query processes what exists and stops, else it looks every ``interval``."""
    bound = (("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else
             ("maxBytesPerTrigger", max_bytes_per_trigger))
    stream = spark.readStream.schema(source_schema or spec.schema).option(*bound).parquet(source_dir)
    out = enforced(conform(project(stream, spec), spec), spec)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir).option("path", sink_dir)
              .queryName(f"load_{spec.name}"))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


#: Why the keyed load refuses a row.
EARLIER, SAME, NULL = "earlier batch", "same batch", "null key"
BATCH = "batch_id"


def start_keyed_stream_load(spark: SparkSession, source_dir: str, spec: TableSpec, sink_dir: str, refused_dir: str,
                            checkpoint_dir: str, source_schema=None, max_bytes_per_trigger: int = 16 << 30,
                            max_files_per_trigger: int | None = None, available_now: bool = False,
                            interval: str = "10 seconds") -> StreamingQuery:
    """``start_stream_load`` that holds the primary key over all batches.

    A micro-batch writes its accepted rows to ``sink_dir/batch_id=n`` and its refused ones
    (key as text, reason, rows) to ``refused_dir/batch_id=n``, each in one commit that
    replaces what an earlier attempt at the same batch left there. A restart repeats the
    batch that was under way with the same files, so every row is accepted or refused once.

    Refused are rows whose key an earlier batch holds, all rows of a key within a batch but
    the least one (by all columns), and rows with a null in the key. The batch's keys, each
    once, meet the sink's key columns in a semi join; only files of earlier batches are read."""
    if not spec.primary_key:
        raise ValueError(f"table {spec.name} has no primary key")
    key = list(spec.primary_key)
    bound = (("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else
             ("maxBytesPerTrigger", max_bytes_per_trigger))
    stream = spark.readStream.schema(source_schema or spec.schema).option(*bound).parquet(source_dir)
    out = enforced(conform(project(stream, spec), spec), spec)

    def write(batch: DataFrame, n: int) -> None:
        session = batch.sparkSession
        keys = [f"_k{i}" for i in range(len(key))]
        rows = batch.select(*[named(c).alias(k) for c, k in zip(key, keys, strict=True)], F.struct(*[named(c) for c in spec.columns]).alias("_row"))
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        each = rows.groupBy(*keys).agg(F.min("_row").alias("_row"), F.count("*").alias("_n")).withColumn("_null", ~known)
        held = _earlier(session, sink_dir, spec, n)
        if held is not None:
            seen = held.select(*[named(c).alias(k) for c, k in zip(key, keys, strict=True)], F.lit(True).alias("_held"))
            each = each.join(seen, keys, "left")
        else:
            each = each.withColumn("_held", F.lit(None).cast("boolean"))
        each = each.checkpoint()
        free = ~F.col("_null") & F.col("_held").isNull()
        each.where(free).select("_row.*").write.mode("overwrite").parquet(f"{sink_dir}/{BATCH}={n}")
        reason = F.when(F.col("_null"), NULL).when(F.col("_held"), EARLIER).otherwise(SAME)
        shown = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
        each.where(~free | (F.col("_n") > 1)).select(shown.alias("key"), reason.alias("reason"), (F.col("_n") - free.cast("int")).alias("n_rows")).write.mode(
            "overwrite").parquet(f"{refused_dir}/{BATCH}={n}")

    shared_dir(spark)
    writer = out.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir).queryName(f"keyed_load_{spec.name}")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def _earlier(spark: SparkSession, sink_dir: str, spec: TableSpec, n: int) -> DataFrame | None:
    """The rows that batches before ``n`` wrote; None before the first."""
    paths = sorted({f.rsplit("/", 1)[0] for f, _, _ in data_files(spark, sink_dir)})
    paths = [p for p in paths if int(p.rsplit(f"{BATCH}=", 1)[1]) < n]
    return spark.read.schema(spec.schema).parquet(*paths) if paths else None


def rows_loaded(spark: SparkSession, sink_dir: str) -> int:
    """Rows that the sink's committed files hold, counted from their metadata."""
    return spark.read.parquet(sink_dir).count()
