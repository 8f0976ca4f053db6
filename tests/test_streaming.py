"""Incremental (streaming) load: every source file lands once, conformed,
and a restart with the same checkpoint adds nothing twice."""

from pyspark.sql import functions as F

from ferry.fixtures import fixture
from ferry.session import fresh_dir
from ferry.streaming.load import rows_loaded, start_stream_load


def test_stream_load_exactly_once(spark):
    s, t, m = fixture(spark, "/root/testdata/sf0.001")
    raw = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    src_dir, sink_dir, ckpt = (fresh_dir(spark, x) for x in ("st-src", "st-sink", "st-ckpt"))
    raw.repartition(4).write.parquet(src_dir)
    spec = m["orders"]
    q = start_stream_load(spark, src_dir, spec, sink_dir, ckpt, source_schema=raw.schema,
                          max_files_per_trigger=1, available_now=True)
    q.awaitTermination(120)
    assert rows_loaded(spark, sink_dir) == raw.count()
    back = spark.read.parquet(sink_dir)
    assert back.schema["o_totalprice"].dataType.simpleString() == "decimal(12,2)"
    assert back.count() == raw.count()
    assert back.agg(F.sum("o_orderkey")).first()[0] == raw.agg(F.sum("o_orderkey")).first()[0]
    q2 = start_stream_load(spark, src_dir, spec, sink_dir, ckpt, source_schema=raw.schema,
                           available_now=True)
    q2.awaitTermination(120)
    assert spark.read.parquet(sink_dir).count() == raw.count()


def test_many_small_files_are_all_counted(spark):
    from pyspark.sql import types as T

    from ferry.manifest import TableSpec
    src_dir, sink_dir, ckpt = (fresh_dir(spark, x) for x in ("many-src", "many-sink", "many-ckpt"))
    spark.range(130).repartition(130, "id").write.option("maxRecordsPerFile", 1).parquet(src_dir)
    spec = TableSpec("ids", T.StructType([T.StructField("id", T.LongType(), False)]))
    q = start_stream_load(spark, src_dir, spec, sink_dir, ckpt, max_files_per_trigger=13, available_now=True)
    q.awaitTermination(200)
    assert rows_loaded(spark, sink_dir) == 130


def test_stream_refuses_a_null_and_a_long_text(spark):
    import pytest
    from pyspark.sql import types as T

    from ferry.manifest import TableSpec
    spec = TableSpec("x", T.StructType([T.StructField("t", T.StringType(), False)]), max_len={"t": 3})
    for bad in (None, "four"):
        src_dir, sink_dir, ckpt = (fresh_dir(spark, x) for x in ("bad-src", "bad-sink", "bad-ckpt"))
        spark.createDataFrame([("ok",), (bad,)], "t string").write.parquet(src_dir)
        q = start_stream_load(spark, src_dir, spec, sink_dir, ckpt, available_now=True)
        with pytest.raises(Exception, match="breaks"):
            q.awaitTermination(100)
