"""A key or value holding a third of all rows: every operator completes
with exact results and never forms pairs within the hot group."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.manifest import ForeignKey, Manifest, TableSpec
from ferry.operators import audit, views
from ferry.operators.parity import table_parity

N = 300_000


def _hot(spark, hot_value=0):
    """id 0..N-1; ``k`` equals ``hot_value`` on every third row, else id."""
    return spark.range(N).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(hot_value)).otherwise(F.col("id")).alias("k"),
        F.concat(F.lit("text-"), F.col("id").cast("string")).alias("txt"))


def test_parity_with_hot_duplicated_key_is_skipped(spark):
    df = _hot(spark)
    rows = table_parity(spark, "t", df, df, ["k"], ["txt"]).collect()
    assert [(r.status, r.reason) for r in rows] == [("SKIPPED", "duplicate key")]


def test_fk_audit_with_hot_orphan_value(spark):
    child = _hot(spark, hot_value=-1).select(F.col("k").alias("fk"))
    parent = spark.range(N).select(F.col("id").alias("pk"))
    m = Manifest([TableSpec("p", T.StructType([T.StructField("pk", T.LongType())]), primary_key=("pk",)),
                  TableSpec("c", T.StructType([T.StructField("fk", T.LongType())]),
                            foreign_keys=(ForeignKey(("fk",), "p", ("pk",)),))])
    r = audit.fk_audit(spark, {"p": parent, "c": child}, m).first()
    assert r.orphans == N // 3


def test_key_audit_with_hot_key(spark):
    r = audit.key_audit(_hot(spark), ["k"]).first()
    assert (r.dup_keys, r.null_keys) == (1, 0)


def test_totals_view_with_hot_customer(spark):
    orders = _hot(spark).select(F.col("id").alias("oid"), F.col("k").alias("cust"),
                                F.lit(1.5).alias("amount"))
    cust = spark.range(5).select(F.col("id").alias("cid"))
    got = {r.cid: (r.order_count, str(r.total_spent)) for r in
           views.totals_view(cust, orders, "cid", "cust", ["cid"], "oid", "amount").collect()}
    assert got[0] == (N // 3, f"{1.5 * (N // 3):.2f}")
    assert got[1] == (1, "1.50") and got[3] == (0, "0.00")
