"""Plan shape: the properties that matter at scale, read from explain()."""

import contextlib
import io

import pytest

from ferry.operators import audit, views
from ferry.operators.metrics import table_metrics
from ferry.operators.parity import table_parity
from ferry.plans.validation import build_plan


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_metrics_read_only_planned_columns(spark, sf001):
    s, t, m = sf001
    tp = [x for x in build_plan(t, m) if x.table == "documents"][0]
    p = plan_text(table_metrics(s["documents"], tp))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in p      # the text is never read
    assert "partial_sum" in p and p.count("Exchange") == 1                # one single-row exchange


def test_parity_is_one_shuffle_without_join(spark, sf001, no_broadcast):
    s, t, m = sf001
    p = plan_text(table_parity(spark, "documents", s["documents"], t["documents"], ["doc_id"],
                               ["text", "lang", "source"]))
    assert "Join" not in p
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_max" in p                                             # map-side combine
    assert "sha2" in p                                                    # long text shuffles as a digest


def test_fk_audit_aggregates_before_the_join(spark, sf001, no_broadcast):
    s, t, m = sf001
    p = plan_text(audit.orphan_count(t["lineitem"], ["l_orderkey"], t["orders"], ["o_orderkey"]))
    assert "LeftAnti" not in p and "LeftOuter" in p
    assert p.count("Exchange hashpartitioning") == 2                      # the join reuses both
    join_at = p.index("SortMergeJoin")
    assert p.index("partial_count(1)") > join_at                          # below the join: pre-aggregated


def test_totals_view_aggregates_orders_before_the_join(spark, sf001, no_broadcast):
    s, t, m = sf001
    p = plan_text(views.totals_view(s["customer"], t["orders"], "c_custkey", "o_custkey",
                                    ["c_custkey", "c_name"], "o_orderkey", "o_totalprice"))
    assert p.index("partial_count(o_orderkey") > p.index("SortMergeJoin")


def test_key_audit_combines_map_side(spark, sf001):
    s, t, m = sf001
    p = plan_text(audit.key_audit(t["orders"], ["o_orderkey"]))
    assert "partial_count(1)" in p and "ReadSchema: struct<o_orderkey:bigint>" in p


def test_load_path_has_no_shuffle(spark, sf001):
    from ferry.operators import load as L
    s, t, m = sf001
    raw = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    p = plan_text(L.conform(L.project(raw, m["lineitem"]), m["lineitem"]))
    assert "Exchange" not in p and "FileScan parquet" in p
