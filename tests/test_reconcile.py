"""Reconcile: seeded defects must flip exactly the expected metrics, errors
stay isolated per table, and reconcile(X, X) always passes."""

from decimal import Decimal, localcontext

from pyspark.sql import types as T

from ferry.manifest import Manifest, TableSpec
from ferry.operators.reconcile import reconcile

# FIXTURES.md: expected metric differences at sf0.01.
EXPECTED_DIFFS = {
    ("customer", "rowcount"): ("1500", "1470"),
    ("customer", "sum:c_acctbal"): ("6743588.96", "6609080.41"),
    ("customer", "sum:c_custkey"): ("1124250", "1102380"),
    ("customer", "sum:c_nationkey"): ("18186", "17823"),
    ("documents", "rowcount"): ("1000", "988"),
    ("documents", "sum:doc_id"): ("499500", "493566"),
    ("documents", "sum:n_chars"): ("2409870", "2392818"),
    ("lineitem", "sum:l_quantity"): ("1524135.00", "1524245.00"),
    ("orders", "rowcount"): ("15000", "14845"),
    ("orders", "sum:o_custkey"): ("11259112", "11143030"),
    ("orders", "sum:o_orderkey"): ("112492500", "111332790"),
    ("orders", "sum:o_totalprice"): ("3758439620.06", "3721958748.96"),
    ("region", "pkmax:r_regionkey"): ("4", "(empty)"),
    ("region", "pkmin:r_regionkey"): ("0", "(empty)"),
    ("region", "rowcount"): ("5", "0"),
    ("region", "sum:r_regionkey"): ("10", "0"),
}

EXPECTED_PARITY = {
    ("region", "r_name"): (0, 5, 0, 0),
    ("customer", "c_name"): (1470, 30, 0, 1462),
    ("customer", "c_mktsegment"): (1470, 30, 0, 1470),
    ("part", "p_name"): (2000, 0, 0, 1900),
    ("orders", "o_orderstatus"): (14845, 155, 0, 14845),
    ("documents", "text"): (988, 12, 0, 808),
    ("documents", "lang"): (988, 12, 0, 988),
}


def test_seeded_defects_flip_exactly_expected_metrics(spark, sf001):
    s, t, m = sf001
    r = reconcile(spark, s, t, m)
    mis = {(x.table_name, x.metric): (x.source_value, x.target_value)
           for x in r.mismatches.collect()}
    assert mis == EXPECTED_DIFFS
    detail = r.detail.collect()
    common = [x for x in detail if x.table_name != "benchmark"]
    assert len(common) == 66
    assert sum(x.status == "DIFF" for x in common) == 16
    # the approximate l_discount and events.value changes are invisible by design
    assert not any(x.metric in ("sum:l_discount", "sum:value") for x in detail)
    v = r.verdict.first()
    assert (v.common, v.ok, v.bad, v.only_source, v.only_target, v.passed) == (12, 6, 6, 1, 1, False)
    par = {(x.table_name, x.column_name): (x.paired, x.only_source, x.only_target, x.identical)
           for x in r.parity.collect()}
    for k, want in EXPECTED_PARITY.items():
        assert par[k] == want, k
    statuses = {x.table_name: x.status for x in r.parity.collect()}
    assert statuses["lineitem"] == "SKIPPED"
    kr = {x.table_name: x.key_range for x in r.table_summary.collect()}
    assert kr["region"] is None and kr["lineitem"] is None
    assert kr["nation"] == "n_nationkey=0..24"
    assert kr["conversations"].startswith("conv_id=") and ", turn=" in kr["conversations"]
    reasons = {x.reason for x in r.mismatches.collect() if x.table_name == "region"}
    assert "text differs" in reasons and "diff=5" in reasons


def test_metrics_only_verdict(spark, sf001):
    s, t, m = sf001
    v = reconcile(spark, s, t, m, strings=False).verdict.first()
    assert (v.ok, v.bad) == (7, 5)


def test_table_subset(spark, sf001):
    s, t, m = sf001
    r = reconcile(spark, s, t, m, tables=["nation", "part", "labels"])
    v = r.verdict.first()
    assert (v.common, v.ok, v.bad, v.only_source, v.only_target) == (2, 1, 1, 1, 0)
    assert {x.table_name for x in r.detail.collect()} == {"nation", "part"}


def test_identical_passes_and_is_symmetric(spark, sf001):
    s, t, m = sf001
    assert reconcile(spark, s, s, m).passed()
    a = {(x.table_name, x.metric) for x in reconcile(spark, s, t, m, strings=False).mismatches.collect()}
    b = {(x.table_name, x.metric) for x in reconcile(spark, t, s, m, strings=False).mismatches.collect()}
    assert a == b


def _spec(name, schema, pk=()):
    return TableSpec(name=name, schema=schema, primary_key=tuple(pk))


def test_error_isolation_and_overflow(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DecimalType(38, 0))])
    big = Decimal("9" * 37)
    good = spark.createDataFrame([(1, Decimal(1)), (2, Decimal(2))], schema)
    wide = spark.createDataFrame([(i, big) for i in range(20)], schema)    # its sum has 39 digits
    huge = spark.createDataFrame([(i, 1e39) for i in range(20)], "id bigint, amt double")
    other = spark.createDataFrame([(1, Decimal(5))], schema)
    m = Manifest([_spec("a", schema, ["id"]), _spec("b", schema, ["id"]), _spec("c", schema, ["id"]), _spec("d", schema, ["id"])])
    src = {"a": good.drop("amt"), "b": huge, "c": other, "d": wide}   # a: missing column, b: overflow
    tgt = {"a": good, "b": good, "c": other, "d": wide}
    r = reconcile(spark, src, tgt, m)
    by_table = {}
    for x in r.detail.collect():
        by_table.setdefault(x.table_name, set()).add(x.status)
    assert by_table == {"a": {"SOURCE_ERROR"}, "b": {"SOURCE_ERROR"}, "c": {"OK"}, "d": {"OK"}}
    mis = r.mismatches.collect()
    assert sorted((x.table_name, x.metric, x.reason) for x in mis) == [
        ("a", "ERROR", "source error"), ("b", "ERROR", "source error")]
    assert all(x.source_value for x in mis)
    assert not r.passed()


def test_empty_and_one_sided_tables(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("x", T.DecimalType(10, 3))])
    empty = spark.createDataFrame([], schema)
    full = spark.createDataFrame([(3, Decimal("1.250")), (7, Decimal("2.000"))], schema)
    m = Manifest([_spec("t", schema, ["k"]), _spec("u", schema, ["k"])])
    r = reconcile(spark, {"t": full, "extra": full}, {"t": empty, "u": full}, m, strings=False)
    rows = {(x.table_name, x.metric): (x.source_value, x.target_value, x.status)
            for x in r.detail.collect()}
    assert rows[("t", "sum:x")] == ("3.250", "0.000", "DIFF")
    assert rows[("t", "pkmin:k")] == ("3", "(empty)", "DIFF")
    assert rows[("u", "rowcount")] == ("-", "2", "MISSING")
    sides = {x.table_name: x.side for x in r.tables.collect()}
    assert sides == {"t": "both", "extra": "source_only", "u": "target_only"}
    v = r.verdict.first()
    assert (v.common, v.only_source, v.only_target, v.passed) == (1, 1, 1, False)
    diff = {x.metric: x.reason for x in r.mismatches.collect()}
    assert diff["sum:x"] == "diff=3.250" and diff["pkmax:k"] == "text differs"


def test_source_scale_is_rounded_to_target_scale(spark):
    s_schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("x", T.DecimalType(10, 4))])
    t_schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("x", T.DecimalType(10, 2))])
    src = spark.createDataFrame([(1, Decimal("1.0050")), (2, Decimal("2.0049"))], s_schema)
    tgt = spark.createDataFrame([(1, Decimal("1.01")), (2, Decimal("2.00"))], t_schema)
    m = Manifest([_spec("t", t_schema, ["k"])])
    r = reconcile(spark, {"t": src}, {"t": tgt}, m, strings=False)
    assert r.passed()


def test_evidence_csv(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    df = spark.createDataFrame([(1,)], schema)
    r = reconcile(spark, {"t": df}, {"t": df}, Manifest([_spec("t", schema, ["k"])]))
    out = r.write_evidence(str(tmp_path / "evidence"))
    parts = [p for p in (tmp_path / "evidence").iterdir() if p.name.endswith(".csv")]
    assert len(parts) == 1 and out
    lines = parts[0].read_text(encoding="utf-8").splitlines()
    assert lines[0] == "table_name,metric,source_value,target_value,status"
    assert len(lines) == 1 + 4


def test_overflow_and_bad_casts_fail_loud_without_ansi(spark):
    from ferry.operators import load as L
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DecimalType(38, 0))])
    huge = spark.createDataFrame([(i, 1e39) for i in range(20)], "id bigint, amt double")
    m = Manifest([_spec("b", schema, ["id"])])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        r = reconcile(spark, {"b": huge}, {"b": spark.createDataFrame([], schema)}, m, strings=False)
        assert {x.status for x in r.detail.collect()} == {"SOURCE_ERROR"}
        spec = TableSpec("x", T.StructType([T.StructField("v", T.DecimalType(4, 1))]))
        bad = spark.createDataFrame([(123456.0,)], "v double")
        import pytest
        with pytest.raises(Exception):
            L.conform(bad, spec).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_target_error_is_isolated(spark):
    from ferry.operators.metrics import one_table_rows
    from ferry.plans.validation import build_plan
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DecimalType(10, 2))])
    ok = spark.createDataFrame([(1, Decimal("1.00"))], schema)
    m = Manifest([_spec("a", schema, ["id"]), _spec("b", schema, ["id"]), _spec("c", schema, ["id"])])
    broken = ok.select("id", F_raise().alias("amt"))
    r = reconcile(spark, {"a": ok, "b": ok, "c": broken}, {"a": broken, "b": ok, "c": broken}, m,
                  strings=False)
    st = {(x.table_name, x.status) for x in r.detail.collect()}
    assert st == {("a", "TARGET_ERROR"), ("b", "OK"), ("c", "SOURCE_ERROR")}
    assert sorted((x.table_name, x.metric, x.reason) for x in r.mismatches.collect()) == [
        ("a", "ERROR", "target error"), ("c", "ERROR", "source and target error")]
    plan = {tp.table: tp for tp in build_plan({"a": ok, "b": ok}, m)}
    assert [x[1] for x in one_table_rows(broken, plan["a"])] == ["ERROR"]
    assert len(one_table_rows(ok, plan["b"])) == len(plan["b"].metrics)


def F_raise():
    from pyspark.sql import functions as F
    return F.raise_error(F.lit("disk gone")).cast("decimal(10,2)")


def test_exact_differences_and_key_bounds(spark):
    for scale in (0, 6, 10, 18):
        dt = T.DecimalType(38, scale)
        schema = T.StructType([T.StructField("z", dt), T.StructField("a", dt)])
        big = Decimal("12345678901234567890")
        step = Decimal(1).scaleb(-scale)
        with localcontext(prec=60):
            higher = big + step
        s = spark.createDataFrame([(big, step)], schema)
        t = spark.createDataFrame([(higher, -step)], schema)
        r = reconcile(spark, {"x": s}, {"x": t}, Manifest([_spec("x", schema, [])]), strings=False)
        rows = r.mismatches.collect()
        assert [x.metric for x in rows] == ["sum:a", "sum:z"]
        assert [Decimal(x.reason.removeprefix("diff=")) for x in rows] == [2 * step, step]
        assert not r.passed()
    key = T.StructType([T.StructField("id", T.IntegerType())])
    for value, same in ((Decimal("1.4"), False), (Decimal("1.0"), True)):
        source = spark.createDataFrame([(value,)], "id decimal(4,1)")
        target = spark.createDataFrame([(1,)], key)
        r = reconcile(spark, {"x": source}, {"x": target}, Manifest([_spec("x", key, ["id"])]), strings=False)
        status = {x.metric: x.status for x in r.detail.collect()}
        assert (status["pkmin:id"] == status["pkmax:id"] == "OK") == same


def test_names_with_dots_and_colons(spark):
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a:v", "b:v", "c.d")])
    df = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], schema)
    spec = _spec("x", schema, ["a:v", "b:v", "c.d"])
    r = reconcile(spark, {"x": df}, {"x": df}, Manifest([spec]))
    assert r.passed()
    assert r.table_summary.first().key_range == "a:v=1..4, b:v=2..5, c.d=3..6"


def test_unreadable_table_is_one_error_row(spark):
    from ferry.sources.tables import parquet_tables
    key = T.StructType([T.StructField("id", T.IntegerType())])
    ok = spark.createDataFrame([(1,)], key)
    gone = parquet_tables(spark, "/root/testdata/sf0.001", ["nowhere"])["nowhere"]
    m = Manifest([_spec("a", key, ["id"]), _spec("b", key, ["id"])])
    r = reconcile(spark, {"a": ok, "b": gone}, {"a": ok, "b": ok}, m)
    assert [(x.table_name, x.reason) for x in r.mismatches.collect()] == [("b", "source error")]
    assert "nowhere" in r.mismatches.first().source_value
    r = reconcile(spark, {"a": ok, "b": ok}, {"a": ok, "b": gone}, m)
    assert {(x.table_name, x.status) for x in r.detail.collect()} == {("a", "OK"), ("b", "TARGET_ERROR")}
