"""Properties: reconcile(X, X) passes; reconcile(X, Y) and reconcile(Y, X)
report the same mismatch keys; parity is symmetric."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ferry.manifest import Manifest, TableSpec
from ferry.operators.reconcile import reconcile

SCHEMA = T.StructType([T.StructField("id", T.LongType()),
                       T.StructField("amount", T.DecimalType(10, 2)),
                       T.StructField("qty", T.IntegerType()),
                       T.StructField("name", T.StringType())])
MANIFEST = Manifest([TableSpec("t", SCHEMA, primary_key=("id",))])

row = st.tuples(st.decimals(min_value=-10**6, max_value=10**6, places=2, allow_nan=False,
                            allow_infinity=False),
                st.integers(-1000, 1000) | st.none(),
                st.text(max_size=40) | st.none())
table = st.dictionaries(st.integers(0, 50), row, max_size=12)


def _df(spark, rows):
    data = [(k, Decimal(a), q, n) for k, (a, q, n) in sorted(rows.items())]
    return spark.createDataFrame(data, SCHEMA)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(x=table, y=table)
def test_reconcile_properties(spark, x, y):
    dx, dy = _df(spark, x), _df(spark, y)
    assert reconcile(spark, {"t": dx}, {"t": dx}, MANIFEST).passed()
    a = reconcile(spark, {"t": dx}, {"t": dy}, MANIFEST)
    b = reconcile(spark, {"t": dy}, {"t": dx}, MANIFEST)
    assert {(r.table_name, r.metric) for r in a.mismatches.collect()} == \
        {(r.table_name, r.metric) for r in b.mismatches.collect()}
    pa = {r.column_name: (r.paired, r.only_source, r.only_target, r.identical) for r in a.parity.collect()}
    pb = {r.column_name: (r.paired, r.only_target, r.only_source, r.identical) for r in b.parity.collect()}
    assert pa == pb
    same_keys = set(x) == set(y)
    assert pa["name"][0] == len(set(x) & set(y))
    if same_keys and all(x[k][2] == y[k][2] for k in x):
        assert pa["name"] == (len(x), 0, 0, len(x))
