"""GUID conversion, audits (keys, unique with collation, foreign keys,
not-null, length) and the view shapes, on tiny literal tables."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.exprs import canonical_uuid, guid_from_le_bytes, guid_from_text
from ferry.manifest import ForeignKey, Manifest, TableSpec, UniqueKey
from ferry.operators import audit, views


def test_guid_bytes_le_matches_python(spark):
    raw = [uuid.uuid4().bytes for _ in range(20)] + [bytes(range(16))]
    df = spark.createDataFrame([(bytearray(b),) for b in raw] + [(None,)], "g binary")
    got = [r.u for r in df.select(guid_from_le_bytes("g").alias("u")).collect()]
    assert got == [str(uuid.UUID(bytes_le=b)) for b in raw] + [None]


def test_guid_fixture_value(spark):
    df = spark.range(1).select(F.unhex(F.md5(F.lit("0"))).alias("g"))
    assert df.select(guid_from_le_bytes("g")).first()[0] == "8420cdcf-d595-ef65-66e7-dff9f98764da"


def test_guid_text_forms_and_bad_input(spark):
    u = uuid.uuid4()
    forms = [str(u).upper(), "{" + str(u) + "}", u.hex, "urn:uuid:" + str(u)]
    df = spark.createDataFrame([(f,) for f in forms], "g string")
    assert {r[0] for r in df.select(guid_from_text("g")).collect()} == {str(u)}
    assert df.select(canonical_uuid("g", T.StringType())).count() == 4
    with pytest.raises(Exception):
        spark.createDataFrame([("not-a-uuid",)], "g string").select(guid_from_text("g")).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([(bytearray(b"short"),)], "g binary").select(guid_from_le_bytes("g")).collect()


def test_guid_is_spelled_once(spark):
    """The conversion doesn't repeat its input's reading, however the text is spelled."""
    u = str(uuid.uuid4())
    odd = ["{{" + u + "}}\n", u[:9] + u[9:].replace("-", ""), "uuid:{" + u + "}", u.replace("-", "") + "\r\n", "-" + u[0] + "-" + u[1:]]
    df = spark.createDataFrame([(x,) for x in odd] + [(None,)], "g string")
    assert [r[0] for r in df.select(guid_from_text("g")).collect()] == [u] * 3 + [u, u, None]
    for bad in ("", "{}", u + "\n\n", "x" + u, u[1:], "-{" + u):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "g string").select(guid_from_text("g")).collect()
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (df.select(guid_from_text("g").alias("x")), df.select(guid_from_le_bytes(F.col("g").cast("binary")).alias("x")))]
    assert plans[0].count("urn:|uuid:") == 1 and plans[1].count("hex(") == 1


def test_key_audit_with_hot_duplicate_and_nulls(spark):
    rows = [(1, 1)] * 300 + [(2, 1), (3, None), (3, None), (4, 2), (4, 2)]
    df = spark.createDataFrame(rows, "a int, b int")
    r = audit.key_audit(df, ["a", "b"]).first()
    assert (r.dup_keys, r.null_keys) == (2, 2)


def test_unique_case_insensitive_accent_sensitive(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("email", T.StringType())])
    df = spark.createDataFrame([(1, "É@x"), (2, "é@x"), (3, "a@x"), (4, "á@x"), (5, None), (6, None)], schema)
    m = Manifest([TableSpec("c", schema, unique=(UniqueKey(("email",), "UNICODE_CI"),))])
    got = audit.unique_audit(spark, {"c": df}, m).first()
    assert (got.collation, got.dup_values) == ("UNICODE_CI", 1)
    got = audit.unique_audit(spark, {"c": df}, m, collation=None).first()
    assert got.dup_values == 0


def test_composite_unique_with_collation_and_number(spark):
    df = spark.createDataFrame([(1, "A"), (1, "a"), (2, "a")], "n int, s string")
    assert audit.unique_values(df, ["n", "s"], "UNICODE_CI").first().dup_values == 1
    assert audit.unique_values(df, ["n", "s"]).first().dup_values == 0


def test_fk_audit_ignores_nulls_and_handles_hot_values(spark):
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    child = spark.createDataFrame([(1,)] * 500 + [(9,)] * 200 + [(None,), (3,)], "fk int")
    schema_p = T.StructType([T.StructField("pk", T.IntegerType())])
    schema_c = T.StructType([T.StructField("fk", T.IntegerType())])
    m = Manifest([TableSpec("p", schema_p, primary_key=("pk",)),
                  TableSpec("c", schema_c, foreign_keys=(ForeignKey(("fk",), "p", ("pk",)),))])
    r = audit.fk_audit(spark, {"p": parent, "c": child}, m).first()
    assert (r.child, r.parent, r.orphans) == ("c", "p", 201)
    r = audit.fk_audit(spark, {"c": child}, m).first()    # parent absent
    assert r.orphans == 701


def test_not_null_and_length(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType(), False),
                           T.StructField("s", T.StringType(), False),
                           T.StructField("opt", T.StringType(), True)])
    df = spark.createDataFrame([(1, "ñandú", None), (2, None, "x"), (3, "abcdef", None)],
                               "k int, s string, opt string")
    m = Manifest([TableSpec("t", schema, max_len={"s": 5})])
    nn = {r.column_name: r.violations for r in audit.not_null_audit(spark, {"t": df}, m).collect()}
    assert nn == {"k": 0, "s": 1}
    ln = {r.column_name: r.violations for r in audit.length_audit(spark, {"t": df}, m).collect()}
    assert ln == {"s": 1}     # ñandú is 5 characters, abcdef is 6
    both = {r.column_name: r.violations for r in audit.column_audit(spark, {"t": df}, m).collect()}
    assert both == {"k:not_null": 0, "s:not_null": 1, "s:max_len": 1}


def test_spanish_order(spark):
    df = spark.createDataFrame([(w,) for w in ["nube", "ñandú", "oso", "Ana", "ábaco"]], "w string")
    assert [r.w for r in views.locale_sorted(df, "w", "es").collect()] == \
        ["ábaco", "Ana", "nube", "ñandú", "oso"]


def test_catalog_and_totals_views(spark):
    cat = spark.createDataFrame([(1, "Tools"), (2, "Toys")], "IdCategory int, Name string")
    prod = spark.createDataFrame([(10, 1, "Hammer"), (11, 2, "Ball"), (12, 3, "Orphan")],
                                 "IdProduct int, IdCategory int, Name string")
    v = views.catalog_view(prod, cat, "IdCategory", "IdCategory", ["IdProduct", "Name"],
                           {"Name": "CategoryName"})
    assert sorted(tuple(r) for r in v.collect()) == [(10, "Hammer", "Tools"), (11, "Ball", "Toys")]
    cust = spark.createDataFrame([(1, "A"), (2, "B")], "IdCustomer int, FullName string")
    orders = spark.createDataFrame([(100, 1, 5.5), (101, 1, None), (102, 1, 1.25)],
                                   "IdOrder int, IdCustomer int, Total double")
    t = views.totals_view(cust, orders, "IdCustomer", "IdCustomer", ["IdCustomer", "FullName"],
                          "IdOrder", "Total")
    got = {r.IdCustomer: (r.order_count, str(r.total_spent)) for r in t.collect()}
    assert got == {1: (3, "6.75"), 2: (0, "0.00")}
    views.register_views(spark, {"VProductCatalog": v})
    assert spark.table("VProductCatalog").count() == 2
