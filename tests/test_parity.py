"""Text parity: pairing on the full key, nulls, hostile text, uuid keys,
duplicate keys and tables without a key."""

from pyspark.sql import types as T

from ferry.manifest import Manifest, TableSpec
from ferry.operators.parity import one_table_parity, string_parity, table_parity

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("body", T.StringType()),
                       T.StructField("note", T.StringType())])


def _rows(df):
    return {r.column_name: (r.paired, r.only_source, r.only_target, r.identical, r.status)
            for r in df.collect()}


def test_hostile_text_and_nulls(spark):
    long_a = "x" * 5000 + "a"
    long_b = "x" * 5000 + "b"
    src = [("u1", 'a,b "quoted"\nline', '{"k": [1, 2]}'), ("u2", None, "n"), ("u3", long_a, None),
           ("u4", "café", "z"), ("u5", "only source", "s")]
    tgt = [("u1", 'a,b "quoted"\nline', '{"k": [1, 2]}'), ("u2", None, "n"), ("u3", long_b, None),
           ("u4", "cafÃ©", "z"), ("u6", "only target", "t")]
    s = spark.createDataFrame(src, SCHEMA)
    t = spark.createDataFrame(tgt, SCHEMA)
    got = _rows(table_parity(spark, "tok", s, t, ["id"], ["body", "note"]))
    # u1 identical, u2 null = null, u3 differs in its last char, u4 mojibake
    assert got["body"] == (4, 1, 1, 2, "DIFF")
    assert got["note"] == (4, 1, 1, 4, "DIFF")


def test_raw_text_mode_agrees_with_digests(spark):
    long_a, long_b = "y" * 3000 + "1", "y" * 3000 + "2"
    s = spark.createDataFrame([("1", long_a, "a"), ("2", "same", None)], SCHEMA)
    t = spark.createDataFrame([("1", long_b, "a"), ("2", "same", None)], SCHEMA)
    hashed = _rows(table_parity(spark, "t", s, t, ["id"], ["body", "note"]))
    raw = _rows(table_parity(spark, "t", s, t, ["id"], ["body", "note"], digest=False))
    assert hashed == raw == {"body": (2, 0, 0, 1, "DIFF"), "note": (2, 0, 0, 2, "OK")}


def test_null_vs_text_is_not_identical(spark):
    s = spark.createDataFrame([("k", None, "a")], SCHEMA)
    t = spark.createDataFrame([("k", "", "a")], SCHEMA)
    got = _rows(table_parity(spark, "t", s, t, ["id"], ["body", "note"]))
    assert got["body"] == (1, 0, 0, 0, "DIFF")
    assert got["note"] == (1, 0, 0, 1, "OK")


def test_trailing_space_and_case_matter(spark):
    s = spark.createDataFrame([("1", "a ", "X")], SCHEMA)
    t = spark.createDataFrame([("1", "a", "x")], SCHEMA)
    got = _rows(table_parity(spark, "t", s, t, ["id"], ["body", "note"]))
    assert got["body"][3] == 0 and got["note"][3] == 0


def test_duplicate_key_is_skipped_not_failed(spark):
    s = spark.createDataFrame([("1", "a", "b"), ("1", "a", "b"), ("2", "c", "d")], SCHEMA)
    t = spark.createDataFrame([("1", "a", "b"), ("2", "c", "d")], SCHEMA)
    rows = table_parity(spark, "t", s, t, ["id"], ["body"]).collect()
    assert [(r.status, r.reason, r.paired) for r in rows] == [("SKIPPED", "duplicate key", None)]


def test_composite_key_and_no_key(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                           T.StructField("txt", T.StringType())])
    s = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], schema)
    t = spark.createDataFrame([(1, 1, "x"), (1, 2, "Y"), (2, 1, "z")], schema)
    m = Manifest([TableSpec("p", schema, primary_key=("a", "b")), TableSpec("q", schema)])
    got = {(r.table_name, r.column_name): (r.paired, r.identical, r.status, r.reason)
           for r in string_parity(spark, {"p": s, "q": s}, {"p": t, "q": t}, m).collect()}
    assert got[("p", "txt")] == (3, 2, "DIFF", None)
    assert got[("q", "txt")] == (None, None, "SKIPPED", "no primary key")


def test_uuid_logical_column_is_not_text(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("token", T.StringType()),
                           T.StructField("owner", T.StringType())])
    spec = TableSpec("ApiToken", schema, primary_key=("id",), logical={"owner": "uuid"})
    assert spec.text_columns() == ["token"]
    s = spark.createDataFrame([("3f2504e0-4f89-11d3-9a0c-0305e82c3301", "t1", "o")], schema)
    r = one_table_parity(spark, "ApiToken", s, s, spec)
    assert [(x[1], x[6]) for x in r] == [("token", "OK")]


def test_key_override_pairs_a_table_without_primary_key(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("txt", T.StringType())])
    s = spark.createDataFrame([(1, "x"), (2, "y")], schema)
    t = spark.createDataFrame([(1, "x"), (2, "z")], schema)
    m = Manifest([TableSpec("q", schema)])
    got = {r.column_name: (r.paired, r.identical, r.status)
           for r in string_parity(spark, {"q": s}, {"q": t}, m, keys={"q": ("a",)}).collect()}
    assert got == {"txt": (2, 1, "DIFF")}


def test_text_key_null_key_and_no_entry(spark):
    from ferry.operators.reconcile import reconcile
    schema = T.StructType([T.StructField("k", T.StringType())])
    s = spark.createDataFrame([("é",), ("b",), (None,)], schema)
    t = spark.createDataFrame([("Ã©",), ("b",), (None,)], schema)
    m = Manifest([TableSpec("p", schema, primary_key=("k",))])
    got = {r.table_name: tuple(r)[1:] for r in string_parity(spark, {"p": s, "q": s}, {"p": t, "q": s}, m).collect()}
    assert got["p"] == ("(key)", 1, 2, 2, 1, "DIFF", None)
    assert got["q"] == ("(key)", None, None, None, None, "SKIPPED", "no manifest entry")
    assert not reconcile(spark, {"p": s}, {"p": t}, m).passed()
    same = s.where("k is not null")
    assert reconcile(spark, {"p": same}, {"p": same}, m).passed()


def test_text_of_any_length_follows_one_rule(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("txt", T.StringType())])
    rows = [(i, "x" * n) for i, n in enumerate((0, 31, 32, 33, 1000))]
    s = spark.createDataFrame(rows, schema)
    t = spark.createDataFrame([(i, x[:-1] + "y" if x else "") for i, x in rows], schema)
    for digest in (True, False):
        r = table_parity(spark, "p", s, t, ["a"], ["txt"], digest).first()
        assert (r.paired, r.identical) == (5, 1)
