"""Load: projection, conformance, counts, staging swap, append conflicts,
fail-loud per table, subset selection and identity high-water marks."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ferry.manifest import Manifest, TableSpec
from ferry.operators import load as L
from ferry.session import fresh_dir

SCHEMA = T.StructType([T.StructField("id", T.LongType(), False),
                       T.StructField("name", T.StringType(), False),
                       T.StructField("price", T.DecimalType(12, 2), False)])
HOSTILE = 'a,"b"\nc\\d {"json": [1, "x"]} é ñ 🙂'


def _manifest():
    return Manifest([TableSpec("item", SCHEMA, primary_key=("id",), identity="id"),
                     TableSpec("other", SCHEMA, primary_key=("id",), identity="id")])


def _source(spark):
    raw = spark.createDataFrame([(2.5, 1, HOSTILE, "extra"), (3.0, 2, "plain", "x")],
                                "price double, id int, name string, junk string")
    return {"item": raw, "other": raw}


def test_load_projects_conforms_counts_and_roundtrips(spark):
    sink = L.ParquetSink(spark, fresh_dir(spark, "t-load"))
    res = L.load(spark, _source(spark), _manifest(), sink, tables=["item", "nope"])
    rep = {(r.table_name, r.status): r.n_rows for r in res.report.collect()}
    assert rep == {("item", "LOADED"): 2, ("(total)", "TOTAL"): 2, ("nope", "NOT_FOUND"): None}
    back = sink.read("item")
    assert back.columns == ["id", "name", "price"]
    assert back.schema["price"].dataType == T.DecimalType(12, 2)
    rows = sorted(back.collect())
    assert rows[0].name == HOSTILE and rows[0].price == Decimal("2.50") and rows[0].id == 1


def test_overwrite_replaces_and_append_checks_keys(spark):
    sink = L.ParquetSink(spark, fresh_dir(spark, "t-load"))
    src = _source(spark)
    L.load(spark, src, _manifest(), sink, tables=["item"])
    L.load(spark, src, _manifest(), sink, tables=["item"])          # replace, not add
    assert sink.read("item").count() == 2
    with pytest.raises(L.LoadError, match="already exist"):
        L.load(spark, src, _manifest(), sink, tables=["item"], mode="append")
    more = spark.createDataFrame([(9.99, 3, "new", "")], "price double, id int, name string, junk string")
    L.load(spark, {"item": more}, _manifest(), sink, tables=["item"], mode="append")
    assert sink.read("item").count() == 3


def test_missing_column_and_bad_cast_fail_loud(spark):
    sink = L.ParquetSink(spark, fresh_dir(spark, "t-load"))
    bad = {"item": spark.createDataFrame([(1, "a")], "id int, name string")}
    with pytest.raises(L.LoadError, match="item.*price"):
        L.load(spark, bad, _manifest(), sink, tables=["item"])
    too_big = {"item": spark.createDataFrame([(1, "a", 1e13)], "id int, name string, price double")}
    with pytest.raises(L.LoadError, match="item"):
        L.load(spark, too_big, _manifest(), sink, tables=["item"])
    assert not sink.exists("item")   # nothing half-written


def test_empty_selection_is_fatal():
    with pytest.raises(L.LoadError):
        L.select_tables(["a", "b"], ["zzz"])
    assert L.select_tables(["b", "a"], []) == (["a", "b"], [])
    assert L.select_tables(["b", "a"], [" b ", "c"]) == (["b"], ["c"])


def test_identity_high_water(spark):
    m = _manifest()
    tables = {"item": spark.createDataFrame([(5, "a", Decimal(1))], SCHEMA),
              "other": spark.createDataFrame([(-4, "a", Decimal(1))], SCHEMA)}
    empty = spark.createDataFrame([], SCHEMA)
    got = {r.table_name: (r.max_id, r.counter, r.next_id, r.is_used)
           for r in L.identity_high_water(spark, tables, m).collect()}
    assert got == {"item": (5, 5, 6, True), "other": (-4, 1, 1, False)}
    got = L.identity_high_water(spark, {"item": empty}, m).first()
    assert (got.max_id, got.counter, got.next_id, got.is_used) == (0, 1, 1, False)


def test_catalog_sink_bucketed(spark):
    db = "ferry_test_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    sink = L.CatalogSink(spark, db, buckets=4, manifest=_manifest())
    L.load(spark, _source(spark), _manifest(), sink, tables=["item"])
    assert sink.read("item").count() == 2
    from ferry.sources.tables import catalog_tables
    tables = catalog_tables(spark, db)
    assert set(tables) == {"item"} and tables["item"].count() == 2
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_migrate_loads_marks_and_proves(spark):
    from ferry.operators.transfer import migrate
    sink = L.ParquetSink(spark, fresh_dir(spark, "t-migrate"))
    src = {n: L.conform(L.project(df, _manifest()[n]), _manifest()[n]) for n, df in _source(spark).items()}
    res = migrate(spark, src, _manifest(), sink, tables=["item"])
    assert {(r.table_name, r.n_rows) for r in res.load_report.collect()} == {("item", 2), ("(total)", 2)}
    assert [(r.table_name, r.next_id) for r in res.high_water.collect()] == [("item", 3)]
    assert res.reconciliation.passed()


def test_empty_table_replace_load(spark):
    sink = L.ParquetSink(spark, fresh_dir(spark, "t-empty"))
    empty = {"item": spark.createDataFrame([], "price double, id int, name string, junk string")}
    res = L.load(spark, empty, _manifest(), sink, tables=["item"])
    assert res.counts == {"item": 0}
    assert sink.read("item").count() == 0 and sink.read("item").columns == ["id", "name", "price"]


def _one(spark, rows, ddl, spec, mode="overwrite", sink=None):
    sink = sink or L.ParquetSink(spark, fresh_dir(spark, "t-rules"))
    L.load(spark, {spec.name: spark.createDataFrame(rows, ddl)}, Manifest([spec]), sink, mode=mode)
    return sink


def test_rules_refuse_the_table(spark):
    from ferry.manifest import UniqueKey
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("qty", T.IntegerType()),
                           T.StructField("code", T.StringType())])
    spec = TableSpec("x", schema, primary_key=("id",), max_len={"code": 3}, unique=(UniqueKey(("code",)),))
    ddl = "id int, qty double, code string"
    for rows, rule in (([(1, 2.2, "a")], "whole"), ([(None, 2.0, "a")], "not_null of id"), ([(1, 2.0, "abcd")], "max_len of code"),
                       ([(1, 2.0, "a"), (1, 3.0, "b")], "primary_key of id"), ([(1, 2.0, "a"), (2, 3.0, "a")], "unique of code")):
        sink = L.ParquetSink(spark, fresh_dir(spark, "t-rules"))
        _one(spark, [(7, 1.0, "old")], ddl, spec, sink=sink)
        for mode in ("overwrite", "append"):
            with pytest.raises(L.LoadError, match=rule):
                _one(spark, rows, ddl, spec, mode, sink)
            assert [tuple(r) for r in sink.read("x").collect()] == [(7, 1, "old")]
            left = sink._fs.listStatus(sink._Path(f"{sink.root}/_staging"))
            assert len(left) == 0
    assert _one(spark, [(1, 2.0, None), (2, 3.0, None)], ddl, spec).read("x").count() == 2


def test_casts_keep_whole_values(spark):
    for ddl, value, target in (("v double", 2.2, T.IntegerType()), ("v decimal(6,2)", Decimal("3.40"), T.LongType()),
                               ("v string", "2.2", T.IntegerType()), ("v timestamp", __import__("datetime").datetime(2020, 1, 2, 3), T.DateType()),
                               ("v binary", bytearray(b"ab"), T.StringType()), ("v double", 1e12, T.IntegerType())):
        spec = TableSpec("x", T.StructType([T.StructField("v", target)]))
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            try:
                with pytest.raises(Exception):
                    L.conform(spark.createDataFrame([(value,)], ddl), spec).collect()
            finally:
                spark.conf.set("spark.sql.ansi.enabled", "true")
    spec = TableSpec("x", T.StructType([T.StructField("v", T.DecimalType(6, 1))]))
    assert L.conform(spark.createDataFrame([(2.26,)], "v double"), spec).first().v == Decimal("2.3")
    spec = TableSpec("x", T.StructType([T.StructField("v", T.IntegerType())]))
    assert L.conform(spark.createDataFrame([(2.0,), (None,)], "v double"), spec).collect() == [(2,), (None,)]


def test_binary_guid_becomes_its_text(spark):
    import uuid
    u = uuid.uuid4()
    spec = TableSpec("x", T.StructType([T.StructField("g", T.StringType())]), logical={"g": "uuid"})
    assert _one(spark, [(bytearray(u.bytes_le),)], "g binary", spec).read("x").first().g == str(u)
    assert _one(spark, [("{" + str(u).upper() + "}",)], "g string", spec).read("x").first().g == str(u)


def test_failed_swap_brings_the_previous_table_back(spark):
    sink = L.ParquetSink(spark, fresh_dir(spark, "t-swap"))
    L.load(spark, _source(spark), _manifest(), sink, tables=["item"])
    sink._moved = lambda source, target: False
    with pytest.raises(L.LoadError, match="previous one is back"):
        L.load(spark, _source(spark), _manifest(), sink, tables=["item"])
    assert sink.read("item").count() == 2
    assert len(sink._fs.listStatus(sink._Path(f"{sink.root}/_staging"))) == 0


def test_catalog_replace_keeps_the_previous_table_on_failure(spark):
    db = "ferry_swap_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    sink = L.CatalogSink(spark, db)
    L.load(spark, _source(spark), _manifest(), sink, tables=["item"])
    bad = {"item": spark.createDataFrame([(1, "a", 1e13)], "id int, name string, price double")}
    with pytest.raises(L.LoadError):
        L.load(spark, bad, _manifest(), sink, tables=["item"])
    L.load(spark, _source(spark), _manifest(), sink, tables=["item"])
    assert sink.read("item").count() == 2
    assert [t.name for t in spark.catalog.listTables(db) if not t.isTemporary] == ["item"]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_no_table_starts_after_a_failure(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False)])
    m = Manifest([TableSpec(n, schema) for n in "abcd"])
    ok, bad = spark.range(3), spark.createDataFrame([(None,)], "id long")
    sink = L.ParquetSink(spark, fresh_dir(spark, "t-stop"))
    with pytest.raises(L.LoadError) as e:
        L.load(spark, {"a": bad, "b": ok, "c": ok, "d": ok}, m, sink, parallelism=1)
    assert e.value.table == "a" and not any(sink.exists(n) for n in "bcd")
    with pytest.raises(L.LoadError) as e:
        L.load(spark, {"a": bad, "b": bad, "c": ok, "d": ok}, m, sink, parallelism=2)
    assert {e.value.table, *(x.table for x in e.value.others)} == {"a", "b"} and not sink.exists("d")


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from ferry.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(Session())


@pytest.mark.parametrize("collation", [None, "UNICODE_CI"])
def test_append_refuses_unique_values_of_the_target(spark, collation):
    from ferry.manifest import UniqueKey

    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("code", T.StringType())])
    manifest = Manifest([TableSpec("item", schema, primary_key=("id",), unique=(UniqueKey(("code",), collation),))])
    sink = L.ParquetSink(spark, fresh_dir(spark, "t-append-unique"))
    rows = lambda *x: {"item": spark.createDataFrame(x, "id bigint, code string")}
    L.load(spark, rows((1, "a"), (2, None)), manifest, sink)
    with pytest.raises(L.LoadError, match="unique of code"):
        L.load(spark, rows((3, "A" if collation else "a")), manifest, sink, mode="append")
    L.load(spark, rows((4, "b"), (5, None), (6, "a " if collation else "A")), manifest, sink, mode="append")
    assert sink.read("item").count() == 5
