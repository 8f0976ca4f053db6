"""Sources (Parquet folder) and the driver entry points. The JDBC reader
is not exercised: it would need a database, and none is started here."""

import os

import pytest
from pyspark.sql import types as T

from ferry.manifest import Manifest, TableSpec
from ferry.sources.tables import jdbc_options, jdbc_tables, parquet_tables

SF = "/root/testdata/sf0.001"


def test_parquet_folder_lists_all_tables(spark):
    tables = parquet_tables(spark, SF)
    assert {"region", "lineitem", "documents", "conversations"} <= set(tables)
    assert tables["nation"].count() == 25


def test_entry_and_registry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"table_name", "metric", "source_value", "target_value", "status"}
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 26
    assert os.path.exists(SF)


def test_missing_and_hidden_tables(spark, tmp_path):
    for name in ("_kept", "plain", "_staging", "_old"):
        spark.range(3).write.parquet(str(tmp_path / name))
    assert set(parquet_tables(spark, str(tmp_path))) == {"_kept", "plain"}
    tables = parquet_tables(spark, str(tmp_path), ["plain", "gone"])
    assert tables["plain"].count() == 3
    with pytest.raises(RuntimeError, match="gone"):
        tables["gone"].columns


def test_jdbc_options_without_a_database():
    """Only the options: the reader itself needs a database, and none is started here."""
    got = jdbc_options("jdbc:x://h/db", "Order", ["o_orderkey", 'a"b', "c.d"], partition_column="Order", bounds=(1, 1001), num_partitions=16)
    assert got["dbtable"] == '(SELECT "o_orderkey", "a""b", "c.d" FROM "Order") t' and got["fetchsize"] == "5000"
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ('"Order"', "1", "1001", "16")
    plain = jdbc_options("jdbc:x://h/db", "sales.nation", fetchsize=100, quote="`")
    assert plain == {"url": "jdbc:x://h/db", "fetchsize": "100", "dbtable": "(SELECT * FROM `sales`.`nation`) t"}


class _Recorder:
    """Stands in for spark.read: records options, answers the bounds query."""

    def __init__(self):
        self.calls = []
        self.read = self

    def format(self, name):
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return (3, 90)


def test_jdbc_bounds_are_asked_of_the_database():
    spark = _Recorder()
    jdbc_tables(spark, "jdbc:x://h/db", ["Order", "nation"], {"Order": "id"}, properties={"user": "u"})
    assert spark.calls[0]["query"] == 'SELECT MIN("id") AS lo, MAX("id") AS hi FROM "Order"'
    assert (spark.calls[1]["lowerBound"], spark.calls[1]["upperBound"], spark.calls[1]["user"]) == ("3", "91", "u")
    assert "partitionColumn" not in spark.calls[2]
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("no", T.IntegerType())])
    spark = _Recorder()
    jdbc_tables(spark, "jdbc:x://h/db", ["a", "b"], manifest=Manifest([TableSpec("a", schema, ("name", "no")), TableSpec("b", schema, ("name",))]))
    assert spark.calls[1]["partitionColumn"] == '"no"' and "partitionColumn" not in spark.calls[2]
