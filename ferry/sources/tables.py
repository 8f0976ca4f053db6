"""Table-set readers: a Parquet folder, the session catalogue, or JDBC.

Reads are lazy; Spark prunes columns and pushes filters into each scan. A table that
cannot be opened takes its place in the set as ``Unreadable``, so that the others are
still loaded and compared: whatever uses it raises the error of opening it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..manifest import INTEGRAL_TYPES, Manifest, TableSet, TableSpec

#: Folders beside the tables that hold none: a sink's own, and writers' metadata.
NO_TABLES = ("_staging", "_old", "_SUCCESS", "_temporary", "_spark_metadata", "_delta_log")


class Unreadable:
    """Stands for a table that could not be opened; any use raises that error."""

    def __init__(self, name: str, error: Exception):
        self._name, self._error = name, error

    def __getattr__(self, attribute: str):
        raise RuntimeError(f"table {self._name} cannot be read: {self._error}") from self._error


def opened(name: str, read: Callable[[], DataFrame]) -> DataFrame | Unreadable:
    try:
        return read()
    except Exception as exc:
        return Unreadable(name, exc)


def parquet_tables(spark: SparkSession, root: str, names=None) -> TableSet:
    """``<root>/<name>.parquet`` (or ``<root>/<name>``) for each name; with
    no names, every table found under ``root``."""
    root = root.rstrip("/")
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if names is None:
        found = (s.getPath().getName() for s in fs.listStatus(Path(root)))
        names = sorted(n.removesuffix(".parquet") for n in found if n not in NO_TABLES and not n.endswith(".crc"))

    def path(n: str) -> str:
        return f"{root}/{n}.parquet" if fs.exists(Path(f"{root}/{n}.parquet")) else f"{root}/{n}"

    return {n: opened(n, lambda n=n: spark.read.parquet(path(n))) for n in names}


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(path, size, time of change) of the data files under ``folder``, or of the file that it
    is; paths are URIs, as Spark's file metadata has them, with ``file:/`` for local ones."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    root = Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out, listed = [], fs.listFiles(root, True)
    while listed.hasNext():
        status = listed.next()
        path = status.getPath()
        if not path.getName().startswith(("_", ".")) and "/_" not in path.toString().removeprefix(root.toString()):
            name = path.toUri().toString()
            out.append(("file:/" + name.removeprefix("file:").lstrip("/") if name.startswith("file:") else name, status.getLen(), status.getModificationTime()))
    return sorted(out)


def catalog_tables(spark: SparkSession, database: str | None = None, names=None) -> TableSet:
    """Base tables of a catalogue database (views excluded: they hold no data)."""
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    tables = sorted(t.name for t in listed if t.tableType != "VIEW" and not t.isTemporary)
    if names is not None:
        tables = [t for t in tables if t in set(names)]

    def full(n: str) -> str:
        return ".".join("`" + x.replace("`", "``") + "`" for x in (database, n) if x)

    return {t: opened(t, lambda t=t: spark.table(full(t))) for t in tables}


def sql_name(name: str, quote: str = '"') -> str:
    """A possibly schema-qualified name, each part quoted (and so kept as it is)."""
    return ".".join(quote + part.replace(quote, quote * 2) + quote for part in name.split("."))


def sql_column(name: str, quote: str = '"') -> str:
    return quote + name.replace(quote, quote * 2) + quote


def jdbc_options(url: str, table: str, columns=None, *, fetchsize: int = 5000,
                 partition_column: str | None = None, bounds: tuple[int, int] | None = None,
                 num_partitions: int = 8, quote: str = '"') -> dict[str, str]:
    """Reader options for one database table: a quoted projection as a derived table,
    read in batches of ``fetchsize`` rows; with a partition column and its bounds, in
    ``num_partitions`` parallel ranges (every row is read: bounds only shape ranges)."""
    what = ", ".join(sql_column(c, quote) for c in columns) if columns else "*"
    out = {"url": url, "fetchsize": str(fetchsize), "dbtable": f"(SELECT {what} FROM {sql_name(table, quote)}) t"}
    if partition_column and bounds:
        out |= {"partitionColumn": sql_column(partition_column, quote), "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1]), "numPartitions": str(num_partitions)}
    return out


def key_range(spark: SparkSession, url: str, table: str, column: str, quote: str = '"',
              properties: dict | None = None) -> tuple[int, int] | None:
    """Smallest and largest value of an integer column, computed by the database."""
    c = sql_column(column, quote)
    row = spark.read.format("jdbc").options(url=url, **(properties or {}),
        query=f"SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {sql_name(table, quote)}").load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]) + 1)


def jdbc_table(spark: SparkSession, url: str, table: str, columns=None, *, fetchsize: int = 5000,
               partition_column: str | None = None, bounds: tuple[int, int] | None = None,
               num_partitions: int = 8, quote: str = '"', properties: dict | None = None,
               predicates: list[str] | None = None) -> DataFrame:
    """One database table as a DataFrame. With an integer ``partition_column`` the read is
    split into parallel ranges; their bounds are asked of the database if not given. These
    are even in the key's values; ``predicates`` (``ranges.range_predicates``) split it
    evenly in rows instead, for keys of any type, a task each."""
    if predicates:
        options = jdbc_options(url, table, columns, fetchsize=fetchsize, quote=quote)
        what = options.pop("dbtable")
        return spark.read.jdbc(options.pop("url"), what, predicates=predicates, properties=options | (properties or {}))
    if partition_column and bounds is None:
        bounds = key_range(spark, url, table, partition_column, quote, properties)
    options = jdbc_options(url, table, columns, fetchsize=fetchsize, partition_column=partition_column,
                           bounds=bounds, num_partitions=num_partitions, quote=quote)
    return spark.read.format("jdbc").options(**options, **(properties or {})).load()


def split_column(spec: TableSpec) -> str | None:
    """The integer column that a table's read can be split on: its identity or key."""
    kinds = {f.name: f.dataType for f in spec.schema.fields}
    return next((c for c in (spec.identity, *spec.primary_key) if isinstance(kinds.get(c), INTEGRAL_TYPES)), None)


def jdbc_tables(spark: SparkSession, url: str, names, partition_columns: dict | None = None,
                manifest: Manifest | None = None, **kwargs) -> TableSet:
    """Several JDBC tables. Each read is split on the integer column that
    ``partition_columns`` names for it, else on the manifest's identity or integer key
    column; a table with neither is read in one task."""
    split = {n: split_column(manifest[n]) for n in names if n in manifest} if manifest else {}
    split |= partition_columns or {}
    return {n: opened(n, lambda n=n: jdbc_table(spark, url, n, partition_column=split.get(n), **kwargs)) for n in names}
