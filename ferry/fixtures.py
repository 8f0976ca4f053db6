"""Stand-in inputs built from the driver's test tables.

"S" (source) is the test tables with money columns typed DECIMAL(12,2).
"T" (target) is S with seeded defects. Both are written as SQL select lists
that run unchanged in Spark and in DuckDB, so the oracle sees the same input.
These builders only shape input rows; every check runs in the operators.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .manifest import ForeignKey, Manifest, TableSet, UniqueKey, spec_from_frame
from .sources.tables import parquet_tables

ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"]

# The typed layer (applied on both sides).
MONEY = "DECIMAL(12,2)"
TYPED = {
    "customer": {"c_acctbal": MONEY},
    "supplier": {"s_acctbal": MONEY},
    "part": {"p_retailprice": MONEY},
    "orders": {"o_totalprice": MONEY},
    "lineitem": {"l_quantity": MONEY, "l_extendedprice": MONEY},
}

# Seeded target defects, (row predicate, {column: new value}).
MUTATIONS = {
    "region": ("false", {}),
    "customer": ("c_custkey % 50 <> 4", {
        "c_name": "CASE WHEN c_custkey % 200 = 9 THEN upper('Customer#' || "
                  "lpad(CAST(c_custkey - 1 AS STRING), 9, '0')) ELSE c_name END"}),
    "part": (None, {
        "p_name": "CASE WHEN p_partkey % 20 = 3 THEN substr(p_name, 1, 3) ELSE p_name END"}),
    "orders": ("o_orderkey % 97 <> 13", {
        "o_totalprice": "CASE WHEN o_orderkey % 101 = 7 THEN "
                        "CAST(o_totalprice + 0.01 AS DECIMAL(12,2)) ELSE o_totalprice END"}),
    "lineitem": (None, {
        "l_quantity": "CASE WHEN l_partkey % 500 = 1 THEN "
                      "CAST(l_quantity + 1 AS DECIMAL(12,2)) ELSE l_quantity END",
        "l_discount": "l_discount + 0.01"}),
    "events": (None, {"value": "value + 1"}),
    "documents": ("doc_id % 89 <> 5", {
        "text": "CASE WHEN doc_id % 50 = 7 THEN substr(text, 1, 100) "
                "WHEN doc_id % 50 = 11 THEN NULL "
                "ELSE replace(text, 'é', 'Ã©') END"}),
}
SOURCE_OMITS = "benchmark"
TARGET_OMITS = "labels"


def raw_tables(spark: SparkSession, sf_dir: str, names=ALL_TABLES) -> TableSet:
    """The test tables as read by the library's Parquet source."""
    return parquet_tables(spark, sf_dir, list(names))


def typed_select(table: str, columns: list[str]) -> list[str]:
    casts = TYPED.get(table, {})
    return [f"CAST({c} AS {casts[c]}) AS {c}" if c in casts else c for c in columns]


def mutated_select(table: str, columns: list[str]) -> tuple[str | None, list[str]]:
    pred, new = MUTATIONS.get(table, (None, {}))
    return pred, [f"{new[c]} AS {c}" if c in new else c for c in columns]


def typed_tables(raw: TableSet) -> TableSet:
    return {n: df.selectExpr(*typed_select(n, df.columns)) for n, df in raw.items()}


def source_tables(spark: SparkSession, sf_dir: str, with_all: bool = False,
                  typed: TableSet | None = None) -> TableSet:
    """S: typed test tables (without ``benchmark`` unless ``with_all``)."""
    typed = typed if typed is not None else typed_tables(raw_tables(spark, sf_dir))
    return {n: df for n, df in typed.items() if with_all or n != SOURCE_OMITS}


def target_tables(spark: SparkSession, sf_dir: str, typed: TableSet | None = None) -> TableSet:
    """T: S with the seeded defects (without ``labels``, with ``benchmark``)."""
    typed = typed if typed is not None else typed_tables(raw_tables(spark, sf_dir))
    out = {}
    for n, df in typed.items():
        if n == TARGET_OMITS:
            continue
        pred, cols = mutated_select(n, df.columns)
        if pred is not None:
            df = df.where(pred)
        out[n] = df.selectExpr(*cols)
    return out


def fk(cols, parent, pcols) -> ForeignKey:
    return ForeignKey(tuple(cols), parent, tuple(pcols))


# Keys and rules of the test tables.
RULES = {
    "region": dict(primary_key=("r_regionkey",), max_len={"r_name": 25}),
    "nation": dict(primary_key=("n_nationkey",),
                   foreign_keys=(fk(["n_regionkey"], "region", ["r_regionkey"]),),
                   max_len={"n_name": 25}),
    "customer": dict(primary_key=("c_custkey",), identity="c_custkey",
                     foreign_keys=(fk(["c_nationkey"], "nation", ["n_nationkey"]),),
                     unique=(UniqueKey(("c_name",)),),
                     max_len={"c_name": 25, "c_mktsegment": 10}),
    "supplier": dict(primary_key=("s_suppkey",), identity="s_suppkey",
                     foreign_keys=(fk(["s_nationkey"], "nation", ["n_nationkey"]),),
                     max_len={"s_name": 25}),
    "part": dict(primary_key=("p_partkey",), identity="p_partkey",
                 max_len={"p_name": 55, "p_brand": 10, "p_type": 25}),
    "orders": dict(primary_key=("o_orderkey",), identity="o_orderkey",
                   foreign_keys=(fk(["o_custkey"], "customer", ["c_custkey"]),),
                   max_len={"o_orderstatus": 1, "o_orderpriority": 15}),
    "lineitem": dict(foreign_keys=(fk(["l_orderkey"], "orders", ["o_orderkey"]),
                                   fk(["l_partkey"], "part", ["p_partkey"]),
                                   fk(["l_suppkey"], "supplier", ["s_suppkey"])),
                     max_len={"l_returnflag": 1, "l_linestatus": 1}),
    "events": dict(primary_key=("event_id",),
                   foreign_keys=(fk(["user_id"], "customer", ["c_custkey"]),)),
    "documents": dict(primary_key=("doc_id",), max_len={"text": 10000}),
    "embeddings": dict(primary_key=("vec_id",)),
    "pages": dict(primary_key=("page_id",)),
    "benchmark": dict(primary_key=("item_id",)),
    "labels": dict(primary_key=("doc_id",),
                   foreign_keys=(fk(["doc_id"], "documents", ["doc_id"]),)),
    "conversations": dict(primary_key=("conv_id", "turn"), unique=(UniqueKey(("conv_id", "role")),),
                          foreign_keys=(fk(["conv_id", "turn"], "lineitem", ["l_orderkey", "l_linenumber"]),)),
}


def fixture_manifest(tables: TableSet) -> Manifest:
    """Keys and rules of the test tables (schemas taken from ``tables``)."""
    return Manifest(spec_from_frame(n, df, **RULES.get(n, {})) for n, df in tables.items())


def loadable(spark: SparkSession, sf_dir: str) -> tuple[TableSet, Manifest]:
    """(every typed test table, its manifest without the two rules that rows of the test
    tables break): a source that its target accepts."""
    typed = typed_tables(raw_tables(spark, sf_dir))
    broken = {("documents", "max_len"), ("conversations", "unique")}
    rules = {n: {k: v for k, v in r.items() if (n, k) not in broken} for n, r in RULES.items()}
    return typed, Manifest(spec_from_frame(n, df, **rules.get(n, {})) for n, df in typed.items())


def fixture(spark: SparkSession, sf_dir: str) -> tuple[TableSet, TableSet, Manifest]:
    """(S, T, manifest) with the manifest covering every table of either side."""
    typed = typed_tables(raw_tables(spark, sf_dir))
    s, t = source_tables(spark, sf_dir, typed=typed), target_tables(spark, sf_dir, typed=typed)
    schemas = dict(s)
    schemas.update({n: df for n, df in t.items() if n not in schemas})
    return s, t, fixture_manifest(schemas)

