"""Closed subsets, key ranges, incremental metrics, resumed loads, keyed streams, JSON."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry import ForeignKey, LoadError, Manifest, ParquetSink, TableSpec, fk_audit, load
from ferry.functions.exprs import canonical_json
from ferry.operators.load import RunLedger
from ferry.operators.metric_state import MetricState
from ferry.operators.metrics import metrics_report
from ferry.operators.parity import string_parity
from ferry.operators.subset import closed_subset
from ferry.plans.validation import build_plan
from ferry.session import fresh_dir
from ferry.sources.ranges import in_ranges, key_ranges, range_predicates, read_ranges

TEXT, LONG = T.StringType(), T.LongType()


def struct(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


# --- closed subsets ------------------------------------------------------------------


def test_closed_subset_follows_cycles_and_self_references(spark):
    r = random.Random(3)
    staff = [(k, r.choice([None, *range(60)]), r.randrange(9)) for k in range(60)]            # boss, unit
    units = [(k, r.choice([None, *range(60)])) for k in range(9)]                             # head: a cycle
    notes = [(r.randrange(60), k % 4, f"n{k}") for k in range(200)]                           # no key; composite reference
    pairs = [(a, b) for a in range(60) for b in range(3)]                                     # (60, 3) missing: orphans of the source
    source = {"staff": spark.createDataFrame(staff, "id int, boss int, unit int"), "unit": spark.createDataFrame(units, "id int, head int"),
              "note": spark.createDataFrame(notes, "who int, kind int, v0 string"), "pair": spark.createDataFrame(pairs, "a int, b int"),
              "lone": spark.createDataFrame([(1,)], "k0 int")}
    m = Manifest([
        TableSpec("staff", source["staff"].schema, ("id",), foreign_keys=(ForeignKey(("boss",), "staff", ("id",)), ForeignKey(("unit",), "unit", ("id",)))),
        TableSpec("unit", source["unit"].schema, ("id",), foreign_keys=(ForeignKey(("head",), "staff", ("id",)),)),
        TableSpec("note", source["note"].schema, foreign_keys=(ForeignKey(("who", "kind"), "pair", ("a", "b")),)),
        TableSpec("pair", source["pair"].schema, ("a", "b"), foreign_keys=(ForeignKey(("a",), "staff", ("id",)),)), TableSpec("lone", source["lone"].schema, ("k0",))])
    got = closed_subset(spark, source, m, {"note": "v0 in ('n3', 'n8', 'n20')", "lone": F.col("k0") == 2})
    want_note = [x for x in notes if x[2] in ("n3", "n8", "n20")]
    want_pair = {(a, b) for a, b, _ in want_note} & set(pairs)
    ids, todo, seen_units = set(), [a for a, _ in want_pair], set()
    while todo:
        k = todo.pop()
        if k is None or k in ids:
            continue
        ids.add(k)
        todo += [staff[k][1], units[staff[k][2]][1]]
        seen_units.add(staff[k][2])
    assert sorted(map(tuple, got["note"].collect())) == sorted(want_note)
    assert {tuple(x) for x in got["pair"].collect()} == want_pair
    assert {x.id for x in got["staff"].collect()} == ids and got["staff"].count() == len(ids)
    assert {x.id for x in got["unit"].collect()} == seen_units
    assert got["lone"].collect() == []
    orphans = {(x.child, x.column_name): x.orphans for x in fk_audit(spark, got, m).collect()}
    assert all(n == 0 for (child, _), n in orphans.items() if child != "note")


def test_closed_subset_needs_known_tables_and_keys(spark):
    df = spark.createDataFrame([(1, 1)], "id int, up int")
    m = Manifest([TableSpec("a", df.schema, foreign_keys=(ForeignKey(("up",), "a", ("id",)),))])
    with pytest.raises(ValueError, match="no primary key"):
        closed_subset(spark, {"a": df}, m, {"a": "id = 1"})
    with pytest.raises(ValueError, match="no such table"):
        closed_subset(spark, {"a": df}, m, {"b": "id = 1"})


# --- key ranges ----------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["sparse", "text", "pair", "repeated", "nulls"])
def test_ranges_cover_every_row_once(spark, kind):
    r = random.Random(kind)
    rows, key = {
        "sparse": ([(k**3,) for k in range(1000)], ["a"]),
        "text": ([(f"it's {k * 7919 % 5000} é",) for k in range(1000)], ["a"]),
        "pair": ([(k // 30, k % 30) for k in range(1000)], ["a", "b"]),
        "repeated": ([(r.choice([1, 2, 2, 2, 2, 9]) * (k % 40),) for k in range(1000)], ["a"]),
        "nulls": ([(None if k < 30 else k,) for k in range(1000)], ["a"])}[kind]
    types = {"text": "a string", "pair": "a bigint, b int"}.get(kind, "a bigint")
    df = spark.createDataFrame(rows, types)
    found = key_ranges(df, key, 100).orderBy("ordinal").collect()
    assert sum(x.n_rows for x in found) == 1000
    if kind != "repeated":
        assert [x.n_rows for x in found] == [100] * 10
    lows = [tuple(x.low) for x in found if None not in tuple(x.low)]
    assert lows == sorted(set(lows))
    predicates = range_predicates(key_ranges(df, key, 100), key, quote="`")
    parts = [df.where(p).count() for p in predicates]
    assert parts == [x.n_rows for x in found]
    assert sorted(map(repr, map(tuple, read_ranges(df, predicates).collect()))) == sorted(map(repr, rows))


def test_rows_find_their_range_in_one_scan(spark):
    """The range of a row is the one whose predicate holds, nulls and repeated keys included,
    and the plan doesn't grow with the ranges."""
    r = random.Random(1)
    rows = [(None if k < 40 else 1 + min(k % 7, 2), None if k == 50 else r.choice(["", "it's", "é", str(r.random())]), k) for k in range(600)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    for key, batch in ((["c", "b"], 60), (["a"], 50)):
        parts = key_ranges(df, key, batch)
        predicates = range_predicates(parts, key, quote="`")
        want = sorted((x.c, i) for i, p in enumerate(predicates) for x in df.where(p).collect())
        assert sorted((x.c, x.ordinal) for x in in_ranges(df, parts, key).collect()) == want and len(want) == 600
    plans = [in_ranges(df, key_ranges(df, ["c"], n), ["c"])._jdf.queryExecution().optimizedPlan().toString().count("\n") for n in (300, 3)]
    assert plans[0] == plans[1]


def test_a_read_by_many_ranges_scans_once(spark):
    """The registered read holds no scan a range."""
    from ferry.suite import read_by_ranges
    plan = read_by_ranges(spark, "/root/testdata/sf0.01")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\n") < 100


def test_ranges_of_no_rows(spark):
    df = spark.createDataFrame([], "a bigint")
    assert key_ranges(df, ["a"], 10).collect() == [] and range_predicates(key_ranges(df, ["a"], 10), ["a"]) == ["1 = 1"]


def test_jdbc_read_takes_range_predicates(spark):
    from ferry.sources.tables import jdbc_table

    class Reader:
        def jdbc(self, url, table, **kwargs):
            return url, table, kwargs

    class Session:
        read = Reader()

    url, table, kwargs = jdbc_table(Session(), "jdbc:x:", "s.t", ["a"], predicates=['"a" < 5', '"a" >= 5'])
    assert (url, table, kwargs["predicates"]) == ("jdbc:x:", '(SELECT "a" FROM "s"."t") t', ['"a" < 5', '"a" >= 5'])
    assert kwargs["properties"] == {"fetchsize": "5000"}


# --- incremental metrics -------------------------------------------------------------


def test_only_new_and_changed_files_are_read(spark):
    from decimal import Decimal

    kind = struct(("id", LONG), ("v", T.DecimalType(38, 2)), ("w", T.IntegerType()))
    folder, state = fresh_dir(spark, "ms-src"), MetricState(spark, fresh_dir(spark, "ms-state"))
    m = Manifest([TableSpec("t", kind, primary_key=("id",))])

    def add(first, n, name):
        spark.createDataFrame([(k, Decimal(f"{10**34 - k}.07"), None if k % 5 == 0 else -k) for k in range(first, first + n)], kind).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")

    def same():
        df = spark.read.schema(kind).parquet(*[f"{folder}/{x}" for x in parts])
        plan = build_plan({"t": df}, m)
        got = state.refresh(plan[0], folder)
        assert sorted(map(tuple, got.report.collect())) == sorted(map(tuple, metrics_report({"t": df}, plan).collect()))
        return got

    parts = ["a", "b c"]
    add(1, 400, "a")
    add(1000, 10, "b c")
    first = same()
    assert (len(first.read), first.kept, first.gone) == (2, 0, 0)
    again = same()
    assert (again.read, again.kept) == ([], 2)
    parts.append("c")
    add(5000, 3, "c")
    more = same()
    assert len(more.read) == 1 and "/c/" in more.read[0] and more.kept == 2
    spark.createDataFrame([], kind).coalesce(1).write.mode("overwrite").parquet(f"{folder}/b c")
    last = same()
    assert last.gone == 1 and last.kept == 2
    assert same().read == []                                # a file without rows is known too
    assert MetricState(spark, state.path).refresh(build_plan({"t": spark.read.schema(kind).parquet(f"{folder}/a")}, m)[0], folder).read == []


# --- ledger and append ---------------------------------------------------------------


def test_ledger_skips_only_what_is_loaded_and_unchanged(spark, tmp_path):
    kind = struct(("id", LONG), ("x", TEXT))
    m = Manifest([TableSpec(n, kind, primary_key=("id",)) for n in "abc"])
    for n in "abc":
        spark.createDataFrame([(k, n) for k in range(5)] + ([(1, "twice")] if n == "c" else []), kind).coalesce(1).write.parquet(f"{tmp_path}/src/{n}")
    source = lambda: {n: spark.read.parquet(f"{tmp_path}/src/{n}") for n in "abc"}
    sink, ledger = ParquetSink(spark, f"{tmp_path}/dst"), RunLedger(spark, f"{tmp_path}/ledger")
    with pytest.raises(LoadError, match="table c"):
        load(spark, source(), m, sink, parallelism=1, ledger=ledger)
    spark.createDataFrame([(k, "c") for k in range(7)], kind).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/src/c")
    spark.catalog.clearCache()
    run = load(spark, source(), m, sink, parallelism=1, ledger=ledger)
    assert run.skipped == ("a", "b") and run.counts == {"a": 5, "b": 5, "c": 7}
    assert load(spark, source(), m, sink, ledger=ledger).skipped == ("a", "b", "c")
    # another input, another plan over it, a target that lost rows, other rules
    spark.createDataFrame([(9, "new")], kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/src/a")
    changed = dict(source(), b=source()["b"].where("id < 3"))
    run = load(spark, changed, m, sink, ledger=ledger)
    assert run.skipped == ("c",) and run.counts == {"a": 6, "b": 3, "c": 7}
    spark.createDataFrame([(1, "c")], kind).write.mode("overwrite").parquet(f"{tmp_path}/dst/c")
    assert load(spark, changed, m, sink, ledger=ledger).skipped == ("a", "b")
    strict = Manifest([m["a"], m["b"], TableSpec("c", kind, primary_key=("id",), max_len={"x": 9})])
    assert load(spark, changed, strict, sink, ledger=ledger).skipped == ("a", "b")
    # rows that stem from no file are loaded each time
    memory = dict(changed, a=spark.createDataFrame([(1, "z")], kind))
    for _ in range(2):
        assert load(spark, memory, strict, sink, ledger=ledger).skipped == ("b", "c")


def test_append_moves_files_and_takes_them_back(spark, tmp_path, monkeypatch):
    kind = struct(("id", LONG))
    m = Manifest([TableSpec("t", kind, primary_key=("id",))])
    sink = ParquetSink(spark, str(tmp_path))
    load(spark, {"t": spark.range(10)}, m, sink)
    before = {f.name for f in (tmp_path / "t").glob("*.parquet")}
    load(spark, {"t": spark.range(10, 30).repartition(3)}, m, sink, mode="append")
    assert sink.read("t").count() == 30
    assert before <= {f.name for f in (tmp_path / "t").glob("*.parquet")}
    moves, moved = [], sink._moved
    monkeypatch.setattr(sink, "_moved", lambda a, b: moves.append(1) or (len(moves) < 3 and moved(a, b)))
    with pytest.raises(LoadError, match="as it was"):
        load(spark, {"t": spark.range(30, 60).repartition(4)}, m, sink, mode="append")
    assert sink.read("t").count() == 30 and not list((tmp_path / "_staging").glob("*"))


# --- keyed stream --------------------------------------------------------------------


def test_keyed_stream_refuses_repeats_across_batches_and_restarts(spark):
    from ferry.streaming.load import start_keyed_stream_load

    kind = T.StructType([T.StructField("a", LONG), T.StructField("b", TEXT), T.StructField("v", TEXT)])
    spec = TableSpec("t", kind, primary_key=("a", "b"))
    src, sink, refused, ckpt = (fresh_dir(spark, f"ks-{x}") for x in ("src", "sink", "refused", "ckpt"))

    def run(rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(src)
        start_keyed_stream_load(spark, src, spec, sink, refused, ckpt, max_files_per_trigger=1, available_now=True).awaitTermination(120)

    run([(1, "x", "first"), (2, "x", "p"), (2, "x", "o"), (None, "x", "q")])
    run([(3, "y", "")])
    run([(4, "y", "")])
    run([(1, "x", "late"), (5, "z", ""), (2, "x", "o"), (2, "x", "o"), (5, None, "")])
    assert {tuple(x) for x in spark.read.parquet(sink).select("a", "b", "v").collect()} == {(1, "x", "first"), (2, "x", "o"), (3, "y", ""), (4, "y", ""), (5, "z", "")}
    got = sorted(tuple(x) for x in spark.read.parquet(refused).select("batch_id", "key", "reason", "n_rows").collect())
    assert got == sorted([(0, "2,x", "same batch", 1), (0, "null,x", "null key", 1), (3, "1,x", "earlier batch", 1), (3, "2,x", "earlier batch", 2), (3, "5,null", "null key", 1)])
    # a batch that is repeated replaces what its first attempt left
    before = spark.read.parquet(sink).count()
    q = start_keyed_stream_load(spark, src, spec, sink, refused, ckpt, max_files_per_trigger=1, available_now=True)
    q.awaitTermination(60)
    assert spark.read.parquet(sink).count() == before


# --- JSON ----------------------------------------------------------------------------


def test_json_columns_pair_by_meaning(spark):
    same = [('{"a": 1, "b": [1.50, {"y": null, "x": "é"}]}', '{"b":[1.5,{"x":"\\u00e9","y":null}],"a":1.0}'), ("[]", " [ ] "), (None, None), ("bad", "bad"), ('{"a":1,"a":2}', '{"a":1,"a":2}')]
    other = [('{"a": 1}', '{"a": 2}'), ('{"a": 1}', '{"a": "1"}'), ("[1, 2]", "[2, 1]"), ('{"a": null}', "{}"), ("bad", "bad "), (None, "null"),
             ('{"n": 123456789012345678901234567890123456789012}', '{"n": 123456789012345678901234567890123456789013}'), ("1e5", "1e6")]
    kind = struct(("id", LONG), ("j", TEXT))
    rows = [*same, *other]
    s, t = (spark.createDataFrame([(k, x[i]) for k, x in enumerate(rows)], kind) for i in (0, 1))
    m = Manifest([TableSpec("t", kind, primary_key=("id",), logical={"j": "json"})])
    got = string_parity(spark, {"t": s}, {"t": t}, m).first()
    assert (got.column_name, got.paired, got.identical, got.status) == ("j", len(rows), len(same), "DIFF")
    forms = [x[0] for x in s.select(canonical_json("j")).collect()], [x[0] for x in t.select(canonical_json("j")).collect()]
    assert [a == b for a, b in zip(*forms)] == [True] * len(same) + [False] * len(other)
