"""Pairing on conformed values, fingerprints, the digest tree and damage classes."""

import random
import uuid
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry import Manifest, ParquetSink, TableSpec, migrate, reconcile
from ferry.operators.damage import damage_summary, table_damage
from ferry.operators.fingerprint import ROW, fingerprints
from ferry.operators.parity import string_parity
from ferry.operators.tree import descend, key_bounds, node_digests, range_of, tree_differences, tree_parity

TEXT, LONG = T.StringType(), T.LongType()


def struct(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


# --- conformed pairing ---------------------------------------------------------------


@pytest.mark.parametrize("form", ["bytes", "upper", "braces"])
def test_uuid_key_in_any_form_migrates_and_verifies(spark, tmp_path, form):
    ids = [uuid.UUID(int=k * 7919 + 1) for k in range(20)]
    spell = {"bytes": lambda u: bytearray(u.bytes_le), "upper": lambda u: str(u).upper(), "braces": lambda u: "{" + str(u) + "}"}[form]
    kind = T.BinaryType() if form == "bytes" else TEXT
    source = spark.createDataFrame([(spell(u), f"token {k}") for k, u in enumerate(ids)], struct(("id", kind), ("token", TEXT)))
    m = Manifest([TableSpec("api", struct(("id", TEXT), ("token", TEXT)), primary_key=("id",), logical={"id": "uuid"})])
    sink = ParquetSink(spark, str(tmp_path))
    run = migrate(spark, {"api": source}, m, sink).reconciliation
    assert run.passed() and run.parity.first()["paired"] == 20
    changed = sink.read("api").withColumn("token", F.when(F.col("id") == str(ids[3]), "x").otherwise(F.col("token")))
    again = reconcile(spark, {"api": source}, {"api": changed}, m)
    row = again.parity.first()
    assert (row.paired, row.identical, row.status) == (20, 19, "DIFF") and not again.passed()


def test_numbers_and_dates_that_the_target_keeps_as_text(spark, tmp_path):
    source = spark.createDataFrame([(k, k * 3, date(2024, 1, k + 1), Decimal(k).scaleb(-2)) for k in range(9)],
                                   struct(("id", LONG), ("code", LONG), ("day", T.DateType()), ("price", T.DecimalType(12, 2))))
    m = Manifest([TableSpec("p", struct(("id", LONG), ("code", TEXT), ("day", TEXT), ("price", TEXT)), primary_key=("id",))])
    sink = ParquetSink(spark, str(tmp_path))
    assert migrate(spark, {"p": source}, m, sink).reconciliation.passed()
    other = sink.read("p").withColumn("day", F.when(F.col("id") == 4, "2024-01-06").otherwise(F.col("day")))
    got = {x.column_name: (x.identical, x.status) for x in reconcile(spark, {"p": source}, {"p": other}, m).parity.collect()}
    assert got == {"code": (9, "OK"), "day": (8, "DIFF"), "price": (9, "OK")}


def test_key_range_of_a_text_key_is_the_integers(spark):
    source = spark.createDataFrame([(str(k),) for k in range(7, 20)], "id string")
    target = source.select(F.col("id").cast("bigint").alias("id"))
    r = reconcile(spark, {"p": source}, {"p": target}, Manifest([TableSpec("p", target.schema, primary_key=("id",))]))
    assert r.passed() and r.table_summary.first()["key_range"] == "id=7..19"
    bad = source.union(spark.createDataFrame([("x1",)], "id string"))
    assert not reconcile(spark, {"p": bad}, {"p": target}, Manifest([TableSpec("p", target.schema, primary_key=("id",))])).passed()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_wider_than_38_digits(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        kind = struct(("id", LONG), ("v", T.DecimalType(38, 3)))
        big = Decimal("9" * 35 + ".999")
        rows = [(k, big if k % 3 else Decimal(f"-{k}{'0' * 20}.125")) for k in range(300)]
        s = spark.createDataFrame(rows, kind)
        m = Manifest([TableSpec("p", kind, primary_key=("id",))])
        assert reconcile(spark, {"p": s}, {"p": s}, m).passed()
        rows[5] = (5, Decimal("9" * 35 + ".998"))
        t = spark.createDataFrame(rows, kind)
        found = reconcile(spark, {"p": s}, {"p": t}, m).mismatches.collect()
        assert [(x.metric, x.reason) for x in found] == [("sum:v", "diff=0.001")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


# --- fingerprints --------------------------------------------------------------------

KIND = struct(("id", LONG), ("d", T.DoubleType()), ("f", T.BooleanType()), ("t", T.TimestampType()), ("a", T.ArrayType(T.FloatType())),
              ("x", TEXT), ("y", TEXT))
ROWS = [(k, k / 3, k % 2 == 0, datetime(2024, 1, 1, 0, 0, k), [k / 7, 1.0], f"x{k}" if k % 5 else None, "" if k % 7 else None) for k in range(40)]


def prints(spark, s, t, key=("id",), kind=KIND):
    got = fingerprints(spark, {"p": s}, {"p": t}, Manifest([TableSpec("p", kind, primary_key=key)]))
    return {x.column_name for x in got.collect() if x.status == "DIFF"}


def test_fingerprints_see_every_type_and_no_order(spark):
    s = spark.createDataFrame(ROWS, KIND)
    assert prints(spark, s, s.orderBy(F.desc("id")).repartition(5)) == set()
    for column, new in (("d", "d + 1e-9"), ("f", "not f"), ("t", "t + interval 1 microsecond"), ("a", "array(a[1], a[0])"), ("x", "coalesce(x, '')")):
        t = s.withColumn(column, F.when(F.col("id") == 10, F.expr(new)).otherwise(F.col(column)))
        assert prints(spark, s, t) == {ROW, column}, column
    # the null moves from one column to the other
    moved = s.withColumns({"x": F.when(F.col("id") == 7, F.lit(None)).otherwise(F.col("x")), "y": F.when(F.col("id") == 7, F.col("x")).otherwise(F.col("y"))})
    assert prints(spark, s, moved) == {ROW, "x", "y"}


def test_swapped_and_repeated_rows_differ(spark):
    s = spark.createDataFrame(ROWS, KIND)
    swap = F.when(F.col("id") == 2, F.lit(ROWS[3][1])).when(F.col("id") == 3, F.lit(ROWS[2][1])).otherwise(F.col("d"))
    assert prints(spark, s, s.withColumn("d", swap)) == {ROW, "d"}
    # without a key a column is a multiset, and only whole rows show the swap
    assert prints(spark, s, s.withColumn("d", swap), key=()) == {ROW}
    twice = spark.createDataFrame(ROWS[:2] * 2, KIND), spark.createDataFrame([ROWS[0]] * 3 + [ROWS[1]], KIND)
    assert ROW in prints(spark, *twice, key=())


def test_verdict_with_row_fingerprints(spark):
    s = spark.createDataFrame(ROWS, KIND)
    m = Manifest([TableSpec("p", KIND, primary_key=("id",))])
    t = s.withColumn("d", F.when(F.col("id") == 2, F.lit(ROWS[3][1])).when(F.col("id") == 3, F.lit(ROWS[2][1])).otherwise(F.col("d")))
    assert reconcile(spark, {"p": s}, {"p": t}, m).passed()
    r = reconcile(spark, {"p": s}, {"p": t}, m, rows=True)
    assert not r.passed() and {x.column_name for x in r.fingerprints.collect() if x.status == "DIFF"} == {ROW, "d"}
    assert reconcile(spark, {"p": s}, {"p": s}, m, rows=True).passed()
    broken = reconcile(spark, {"p": s}, {"p": s.drop("f")}, m, rows=True)
    assert not broken.passed() and [x.status for x in broken.fingerprints.collect()] == ["ERROR"]


def test_equal_values_in_other_forms_are_equal(spark):
    kind = struct(("id", TEXT), ("d", T.DoubleType()), ("n", T.DecimalType(12, 2)))
    u = uuid.uuid4()
    s = spark.createDataFrame([(bytearray(u.bytes_le), -0.0, 1), (bytearray(uuid.UUID(int=1).bytes_le), float("nan"), None)],
                              struct(("id", T.BinaryType()), ("d", T.DoubleType()), ("n", LONG)))
    t = spark.createDataFrame([(str(uuid.UUID(int=1)), float("nan"), None), (str(u), 0.0, Decimal("1.00"))], kind)
    got = fingerprints(spark, {"p": s}, {"p": t}, Manifest([TableSpec("p", kind, primary_key=("id",), logical={"id": "uuid"})]))
    assert {x.status for x in got.collect()} == {"OK"}


def test_fingerprint_moves_one_row_per_task(spark, sf001):
    from test_plans import plan_text

    s, t, m = sf001
    p = plan_text(fingerprints(spark, s, t, m, tables=["lineitem"]))
    assert "hashpartitioning" not in p and "Exchange SinglePartition" in p and "partial_sum" in p


# --- digest tree ---------------------------------------------------------------------


def parity_rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("kind", ["long", "text", "pair", "sparse"])
def test_tree_equals_full_parity(spark, kind):
    r = random.Random(kind)
    key = {"long": lambda k: (k,), "text": lambda k: (f"k-{k * 7919 % 1000:04d}é",), "pair": lambda k: (k // 40, k % 40),
           "sparse": lambda k: (k if k < 500 else 10**15 + k * k,)}[kind]
    types = {"long": [LONG], "text": [TEXT], "pair": [LONG, T.IntegerType()], "sparse": [LONG]}[kind]
    fields = [(f"k{i}", t) for i, t in enumerate(types)]
    schema = struct(*fields, ("x", TEXT), ("y", TEXT))
    rows = [(*key(k), f"text {k}", None if k % 9 == 0 else "y") for k in range(1000)]
    changed = []
    for row in rows:
        u = r.random()
        if u < 0.01:
            continue
        changed.append((*row[:-2], row[-2] + "!" if u < 0.02 else row[-2], "z" if u > 0.99 else row[-1]))
    changed += [(*[None] * len(types), "no key", None)]
    changed += [(*((x + "x" if isinstance(x, str) else -x - 1) for x in key(3)), "new", None)]
    s, t = spark.createDataFrame(rows, schema), spark.createDataFrame(changed, schema)
    m = Manifest([TableSpec("p", schema, primary_key=tuple(f for f, _ in fields))])
    assert parity_rows(tree_parity(spark, {"p": s}, {"p": t}, m, coarse=8, fine=8)) == parity_rows(string_parity(spark, {"p": s}, {"p": t}, m))
    assert parity_rows(tree_parity(spark, {"p": s}, {"p": s}, m, coarse=8, fine=8)) == parity_rows(string_parity(spark, {"p": s}, {"p": s}, m))
    a, b = ({x[:-2]: x[-2:] for x in side if x[0] is not None} for side in (rows, changed))
    want = Counter()
    for k in set(a) | set(b):
        if a.get(k) != b.get(k):
            want[",".join(map(str, k)), "only_target" if k not in a else "only_source" if k not in b else "differs"] += 1
    want[",".join(["null"] * len(types)), "only_target"] += 1
    assert Counter((x.key, x.state) for x in tree_differences(spark, {"p": s}, {"p": t}, m, coarse=8, fine=8).collect()) == want


def test_tree_of_small_and_empty_tables(spark):
    schema = struct(("k", LONG), ("x", TEXT))
    m = Manifest([TableSpec("p", schema, primary_key=("k",))])
    frames = [spark.createDataFrame(rows, schema) for rows in ([], [(1, "a")], [(1, "b")], [(None, "a")], [(1, "a"), (2, "b"), (3, None)])]
    for s in frames:
        for t in frames:
            assert parity_rows(tree_parity(spark, {"p": s}, {"p": t}, m)) == parity_rows(string_parity(spark, {"p": s}, {"p": t}, m))


def test_ranges_hold_every_key_and_are_even(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id")).alias("k"))
    bounds = key_bounds(df, ["k"], 64)
    assert bounds == sorted(set(bounds)) and len(bounds) == 63
    coarse, leaf = range_of(df, ["k"], bounds, 8)
    rows = df.select("k", coarse.alias("c"), leaf.alias("l")).collect()
    for x in rows:
        assert x.l == sum(b[0] <= x.k for b in bounds) and x.c == x.l // 8
    held = Counter(x.l for x in rows)
    assert len(held) == 64 and max(held.values()) < 4 * 5000 / 64


def test_equal_ranges_never_shuffle_a_row(spark, sf001):
    """The digests of a range are combined before they move, and a pass reads the text of
    differing key ranges only."""
    from test_plans import plan_text

    s, t, m = sf001
    src = s["documents"].select("doc_id", "text")
    bounds = key_bounds(src, ["doc_id"], 64)
    p = plan_text(node_digests(src, src, ["doc_id", "text"], [range_of(src, ["doc_id"], bounds, 8)[0]] * 2))
    assert p.count("Exchange hashpartitioning(node") == 1 and p.index("Exchange") < p.rindex("partial_sum")
    same = descend(src, src, ["doc_id"], ["text"])
    assert same.nodes == [] and same.equal_rows == src.count() and same.source.isEmpty()
    one = src.withColumn("text", F.when(F.col("doc_id") == 500, "x").otherwise(F.col("text")))
    tree = descend(src, one, ["doc_id"], ["text"])
    assert [x[0] for x in tree.nodes] == [0, 1] and tree.source.count() < 20
    assert "PushedFilters: [Or" in plan_text(tree.source) or "GreaterThanOrEqual(doc_id" in plan_text(tree.source)


# --- damage --------------------------------------------------------------------------


def test_damage_classes(spark):
    r = random.Random(6)
    letters = "abc éñüß¿ €“” Жя 日本 😀 Ã Â ©"
    rows, want = [], {}

    def twice(x, page):
        return "".join(chr(b) if page == "latin-1" else bytes([b]).decode("cp1252", "ignore") or chr(b) for b in x.encode())

    for k in range(400):
        text = "".join(r.choice(letters) for _ in range(r.randrange(1, 60)))
        kind = r.choice(["latin-1", "cp1252", "cut", "none", "filled", "other", "same", "partly"])
        if kind in ("latin-1", "cp1252", "partly"):  # marks that read as bytes themselves would be decoded too
            text = text.translate(dict.fromkeys(map(ord, "ÃÂ" + "¿©€“”" * (kind == "partly")))) + "é"
        source, target = text, text
        if kind in ("latin-1", "cp1252"):
            target = twice(text, kind)
            want[k] = "double_encoded"
        elif kind == "partly":
            target = text.replace("é", "Ã©")
            want[k] = "double_encoded"
        elif kind == "cut":
            target = text[: r.randrange(len(text))]
            want[k] = "truncated"
        elif kind == "none":
            target, want[k] = None, "nulled"
        elif kind == "filled":
            source, want[k] = None, "filled"
        elif kind == "other":
            at = r.randrange(len(text))
            target, want[k] = text[:at] + "#" + text[at + 1 :], "other"
        rows.append((k, source, target))
    kind = struct(("id", LONG), ("x", TEXT))
    s, t = (spark.createDataFrame([(x[0], x[i]) for x in rows], kind) for i in (1, 2))
    got = table_damage("p", s, t, TableSpec("p", kind, primary_key=("id",))).collect()
    assert {int(x.key): x.damage for x in got} == want
    for x in got:
        _, a, b = rows[int(x.key)]
        if a is None or b is None:
            assert x.position is None and x.source_char is None and x.target_char is None
            continue
        at = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        shown = [f"U+{ord(y[at]):04X}" if at < len(y) else None for y in (a, b)]
        assert (x.position, x.source_char, x.target_char) == (at + 1, *shown)
    counts = damage_summary(spark.createDataFrame([tuple(x) for x in got], "table_name string, key string, column_name string, damage string, position bigint, source_char string, target_char string"))
    assert {x.damage: x.n_rows for x in counts.collect()} == Counter(want.values())


def test_damage_of_one_sided_repeated_and_null_keys_is_not_text_damage(spark):
    kind = struct(("id", LONG), ("x", TEXT))
    s = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (4, "e" * 50_000)], kind)
    t = spark.createDataFrame([(2, "z"), (3, "y"), (None, "w"), (4, "e" * 49_999 + "f")], kind)
    got = table_damage("p", s, t, TableSpec("p", kind, primary_key=("id",))).collect()
    assert [(x.key, x.damage, x.position) for x in got] == [("4", "other", 50_000)]
