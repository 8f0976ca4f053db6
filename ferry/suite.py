"""The registered checks: each takes (spark, sf_dir) and returns a DataFrame
computed by the library's operators over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import fixture, loadable, raw_tables, source_tables
from .functions.exprs import guid_from_le_bytes, guid_from_text
from .manifest import Manifest, spec_from_frame
from .operators import audit, damage, fingerprint, load as loadop, metric_state, subset, tree, views
from .operators.metrics import metrics_report
from .operators.transfer import migrate
from .operators.parity import string_parity, table_parity
from .operators.reconcile import Reconciliation, reconcile
from .plans.validation import build_plan
from .session import fresh_dir
from .sources import ranges
from .sources.tables import parquet_tables

# Fixed values of the fixture (see FIXTURES.md).
LINEITEM_CANDIDATE_KEY = ("l_orderkey", "l_linenumber")
SUBSET_REQUEST = ["customer", "orders", "no_such_table"]
DRIFTED_COLUMN = "o_totalprice"   # dropped from source orders by reconcile_source_error
WORD_SPLIT = r"[ \t\n\r\f]+"

def _reconciled(spark: SparkSession, sf_dir: str, identical: bool = False,
                strings: bool = True) -> Reconciliation:
    s, t, m = fixture(spark, sf_dir)
    return reconcile(spark, s, s if identical else t, m, strings=strings)


def source_metrics(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return metrics_report(s, build_plan(t, m))


def target_metrics(spark, sf_dir):
    """Target report; includes the emptied ``region`` (sum 0, ``(empty)``)."""
    s, t, m = fixture(spark, sf_dir)
    return metrics_report(t, build_plan(t, m))


def reconcile_detail(spark, sf_dir):
    return _reconciled(spark, sf_dir).detail


def reconcile_mismatches(spark, sf_dir):
    return _reconciled(spark, sf_dir).mismatches


def reconcile_table_summary(spark, sf_dir):
    return _reconciled(spark, sf_dir).table_summary


def reconcile_verdict(spark, sf_dir):
    return _reconciled(spark, sf_dir).verdict


def reconcile_metrics_verdict(spark, sf_dir):
    """Verdict with text parity switched off (metrics only)."""
    return _reconciled(spark, sf_dir, strings=False).verdict


def reconcile_source_error(spark, sf_dir):
    """Detail when one source table cannot be summed (its orders lost the
    o_totalprice column): that table's metrics are SOURCE_ERROR, every
    other table is compared as usual."""
    s, t, m = fixture(spark, sf_dir)
    drifted = dict(s, orders=s["orders"].drop(DRIFTED_COLUMN))
    return reconcile(spark, drifted, t, m, strings=False).detail


def migrate_and_verify(spark, sf_dir):
    """The whole run: load every test table into a fresh sink, read the
    written tables back as the target and reconcile them with the source."""
    s, m = loadable(spark, sf_dir)
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "migrate"))
    return migrate(spark, s, m, sink, tables=sorted(s)).reconciliation.verdict


def evidence_csv(spark, sf_dir):
    """The detail report written as CSV evidence and read back."""
    path = _reconciled(spark, sf_dir).write_evidence(fresh_dir(spark, "evidence"))
    return spark.read.option("header", True).schema(
        "table_name string, metric string, source_value string, target_value string, "
        "status string").csv(path)


def load_full_report(spark, sf_dir):
    """Load of every test table: rows per table and the total."""
    s, m = loadable(spark, sf_dir)
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "load-full"))
    return loadop.load(spark, s, m, sink, tables=sorted(s)).report


def load_refused_report(spark, sf_dir):
    """Every target table offered to a fresh sink under all its rules: the rules that
    refuse a table, with the rows (of keys: the keys) that break them."""
    s, t, m = fixture(spark, sf_dir)
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "load-refused"))
    rows = []
    for name in sorted(t):
        try:
            loadop.load(spark, t, m, sink, tables=[name])
        except loadop.LoadError as error:
            if not error.violations:
                raise
            rows += [(name, rule, column, n) for rule, column, n in error.violations]
    return spark.createDataFrame(rows, "table_name string, rule string, column_name string, n_violations bigint")


def load_binary_guids(spark, sf_dir):
    """Orders with a GUID column held as 16 bytes (the md5 of the key), loaded into a
    target whose column is a uuid, and read back."""
    orders = raw_tables(spark, sf_dir, ["orders"])["orders"].withColumn("guid", F.unhex(F.md5(F.col("o_orderkey").cast("string"))))
    spec = spec_from_frame("orders", orders.withColumn("guid", F.lit("")), primary_key=("o_orderkey",), logical={"guid": "uuid"})
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "load-guids"))
    loadop.load(spark, {"orders": orders}, Manifest([spec]), sink)
    return sink.read("orders").select("o_orderkey", "guid")


def _renamed(df):
    """``df`` with every column ``x`` named ``x.a:v``."""
    return df.toDF(*[f"{c}.a:v" for c in df.columns])


def reconcile_odd_names(spark, sf_dir):
    """Orders and their seeded target under column names with dots and colons, loaded,
    compared and paired."""
    s, t, m = fixture(spark, sf_dir)
    source, target = _renamed(s["orders"]), _renamed(t["orders"])
    manifest = Manifest([spec_from_frame("orders", source, primary_key=("o_orderkey.a:v",))])
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "odd-names"))
    loadop.load(spark, {"orders": target}, manifest, sink)
    r = reconcile(spark, {"orders": source}, {"orders": sink.read("orders")}, manifest)
    return r.table_summary


def reconcile_unreadable(spark, sf_dir):
    """Mismatches when one source folder does not exist: an error for that table, the
    others compared as usual. The error's wording is Spark's and left out."""
    s, t, m = fixture(spark, sf_dir)
    gone = parquet_tables(spark, f"{sf_dir}/no-such-folder", ["orders"])
    out = reconcile(spark, dict(s, **gone), t, m, strings=False).mismatches
    return out.withColumn("source_value", F.when(F.col("metric") == "ERROR", F.lit("(message)")).otherwise(F.col("source_value")))


def reconcile_wide_scale(spark, sf_dir):
    """Order totals at ten decimals, the target's off by one in the last place for every
    order: the difference is exact."""
    orders = raw_tables(spark, sf_dir, ["orders"])["orders"]
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("decimal(28,10)")
    source = orders.select("o_orderkey", total.alias("total"))
    target = orders.select("o_orderkey", (total + F.lit("0.0000000001").cast("decimal(28,10)")).cast("decimal(28,10)").alias("total"))
    manifest = Manifest([spec_from_frame("orders", source, primary_key=("o_orderkey",))])
    return reconcile(spark, {"orders": source}, {"orders": target}, manifest).mismatches


def text_key_parity(spark, sf_dir):
    """Customers keyed by name, their only text, against the seeded target: damaged names
    pair with nothing."""
    s, t, m = fixture(spark, sf_dir)
    source, target = (x["customer"].select("c_name", "c_acctbal") for x in (s, t))
    manifest = Manifest([spec_from_frame("customer", source, primary_key=("c_name",))])
    return string_parity(spark, {"customer": source, "labels": s["labels"]}, {"customer": target, "labels": s["labels"]}, manifest)


def stream_load_orders(spark, sf_dir):
    """Incremental copy of the orders files (written as four files), one
    file per micro-batch."""
    from .streaming.load import start_stream_load
    s, t, m = fixture(spark, sf_dir)
    raw = raw_tables(spark, sf_dir, ["orders"])["orders"]
    src_dir, sink_dir = fresh_dir(spark, "stream-src"), fresh_dir(spark, "stream-sink")
    raw.repartition(4).write.parquet(src_dir)
    q = start_stream_load(spark, src_dir, m["orders"], sink_dir, fresh_dir(spark, "stream-ckpt"),
                          source_schema=raw.schema, max_files_per_trigger=1, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(sink_dir)


def guid_text_canonical(spark, sf_dir):
    """Each order key's GUID spelled in upper case with braces, rendered
    canonically by the text branch of the GUID conversion."""
    orders = raw_tables(spark, sf_dir, ["orders"])["orders"]
    spelled = F.concat(F.lit("{"), F.upper(guid_from_le_bytes(
        F.unhex(F.md5(F.col("o_orderkey").cast("string"))))), F.lit("}"))
    return orders.select("o_orderkey", guid_from_text(spelled).alias("guid"))


def column_audit(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return audit.column_audit(spark, t, m)


def reconcile_identical(spark, sf_dir):
    return _reconciled(spark, sf_dir, identical=True).verdict


def string_parity_all(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return string_parity(spark, s, t, m)


def string_parity_raw(spark, sf_dir):
    """Text parity comparing raw text bytes instead of digests."""
    s, t, m = fixture(spark, sf_dir)
    return string_parity(spark, s, t, m, digest=False)


def string_parity_skipped(spark, sf_dir):
    """Pairing lineitem on its non-unique candidate key must be SKIPPED."""
    s, t, m = fixture(spark, sf_dir)
    key = list(LINEITEM_CANDIDATE_KEY)
    cols = [c for c in m["lineitem"].text_columns() if c not in key]
    return table_parity(spark, "lineitem", s["lineitem"], t["lineitem"], key, cols)


def load_conform(spark, sf_dir):
    """Raw customer projected to the target order and cast to target types."""
    s, t, m = fixture(spark, sf_dir)
    raw = raw_tables(spark, sf_dir, ["customer"])["customer"]
    spec = m["customer"]
    return loadop.conform(loadop.project(raw, spec), spec)


def load_subset_report(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "load-subset"))
    return loadop.load(spark, s, m, sink, tables=SUBSET_REQUEST).report


def load_append_conflicts(spark, sf_dir):
    """Target orders are loaded, then source orders are checked for append."""
    s, t, m = fixture(spark, sf_dir)
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "load-append"))
    loadop.load(spark, t, m, sink, tables=["orders"])
    incoming = loadop.conform(loadop.project(s["orders"], m["orders"]), m["orders"])
    return loadop.append_conflicts(incoming, sink.read("orders"), m["orders"].primary_key)


def load_roundtrip(spark, sf_dir):
    """Documents written by ``load`` and read back: md5 of every text."""
    s, t, m = fixture(spark, sf_dir)
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "load-roundtrip"))
    loadop.load(spark, s, loadable(spark, sf_dir)[1], sink, tables=["documents"])
    back = sink.read("documents")
    return back.select("doc_id", F.md5("text").alias("text_md5"),
                       F.char_length("text").cast("bigint").alias("text_chars"), "lang", "source", "n_chars")


def identity_high_water(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return loadop.identity_high_water(spark, t, m)


def guid_canonical(spark, sf_dir):
    """Each order key's md5 read as 16 GUID bytes, rendered canonically."""
    orders = raw_tables(spark, sf_dir, ["orders"])["orders"]
    raw = F.unhex(F.md5(F.col("o_orderkey").cast("string")))
    return orders.select("o_orderkey", guid_from_le_bytes(raw).alias("guid"))


def supplier_catalog(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    cat = views.catalog_view(s["supplier"], s["nation"], "s_nationkey", "n_nationkey",
                             ["s_suppkey", "s_name", "s_acctbal"], {"n_name": "n_name"})
    views.register_views(spark, {"supplier_catalog": cat})
    return spark.table("supplier_catalog")


def customer_order_totals(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    tot = views.totals_view(s["customer"], t["orders"], "c_custkey", "o_custkey",
                            ["c_custkey", "c_name"], "o_orderkey", "o_totalprice")
    return tot.withColumn("total_spent", F.col("total_spent").cast("string"))


def pk_audit(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return audit.pk_audit(spark, t, m, keys={"lineitem": LINEITEM_CANDIDATE_KEY})


def unique_audit(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return audit.unique_audit(spark, t, m, collation=None)


def unique_ci_audit(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return audit.unique_audit(spark, t, m, collation="UNICODE_CI")


def fk_audit(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return audit.fk_audit(spark, t, m)


def not_null_audit(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return audit.not_null_audit(spark, t, m)


def length_audit(spark, sf_dir):
    s, t, m = fixture(spark, sf_dir)
    return audit.length_audit(spark, t, m)


def locale_order(spark, sf_dir):
    """Every distinct word of every document, with its place in the Spanish order among
    the words of its length."""
    docs = source_tables(spark, sf_dir)["documents"]
    words = (docs.select(F.explode(F.split("text", WORD_SPLIT)).alias("word"))
             .where(F.col("word") != "").distinct())
    return views.locale_rank(words, "word", F.char_length("word"), "es").select(
        "word", F.col("group_key").cast("long").alias("word_length"), F.col("place").cast("long").alias("place"))


def _keyed_by_guid(spark, sf_dir):
    """(source, target, manifest) of orders under a uuid key that the source holds as 16
    bytes in one table and in braces and capitals in another, with a date, a number and a
    decimal that the target keeps as text; of every 101st order the target's text is cut."""
    orders = raw_tables(spark, sf_dir, ["orders"])["orders"]
    raw = F.unhex(F.md5(F.col("o_orderkey").cast("string")))
    spelled = F.concat(F.lit("{"), F.upper(guid_from_le_bytes(raw)), F.lit("}"))
    columns = ["guid", F.col("o_orderdate").cast("date").alias("day"), F.col("o_custkey").alias("customer"),
               F.col("o_totalprice").cast("decimal(12,2)").alias("total"), F.col("o_orderpriority").alias("priority"), "o_orderkey"]
    source = {"orders_bytes": orders.withColumn("guid", raw).select(*columns), "orders_spelled": orders.withColumn("guid", spelled).select(*columns)}
    texts = {c: F.col(c).cast("string") for c in ("day", "customer", "total")}
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "guid-keys"))
    manifest = Manifest(spec_from_frame(n, df.withColumn("guid", F.lit("")).withColumns(texts), primary_key=("guid",), logical={"guid": "uuid"})
                        for n, df in source.items())
    loadop.load(spark, source, manifest, sink)
    cut = F.when(F.col("o_orderkey") % 101 == 7, F.substring("priority", 1, 2)).otherwise(F.col("priority"))
    return source, {n: sink.read(n).withColumn("priority", cut) for n in source}, manifest


def uuid_key_parity(spark, sf_dir):
    """Text parity of tables that load converted: uuid keys and rendered texts pair."""
    source, target, manifest = _keyed_by_guid(spark, sf_dir)
    return string_parity(spark, source, target, manifest)


def text_key_range(spark, sf_dir):
    """Orders whose key the source holds as text and the target as an integer."""
    s, t, m = fixture(spark, sf_dir)
    source = s["orders"].withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    return reconcile(spark, {"orders": source}, {"orders": s["orders"]}, Manifest([m["orders"]])).table_summary


def tree_parity(spark, sf_dir):
    """Text parity by the digest tree: the same rows as ``string_parity``."""
    s, t, m = fixture(spark, sf_dir)
    return tree.tree_parity(spark, s, t, m)


def tree_differences(spark, sf_dir):
    """Every key that one side lacks or whose texts differ, from differing ranges only."""
    s, t, m = fixture(spark, sf_dir)
    return tree.tree_differences(spark, s, t, m).withColumn("columns", F.array_join("columns", ","))


def row_fingerprints(spark, sf_dir):
    """Whole rows and single columns of every common table, doubles and times included."""
    s, t, m = fixture(spark, sf_dir)
    return fingerprint.fingerprints(spark, s, t, m)


def reconcile_rows_verdict(spark, sf_dir):
    """Verdict where only a double of the events differs: sums and texts agree, the rows'
    fingerprints don't."""
    s, t, m = fixture(spark, sf_dir)
    target = dict(s, events=s["events"].withColumn("value", F.when(F.col("event_id") % 101 == 7, F.col("value") + 1).otherwise(F.col("value"))))
    plain, whole = (reconcile(spark, s, target, m, strings=False, rows=rows).verdict for rows in (False, True))
    return plain.withColumn("rows", F.lit(False)).unionByName(whole.withColumn("rows", F.lit(True)))


def text_damage(spark, sf_dir):
    """Every differing text, its class of damage and where it begins."""
    s, t, m = fixture(spark, sf_dir)
    return damage.text_damage(spark, s, t, m)


def text_damage_summary(spark, sf_dir):
    """Differing texts by table, column and class of damage."""
    s, t, m = fixture(spark, sf_dir)
    return damage.damage_summary(damage.text_damage(spark, s, t, m))


def reconcile_wide_sums(spark, sf_dir):
    """Order totals times 10 ** 20, whose sum passes 38 digits; the target's is one unit
    more in one order."""
    orders = raw_tables(spark, sf_dir, ["orders"])["orders"]
    total = F.concat(F.col("o_totalprice").cast("decimal(12,2)").cast("decimal(14,2)").cast("string"), F.lit("00000000000000000000000")).cast("string")
    wide = F.replace(total, F.lit("."), F.lit("")).cast("decimal(38,0)")
    source = orders.select("o_orderkey", wide.alias("total"), wide.alias("same"))
    one = F.when(F.col("o_orderkey") == 7, 1).otherwise(0).cast("decimal(38,0)")
    target = source.withColumn("total", (F.col("total") + one).cast("decimal(38,0)"))
    manifest = Manifest([spec_from_frame("orders", source, primary_key=("o_orderkey",))])
    return reconcile(spark, {"orders": source}, {"orders": target}, manifest, strings=False).detail


def locale_places(spark, sf_dir):
    """Every distinct word of every document, with its place in the Spanish order of all."""
    docs = source_tables(spark, sf_dir)["documents"]
    words = docs.select(F.explode(F.split("text", WORD_SPLIT)).alias("word")).where(F.col("word") != "").distinct()
    return views.locale_places(words, "word", "es")


def key_ranges(spark, sf_dir):
    """Reads of orders (integer keys, and uuids), documents and conversations (two columns)
    split into ranges of equal depth."""
    raw = raw_tables(spark, sf_dir, ["orders", "documents", "conversations"])
    guids = raw["orders"].select(guid_from_le_bytes(F.unhex(F.md5(F.col("o_orderkey").cast("string")))).alias("guid"))
    parts = [("orders", raw["orders"], ["o_orderkey"], 1000), ("orders_guid", guids, ["guid"], 700), ("documents", raw["documents"], ["doc_id"], 64),
             ("conversations", raw["conversations"], ["conv_id", "turn"], 100)]

    def shown(c):
        return F.array_join(F.expr(f"array({', '.join(f'cast({c}.k{i} as string)' for i in range(width))})"), ",").alias(c)

    out = None
    for name, df, key, batch in parts:
        width = len(key)
        one = ranges.key_ranges(df, key, batch).select(F.lit(name).alias("table_name"), "ordinal", shown("low"), shown("high"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def read_by_ranges(spark, sf_dir):
    """Orders read range by range through the predicates of their uuid key: rows a range."""
    orders = raw_tables(spark, sf_dir, ["orders"])["orders"]
    orders = orders.withColumn("guid", guid_from_le_bytes(F.unhex(F.md5(F.col("o_orderkey").cast("string")))))
    parts = ranges.key_ranges(orders, ["guid"], 500).checkpoint()
    predicates = ranges.range_predicates(parts, ["guid"], quote="`")
    rows = ranges.in_ranges(orders.select("guid", "o_orderkey"), parts, ["guid"]).where(F.col("ordinal") < len(predicates))
    return rows.groupBy("ordinal").agg(F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("keys"))


#: What the subset begins with.
SUBSET_SEEDS = {"lineitem": "l_orderkey % 97 = 5 AND l_linenumber = 1", "labels": "doc_id % 10 = 3", "events": "event_id % 211 = 7"}


def closed_subset(spark, sf_dir):
    """Rows and orphans of a subset that is closed under the foreign keys."""
    s, m = loadable(spark, sf_dir)
    part = subset.closed_subset(spark, s, m, SUBSET_SEEDS)
    rows = None
    for n in sorted(part):
        one = part[n].select(F.lit(n).alias("table_name"), F.xxhash64(*[F.col(c) for c in m[n].primary_key or ["l_orderkey", "l_linenumber"]]).alias("x"))
        rows = one if rows is None else rows.unionByName(one)
    orphans = audit.fk_audit(spark, part, Manifest([m[n] for n in part])).groupBy(F.col("child").alias("table_name")).agg(F.sum("orphans").alias("orphans"))
    return rows.groupBy("table_name").agg(F.count("*").alias("n_rows")).join(orphans, "table_name", "left").withColumn("orphans", F.coalesce("orphans", F.lit(0)))


def metrics_incremental(spark, sf_dir):
    """Metrics of orders kept file by file: the report after a fifth file (the target's
    first thousand keys) joined four, and the files that this second refresh read."""
    s, t, m = fixture(spark, sf_dir)
    folder, state = fresh_dir(spark, "metric-src"), metric_state.MetricState(spark, fresh_dir(spark, "metric-state"))
    plan = [p for p in build_plan(t, m) if p.table == "orders"][0]
    s["orders"].repartition(4).write.parquet(folder)
    state.refresh(plan, folder)
    t["orders"].where("o_orderkey < 1000").coalesce(1).write.mode("append").parquet(folder)
    last = state.refresh(plan, folder)
    return last.report.withColumn("files_read", F.lit(len(last.read)).cast("bigint")).withColumn("files_kept", F.lit(last.kept).cast("bigint"))


def load_resumed(spark, sf_dir):
    """A load that a bad table ended, run again with its ledger after the mend: what was
    loaded the first time is left alone."""
    s, m = loadable(spark, sf_dir)
    names = ["customer", "orders", "nation"]
    sink = loadop.ParquetSink(spark, fresh_dir(spark, "load-resumed"))
    ledger = loadop.RunLedger(spark, fresh_dir(spark, "load-ledger"))
    bad = dict(s, orders=s["orders"].unionByName(s["orders"].where("o_orderkey < 100")))
    try:
        loadop.load(spark, bad, m, sink, tables=names, parallelism=1, ledger=ledger)
        raise AssertionError("the repeated keys were loaded")
    except loadop.LoadError as error:
        refused = error.table
    result = loadop.load(spark, s, m, sink, tables=names, parallelism=1, ledger=ledger)
    return result.report.withColumn("skipped", F.col("table_name").isin(list(result.skipped))).withColumn("refused_before", F.col("table_name") == refused)


def stream_keyed_orders(spark, sf_dir):
    """Orders in four files and a fifth that repeats some of their keys, copied file by
    file with the key held: the refused rows, and the accepted rows as one."""
    from .streaming.load import start_keyed_stream_load
    s, t, m = fixture(spark, sf_dir)
    raw = raw_tables(spark, sf_dir, ["orders"])["orders"]
    src, sink, refused = (fresh_dir(spark, f"keyed-{x}") for x in ("src", "sink", "refused"))
    ckpt = fresh_dir(spark, "keyed-ckpt")

    def run():
        start_keyed_stream_load(spark, src, m["orders"], sink, refused, ckpt, source_schema=raw.schema, max_files_per_trigger=1, available_now=True).awaitTermination()

    raw.repartition(4).write.parquet(src)
    run()
    raw.where("o_orderkey % 50 = 3").coalesce(1).write.mode("append").parquet(src)
    run()
    accepted = spark.read.parquet(sink).agg(F.lit("(accepted)").alias("key"), F.lit("").alias("reason"), F.count("*").alias("n_rows"))
    return spark.read.parquet(refused).select("key", "reason", F.col("n_rows").cast("bigint").alias("n_rows")).unionByName(accepted)


def json_parity(spark, sf_dir):
    """Orders with a JSON column whose keys, white space and fractions the target spells in
    another way, and of every 101st order another value."""
    orders = raw_tables(spark, sf_dir, ["orders"])["orders"]
    total, key = F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.col("o_orderkey").cast("string")
    source = orders.select("o_orderkey", F.format_string('{"k": %s, "price": {"total": %s, "list": [1.50, null]}, "p": "%s"}', key, total, "o_orderpriority").alias("doc"))
    other = F.when(F.col("o_orderkey") % 101 == 7, "2.5").otherwise("1.5")
    target = orders.select("o_orderkey", F.format_string('{"p":"%s","price":{"list":[%s,null],"total":%s0},"k":%s}', "o_orderpriority", other, total, key).alias("doc"))
    manifest = Manifest([spec_from_frame("orders", source, primary_key=("o_orderkey",), logical={"doc": "json"})])
    return string_parity(spark, {"orders": source}, {"orders": target}, manifest)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_metrics": source_metrics,
    "target_metrics": target_metrics,
    "reconcile_detail": reconcile_detail,
    "reconcile_mismatches": reconcile_mismatches,
    "reconcile_table_summary": reconcile_table_summary,
    "reconcile_verdict": reconcile_verdict,
    "reconcile_identical": reconcile_identical,
    "reconcile_metrics_verdict": reconcile_metrics_verdict,
    "migrate_and_verify": migrate_and_verify,
    "reconcile_source_error": reconcile_source_error,
    "evidence_csv": evidence_csv,
    "load_full_report": load_full_report,
    "load_refused_report": load_refused_report,
    "load_binary_guids": load_binary_guids,
    "reconcile_odd_names": reconcile_odd_names,
    "reconcile_unreadable": reconcile_unreadable,
    "reconcile_wide_scale": reconcile_wide_scale,
    "text_key_parity": text_key_parity,
    "stream_load_orders": stream_load_orders,
    "guid_text_canonical": guid_text_canonical,
    "column_audit": column_audit,
    "string_parity": string_parity_all,
    "string_parity_raw": string_parity_raw,
    "string_parity_skipped": string_parity_skipped,
    "load_conform": load_conform,
    "load_subset_report": load_subset_report,
    "load_append_conflicts": load_append_conflicts,
    "load_roundtrip": load_roundtrip,
    "identity_high_water": identity_high_water,
    "guid_canonical": guid_canonical,
    "supplier_catalog": supplier_catalog,
    "customer_order_totals": customer_order_totals,
    "pk_audit": pk_audit,
    "unique_audit": unique_audit,
    "unique_ci_audit": unique_ci_audit,
    "fk_audit": fk_audit,
    "not_null_audit": not_null_audit,
    "length_audit": length_audit,
    "locale_order": locale_order,
    "uuid_key_parity": uuid_key_parity,
    "text_key_range": text_key_range,
    "tree_parity": tree_parity,
    "tree_differences": tree_differences,
    "row_fingerprints": row_fingerprints,
    "reconcile_rows_verdict": reconcile_rows_verdict,
    "text_damage": text_damage,
    "text_damage_summary": text_damage_summary,
    "reconcile_wide_sums": reconcile_wide_sums,
    "locale_places": locale_places,
    "key_ranges": key_ranges,
    "read_by_ranges": read_by_ranges,
    "closed_subset": closed_subset,
    "metrics_incremental": metrics_incremental,
    "load_resumed": load_resumed,
    "stream_keyed_orders": stream_keyed_orders,
    "json_parity": json_parity,
}
