"""DuckDB SQL that recomputes each registered check independently.

Inputs are the same stand-in tables (typed layer S, seeded target T) written
as CTEs over the pre-registered test views. The validation plan is derived
here from the Parquet schemas with pyarrow, not from the Spark code.
"""

from __future__ import annotations

import os
from functools import lru_cache

import pyarrow as pa
import pyarrow.parquet as pq

from ferry.fixtures import (ALL_TABLES, MUTATIONS, RULES, SOURCE_OMITS, TARGET_OMITS, TYPED)
from ferry.suite import LINEITEM_CANDIDATE_KEY, SUBSET_REQUEST

SCHEMA_DIRS = ["/root/testdata/sf0.01", "/root/testdata/sf0.001", "/root/testdata/sf0.1"]


def _schema_dir() -> str:
    for d in SCHEMA_DIRS:
        if os.path.exists(f"{d}/region.parquet"):
            return d
    raise FileNotFoundError("no test data folder found")


@lru_cache(maxsize=1)
def raw_schemas() -> dict[str, list[tuple[str, pa.DataType]]]:
    d = _schema_dir()
    out = {}
    for n in ALL_TABLES:
        s = pq.read_schema(f"{d}/{n}.parquet")
        out[n] = [(f.name, f.type) for f in s]
    return out


@lru_cache(maxsize=1)
def typed_schemas() -> dict[str, list[tuple[str, str]]]:
    """(column, kind) where kind is int / dec:<scale> / text / other."""
    out = {}
    for n, cols in raw_schemas().items():
        kinds = []
        for c, t in cols:
            if c in TYPED.get(n, {}):
                kinds.append((c, "dec:" + TYPED[n][c].split(",")[1].rstrip(")")))
            elif pa.types.is_integer(t):
                kinds.append((c, "int"))
            elif pa.types.is_decimal(t):
                kinds.append((c, f"dec:{t.scale}"))
            elif pa.types.is_string(t) or pa.types.is_large_string(t):
                kinds.append((c, "text"))
            else:
                kinds.append((c, "other"))
        out[n] = kinds
    return out


S_TABLES = [n for n in ALL_TABLES if n != SOURCE_OMITS]
T_TABLES = [n for n in ALL_TABLES if n != TARGET_OMITS]
COMMON = sorted(set(S_TABLES) & set(T_TABLES))


def ctes() -> str:
    """s_<table> (typed layer) and t_<table> (seeded defects) for all tables."""
    parts = []
    for n in ALL_TABLES:
        casts = TYPED.get(n, {})
        if casts:
            rep = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in casts.items())
            parts.append(f"s_{n} AS (SELECT * REPLACE ({rep}) FROM {n})")
        else:
            parts.append(f"s_{n} AS (SELECT * FROM {n})")
    for n in ALL_TABLES:
        pred, new = MUTATIONS.get(n, (None, {}))
        sel = f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in new.items())})" if new \
            else "SELECT *"
        where = f" WHERE {pred}" if pred else ""
        parts.append(f"t_{n} AS ({sel} FROM s_{n}{where})")
    return "WITH " + ",\n".join(parts)


def plan(tables) -> list[tuple[str, str, str, int]]:
    """(table, metric, column, scale) from the target's schemas and keys."""
    sch = typed_schemas()
    rows = []
    for n in sorted(tables):
        pk = RULES.get(n, {}).get("primary_key", ())
        rows.append((n, "rowcount", None, 0))
        for c, k in sch[n]:
            if k == "int" or k.startswith("dec:"):
                rows.append((n, f"sum:{c}", c, int(k[4:]) if k.startswith("dec:") else 0))
        for c, k in sch[n]:
            if c in pk and k == "int":
                rows.append((n, f"pkmin:{c}", c, 0))
                rows.append((n, f"pkmax:{c}", c, 0))
    return rows


def metric_sql(side: str, tables, plan_tables=None) -> str:
    """UNION ALL of (table_name, metric, value, scale) for one side."""
    parts = []
    for n, metric, c, scale in plan(plan_tables or T_TABLES):
        if n not in tables:
            continue
        src = f"{side}_{n}"
        if metric == "rowcount":
            v = "CAST(count(*) AS VARCHAR)"
        elif metric.startswith("sum:"):
            d = f"DECIMAL(38,{scale})"
            v = f"CAST(COALESCE(SUM(CAST({c} AS {d})), CAST(0 AS {d})) AS VARCHAR)"
        else:
            fn = "MIN" if metric.startswith("pkmin") else "MAX"
            v = f"COALESCE(CAST(CAST({fn}({c}) AS DECIMAL(38,0)) AS VARCHAR), '(empty)')"
        parts.append(f"SELECT '{n}' AS table_name, '{metric}' AS metric, {v} AS value, "
                     f"{scale} AS scale FROM {src}")
    return "\nUNION ALL ".join(parts)


def _reports(tp: str = "t", t_tables=None, s_tables=None) -> str:
    """src / tgt reports; the plan comes from the target side's tables."""
    t_tables = t_tables or T_TABLES
    return (ctes() + ",\nsrc AS (" + metric_sql("s", s_tables or S_TABLES, t_tables) + "),\ntgt AS ("
            + metric_sql(tp, t_tables, t_tables) + ")")


DETAIL = """detail AS (
  SELECT t.table_name, t.metric, COALESCE(s.value, '-') AS source_value, t.value AS target_value,
         CASE WHEN s.value IS NULL THEN 'MISSING' WHEN s.value = t.value THEN 'OK' ELSE 'DIFF' END
           AS status
  FROM tgt t LEFT JOIN src s ON s.table_name = t.table_name AND s.metric = t.metric)"""


def detail_with_source_error(failed) -> str:
    """Detail where the source tables in ``failed`` could not be read."""
    return f"""detail AS (
  SELECT t.table_name, t.metric,
         CASE WHEN t.table_name IN {_in(failed)} THEN '-' ELSE COALESCE(s.value, '-') END AS source_value,
         t.value AS target_value,
         CASE WHEN t.table_name IN {_in(failed)} THEN 'SOURCE_ERROR'
              WHEN s.value IS NULL THEN 'MISSING' WHEN s.value = t.value THEN 'OK' ELSE 'DIFF' END
           AS status
  FROM tgt t LEFT JOIN src s ON s.table_name = t.table_name AND s.metric = t.metric)"""


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _diff_case(scales) -> str:
    whens = " ".join(
        f"WHEN {s} THEN CAST(CAST(abs(CAST(s.value AS DECIMAL(38,{s})) - "
        f"CAST(t.value AS DECIMAL(38,{s}))) AS DECIMAL(38,{s})) AS VARCHAR)" for s in scales)
    return f"CASE t.scale {whens} END"


def mismatches_body(common=COMMON) -> str:
    scales = sorted({p[3] for p in plan(T_TABLES)})
    return f"""mism AS (
  SELECT COALESCE(s.table_name, t.table_name) AS table_name, COALESCE(s.metric, t.metric) AS metric,
         COALESCE(s.value, '-') AS source_value, COALESCE(t.value, '-') AS target_value,
         CASE WHEN s.value IS NULL THEN 'missing in source'
              WHEN t.value IS NULL THEN 'missing in target'
              WHEN s.value <> '(empty)' AND t.value <> '(empty)' THEN 'diff=' || {_diff_case(scales)}
              ELSE 'text differs' END AS reason
  FROM (SELECT * FROM src WHERE table_name IN {_in(common)}) s
  FULL OUTER JOIN (SELECT * FROM tgt WHERE table_name IN {_in(common)}) t
    ON s.table_name = t.table_name AND s.metric = t.metric
  WHERE s.value IS NULL OR t.value IS NULL OR s.value <> t.value)"""


def parity_select(n: str, key, cols, tp: str = "t") -> str:
    """Per text column: paired / one-sided / identical counts, with the
    duplicate-key gate (any key held by two rows on a side => SKIPPED)."""
    if not key:
        cols = cols or ["(key)"]
        return "\nUNION ALL ".join(
            f"SELECT '{n}' AS table_name, '{c}' AS column_name, CAST(NULL AS BIGINT) AS paired, "
            f"CAST(NULL AS BIGINT) AS only_source, CAST(NULL AS BIGINT) AS only_target, "
            f"CAST(NULL AS BIGINT) AS identical, 'SKIPPED' AS status, 'no primary key' AS reason"
            for c in cols)
    kl = ", ".join(key)
    on = " AND ".join(f"s.{k} = t.{k}" for k in key)
    dup = (f"((SELECT count(*) FROM (SELECT {kl} FROM s_{n} GROUP BY {kl} HAVING count(*) > 1)) "
           f"+ (SELECT count(*) FROM (SELECT {kl} FROM {tp}_{n} GROUP BY {kl} HAVING count(*) > 1)) > 0)")
    out = []
    for c in cols or [None]:
        same = f"s.{c} IS NOT DISTINCT FROM t.{c}" if c else "true"
        inner = (f"SELECT count(*) FILTER (WHERE s._p IS NOT NULL AND t._p IS NOT NULL) AS paired, "
                 f"count(*) FILTER (WHERE t._p IS NULL) AS only_source, "
                 f"count(*) FILTER (WHERE s._p IS NULL) AS only_target, "
                 f"count(*) FILTER (WHERE s._p IS NOT NULL AND t._p IS NOT NULL AND "
                 f"{same}) AS identical, {dup} AS dup "
                 f"FROM (SELECT *, 1 AS _p FROM s_{n}) s FULL OUTER JOIN "
                 f"(SELECT *, 1 AS _p FROM {tp}_{n}) t ON {on}")
        out.append(
            f"SELECT '{n}' AS table_name, '{c or '(key)'}' AS column_name, "
            f"CASE WHEN dup THEN NULL ELSE paired END AS paired, "
            f"CASE WHEN dup THEN NULL ELSE only_source END AS only_source, "
            f"CASE WHEN dup THEN NULL ELSE only_target END AS only_target, "
            f"CASE WHEN dup THEN NULL ELSE identical END AS identical, "
            f"CASE WHEN dup THEN 'SKIPPED' WHEN identical = paired AND only_source = 0 "
            f"AND only_target = 0 THEN 'OK' ELSE 'DIFF' END AS status, "
            f"CASE WHEN dup THEN 'duplicate key' END AS reason FROM ({inner})")
    return "\nUNION ALL ".join(out)


def text_columns(n: str, key) -> list[str]:
    return [c for c, k in typed_schemas()[n] if k == "text" and c not in key]


def parity_body(tp: str = "t", common=COMMON) -> str:
    parts = []
    for n in common:
        key = RULES.get(n, {}).get("primary_key", ())
        parts.append(parity_select(n, key, text_columns(n, key), tp))
    return "parity AS (" + "\nUNION ALL ".join(parts) + ")"


def summary_body(s_tables=None) -> str:
    s_tables = s_tables or S_TABLES
    return f"""pstat AS (
  SELECT table_name, CASE WHEN max(CASE WHEN status = 'DIFF' THEN 1 ELSE 0 END) = 1 THEN 'DIFF'
                          WHEN max(CASE WHEN status = 'SKIPPED' THEN 1 ELSE 0 END) = 1 THEN 'SKIPPED'
                          ELSE 'OK' END AS parity_status
  FROM parity GROUP BY table_name),
kr AS (
  SELECT table_name, string_agg(r, ', ' ORDER BY r) AS key_range FROM (
    SELECT table_name, split_part(metric, ':', 2) || '=' ||
           max(CASE WHEN metric LIKE 'pkmin:%' THEN target_value END) || '..' ||
           max(CASE WHEN metric LIKE 'pkmax:%' THEN target_value END) AS r,
           max(CASE WHEN metric LIKE 'pkmin:%' THEN target_value END) AS lo
    FROM detail WHERE metric LIKE 'pk%' GROUP BY table_name, split_part(metric, ':', 2))
  WHERE lo NOT IN ('(empty)', '-') GROUP BY table_name),
summary AS (
  SELECT d.table_name, any_value(kr.key_range) AS key_range,
         max(CASE WHEN metric = 'rowcount' THEN source_value END) AS source_rows,
         max(CASE WHEN metric = 'rowcount' THEN target_value END) AS target_rows,
         count(*) FILTER (WHERE metric LIKE 'sum:%' AND status = 'OK') AS sums_ok,
         count(*) FILTER (WHERE metric LIKE 'sum:%') AS sums_total,
         COALESCE(any_value(p.parity_status), 'NONE') AS parity_status,
         CASE WHEN d.table_name NOT IN {_in(s_tables)} THEN 'MISSING'
              WHEN max(CASE WHEN status <> 'OK' THEN 1 ELSE 0 END) = 1
                   OR any_value(p.parity_status) = 'DIFF' THEN 'DIFF'
              ELSE 'OK' END AS status
  FROM detail d LEFT JOIN pstat p ON p.table_name = d.table_name
  LEFT JOIN kr ON kr.table_name = d.table_name
  GROUP BY d.table_name)"""


def names_body(t_tables=None, s_tables=None) -> str:
    s = " UNION ALL ".join(f"SELECT '{n}' AS table_name" for n in (s_tables or S_TABLES))
    t = " UNION ALL ".join(f"SELECT '{n}' AS table_name" for n in (t_tables or T_TABLES))
    return f"""names AS (
  SELECT COALESCE(s.table_name, t.table_name) AS table_name,
         CASE WHEN s.table_name IS NOT NULL AND t.table_name IS NOT NULL THEN 'both'
              WHEN s.table_name IS NOT NULL THEN 'source_only' ELSE 'target_only' END AS side
  FROM ({s}) s FULL OUTER JOIN ({t}) t ON s.table_name = t.table_name)"""


def reconcile_sql(final: str, identical: bool = False, strings: bool = True, tables=None) -> str:
    """Full comparison S against T (or, with ``identical``, S against S); ``tables`` are
    those of both sides."""
    s_tables = tables or S_TABLES
    tp, t_tables = ("s", s_tables) if identical else ("t", tables or T_TABLES)
    common = sorted(set(s_tables) & set(t_tables))
    par = parity_body(tp, common) if strings else (
        "parity AS (SELECT CAST(NULL AS VARCHAR) AS table_name, CAST(NULL AS VARCHAR) AS status "
        "WHERE false)")
    summary = summary_body(s_tables) if strings else summary_body(s_tables).replace(
        "COALESCE(any_value(p.parity_status), 'NONE')", "'OFF'")
    return (_reports(tp, t_tables, s_tables) + ",\n" + DETAIL + ",\n" + mismatches_body(common) + ",\n"
            + par + ",\n" + summary + ",\n" + names_body(t_tables, s_tables) + "\n" + final)


VERDICT_FINAL = """SELECT count(*) FILTER (WHERE kind = 'table') AS common,
       count(*) FILTER (WHERE kind = 'table' AND status = 'OK') AS ok,
       count(*) FILTER (WHERE kind = 'table' AND status <> 'OK') AS bad,
       count(*) FILTER (WHERE kind = 'source_only') AS only_source,
       count(*) FILTER (WHERE kind = 'target_only') AS only_target,
       count(*) FILTER (WHERE kind = 'mismatch') AS mismatches,
       (count(*) FILTER (WHERE kind = 'table' AND status <> 'OK') = 0
        AND count(*) FILTER (WHERE kind IN ('source_only', 'target_only', 'mismatch')) = 0) AS passed
FROM (SELECT 'table' AS kind, status FROM summary
      WHERE table_name IN (SELECT table_name FROM names WHERE side = 'both')
      UNION ALL SELECT side, NULL FROM names
      UNION ALL SELECT 'mismatch', NULL FROM mism)"""


def fk_sql() -> str:
    parts = []
    for n in T_TABLES:
        for fk in RULES.get(n, {}).get("foreign_keys", ()):
            same = " AND ".join(f"p.{pc} = c.{c}" for c, pc in zip(fk.columns, fk.parent_columns))
            known = " AND ".join(f"c.{c} IS NOT NULL" for c in fk.columns)
            if fk.parent in T_TABLES:
                cond = f"NOT EXISTS (SELECT 1 FROM t_{fk.parent} p WHERE {same})"
            else:
                cond = "TRUE"
            parts.append(f"SELECT '{n}' AS child, '{','.join(fk.columns)}' AS column_name, '{fk.parent}' AS parent, "
                         f"count(*) FILTER (WHERE {known} AND {cond}) AS orphans "
                         f"FROM t_{n} c")
    return ctes() + "\n" + "\nUNION ALL ".join(parts)


def pk_audit_sql() -> str:
    keys = {n: RULES[n]["primary_key"] for n in T_TABLES if RULES.get(n, {}).get("primary_key")}
    keys["lineitem"] = LINEITEM_CANDIDATE_KEY
    parts = []
    for n, key in sorted(keys.items()):
        kl = ", ".join(key)
        isnull = " OR ".join(f"{k} IS NULL" for k in key)
        parts.append(
            f"SELECT '{n}' AS table_name, count(*) FILTER (WHERE NOT has_null AND n > 1) AS dup_keys, "
            f"CAST(COALESCE(SUM(n) FILTER (WHERE has_null), 0) AS BIGINT) AS null_keys "
            f"FROM (SELECT {kl}, count(*) AS n, ({isnull}) AS has_null FROM t_{n} GROUP BY {kl}, has_null)")
    return ctes() + "\n" + "\nUNION ALL ".join(parts)


def unique_sql(collation: str | None) -> str:
    parts = []
    for n in T_TABLES:
        for u in RULES.get(n, {}).get("unique", ()):
            text = {c for c, k in typed_schemas()[n] if k == "text"}
            exprs = ", ".join(f"{c} COLLATE NOCASE" if collation and c in text else c for c in u.columns)
            known = " AND ".join(f"{c} IS NOT NULL" for c in u.columns)
            parts.append(
                f"SELECT '{n}' AS table_name, '{','.join(u.columns)}' AS column_name, "
                f"'{collation or 'UTF8_BINARY'}' AS collation, count(*) AS dup_values FROM "
                f"(SELECT count(*) FROM t_{n} WHERE {known} GROUP BY {exprs} HAVING count(*) > 1)")
    return ctes() + "\n" + "\nUNION ALL ".join(parts)


def column_check_parts(kind: str, suffix: str = "") -> list[str]:
    sch = raw_schemas()
    parts = []
    for n in sorted(T_TABLES):
        if kind == "not_null":
            items = [(c, f"{c} IS NULL") for c, _ in sch[n]]
        else:
            items = [(c, f"length({c}) > {m}")
                     for c, m in sorted(RULES.get(n, {}).get("max_len", {}).items())]
        for c, p in items:
            parts.append(f"SELECT '{n}' AS table_name, '{c}{suffix}' AS column_name, "
                         f"count(*) FILTER (WHERE {p}) AS violations FROM t_{n}")
    return parts


def column_check_sql(kind: str) -> str:
    return ctes() + "\n" + "\nUNION ALL ".join(column_check_parts(kind))


def identity_sql() -> str:
    parts = []
    for n in sorted(T_TABLES):
        c = RULES.get(n, {}).get("identity")
        if not c:
            continue
        parts.append(
            f"SELECT '{n}' AS table_name, '{c}' AS column_name, m AS max_id, greatest(m, 1) AS counter, "
            f"CASE WHEN m > 0 THEN m + 1 ELSE 1 END AS next_id, m > 0 AS is_used "
            f"FROM (SELECT CAST(COALESCE(max({c}), 0) AS BIGINT) AS m FROM t_{n})")
    return ctes() + "\n" + "\nUNION ALL ".join(parts)


GUID_SQL = """SELECT o_orderkey,
  substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2) || '-' ||
  substr(h, 11, 2) || substr(h, 9, 2) || '-' || substr(h, 15, 2) || substr(h, 13, 2) || '-' ||
  substr(h, 17, 4) || '-' || substr(h, 21, 12) AS guid
FROM (SELECT o_orderkey, lower(md5(CAST(o_orderkey AS VARCHAR))) AS h FROM orders)"""


def column_audit_sql() -> str:
    """NOT NULL and length rules together, named column:rule."""
    parts = column_check_parts("not_null", ":not_null") + column_check_parts("max_len", ":max_len")
    return ctes() + "\n" + "\nUNION ALL ".join(parts)


def refused_sql() -> str:
    """Rules that rows of the target's tables break, with the rows (of keys: the keys)."""
    parts = []
    for n in T_TABLES:
        rules = RULES.get(n, {})
        items = [("not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)") for c, _ in raw_schemas()[n]]
        items += [("max_len", c, f"count(*) FILTER (WHERE length({c}) > {m})") for c, m in rules.get("max_len", {}).items()]
        parts += [f"SELECT '{n}' AS table_name, '{r}' AS rule, '{c}' AS column_name, {v} AS n_violations FROM t_{n}" for r, c, v in items]
        keys = [("primary_key", rules["primary_key"])] if rules.get("primary_key") else []
        keys += [("unique", u.columns) for u in rules.get("unique", ())]
        parts += [f"SELECT '{n}', '{r}', '{','.join(k)}', count(*) FROM (SELECT 1 FROM t_{n} WHERE "
                  + " AND ".join(f"{c} IS NOT NULL" for c in k) + f" GROUP BY {', '.join(k)} HAVING count(*) > 1)" for r, k in keys]
    return ctes() + "\nSELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE n_violations > 0"


def unreadable_sql() -> str:
    """Mismatches of the common tables without orders, and orders' error row."""
    return reconcile_sql("""SELECT * FROM mism WHERE table_name <> 'orders'
UNION ALL SELECT 'orders', 'ERROR', '(message)', '-', 'source error'""", strings=False)


WIDE_SCALE_SQL = """SELECT 'orders' AS table_name, 'sum:total' AS metric, CAST(s AS VARCHAR) AS source_value,
  CAST(s + d AS VARCHAR) AS target_value, 'diff=' || CAST(d AS VARCHAR) AS reason
FROM (SELECT CAST(SUM(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(28,10))) AS DECIMAL(38,10)) AS s,
             CAST(SUM(CAST('0.0000000001' AS DECIMAL(28,10))) AS DECIMAL(38,10)) AS d FROM orders)"""


def load_report_sql(request, available) -> str:
    loaded = [n for n in sorted(available) if n in request]
    missing = sorted(set(request) - set(available))
    rows = [f"SELECT '{n}' AS table_name, count(*) AS n_rows, 'LOADED' AS status FROM s_{n}"
            for n in loaded]
    rows.append("SELECT '(total)', (" + " + ".join(f"(SELECT count(*) FROM s_{n})" for n in loaded)
                + "), 'TOTAL'")
    rows += [f"SELECT '{m}', CAST(NULL AS BIGINT), 'NOT_FOUND'" for m in missing]
    return ctes() + "\n" + "\nUNION ALL ".join(rows)


UUID_PARITY_SQL = """SELECT t.table_name, c.column_name, count(*) AS paired, CAST(0 AS BIGINT) AS only_source, CAST(0 AS BIGINT) AS only_target,
  count(*) FILTER (WHERE c.column_name <> 'priority' OR o_orderkey % 101 <> 7 OR length(o_orderpriority) <= 2) AS identical,
  CASE WHEN identical = paired THEN 'OK' ELSE 'DIFF' END AS status, CAST(NULL AS VARCHAR) AS reason
FROM orders, (VALUES ('orders_bytes'), ('orders_spelled')) t(table_name), (VALUES ('day'), ('customer'), ('total'), ('priority')) c(column_name)
GROUP BY ALL"""

WIDE_SUMS_SQL = """WITH v AS (SELECT CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS HUGEINT) AS x, o_orderkey FROM orders),
s AS (SELECT sum(x) AS x, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi, sum(o_orderkey) AS k, count(*) FILTER (WHERE o_orderkey = 7) AS one FROM v)
SELECT 'orders' AS table_name, m AS metric, a AS source_value, b AS target_value, CASE WHEN a = b THEN 'OK' ELSE 'DIFF' END AS status FROM (
  SELECT 'rowcount' AS m, CAST(n AS VARCHAR) AS a, a AS b FROM s
  UNION ALL SELECT 'sum:o_orderkey', CAST(k AS VARCHAR), CAST(k AS VARCHAR) FROM s
  UNION ALL SELECT 'sum:total', x || repeat('0', 23), x || CASE one WHEN 0 THEN repeat('0', 23) ELSE repeat('0', 22) || '1' END FROM s
  UNION ALL SELECT 'sum:same', x || repeat('0', 23), x || repeat('0', 23) FROM s
  UNION ALL SELECT 'pkmin:o_orderkey', CAST(lo AS VARCHAR), CAST(lo AS VARCHAR) FROM s
  UNION ALL SELECT 'pkmax:o_orderkey', CAST(hi AS VARCHAR), CAST(hi AS VARCHAR) FROM s)"""


def differences_sql() -> str:
    """Keys that one side lacks or whose texts differ."""
    parts = []
    for n in COMMON:
        key = RULES.get(n, {}).get("primary_key", ())
        if not key:
            continue
        shown = " || ',' || ".join(f"CAST({k} AS VARCHAR)" for k in key)
        names = ", ".join(f"CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN '{c}' END" for c in text_columns(n, key)) or "NULL"
        parts.append(f"""SELECT '{n}' AS table_name, {shown} AS key, CASE WHEN t._p IS NULL THEN 'only_source' WHEN s._p IS NULL THEN 'only_target' ELSE 'differs' END AS state,
  CASE WHEN s._p = 1 AND t._p = 1 THEN concat_ws(',', {names}) ELSE '' END AS columns
FROM (SELECT *, 1 AS _p FROM s_{n}) s FULL OUTER JOIN (SELECT *, 1 AS _p FROM t_{n}) t USING ({', '.join(key)})
WHERE t._p IS NULL OR s._p IS NULL OR concat_ws(',', {names}) <> ''""")
    return ctes() + "\n" + "\nUNION ALL ".join(parts)


def fingerprint_sql() -> str:
    """Whole rows, and each column beside the key, compared as multisets."""
    parts = []
    for n in COMMON:
        key = list(RULES.get(n, {}).get("primary_key", ()))
        columns = [c for c, _ in raw_schemas()[n]]
        for label, names in [("(row)", columns), *[(c, [*key, c]) for c in columns if c not in key]]:
            cols = ", ".join(names)
            parts.append(f"""SELECT '{n}' AS table_name, '{label}' AS column_name, (SELECT count(*) FROM s_{n}) AS source_rows, (SELECT count(*) FROM t_{n}) AS target_rows,
  CASE WHEN EXISTS (SELECT {cols} FROM s_{n} EXCEPT ALL SELECT {cols} FROM t_{n}) OR EXISTS (SELECT {cols} FROM t_{n} EXCEPT ALL SELECT {cols} FROM s_{n})
  THEN 'DIFF' ELSE 'OK' END AS status""")
    return ctes() + "\n" + "\nUNION ALL ".join(parts)


def damage_sql(final: str) -> str:
    """Differing texts of paired keys. The seeded double encoding is of one letter, so
    undoing it is one replacement."""
    parts = []
    for n in COMMON:
        key = RULES.get(n, {}).get("primary_key", ())
        shown = " || ',' || ".join(f"CAST({k} AS VARCHAR)" for k in key)
        for c in text_columns(n, key) if key else []:
            on = " AND ".join(f"s.{k} = t.{k}" for k in key)
            parts.append(f"SELECT '{n}' AS table_name, {shown.replace('CAST(', 'CAST(s.')} AS key, '{c}' AS column_name, s.{c} AS s, t.{c} AS t FROM s_{n} s JOIN t_{n} t ON {on} WHERE s.{c} IS DISTINCT FROM t.{c}")
    char = "CASE WHEN position <= len({0}) THEN 'U+' || printf('%04X', unicode({0}[position])) END"
    return ctes() + ",\npairs AS (" + "\nUNION ALL ".join(parts) + """),
split AS (SELECT *, string_split(s, '') AS a, string_split(t, '') AS b FROM pairs),
placed AS (SELECT *, CASE WHEN s IS NOT NULL AND t IS NOT NULL THEN coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i])), least(len(a), len(b)) + 1) END AS position FROM split),
damaged AS (SELECT table_name, key, column_name,
  CASE WHEN t IS NULL THEN 'nulled' WHEN s IS NULL THEN 'filled' WHEN replace(t, 'Ã©', 'é') = s THEN 'double_encoded' WHEN starts_with(s, t) THEN 'truncated' ELSE 'other' END AS damage,
  position, """ + char.format("a") + " AS source_char, " + char.format("b") + " AS target_char FROM placed)\n" + final


def ranges_sql() -> str:
    guid = GUID_SQL
    parts = []
    for name, table, key, batch in (("orders", "orders", ["o_orderkey"], 1000), ("orders_guid", f"({guid})", ["guid"], 700),
                                    ("documents", "documents", ["doc_id"], 64), ("conversations", "conversations", ["conv_id", "turn"], 100)):
        k = ", ".join(key)
        shown = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in key)
        parts.append(f"""SELECT '{name}' AS table_name, ordinal, arg_min(shown, place) AS low, arg_max(shown, place) AS high, count(*) AS n_rows
FROM (SELECT {shown} AS shown, place, place // {batch} AS ordinal FROM (SELECT {k}, row_number() OVER (ORDER BY {k}) - 1 AS place FROM {table})) GROUP BY ordinal""")
    return "\nUNION ALL ".join(parts)


BY_RANGES_SQL = f"""SELECT place // 500 AS ordinal, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY guid) - 1 AS place FROM ({GUID_SQL})) GROUP BY 1"""


def subset_sql() -> str:
    """The closed subset by recursion over (table, key) pairs."""
    edges, nodes = [], []
    for n in ALL_TABLES:
        rules = RULES.get(n, {})
        own = rules.get("primary_key")
        own = "CAST(" + " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in own) + " AS VARCHAR)" if own else "CAST(l_orderkey || ',' || l_linenumber AS VARCHAR)"
        for fk in rules.get("foreign_keys", ()):
            if fk.parent == "lineitem":
                continue
            edges.append(f"SELECT '{n}' AS child, {own} AS child_key, '{fk.parent}' AS parent, CAST({fk.columns[0]} AS VARCHAR) AS parent_key FROM {n}")
    from ferry.suite import SUBSET_SEEDS
    for n, where in SUBSET_SEEDS.items():
        own = RULES.get(n, {}).get("primary_key") or ("l_orderkey", "l_linenumber")
        nodes.append(f"SELECT '{n}' AS t, CAST({' || chr(44) || '.join(f'CAST({c} AS VARCHAR)' for c in own)} AS VARCHAR) AS k FROM {n} WHERE {where}")
    seeds = "\nUNION ALL ".join(nodes)
    return f"""WITH RECURSIVE edge AS ({" UNION ALL ".join(edges)}),
lines AS (SELECT count(*) AS n FROM lineitem WHERE {SUBSET_SEEDS['lineitem']}),
reached(t, k) AS (SELECT DISTINCT t, k FROM ({seeds})
  UNION SELECT e.parent, e.parent_key FROM reached r JOIN edge e ON e.child = r.t AND e.child_key = r.k)
SELECT t AS table_name, CASE t WHEN 'lineitem' THEN (SELECT n FROM lines) ELSE count(*) END AS n_rows, CAST(0 AS BIGINT) AS orphans FROM reached GROUP BY t"""


def incremental_sql() -> str:
    d = "DECIMAL(38,2)"
    return ctes() + f""", every AS (SELECT * FROM s_orders UNION ALL SELECT * FROM t_orders WHERE o_orderkey < 1000)
SELECT 'orders' AS table_name, metric, value, CAST(1 AS BIGINT) AS files_read, CAST(4 AS BIGINT) AS files_kept FROM (
""" + "\nUNION ALL ".join(
        f"SELECT '{m}' AS metric, " + ("CAST(count(*) AS VARCHAR)" if m == "rowcount" else
                                       f"CAST(sum(CAST({c} AS DECIMAL(38,{k}))) AS VARCHAR)" if m.startswith("sum") else
                                       f"CAST({'min' if m.startswith('pkmin') else 'max'}({c}) AS VARCHAR)") + " AS value FROM every"
        for n, m, c, k in plan(["orders"])) + ")"


RESUMED_SQL = """SELECT table_name, n_rows, status, table_name = 'customer' OR table_name = 'nation' AS skipped, table_name = 'orders' AS refused_before FROM (
  SELECT 'customer' AS table_name, count(*) AS n_rows, 'LOADED' AS status FROM customer
  UNION ALL SELECT 'nation', count(*), 'LOADED' FROM nation
  UNION ALL SELECT 'orders', count(*), 'LOADED' FROM orders
  UNION ALL SELECT '(total)', (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM orders), 'TOTAL')"""


def oracle_sql() -> dict[str, str]:
    cte = ctes()
    customer_cols = ", ".join(c for c, _ in raw_schemas()["customer"])
    return {
        "source_metrics": _reports() + "\nSELECT table_name, metric, value FROM src",
        "target_metrics": _reports() + "\nSELECT table_name, metric, value FROM tgt",
        "reconcile_detail": reconcile_sql("SELECT * FROM detail"),
        "reconcile_mismatches": reconcile_sql("SELECT * FROM mism"),
        "reconcile_table_summary": reconcile_sql("SELECT * FROM summary"),
        "reconcile_verdict": reconcile_sql(VERDICT_FINAL),
        "reconcile_identical": reconcile_sql(VERDICT_FINAL, identical=True),
        "reconcile_metrics_verdict": reconcile_sql(VERDICT_FINAL, strings=False),
        "migrate_and_verify": reconcile_sql(VERDICT_FINAL, identical=True, tables=ALL_TABLES),
        "reconcile_source_error": (_reports() + ",\n" + detail_with_source_error(["orders"])
                                   + "\nSELECT * FROM detail"),
        "evidence_csv": reconcile_sql("SELECT * FROM detail"),
        "load_full_report": load_report_sql(ALL_TABLES, ALL_TABLES),
        "load_refused_report": refused_sql(),
        "load_binary_guids": GUID_SQL,
        "reconcile_odd_names": reconcile_sql("SELECT * REPLACE (replace(key_range, '=', '.a:v=') AS key_range) FROM summary",
                                             tables=["orders"]),
        "reconcile_unreadable": unreadable_sql(),
        "reconcile_wide_scale": WIDE_SCALE_SQL,
        "text_key_parity": cte + "\n" + parity_select("customer", ("c_name",), []) + """
UNION ALL SELECT 'labels', '(key)', NULL, NULL, NULL, NULL, 'SKIPPED', 'no manifest entry'""",
        "stream_load_orders": cte + "\nSELECT * FROM s_orders",
        "guid_text_canonical": GUID_SQL,
        "column_audit": column_audit_sql(),
        "string_parity": cte + ",\n" + parity_body() + "\nSELECT * FROM parity",
        "string_parity_raw": cte + ",\n" + parity_body() + "\nSELECT * FROM parity",
        "string_parity_skipped": cte + "\n" + parity_select(
            "lineitem", LINEITEM_CANDIDATE_KEY, text_columns("lineitem", LINEITEM_CANDIDATE_KEY)),
        "load_conform": f"SELECT {customer_cols.replace('c_acctbal', 'CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal')} FROM customer",
        "load_subset_report": load_report_sql(SUBSET_REQUEST, S_TABLES),
        "load_append_conflicts": cte + "\nSELECT o_orderkey FROM s_orders WHERE o_orderkey IN (SELECT o_orderkey FROM t_orders)",
        "load_roundtrip": ("SELECT doc_id, md5(text) AS text_md5, length(text) AS text_chars, lang, "
                           "source, n_chars FROM documents"),
        "identity_high_water": identity_sql(),
        "guid_canonical": GUID_SQL,
        "supplier_catalog": ("SELECT s_suppkey, s_name, n_name, CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal "
                             "FROM supplier JOIN nation ON s_nationkey = n_nationkey"),
        "customer_order_totals": cte + """
SELECT c.c_custkey, c.c_name, count(o.o_orderkey) AS order_count,
       CAST(COALESCE(SUM(CAST(o.o_totalprice AS DECIMAL(38,2))), CAST(0 AS DECIMAL(38,2))) AS VARCHAR)
         AS total_spent
FROM s_customer c LEFT JOIN t_orders o
  ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_name""",
        "uuid_key_parity": UUID_PARITY_SQL,
        "text_key_range": reconcile_sql("SELECT * FROM summary", identical=True, tables=["orders"]),
        "tree_parity": cte + ",\n" + parity_body() + "\nSELECT * FROM parity",
        "tree_differences": differences_sql(),
        "row_fingerprints": fingerprint_sql(),
        "reconcile_rows_verdict": reconcile_sql("SELECT v.* REPLACE (v.passed AND (NOT r OR NOT EXISTS (SELECT 1 FROM events WHERE event_id % 101 = 7)) AS passed), r AS rows "
                                                f"FROM ({VERDICT_FINAL}) v, (VALUES (false), (true)) x(r)", identical=True, strings=False),
        "text_damage": damage_sql("SELECT * FROM damaged"),
        "text_damage_summary": damage_sql("SELECT table_name, column_name, damage, count(*) AS n_rows, min(position) AS first_position FROM damaged GROUP BY ALL"),
        "reconcile_wide_sums": WIDE_SUMS_SQL,
        "locale_places": ("SELECT word, row_number() OVER (ORDER BY word COLLATE es, word) AS place FROM (SELECT DISTINCT word FROM (SELECT "
                          "unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents) WHERE word <> '')"),
        "key_ranges": ranges_sql(),
        "read_by_ranges": BY_RANGES_SQL,
        "closed_subset": subset_sql(),
        "metrics_incremental": incremental_sql(),
        "load_resumed": RESUMED_SQL,
        "stream_keyed_orders": ("SELECT CAST(o_orderkey AS VARCHAR) AS key, 'earlier batch' AS reason, CAST(1 AS BIGINT) AS n_rows FROM orders WHERE o_orderkey % 50 = 3 "
                                "UNION ALL SELECT '(accepted)', '', count(*) FROM orders"),
        "json_parity": ("SELECT 'orders' AS table_name, 'doc' AS column_name, count(*) AS paired, CAST(0 AS BIGINT) AS only_source, CAST(0 AS BIGINT) AS only_target, "
                        "count(*) FILTER (WHERE o_orderkey % 101 <> 7) AS identical, 'DIFF' AS status, CAST(NULL AS VARCHAR) AS reason FROM orders"),
        "pk_audit": pk_audit_sql(),
        "unique_audit": unique_sql(None),
        "unique_ci_audit": unique_sql("UNICODE_CI"),
        "fk_audit": fk_sql(),
        "not_null_audit": column_check_sql("not_null"),
        "length_audit": column_check_sql("max_len"),
        "locale_order": ("SELECT word, length(word) AS word_length, row_number() OVER (PARTITION BY length(word) "
                         "ORDER BY word COLLATE es, word) AS place FROM (SELECT DISTINCT word FROM (SELECT "
                         "unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents) WHERE word <> '')"),
    }
