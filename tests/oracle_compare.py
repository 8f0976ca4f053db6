"""Run every registered query and its DuckDB oracle; compare row count,
column names and an order-insensitive hash of the values.

    python tests/oracle_compare.py [--no-ansi] [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ferry.fixtures import ALL_TABLES  # noqa: E402


def norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main():
    args = [a for a in sys.argv[1:] if a != "--no-ansi"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    import __spark_entry__ as entry
    from ferry.session import local_session
    spark = local_session()
    if "--no-ansi" in sys.argv:
        spark.conf.set("spark.sql.ansi.enabled", "false")
    con = duckdb.connect()
    for n in ALL_TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{sf}/{n}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        dt = time.time() - t0
        sql = sqls.get(name)
        if sql is None:
            print(f"{name:28s} spark={len(rows):7d} rows  (no oracle)  {dt:.1f}s")
            continue
        cur = con.execute(sql)
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        same = (sorted(cols) == sorted(ocols) and len(rows) == len(orows)
                and digest(cols, rows) == digest(ocols, orows))
        bad += not same
        print(f"{name:28s} spark={len(rows):7d} duck={len(orows):7d} "
              f"{'MATCH' if same else 'MISMATCH'}  {dt:.1f}s")
        if not same:
            print("   cols", sorted(cols), sorted(ocols))
            sr = sorted(map(lambda r: tuple(norm(x) for x in r), rows))[:5]
            o_idx = [ocols.index(c) for c in cols] if sorted(cols) == sorted(ocols) else range(len(ocols))
            orr = sorted(tuple(norm(r[i]) for i in o_idx) for r in orows)[:5]
            print("   spark", sr)
            print("   duck ", orr)
    print("mismatches:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
