"""Print the physical plans of the heavy operators at a given scale, with
broadcast joins disabled so the plans show their large-table shape.

    python tools/explain_plans.py [/root/testdata/sf0.1]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ferry.fixtures import fixture  # noqa: E402
from ferry.operators import audit, views  # noqa: E402
from ferry.operators.metrics import table_metrics  # noqa: E402
from ferry.operators.parity import table_parity  # noqa: E402
from ferry.plans.validation import build_plan  # noqa: E402
from ferry.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    s, t, m = fixture(spark, sf)
    tp = {x.table: x for x in build_plan(t, m)}
    shown = {
        "metrics(lineitem)": table_metrics(t["lineitem"], tp["lineitem"]),
        "parity(documents)": table_parity(spark, "documents", s["documents"], t["documents"],
                                          ["doc_id"], ["text", "lang", "source"]),
        "fk_audit(lineitem.l_orderkey -> orders)": audit.orphan_count(
            t["lineitem"], ["l_orderkey"], t["orders"], ["o_orderkey"]),
        "pk_audit(orders)": audit.key_audit(t["orders"], ["o_orderkey"]),
        "unique_ci(customer.c_name)": audit.unique_values(t["customer"], ["c_name"], "UNICODE_CI"),
        "totals_view(customer, orders)": views.totals_view(
            s["customer"], t["orders"], "c_custkey", "o_custkey", ["c_custkey", "c_name"],
            "o_orderkey", "o_totalprice"),
    }
    for name, df in shown.items():
        print(f"==== {name}")
        df.explain()
    spark.stop()


if __name__ == "__main__":
    main()
