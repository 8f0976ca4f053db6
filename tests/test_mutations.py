"""Each seeded defect on its own flips exactly its expected metrics."""

import pytest

from ferry.fixtures import MUTATIONS, mutated_select
from ferry.operators.reconcile import reconcile

from test_reconcile import EXPECTED_DIFFS

# part: text only; events and the l_discount change: approximate, invisible.
EXPECTED_TEXT_ONLY = {"part"}


@pytest.mark.parametrize("table", sorted(MUTATIONS))
def test_single_defect(spark, sf001, table):
    s, _, m = sf001
    df = s[table]
    pred, cols = mutated_select(table, df.columns)
    mutated = (df.where(pred) if pred else df).selectExpr(*cols)
    r = reconcile(spark, {table: df}, {table: mutated}, m, strings=True)
    got = {(x.table_name, x.metric) for x in r.mismatches.collect()}
    want = {k for k in EXPECTED_DIFFS if k[0] == table}
    assert got == want
    parity = {x.status for x in r.parity.collect()}
    if table in EXPECTED_TEXT_ONLY:
        assert got == set() and "DIFF" in parity
    if table in ("events",):
        assert r.passed()
