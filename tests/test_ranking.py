"""Places in a distributed order."""

import random
from collections import Counter


def test_places_need_no_window_over_a_group(spark):
    """Places equal a plain sort's, with a group of most rows and ties."""
    from pyspark.sql import functions as F

    from ferry.operators.ranking import places

    r = random.Random(2)
    rows = [(r.choice(["a"] * 6 + ["b", None]), r.choice([None, *range(50)]), k) for k in range(3000)]
    got = places(spark.createDataFrame(rows, "g string, v int, k int"), [F.col("v"), F.col("k")], ["g"]).collect()
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or "", x[1] is not None, x[1] or 0, x[2]))
    size, seen = Counter(x[0] for x in rows), Counter()
    want = []
    for i, x in enumerate(order):
        want.append((*x, i, seen[x[0]], size[x[0]]))
        seen[x[0]] += 1
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
