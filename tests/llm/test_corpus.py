"""Operators that compare documents, against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from tests_llm_brute import brute_components

SF = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark, edge_docs):
    more = edge_docs.withColumn("doc_id", edge_docs.doc_id + 100_000)
    return spark.read.parquet(f"{SF}/documents.parquet").unionByName(more, allowMissingColumns=True).cache()


def invented(r, n):
    return ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def test_components(spark):
    from ferry.llm.components import components

    r = random.Random(2)
    links = [(i, i + 1) for i in range(1, 200)] + [(1000, x) for x in range(1001, 1400)] + [(5000, 5000), (7, None)]
    links += [(r.randrange(2000, 2400), r.randrange(2000, 2400)) for _ in range(150)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {x.id: x.component_id for x in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_near_duplicates_match_brute_force(spark, docs, no_docs):
    from ferry.llm.neardup import near_duplicates

    r = random.Random(4)
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    base = invented(r, 80)
    for k in range(150):  # a family of near copies, most within reach of some other
        words = list(base)
        for _ in range(r.randrange(1, 5)):
            words[r.randrange(80)] = "x" + str(r.randrange(10**6))
        rows.append((200_000 + k, " ".join(words)))
    passage = " ".join(invented(r, 30))
    rows += [(300_000 + k, passage + " " + " ".join(invented(r, 30))) for k in range(100)]
    rows += [(310_000 + k, rows[-1 - 7 * k][1] + " tail words here") for k in range(10)]
    rows += [(400_000 + k, " ".join(base[:40])) for k in range(60)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = brute_components({i: t for i, t in rows if i is not None})
    seen = got.collect()
    assert len(seen) == sum(i is not None for i, _ in rows)
    for g in seen:
        assert (g.n_shingles, g.component_id) == want[g.doc_id], g
        assert g.kept == (g.doc_id == g.component_id)
    assert near_duplicates(no_docs).collect() == []


def test_crowded_regions_lose_no_link(spark, monkeypatch):
    """Where hardly two documents fit a region, links are found all the same: shingles of
    any number of documents bring them together."""
    from ferry.llm import neardup

    monkeypatch.setattr(neardup, "REGION", 2)
    monkeypatch.setattr(neardup, "UNIT", 16)
    r, rows = random.Random(8), []
    for family in range(3):
        base = invented(r, 90)
        for k in range(60):  # within reach of few others
            words = list(base)
            for at in r.sample(range(90), r.randrange(1, 4)):
                words[at] = "x" + str(r.randrange(10**6))
            rows.append((1000 * family + k, " ".join(words)))
    want = brute_components(dict(rows))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {g.doc_id: (g.n_shingles, g.component_id) for g in got} == want


def test_crowded_documents_join_by_their_rarest_shingles(spark, monkeypatch):
    """Of documents that share a passage, and of near copies, only a quarter of the shingles
    meets other documents', and what is kept for them lies in few partitions."""
    from ferry.llm import neardup
    from ferry.llm.common import saved

    kept = []
    monkeypatch.setattr(neardup, "REGION", 2)
    monkeypatch.setattr(neardup, "saved", lambda df: kept.append(saved(df)) or kept[-1])
    r, rows = random.Random(31), []
    passage, base = invented(r, 40), invented(r, 90)
    for k in range(60):
        rows.append((k, " ".join(passage + invented(r, 60))))
        rows.append((1000 + k, " ".join(base[:k] + ["x" + str(k)] + base[k + 1 :])))
    want = brute_components(dict(rows))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {g.doc_id: (g.n_shingles, g.component_id) for g in got} == want
    joined = [x for x in kept if x.columns == ["rep", "h"]]
    assert len(joined) == 1 and 0 < joined[0].count() <= sum(n // 4 + 1 for n, _ in want.values())
    assert {x.rdd.getNumPartitions() for x in kept if "region" in x.columns} == {1}


def test_linked_sets_share_a_rarest_shingle():
    """In whatever order the levels put shingles, two sets that are linked share one of the
    first of each, and no more than those are taken."""
    from ferry.llm.neardup import SLOTS, rarest, slots

    r = np.random.default_rng(32)
    levels, tried = r.integers(0, 4, SLOTS).astype(np.uint8), 0
    for _ in range(400):
        x = np.unique(r.integers(0, 1 << 63, int(r.integers(1, 40))).astype(np.uint64))
        y = np.unique(np.concatenate([x[r.random(len(x)) < 0.9], r.integers(0, 1 << 63, int(r.integers(0, 4))).astype(np.uint64)]))
        levels[slots(np.intersect1d(x, y))] |= 1  # what two sets hold is never of level 0
        both = len(np.intersect1d(x, y))
        if 100 * both >= 75 * (len(x) + len(y) - both):
            first = [rarest(s, levels, 75) for s in (x, y)]
            assert len(np.intersect1d(*first)) and all(len(f) <= len(s) // 4 + 1 for f, s in zip(first, (x, y)))
            tried += 1
    assert tried > 50


def test_region_parts_stay_small(spark):
    """Thousands of almost equal signatures never meet in one region."""
    from pyspark.sql import functions as F

    from ferry.llm.neardup import HASHES, REGION, regions

    sig = np.arange(HASHES, dtype=">u4").tobytes()
    rows = spark.range(3000).select(F.col("id").alias("rep"), F.lit(50).cast("long").alias("n"), F.lit(bytearray(sig)).alias("sig"))
    counts = regions(rows).groupBy("region").count()
    assert counts.agg(F.max("count")).first()[0] <= 4 * REGION
    leads = regions(rows).where("rep = 0").select("region").distinct().count()
    assert leads == counts.count()


def brute_lines(rows):
    """{(id, text): (what is left, lines gone)} of texts that lose lines: every two lines in
    a row that stand earlier too go, unless they are the first of another such pair."""
    rows = sorted({x for x in rows if x[0] is not None and x[1] is not None}, key=repr)
    places = defaultdict(set)
    for i, text in rows:
        lines = text.split("\n")
        for k, pair in enumerate(zip(lines, lines[1:])):
            if SPACED.search("\n".join(pair)):
                places[pair].add((i, k, text))
    again, here = defaultdict(set), defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            for i, k, text in found:
                (here if (i, k) == min(found)[:2] else again)[i, text] |= {k, k + 1}
    out = {}
    for (i, text), gone in again.items():
        if gone := gone - here[i, text]:
            out[i, text] = ("\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone), len(gone))
    return out


def test_another_document_moves_no_bound(spark):
    """What goes from a document does not change with documents that come later."""
    from ferry.llm.linededup import line_dedup, windows

    r = random.Random(26)
    shared, other = ([" ".join(invented(r, 4)) for _ in range(12)] for _ in range(2))
    rows = [(1, "\n".join(["a", *shared, "b"])), (2, "\n".join(["c", *shared, "d"])), (3, "\n".join([*other[:2], *shared[4:7], *other[2:4]]))]
    frames = [spark.createDataFrame(rows[:n], "doc_id bigint, text string") for n in (2, 3)]
    few, more = ({x.doc_id: (x.text, x.n_removed_lines) for x in line_dedup(df).collect()} for df in frames)
    assert few == {1: (rows[0][1], 0), 2: ("c\nd", 12)} and more == few | {3: ("\n".join(other[:4]), 3)}
    few, more = ({tuple(x) for x in windows(df, "doc_id", "text").collect()} for df in frames)
    assert few == {x for x in more if x[0] < 3}


def test_line_dedup(spark, docs, no_docs):
    from pyspark.sql import functions as F

    from ferry.llm.linededup import line_dedup

    r = random.Random(6)
    shared = [" ".join(invented(r, 9)) for _ in range(12)]
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    for k in range(40):
        own = [" ".join(invented(r, 9)) for _ in range(r.randrange(1, 9))]
        at = r.randrange(len(own) + 1)
        rows.append((500_000 + k, "\n".join(own[:at] + shared + own[at:])))
    rows += [(600_000 + k, "\n".join(invented(r, 5) + shared[:1])) for k in range(30)]
    df = spark.createDataFrame([(*x, "n") for x in rows], "doc_id bigint, text string, lines string")
    got = line_dedup(df).collect()
    assert len(got) == len(rows)
    want = brute_lines(rows)
    for g, (i, text) in zip(sorted(got, key=lambda x: (x.doc_id or 0, x.text or "")), sorted(rows, key=lambda x: (x[0] or 0, x[1] or ""))):
        if i is None or (i, text) not in want:
            assert g.n_removed_lines == 0
        else:
            assert (g.text, g.n_removed_lines) == want[i, text]
    untouched = {g.doc_id: g.text for g in got if not g.n_removed_lines}
    assert all(untouched[i] == t for i, t in rows if i in untouched and i != 100_008)
    passages = [g for g in got if g.doc_id and 500_001 <= g.doc_id < 600_000]
    assert sum(g.n_removed_lines >= 4 for g in passages) >= 38
    assert all(g.n_removed_lines == 0 for g in got if g.doc_id and g.doc_id >= 600_000)
    assert line_dedup(no_docs.drop("lines")).collect() == []
    assert df.select(F.count("*")).first()[0] == len(got)


def test_substring_repeats(spark, docs, no_docs):
    from ferry.llm.substrings import chunk_ends, repeated_spans, without_repeats

    r = random.Random(8)
    rows = []
    for k in range(60):  # a passage of 55 words amid own text
        passage = " ".join(invented(random.Random(900 + k // 3), 55))
        rows.append((k, " ".join(invented(r, r.randrange(3, 200))) + " " + passage + ". " + " ".join(invented(r, 100)), passage))
    clean = [(1000 + k, " ".join(invented(r, 300)), None) for k in range(100)]
    every = spark.createDataFrame([x[:2] for x in rows + clean], "doc_id bigint, text string")
    got = repeated_spans(every).collect()
    texts = {i: t for i, t, _ in rows + clean}
    caught = {g.doc_id for g in got}
    assert caught >= {k for k in range(60) if k % 3} and not any(i >= 1000 for i in caught)
    for g in got:
        assert texts[g.doc_id][g.start : g.end] in texts[g.first_doc_id] or len(g.source_doc_ids) > 1
        assert min(g.source_doc_ids) == g.first_doc_id and {*g.source_doc_ids} <= {*range(g.doc_id - g.doc_id % 3, g.doc_id)}
    cut = {x.doc_id: x.text for x in without_repeats(every).collect()}
    for g in got:
        assert len(cut[g.doc_id]) == len(texts[g.doc_id]) - sum(x.end - x.start for x in got if x.doc_id == g.doc_id)
    assert all(cut[i] == t for i, t in texts.items() if i not in caught)
    # every chunk that the digests call repeated is repeated, on all the data
    texts = defaultdict(set)
    for x in docs.collect():
        texts[x.doc_id].add(x.text or "")
    for g in repeated_spans(docs).collect():
        assert any(len(t) >= g.end for t in texts[g.doc_id])
    data = np.frombuffer(b"ab" * 50_000, np.uint8)
    ends = chunk_ends(data)
    assert ends[-1] == len(data) and np.diff(np.append(0, ends)).max() <= 1024
    assert repeated_spans(no_docs).collect() == []


def test_decontamination(spark, docs, no_docs):
    from ferry.llm.decontam import contaminations, decontaminated

    r = random.Random(9)
    items = [" ".join(invented(r, r.randrange(14, 60))) for _ in range(50)] + ["one two three", " ".join(invented(r, 6)), None, ""]
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(items)] + [(99, items[3], "y"), (None, "who knows", "z")], "item_id bigint, text string, words string")
    rows = []
    for k in range(50):
        words = items[k].split()
        changed = list(words)
        for at in range(4, len(words), 9):  # every ninth word is another
            changed[at] = "zz" + str(at)
        own = [" ".join(invented(r, r.randrange(1, 300))) for _ in range(2)]
        rows.append((k, f"{own[0]} {' '.join(words)} {own[1]}"))
        rows.append((100 + k, f"{own[0]} {' '.join(changed).upper()}, {own[1]}"))
        rows.append((200 + k, own[0] + " " + " ".join(words[:4]) + " " + own[1]))
    rows.append((400, "xx yy " + items[51] + " zz"))
    rows += [(500 + k, " ".join(invented(r, 200))) for k in range(100)]
    gap = " ".join(invented(r, 60))
    rows.append((401, "w " + items[1] + " " + gap + " " + items[2] + " " + gap + " " + items[1]))  # all within reach of the start
    rows += [(600, "one two three"), (601, None), (602, ""), (None, items[0])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = contaminations(df, bench).collect()
    assert {g.doc_id for g in got} == {*range(50), *range(100, 150), 400, 401}
    assert sorted((g.item_id, g.n_equal) for g in got if g.doc_id == 401) == sorted((k, len(items[k].split())) for k in (1, 1, 2))
    for g in got:
        assert g.doc_id == 401 or g.item_id == (51 if g.doc_id == 400 else g.doc_id % 100)
        doc, item = PLAIN.findall(dict(rows)[g.doc_id].translate(LOW)), PLAIN.findall(items[g.item_id].translate(LOW))
        same = [x == y for x, y in zip(doc[g.doc_word : g.doc_word + g.n_words], item[g.item_word : g.item_word + g.n_words])]
        assert sum(same) == g.n_equal and len(same) == g.n_words and same[0] and same[-1]
    left = decontaminated(df, bench)
    assert left.columns == df.columns
    assert left.count() == len(rows) - 102
    assert contaminations(df, bench.limit(0)).collect() == []
    assert contaminations(no_docs, bench).collect() == []
    assert contaminations(docs, bench).count() == 0


def test_short_items_and_gaps(spark):
    """Items of 7 to 9 words with one other word at any place; one row an alignment."""
    from ferry.llm.decontam import contaminations, decontaminated

    r = random.Random(19)
    items, rows, want = [], [], set()
    for n in range(7, 10):
        for at in range(n):
            words = invented(r, n)
            items.append((len(items), " ".join(words)))
            words[at] = "other"
            rows.append((len(items) - 1, " ".join(invented(r, 30) + words + invented(r, 30))))
            want.add((len(items) - 1, len(items) - 1))
    long = invented(r, 500)
    items.append((100, " ".join(long)))
    for i, gap in enumerate((20, 60, 100, 250)):  # other words of the same number in the middle
        rows.append((100 + i, " ".join(invented(r, 9) + long[:100] + invented(r, gap) + long[100 + gap :])))
        want.add((100 + i, 100))
    docs = spark.createDataFrame([(*x, 1, 2, 3) for x in rows], "doc_id bigint, text string, bad int, item_id int, best int")
    got = contaminations(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(g.doc_id, g.item_id) for g in got} == want and len(got) == len(want)
    assert {g.doc_id: g.n_equal for g in got if g.doc_id >= 100} == {100: 480, 101: 340, 102: 300, 103: 150}  # a gap costs two a word
    left = decontaminated(docs, spark.createDataFrame(items[:3], "item_id bigint, text string"))
    assert left.columns == docs.columns and left.count() == len(rows) - 3


def test_hash_bitmap(spark):
    from ferry.llm import words as W
    from ferry.llm.filters import bitmap, passes

    held = W.constants(5000, 3)
    table = bitmap(spark.createDataFrame([(int(x),) for x in held.view(np.int64)], "hash bigint"))
    assert passes(table, held).all()
    assert passes(table, W.constants(200_000, 4)).mean() < 1e-4
    assert not passes(bitmap(spark.createDataFrame([], "hash bigint")), held).any()


def test_line_dedup_short_passages(spark):
    """Passages of 2 to 8 lines go whole, whatever stands around them and however often
    shorter ones stand elsewhere; runs of one line too."""
    from ferry.llm.linededup import line_dedup

    r = random.Random(16)
    line = lambda: " ".join(invented(r, 5))
    own = lambda least=0: [line() for _ in range(r.randrange(least, 7))]
    rows, want = [], {}
    for k in range(350):
        passage = [line() for _ in range(2 + k % 7)]
        for copy in range(3):
            before, after = own(), own()
            rows.append((3 * k + copy, "\n".join(before + passage + after)))
            want[3 * k + copy] = "\n".join(before + passage + after if not copy else before + after)
    long = [line() for _ in range(7)]  # its start and its end also stand alone
    for k, part in enumerate((long, long[:3], long[:3], long, long[5:], long[5:])):
        before, after = own(1), own(1)
        rows.append((2000 + k, "\n".join(before + part + after)))
        want[2000 + k] = "\n".join(before + (long if not k else []) + after) if k != 3 else "\n".join(before + after)
    one = line()
    for k, n in enumerate((6, 8, 2, 20)):
        before, after = line(), line()
        rows.append((3000 + k, "\n".join([before] + [one] * n + [after])))
        want[3000 + k] = "\n".join([before] + [one] * (0 if k else 2) + [after])
    got = {g.doc_id: g for g in line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: g.text for i, g in got.items() if want[i]} == {i: t for i, t in want.items() if t}
    assert all(g.n_removed_lines == g.n_lines for i, g in got.items() if not want[i])


def test_near_duplicates_of_repeated_ids(spark):
    """An id of several texts stands for one of them, whatever the order of its rows."""
    from ferry.llm.neardup import near_duplicates

    r = random.Random(5)
    a, b, c = (invented(r, 60) for _ in range(3))
    near = lambda x: " ".join(x[:58] + ["aa", "bb"])
    rows = [(1, " ".join(a)), (2, near(a)), (2, " ".join(b)), (3, near(b)), (4, near(c)), (5, " ".join(c)), (5, " ".join(c)), (6, None), (6, " ".join(c)), (7, "")]
    seen = {tuple(sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in near_duplicates(spark.createDataFrame(part, "doc_id bigint, text string")).collect()))
            for part in (rows, rows[::-1], rows[5:] + rows[:5])}
    assert len(seen) == 1
    found = {}
    for i, n, component, kept in seen.pop():
        assert found.setdefault(i, component) == component and kept == (i == component)
    assert found[1] == 1 and found[2] in (1, 2) and found[3] == (2 if found[2] == 2 else 3) and found[5] == found[6] == 4 and found[7] == 7


def test_spanning_forest_is_a_heaviest_one():
    from ferry.llm.neardup import forest

    r = np.random.default_rng(3)
    for n in (2, 5, 40):
        x, y = np.triu_indices(n, 1)
        keep = r.random(len(x)) < 0.6
        x, y = x[keep], y[keep]
        w = r.integers(0, 9, len(x)) / 8
        got = forest(x, y, w, n)
        parent, total = list(range(n)), 0.0

        def root(k):
            while parent[k] != k:
                k = parent[k]
            return k

        for k in np.argsort(-w, kind="stable"):
            if root(x[k]) != root(y[k]):
                parent[root(x[k])] = root(y[k])
                total += w[k]
        assert abs(w[got].sum() - total) < 1e-9 and len(got) == n - sum(parent[k] == k for k in range(n))


def test_near_duplicates_sole_links(spark):
    """Documents linked with one member of a family of thousands alone are found."""
    from ferry.llm.neardup import near_duplicates

    r = random.Random(26)
    base = invented(r, 100)
    family = []
    for k in range(2500):
        words = list(base)
        words[r.randrange(10, 90)] = f"own{k}"
        family.append(words)
    rows = [(1000 + k, " ".join(w)) for k, w in enumerate(family)]
    for k in range(100):  # one word of the base fewer than a link with other members allows
        words = list(family[20 * k])
        at = next(i for i, w in enumerate(words) if w.startswith("own"))
        free = [i for i in (2, 8, 14, 20, 26, 32, 38, 44, 50, 56, 62, 68, 74, 80, 86, 92) if abs(i - at) > 9]
        for i in r.sample(free, 2):
            words[i] = f"far{k}x{i}"
        rows.append((10_000 + k, " ".join(words) + " " + " ".join(f"end{k}x{j}" for j in range(3))))
    got = {g.doc_id: g.component_id for g in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    links = [k for k in range(100) if linked(dict(rows)[10_000 + k], dict(rows)[1000 + 20 * k])]
    sole = [k for k in links if sum(linked(dict(rows)[10_000 + k], " ".join(w)) for w in family[1::50]) == 0]
    assert len(sole) >= 90
    assert [k for k in sole if got[10_000 + k] != 1000] == []


def linked(a, b):
    from tests_llm_brute import shingles

    x, y = shingles(a), shingles(b)
    return 100 * len(x & y) >= 75 * len(x | y)
