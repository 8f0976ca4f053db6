"""SimHash, phrases and the Merkle manifest against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

LOW = {c: c + 32 for c in range(65, 91)}
SF = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- SimHash -----------------------------------------------------------------------


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    said = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in said]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_sets(prints):
    """Smallest id reachable, for (id, fingerprint) rows with repeated ids."""
    parent = {i: i for i, _ in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = np.array([f for _, f in prints], np.uint64)
    for k, (i, f) in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(fps ^ np.uint64(f)) <= 3):
            x, y = root(i), root(prints[j][0])
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def check_simhash(rows, docs):
    from ferry.llm.simhash import simhash_duplicates

    got = simhash_duplicates(docs).collect()
    prints = [(i, brute_print(t)) for i, t in rows]
    want = brute_sets([x for x in prints if x[0] is not None])
    assert sorted((repr(x.doc_id), x.fingerprint) for x in got) == sorted((repr(i), f"{f:016x}") for i, f in prints)
    for x in got:
        assert x.component_id == want.get(x.doc_id)


def test_simhash_matches_brute_force(spark, edge_docs, edge_rows, no_docs):
    from ferry.llm.simhash import simhash_duplicates

    r = random.Random(1)
    rows = list(edge_rows) + [(8, "another text under an id that stands elsewhere"), (60, "another text under an id that stands elsewhere")]
    base = ["".join(r.choice("abcdef") for _ in range(5)) for _ in range(150)]
    for k in range(300):
        words = list(base)
        for _ in range(r.randrange(1, 4)):
            words[r.randrange(150)] = "x" + str(r.randrange(10**6))
        rows.append((1000 + k, " ".join(words)))
    rows += [(2000 + k, " ".join(base)) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_simhash(rows, docs.selectExpr("*", "1 as fp", "'x' as rep", "2 as deal"))
    assert simhash_duplicates(no_docs).collect() == []


def test_simhash_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_simhash([(x.doc_id, x.text) for x in docs.collect()], docs)


def test_masks_cover_the_radius():
    from ferry.llm.simhash import masks

    r = random.Random(5)
    first = masks()
    for outer in (0, first[3], masks(first[3])[7]):
        for _ in range(3000):
            free = [i for i in range(64) if not outer >> i & 1]
            d = sum(1 << i for i in r.sample(free, r.randrange(1, 4)))
            assert any(not m & d for m in masks(outer))
    assert all(64 - x.bit_count() <= 8 for m in first[:4] for y in masks(m)[:4] for x in masks(y))


def test_crowded_buckets_are_divided_without_loss(spark, monkeypatch):
    """Fingerprints that differ in a few bits of one base, in buckets of 16 at most."""
    from pyspark.sql import functions as F

    from ferry.llm import simhash
    from ferry.llm.components import components

    monkeypatch.setattr(simhash, "BUCKET", 16)
    r = random.Random(9)
    base, weak = r.getrandbits(64), r.sample(range(64), 14)
    fps = sorted({base ^ sum(1 << b for b in weak if r.random() < 0.5) for _ in range(500)} | {r.getrandbits(64) for _ in range(100)}
                 | {base ^ sum(1 << b for b in r.sample(range(64), 6)) for _ in range(200)})
    r.shuffle(fps)
    classes = spark.createDataFrame([(simhash._signed(f), k) for k, f in enumerate(fps)], "fp bigint, rep bigint")
    grouped = simhash.buckets(classes)
    held = grouped.groupBy("mask", "key").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert held <= 256
    want = brute_sets(list(enumerate(fps)))
    got = {x.id: x.component_id for x in components(simhash.links(grouped)).collect()}
    assert {k: got.get(k, k) for k in want} == want


# --- phrases -----------------------------------------------------------------------


def brute_phrases(rows, least, top):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = set()
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if a >= cand[lang, p[i : i + m]]:
                    inside.add((lang, p[i : i + m]))
    out = defaultdict(list)
    for (lang, p), a in cand.items():
        if (lang, p) not in inside:
            score, _, l, r = min((1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, x in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(x)[:top]))


@pytest.mark.parametrize("hot", [40, 1 << 23])
def test_phrases_match_brute_force(spark, edge_rows, no_docs, hot, monkeypatch):
    """With hot prefixes of every length, and without."""
    from ferry.llm import phrases

    monkeypatch.setattr(phrases, "HOT_MOST", hot)
    r = random.Random(8)
    words = ["red", "Green", "blue", "ünder", "of", "the", "end", "x\x0by", " "]
    rows = [("en" if k % 3 else None, t) for k, (_, t) in enumerate(edge_rows)]
    for _ in range(300):
        rows.append((r.choice(["en", "de", "", None]), " ".join(r.choice(words) + r.choice(["", "", "", ",", "."]) for _ in range(r.randrange(60)))))
    rows += [("en", "a common passage of seven words indeed")] * 80 + [("de", "Tick tick tick tick tick tick")] * 60 + [("und", "one of und")] * 30
    docs = spark.createDataFrame([(k, a, b, 1) for k, (a, b) in enumerate(rows)], "words bigint, lang string, text string, `key` int").repartition(7)
    got = phrases.collocations(docs, least=20, top=60)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 20, 60)
    assert phrases.collocations(no_docs).collect() == []


def test_packed_suffixes_come_back():
    from ferry.llm.phrases import packed, unpacked

    r = np.random.default_rng(7)
    for n, kinds in ((1, 1), (500, 40), (40_000, 10**9)):
        words = r.integers(0, kinds + 1, (5, n)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        number, depth = r.integers(1, 1 << 32, n), r.integers(1, 6, n)
        got = unpacked(packed(words, number, depth))
        assert (got[0] == words).all() and (got[1] == number).all() and (got[2] == depth).all()


def test_abandoned_parts_never_hold_a_frequent_phrase():
    from ferry.llm.phrases import combined, sorted_counts

    r = np.random.default_rng(4)
    words = r.integers(1, 6, (5, 4000)).astype(np.uint64)
    words[r.integers(2, 5):, ::3] = 0
    rows, n = combined(words, np.ones(4000))
    assert n.sum() == 4000 and len({tuple(x) for x in rows.T}) == rows.shape[1]
    got = dict(sorted_counts(rows, n, np.ones(len(n), np.int64), 30))
    want = Counter(tuple(c[:m].tolist()) for c in words.T for m in range(2, int((c != 0).sum()) + 1))
    assert got == {k: v for k, v in want.items() if v >= 30}


# --- Merkle manifest ---------------------------------------------------------------


def brute_tree(leaves):
    """(root, per leaf its (left, right) siblings by level)."""
    ways, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = p // 8 * 8
            ways[i].append(("".join(nodes[run:p]), "".join(nodes[p + 1 : run + 8])))
        nodes = [sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [p // 8 for p in at]
    return nodes[0], ways


def brute_manifest(rows):
    """{(doc_id, leaf): {(subroot, root, proof digest, folded)}} of (doc_id, source, lang, n_chars, text)."""
    import zlib

    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by_lang = defaultdict(list)
    for row in rows:
        changed = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        other = sha(*map(field, (*row[:4], row[4].translate(LOW)))) if changed else None
        by_lang[row[2]].append(((row[0] is not None, row[0] or 0), sha(*map(field, row)), row[0], other))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: brute_tree([y[1] for y in sorted(by_lang[x], key=lambda y: y[:2])]) for x in langs}
    root, tops = brute_tree([trees[x][0] for x in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        for (_, leaf, i, other), way in zip(sorted(by_lang[lang], key=lambda y: y[:2]), trees[lang][1], strict=True):
            way = way + top
            at = other or leaf
            for l, r in way:
                at = sha(l, at, r)
            out.append((repr(i), leaf, trees[lang][0], root, sha(*[l + r for l, r in way]), at, at == root))
    return sorted(out)


@pytest.mark.parametrize("most", [1, 2, 9, 1000])
def test_manifest_matches_brute_force(spark, edge_docs, most, tmp_path, monkeypatch):
    from ferry.llm import merkle
    from ferry.llm.queries import op13_merkle_manifest

    monkeypatch.setattr(merkle, "BLOCK", 64)
    r = random.Random(most)
    rows = [(x.doc_id, x.source, x.lang, x.n_chars, x.text) for x in edge_docs.collect()]
    rows += [(100 + k, r.choice(["a", None]), r.choice(["en"] * 8 + ["de", "", "é", None] + [f"l{k % 9}"]), k, f"Text {k} É") for k in range(900)]
    rows = (rows + rows[3:6])[:most] if most > 2 else rows[-most:]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(*x, 1, "w") for x in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, node int, kept string").write.parquet(path)
    got = op13_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((repr(x[0]), *x[1:]) for x in got.collect()) == brute_manifest(rows)


def test_manifest_of_no_rows(no_docs):
    from ferry.llm.merkle import proofs

    assert proofs(no_docs).collect() == []
