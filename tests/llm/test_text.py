"""Per-document operators against plain Python."""

import hashlib
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

SF = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark, edge_docs):
    return spark.read.parquet(f"{SF}/documents.parquet").unionByName(edge_docs.withColumn("doc_id", edge_docs.doc_id + 100_000), allowMissingColumns=True)


def by_id(rows, key="doc_id"):
    return {r[key]: r for r in rows}


def test_words_match_regex():
    from ferry.llm import words as W

    texts = ["", "a B  c", "\t", "x\x0by é", "a\x00b A-b 9z", "long" * 50]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0] + [len(t.encode()) for t in texts])
    for kind, pattern in (("spaced", SPACED), ("plain", PLAIN)):
        words = W.split(data, bounds, kind)
        got = [data[a:b].tobytes().decode().translate(LOW) for a, b in zip(words.start, words.end)]
        want = [pattern.findall(t.translate(LOW)) for t in texts]
        assert got == [w for t in want for w in t]
        assert words.counts().tolist() == [len(t) for t in want]
        seen = {}
        for w, h in zip(got, words.hash.tolist()):
            assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_bpe_is_tiktoken(docs, no_docs):
    import base64

    import public_tokenizers as P
    import tiktoken

    from ferry.llm.bpe import encode_decode

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = encode_decode(docs, path, P.PATTERN, keep=("doc_id", "text")).collect()
    assert len(got) == docs.count()
    for r in got:
        text = r.text or ""
        want = enc.encode_ordinary(text)
        assert r.token_ids == want and r.n_tokens == len(want)
        assert bytes(r.decoded) == text.encode()
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_decode(no_docs, path, P.PATTERN).collect() == []
    with pytest.raises(ValueError):
        encode_decode(docs.withColumnRenamed("lang", "decoded"), path, P.PATTERN, keep=("decoded",))


def test_bpe_cuts_and_rounds():
    import random

    import public_tokenizers as P
    import tiktoken

    from ferry.llm.bpe import codec
    from ferry.llm.common import text_slices

    own = codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    r = random.Random(1)
    parts = ["'s", "'t", "'re", "'", "ll", "'ve", " ", "  ", "\n", "\t", "a", "Z", "é", "12", "٣", "!", "中文", "😀", "s", "\r\n", "　", "\x1c", "re", "'S", "​"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(20))) for _ in range(3000)] + ["q" * 900, "xyzzy" * 300, "y" * 20_000, "ab" * 3000, "-" * 9000,
                                                                                                     "".join(r.choice("abcdefghij") for _ in range(3000))]
    for a, b, data, bounds in text_slices(pa.array(texts)):
        ids, at = own.encode(data, bounds)
        back, back_at = own.decode(ids, at)
        assert back.tobytes() == data.tobytes() and (back_at == bounds).all()
        for i in range(a, b):
            assert ids[at[i - a] : at[i - a + 1]].tolist() == enc.encode_ordinary(texts[i])


def quality_of(text):
    words = SPACED.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), base


def test_quality_measures(docs, no_docs):
    from ferry.llm.quality import passing, quality

    rows = quality(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        want = quality_of(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert r.kept == (not r.base_failed and not r.broken)
    kept = passing(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.kept)
    assert quality(no_docs).collect() == []


def test_quality_rules_have_effect(spark):
    from ferry.llm.quality import quality

    good = "the cat of the house and the dog " * 1 + " ".join(f"word{i} of" for i in range(60))
    rows = by_id(quality(spark.createDataFrame([
        (1, good), (2, good + " |" * 60), (3, " ".join(f"zz{i}" for i in range(80))), (4, "\n".join(f"- the {i} of it{i}" for i in range(40)))],
        "doc_id int, text string")).collect())
    assert rows[1].kept and rows[2].broken == ["symbol_ratio"] and rows[3].broken == ["stop_word_ratio"] and rows[4].broken == ["bullet_line_ratio"]


def test_chat_read_back(spark):
    from ferry.llm.chat import digests, windows

    conv = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tough = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
             (-2, 0, "system", "\\[INST\\]"), (-3, 0, None, None), (-3, 0, "assistant", "<"), (-3, 1, "assistant", "[\\"), (-3, 1, "assistant", "[\\"),
             (-3, None, "user", "</s"), (None, 3, "assistant", "x"), (-4, 0, "system", "be " * 3000), (-4, 1, "assistant", "w " * 5000), (-4, 2, "assistant", "</s>")]
    tough += [(-5, i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 40)) for i in range(700)]
    rows = conv.collect() + tough
    df = spark.createDataFrame([tuple(r) + (0,) for r in rows], "conv_id bigint, turn bigint, role string, text string, window int")
    out = windows(df, budget=256, history=48).collect()
    got = by_id(digests(windows(df, budget=256, history=48)).collect(), "conv_id")
    by_conv = {}
    for c, t, role, text in rows:
        by_conv.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by_conv)
    for c, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest()), c
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest()), c
    assert got[-5].n_windows > 10
    for w in out:
        assert not w.over_budget or w.conv_id == -4 or w.n_turns <= 2 + w.n_repeated, w
        if w.conv_id == -4:
            assert w.formatted.startswith("[INST]system[/INST]be be")
    assert any(w.n_repeated for w in out if w.conv_id == -5)
    assert windows(df.limit(0)).collect() == []


LICENSES = ["mit license", "apache license", "general public license"]


def test_license_base_and_labels(spark, docs, no_docs):
    from ferry.llm.licenses import TEMPLATES, license_scan

    mit = dict(TEMPLATES)["mit-text"]
    damaged = mit.replace("sublicense", "relicense").replace("free of charge", "wholly free of any charge")
    more = spark.createDataFrame([(900, "X MIT-License. mit license mit  LICENSE the General Public\nLicense"), (901, "intro words " + damaged),
                                  (902, "apache license" * 2), (903, "permission is hereby granted")], "doc_id bigint, text string")
    every = docs.unionByName(more, allowMissingColumns=True).where("doc_id is not null")
    rows = by_id(license_scan(every).collect())
    for r in every.collect():
        words = PLAIN.findall((r.text or "").translate(LOW))
        places, labels = [], set()
        for phrase, label in zip(LICENSES, ("mit", "apache", "gpl")):
            p = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        g = rows[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))), r.doc_id
        assert labels <= set(g.labels.split(",")) | {""} and 0 <= g.score <= 1
    assert "mit-text" in rows[901].labels and 0.8 < rows[901].score < 1
    assert rows[903].labels == ""
    assert license_scan(no_docs).collect() == []


def test_license_inserted_stretch(spark):
    """A stretch of 3 to 20 words, at every place of each licence text, hides none of them."""
    from ferry.llm.licenses import GRAM, TEMPLATES, license_scan

    rows, want = [], []
    for name, text in TEMPLATES:
        words = PLAIN.findall(text.translate(LOW))
        for size in (3, 6, 9, 14, 20):
            if size > 0.75 * len(words):
                continue
            for at in range(1, len(words)):
                if max(at, len(words) - at) >= GRAM:
                    own = [f"own{len(rows)}x{k}" for k in range(size)]
                    rows.append((len(rows), " ".join(["before"] * 30 + words[:at] + own + words[at:] + ["after"] * 30)))
                    want.append(name)
    got = by_id(license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert [(i, n) for i, n in enumerate(want) if n not in got[i].labels.split(",")] == []


def test_license_phrases_of_repeated_rows(spark):
    from ferry.llm.licenses import license_scan

    rows = [(1, "the mit license here"), (1, "the mit license here"), (2, "General Public License, apache license"), (2, "General Public License, apache license"),
            (3, "a general public matter"), (3, "a new public license"), (None, "an mit license"), (None, "no mit license"), (None, "say mit license, apache license")]
    got = by_id(license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    found = {i: (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels, g.score) for i, g in got.items()}
    assert found == {1: (4, 1, 1, 1, "mit", 0.5), 2: (5, 2, 0, 3, "apache,gpl", 0.5), 3: (4, 0, None, None, "", 0.0), None: (5, 2, 1, 3, "apache,mit", 0.5)}
    assert [got[i].labels for i in (1, 2, 3, None)] == ["mit", "apache,gpl", "", "apache,mit"]


def plain_identifiers(text):
    def luhn(d):
        t = 0
        for i, c in enumerate(d[::-1]):
            x = int(c) * (2 if i % 2 else 1)
            t += x - 9 if x > 9 else x
        return t % 10 == 0

    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return out


TOUGH = ["a@b.c@d.e x@y.z", "@@a.b@c.d.", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.0004", "4111 1111 1111 1111 4111-1111-1111-11111", "+1 (555) 010-9999. +49",
         "mail a.b+c@x-y.co.uk, 10.0.0.1:80", "é@x.y", "a@b", "..@..", "+1+22 333 4444 55", "5555555555554444 " * 3]


def test_personal_data_base(spark, docs, no_docs):
    import random

    from ferry.llm.pii import identifiers, personal_data

    r = random.Random(5)
    noise = ["".join(r.choice("ab1 .@+-()29") for _ in range(60)) for _ in range(4000)]
    for text in TOUGH + noise:
        got = [("email ip card phone".split()[k], a, b) for k, a, b in identifiers(text)]
        assert got == plain_identifiers(text), text
    rows = personal_data(docs).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for g in rows:
        want = plain_identifiers(texts[g.doc_id])
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert g.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(x[0] == k for x in want) for k in "email ip card phone".split()]
        assert set(told.split(",")) <= set(g.spans.split(","))
    assert personal_data(no_docs).collect() == []


@pytest.mark.parametrize("text, kind, found", [
    ("write to john (at) example (dot) com now", 0, "john (at) example (dot) com"),
    ("write john.doe at example dot org.", 0, "john.doe at example dot org"),
    ("é jоhn@exаmple.com", 0, "jоhn@exаmple.com"),
    ("call plus four four two zero seven nine four six zero nine five eight please", 3,
     "plus four four two zero seven nine four six zero nine five eight"),
    ("ip １０.０.０.１ here", 1, "１０.０.０.１"),
    ("jo​hn@mail.example.com", 0, "jo​hn@mail.example.com"),
    ("card four one one one 1111 1111 1111 x", 2, "four one one one 1111 1111 1111"),
    ("we met at noon, dot by dot. one two three", 0, None),
    ("john dot doe at mail dot example dot co dot uk", 0, "john dot doe at mail dot example dot co dot uk"),
    ("JOHN [AT] EXAMPLE [DOT] COM", 0, "JOHN [AT] EXAMPLE [DOT] COM"),
    ("john @ example.com or", 0, "john @ example.com"),
    ("john[@]example[.]com", 0, "john[@]example[.]com"),
    ("call +1 (555) O1O-9999 or +1 555 0l0 9999", 3, "+1 555 0l0 9999"),
    ("+٣٣ ٦١٢ ٣٤٥ ٦٧٨", 3, "+٣٣ ٦١٢ ٣٤٥ ٦٧٨"),
    ("ten @ noon. we met at home.", 0, None),
])
def test_disguised_identifiers(text, kind, found):
    from ferry.llm.pii import personal_spans

    plain, every = personal_spans(text)
    new = [text[a:b] for k, a, b in every if k == kind and (k, a, b) not in plain]
    assert set(plain) <= set(every)
    assert new == ([found] if found else [])


def test_language_profiles(spark, edge_docs, no_docs):
    from ferry.llm.langid import identify

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = by_id(identify(docs).collect())
    import zlib

    real = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [i for i, r in rows.items() if r.held_out and real[i]]
    assert np.mean([rows[i].lang_pred == real[i] for i in held]) > 0.95
    edge = identify(edge_docs)
    assert edge.count() == edge_docs.count()
    texts = {r.doc_id: r.text or "" for r in edge_docs.collect()}
    for r in edge.collect():
        letters = any(unicodedata.category(c)[0] == "L" for c in texts[r.doc_id])
        assert r.lang_pred == ("en" if letters else "und") and 0 <= r.score <= 1
    assert identify(no_docs).collect() == []
    nothing = identify(edge_docs.withColumn("lang", edge_docs.lang.substr(9, 1)).where("lang = 'x' or lang is null"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
