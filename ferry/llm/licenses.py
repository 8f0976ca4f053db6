"""License scans by diagonal voting of word k-grams."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm import words as W
from ferry.llm.common import saved, shipped, text_slices
from ferry.llm.filters import id_bitmap, id_hash, passes

# Phrases with their labels, and public licence texts or notices.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
TEMPLATES = (
    ("mit-text", """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
so, subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("mit-notice", "Released under the MIT License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-text", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations
under the License."""),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU General Public License for more details."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
)
#: Words of a gram: of phrases, which must match whole, and of templates.
PHRASE_GRAM, GRAM = 2, 4
#: Diagonals so far apart belong together; a gap of so many words ends a span.
BAND, GAP = 8, 40
#: Share of a template's words that a verified span must hold, in order.
LEAST_SHARE = 0.75


def _words_of(text: str) -> tuple[W.Words, list[int]]:
    data = np.frombuffer(text.encode(), np.uint8)
    words = W.split(data, np.array([0, len(data)]), "plain")
    return words, words.hash.view(np.int64).tolist()


def template_rows() -> list[tuple[int, int, int, int]]:
    """(gram, hash, template, pos) of every rolling gram of the fixed texts: some hundreds
    of rows whatever the corpus, so they may be broadcast."""
    out = []
    for i, (text, size) in enumerate([(p, PHRASE_GRAM) for p, _ in PHRASES] + [(t, GRAM) for _, t in TEMPLATES]):
        hashes, at = W.grams(_words_of(text)[0], tuple(range(size)), salt=size)
        out += [(size, int(h), i, int(p)) for h, p in zip(hashes.view(np.int64), at, strict=True)]
    return out


def word_grams(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, of, n_words, g2, g4): all rolling gram hashes of each text; ``of`` is its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(2), 1 << 19):
                words = W.split(data, bounds, "plain")
                columns = [pa.array(words.counts(), pa.int64())]
                for size in (PHRASE_GRAM, GRAM):
                    hashes, at = W.grams(words, tuple(range(size)), salt=size)
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(at, words.of), pa.int32()), pa.array(hashes.view(np.int64))))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(first, end - first) for i in (0, 1)), *columns],
                                                 names=["doc_id", "of", "n_words", "g2", "g4"])

    return shipped(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("of"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, of bigint, n_words bigint, g2 array<bigint>, g4 array<bigint>")


def votes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, of, n_words, template, diagonal, held, first_word, last_word): every rolling
    gram of every text joined to the template positions of equal hash, by diagonal
    (document position less template position). Bit i of ``held`` says that a phrase's
    gram i stands there; rows that repeat a text set the same bits. Template -1 keeps a
    row of each text."""
    templates = F.broadcast(docs.sparkSession.createDataFrame(template_rows(), "gram int, hash bigint, template int, pos int"))

    def gram(size: int, column: str):
        return F.transform(column, lambda h, i: F.struct(F.lit(size).alias("gram"), i.alias("at"), h.alias("hash")))

    none = F.struct(F.lit(0).alias("gram"), F.lit(-1).alias("at"), F.lit(None).cast("bigint").alias("hash"))
    grams = word_grams(docs, id_col, text_col).select("doc_id", "of", "n_words", F.explode(F.concat(
        F.array(none), gram(PHRASE_GRAM, "g2"), gram(GRAM, "g4"))).alias("g")).select("doc_id", "of", "n_words", "g.*")
    hits = grams.join(templates, ["gram", "hash"], "left").where("gram = 0 or template is not null")
    return hits.groupBy("doc_id", "of", F.coalesce("template", F.lit(-1)).alias("template"), (F.col("at") - F.col("pos")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"), F.expr("bit_or(case when gram = %d then shiftleft(1, pos) end)" % PHRASE_GRAM).alias("held"), F.min("at").alias("first_word"),
        F.max(F.col("at") + F.col("gram") - 1).alias("last_word"))


def merged(diagonals: DataFrame) -> DataFrame:
    """(doc_id, template, first_word, last_word): diagonals at most ``BAND`` apart are one
    span unless more than ``GAP`` words lie between their votes, so a few inserted or
    lost words don't part a text."""
    own = Window.partitionBy("doc_id", "template").orderBy("first_word", "diagonal")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    fresh = (F.abs(F.col("diagonal") - F.lag("diagonal").over(own)) > BAND) | (F.col("first_word") - F.max("last_word").over(before) > GAP)
    rows = diagonals.withColumn("fresh", F.coalesce(fresh.cast("int"), F.lit(1)))
    return (rows.withColumn("span", F.sum("fresh").over(own.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc_id", "template", "span").agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word")).drop("span"))


def verified(spans: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, template, first_word, last_word, share): spans whose words, read from the
    text, hold ``LEAST_SHARE`` of the template's words in order. A template's length of words on
    either side is read too, for what no vote reached: a stretch inserted anywhere, of up
    to three quarters of that length, hides no text of which ``GRAM`` words are left in
    a row."""
    shared = docs.sparkSession.sparkContext.broadcast(id_bitmap(spans.select("doc_id")))
    known = [_words_of(t)[1] for t, _ in PHRASES] + [_words_of(t)[1] for _, t in TEMPLATES]

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(shared.value, id_hash(batch.column(0).to_numpy()))))
            for first, end, data, bounds in text_slices(batch.column(1)):
                found = W.split(data, bounds, "plain")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first),
                     pa.array([found.hash[a:b].tobytes() for a, b in zip(found.of[:-1], found.of[1:], strict=True)], pa.binary())],
                    names=["doc_id", "words"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = []
            for t, a, b, w in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
                template, own = known[t], np.frombuffer(w, np.int64)
                reach = own[max(0, a - len(template)) : b + 1 + len(template)].tolist()
                blocks = SequenceMatcher(None, template, reach, autojunk=False).get_matching_blocks()
                share.append(sum(x.size for x in blocks) / len(template))
            out = batch.select([0, 1, 2, 3]).append_column("share", pa.array(share, pa.float64()))
            yield out.filter(pa.array([x >= LEAST_SHARE for x in share], pa.bool_()))

    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    own = texts.mapInArrow(words, "doc_id bigint, words binary")
    return spans.select("doc_id", "template", "first_word", "last_word").join(own, "doc_id").mapInArrow(
        check, "doc_id bigint, template int, first_word int, last_word int, share double")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
    All rolling word grams of a text are joined to the positions of fixed phrases and
    licence texts; hits vote for diagonals. A phrase stands where one diagonal of a text
    has each of its grams: ``n_base`` places, the smallest and largest start in words, their
    ``base_labels``. For licence texts, neighbouring diagonals are merged and the spans
    verified word by word; their labels join the phrases' in ``labels``. ``score`` is the
    largest verified share of a licence text's words, at least 0.5 where a phrase stands,
    0 without either.

    One row per id (rows that repeat an id are one document, in which a phrase at the same
    word counts once; null is an id whose phrases count and whose licence texts don't). A null or empty text gives zeros, null
    positions and empty labels. Columns beside id and text are ignored; an empty table
    gives an empty result.
    """
    found = saved(votes(docs, id_col, text_col))
    need = [len(_words_of(p)[1]) - PHRASE_GRAM + 1 for p, _ in PHRASES]
    whole = F.expr("case template " + " ".join(f"when {i} then {(1 << n) - 1}" for i, n in enumerate(need)) + " end")
    names = F.expr("case template " + " ".join(f"when {i} then '{x}'" for i, x in enumerate([x for _, x in PHRASES] + [x for x, _ in TEMPLATES])) + " end")
    phrases = found.where((F.col("template") >= 0) & (F.col("held") == whole)).select(
        "doc_id", names.alias("label"), F.col("first_word").alias("place"), F.lit(0.5).alias("share")).distinct()
    spans = saved(merged(found.where(F.col("template") >= len(PHRASES))).where("doc_id is not null"))
    texts = verified(spans, docs, id_col, text_col).select(
        "doc_id", names.alias("label"), F.lit(None).cast("int").alias("place"), "share")
    rows = found.where("template = -1").select("doc_id", "n_words", *[F.lit(None).cast(t).alias(c) for c, t in (("label", "string"), ("place", "int"), ("share", "double"))])
    more = phrases.union(texts).select("doc_id", F.lit(0).cast("long").alias("n_words"), "label", "place", "share")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return rows.union(more).groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.count("place").alias("n_base"), F.min("place").cast("long").alias("first_word"),
        F.max("place").cast("long").alias("last_word"), joined(F.when(F.col("place").isNotNull(), F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"))
