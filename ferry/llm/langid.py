"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm import words as W
from ferry.llm.common import shipped, text_slices

#: Lengths of n-grams, and the most frequent ones that make a profile.
LENGTHS, PROFILE = (1, 2, 3), 400
#: N-grams are counted under so many bits of their hash.
BITS = 20
#: The most languages that a model may hold; learning more raises.
MOST_LANGS = 2000


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a letter, and its lower case where that is one letter."""
    every = [*range(0xD800), *range(0xE000, 0x110000)]
    letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for c in every:
        x = chr(c)
        if x.isalpha():
            letter[c] = True
            if len(y := x.lower()) == 1:
                lower[c] = ord(y)
    return letter, lower


def ngrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text index, letters per text): n-grams of the letters' words, each word
    between two blanks; text indices ascend within each length."""
    letter, lower = _letters()
    point = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.searchsorted(np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data)), bounds)
    # a blank after each text, so that words don't cross texts
    point = np.insert(point, at[1:], 0x20)
    at = at + np.arange(len(at))
    is_letter = letter[point]
    letters = np.add.reduceat(np.append(is_letter, False).astype(np.int64), at[:-1]) if len(at) > 1 else np.zeros(0, np.int64)
    point = np.where(is_letter, lower[point], 0x20)
    text = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
    blank = ~is_letter
    keep = ~(blank & np.append(True, blank[:-1] & (text[1:] == text[:-1])))  # runs of blanks are one
    first = np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, bool)
    keep |= first & is_letter
    point, text = point[keep].astype(W.U64), text[keep]
    # a word at a text's start also follows a blank
    starts = np.flatnonzero(np.append(True, text[1:] != text[:-1]) & (point != 0x20)) if len(text) else np.zeros(0, np.int64)
    point, text = np.insert(point, starts, W.U64(0x20)), np.insert(text, starts, text[starts])
    out, of = [], []
    for n in LENGTHS:
        if len(point) < n:
            continue
        h = np.zeros(len(point) - n + 1, W.U64)
        for k in range(n):
            h = h * W.U64(0x110000) + point[k : len(point) - n + 1 + k]
        ok = (text[: len(h)] == text[n - 1 :])
        if n == 1:
            ok &= point != 0x20
        if n == 3:
            ok &= point[1:-1] != 0x20
        out.append((W.mix(h[ok] + W.U64(n)) >> W.U64(64 - BITS)).astype(np.int64))
        of.append(text[: len(h)][ok])
    return np.concatenate(out) if out else np.zeros(0, np.int64), np.concatenate(of) if of else np.zeros(0, np.int32), letters


def profiles(train: DataFrame, lang_col: str = "lang", text_col: str = "text") -> pd.DataFrame:
    """(lang, gram, rank): each language's ``PROFILE`` most frequent n-grams, counted over
    every text of ``train``. The model: at most ``MOST_LANGS`` * ``PROFILE`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def flush():
            for lang, c in counts.items():
                grams = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(c[grams], pa.int64())],
                                                 names=["lang", "gram", "n"])
            counts.clear()

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for first, end, data, bounds in text_slices(batch.column(0)):
                grams, text, _ = ngrams(data, bounds)
                own, code = np.unique(langs[first:end].astype(str), return_inverse=True)
                for i, lang in enumerate(own.tolist()):
                    if lang not in counts and len(counts) >= 16:  # tables at once, a bound on memory only
                        yield from flush()
                    found = np.bincount(grams[code[text] == i], minlength=1 << BITS)
                    counts[lang] = counts[lang] + found if lang in counts else found
        yield from flush()

    rows = shipped(train).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col), F.col(lang_col)).mapInArrow(
        run, "lang string, gram bigint, n bigint")
    total = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    if (n := total.select("lang").distinct().limit(MOST_LANGS + 1).count()) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages: {n}")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    return total.withColumn("rank", rank).where(F.col("rank") <= PROFILE).select("lang", "gram", "rank").toPandas()


def predict(docs: DataFrame, model: pd.DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added.

    A document's ``PROFILE`` most frequent n-grams, ranked, are compared to each
    language's profile: the distance sums the differences of ranks, ``PROFILE`` for an
    n-gram that the profile lacks. The nearest language wins, of equal ones the first by
    name. ``score`` is 1 less the distance over the greatest possible one. A null text,
    one without a letter, and any text under an empty model is ``und`` with score 0.
    """
    if clash := {"lang_pred", "score"} & set(docs.columns):
        raise ValueError(f"columns already exist: {sorted(clash)}")
    langs = sorted(model["lang"].unique().tolist())
    table = np.full((1 << BITS, ), -1, np.int32)  # gram -> row of ranks
    grams = np.unique(model["gram"].to_numpy(np.int64)) if len(model) else np.zeros(0, np.int64)
    table[grams] = np.arange(len(grams))
    ranks = np.zeros((len(grams) + 1, len(langs)), np.int32)  # 0: absent; the last row is for unknown grams
    for lang, gram, rank in model.itertuples(index=False):
        ranks[table[gram], langs.index(lang)] = rank
    shared = docs.sparkSession.sparkContext.broadcast((langs, table, ranks))
    names = docs.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table, ranks = shared.value
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(names.index(text_col))):
                grams, text, letters = ngrams(data, bounds)
                key, n = np.unique(text.astype(np.int64) << BITS | grams, return_counts=True)
                own, gram = key >> BITS, key & ((1 << BITS) - 1)
                order = np.lexsort((gram, -n, own))
                own, gram = own[order], gram[order]
                at = np.searchsorted(own, np.arange(end - first + 1))
                pred, score = [], []
                for i in range(end - first):
                    top = gram[at[i] : min(at[i + 1], at[i] + PROFILE)]
                    if not letters[i] or not langs:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    r = ranks[table[top]]
                    away = np.where(r > 0, np.abs(r - np.arange(1, len(top) + 1)[:, None]), PROFILE).sum(0)
                    best = int(np.argmin(away))
                    pred.append(langs[best])
                    score.append(float(1 - away[best] / (PROFILE * len(top))))
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                                 names=[*names, "lang_pred", "score"])

    return shipped(docs).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score): a model learned on the rows that are not held
    out and have a language, applied to all rows.

    Repeated rows count as often as they stand. A null id is not held out. An empty table
    gives an empty result. Columns beside the three named are ignored.
    """
    model = profiles(docs.where(~held_out(id_col)), lang_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model).drop("text")
