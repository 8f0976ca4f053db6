"""Benchmark decontamination with spaced seeds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import words as W
from ferry.llm.common import saved, shipped, text_slices
from ferry.llm.filters import bitmap, passes

#: Seed masks: 1 takes the word into the hash, 0 ignores it.
MASKS = ("111101111", "11011011", "1110111", "101110011", "1100110101")
#: Items shorter than some mask are sought by a contiguous seed of so many words too, and
#: shorter ones not at all.
SHORTEST = 4
#: Words around hits that a segment carries for the verification.
MARGIN = 96
#: Words between hits up to which they share a segment: what their margins reach.
JOINED = 2 * MARGIN


def _seeds(masks: tuple[str, ...]) -> list[tuple[int, ...]]:
    spaced = [tuple(i for i, x in enumerate(m) if x == "1") for m in masks]
    return [*spaced, tuple(range(SHORTEST))]


def _hashes(words: W.Words, seeds: list[tuple[int, ...]], which) -> tuple[np.ndarray, np.ndarray]:
    parts = [W.grams(words, seeds[k], salt=100 + k) for k in which]
    return np.concatenate([h for h, _ in parts]), np.concatenate([a for _, a in parts])


def item_index(benchmark: DataFrame, masks: tuple[str, ...], id_col: str, text_col: str) -> DataFrame:
    """(item_id, n_words, words, hashes): one row per distinct word sequence, which the
    smallest item id stands for; ``hashes`` are (hash, pos) of the seeds."""
    seeds = _seeds(masks)
    longest = max(map(len, masks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(1)):
                words = W.split(data, bounds, "plain")
                rows = []
                for i, n in enumerate(words.counts()):
                    own = words.hash[words.of[i] : words.of[i + 1]]
                    one = W.Words(own, own, own, np.array([0, n]))
                    which = [k for k, m in enumerate(masks) if len(m) <= n] + [len(masks)] * int(SHORTEST <= n < longest)
                    h, at = _hashes(one, seeds, which) if len(which) else (np.zeros(0, W.U64), np.zeros(0, np.int64))
                    rows.append((n, own.tobytes(), [{"hash": int(x), "pos": int(y)} for x, y in zip(h.view(np.int64), at, strict=True)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array([r[0] for r in rows], pa.int32()),
                     pa.array([r[1] for r in rows], pa.binary()),
                     pa.array([r[2] for r in rows], pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32())])))],
                    names=["item_id", "n_words", "words", "hashes"])

    items = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    rows = items.mapInArrow(run, "item_id bigint, n_words int, words binary, hashes array<struct<hash: bigint, pos: int>>")
    return rows.where(F.size("hashes") > 0).groupBy("words").agg(
        F.min("item_id").alias("item_id"), F.first("n_words").alias("n_words"), F.first("hashes").alias("hashes"))


def segments(docs: DataFrame, masks: tuple[str, ...], short: bool, shared, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, seg, first, words, hits): stretches of documents around seeds that pass the
    filter, with their words' hashes and the (hash, pos) of those seeds; ``seg`` is the
    first seed's word, ``first`` that of the words carried."""
    seeds = _seeds(masks)
    which = range(len(seeds) - (not short))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(1)):
                words = W.split(data, bounds, "plain")
                if not len(words.hash):
                    continue
                found = []
                for k in which:
                    h, at = W.grams(words, seeds[k], salt=100 + k)
                    ok = passes(table, h)
                    found.append((h[ok], at[ok]))
                hashes, at = (np.concatenate(x) for x in zip(*found, strict=True))
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                hashes, at = hashes[order], at[order]
                text = words.texts()[at]
                cuts = np.flatnonzero((np.diff(at) > JOINED) | (np.diff(text) > 0)) + 1
                rows = []
                for a, b in zip(np.append(0, cuts), np.append(cuts, len(at)), strict=True):
                    lo, hi = words.of[text[a]], words.of[text[a] + 1]
                    left, right = max(lo, at[a] - MARGIN), min(hi, at[b - 1] + MARGIN)
                    rows.append((first + text[a], at[a] - lo, left - lo, words.hash[left:right].tobytes(),
                                 [{"hash": int(h), "pos": int(p)} for h, p in zip(hashes[a:b].view(np.int64), at[a:b] - lo, strict=True)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary()),
                     pa.array([r[4] for r in rows], pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int64())])))],
                    names=["doc_id", "seg", "first", "words", "hits"])

    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, seg bigint, first bigint, words binary, hits array<struct<hash: bigint, pos: bigint>>")


def best_overlap(same: np.ndarray, penalty: int) -> tuple[int, int]:
    """Bounds of the stretch of aligned words with the largest sum of 1 per equal and
    -``penalty`` per unequal word, the longest of equal ones."""
    sums = np.append(0, np.cumsum(np.where(same, 1, -penalty)))
    low = np.minimum.accumulate(sums)
    gain = sums - low
    end = len(gain) - 1 - int(np.argmax(gain[::-1]))
    return int(np.argmin(sums[: end + 1])), end


def contaminations(docs: DataFrame, benchmark: DataFrame, min_words: int = 10, min_share: float = 0.7,
                   penalty: int = 2, masks: tuple[str, ...] = MASKS, id_col: str = "doc_id",
                   text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words, n_equal): overlaps of documents with
    benchmark items, one row per document, item and alignment.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
    Spaced seeds (``masks``) hash the words at some places of a window and ignore the
    others; document and item seeds of equal hash are joined and fix an alignment. Along
    it, the stretch with the best sum (1 per equal word, -``penalty`` per other) is the
    overlap. It counts if it has ``min_words`` equal words or spans ``min_share`` of the
    item's words, in either case at least ``SHORTEST`` equal ones.

    Of an alignment's overlaps the one with most equal words counts, the first of equal ones.

    Items shorter than some mask are sought by the masks that they hold and by every
    ``SHORTEST`` words in a row, which finds each item of 7 to 9 words with one other word;
    one of 4 to 6 is found where ``SHORTEST`` words in a row are left. Shorter items are
    evidence of nothing and match nothing.
    Equal items are represented by the smallest id. A filter of fixed size keeps
    documents' seeds that no item has out of the join. Null, empty and wordless texts and
    null ids match nothing; repeated rows of a document are one; columns beside id and
    text are ignored; an empty table on either side gives an empty result.
    """
    shipped(docs)
    items = saved(item_index(benchmark, masks, item_id_col, item_text_col))
    seeds = items.select("item_id", F.explode("hashes").alias("s")).select("item_id", "s.hash", F.col("s.pos").alias("item_pos"))
    table = docs.sparkSession.sparkContext.broadcast(bitmap(seeds.select("hash").distinct()))
    longest = max(map(len, masks))
    short = bool(items.where(F.col("n_words") < longest).head(1))
    found = saved(segments(docs, masks, short, table, id_col, text_col).withColumn("seg", F.xxhash64("seg", "words"))
                  .dropDuplicates(["doc_id", "seg"]))
    hits = found.select("doc_id", "seg", F.explode("hits").alias("h")).select("doc_id", "seg", "h.hash", "h.pos")
    lines = hits.join(seeds, "hash").select("doc_id", "seg", "item_id", (F.col("pos") - F.col("item_pos")).alias("offset")).distinct()
    rows = (lines.join(found.select("doc_id", "seg", "first", "words"), ["doc_id", "seg"])
            .join(items.select("item_id", F.col("words").alias("item_words")), "item_id")
            .select("doc_id", "item_id", "offset", "first", "words", "item_words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, (offset, first) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                doc = np.frombuffer(batch.column(4)[i].as_buffer(), W.U64)
                item = np.frombuffer(batch.column(5)[i].as_buffer(), W.U64)
                lo, hi = max(offset, first), min(offset + len(item), first + len(doc))
                same = doc[lo - first : hi - first] == item[lo - offset : hi - offset]
                a, b = best_overlap(same, penalty)
                equal = int(same[a:b].sum())
                if equal >= min_words or (b - a >= min_share * len(item) and equal >= min(SHORTEST, len(item))):
                    out.append((i, lo + a, lo + a - offset, b - a, equal))
            at = pa.array([r[0] for r in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)]
                                             + [pa.array([r[k] for r in out], pa.int64()) for k in range(1, 5)],
                                             names=["doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal"])

    found = rows.mapInArrow(run, "doc_id bigint, item_id bigint, doc_word bigint, item_word bigint, n_words bigint, n_equal bigint")
    best = F.max_by(F.struct("doc_word", "item_word", "n_words", "n_equal"), F.struct("n_equal", F.negate("doc_word"), F.negate("n_words")))
    return found.groupBy("doc_id", "item_id", (F.col("doc_word") - F.col("item_word")).alias("offset")).agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows of contaminated documents; rows with a null id stay. No
    column name of ``docs`` can clash with a helper's."""
    bad = contaminations(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("bad")).distinct()
    return docs.join(bad, docs[id_col].cast("long") == bad["bad"], "left_anti")
