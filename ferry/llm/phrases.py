"""Phrase collocations: suffix pointers, routed by leading words and sorted by multikey quicksort."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm import words as W
from ferry.llm.common import saved, shipped, text_slices
from ferry.llm.filters import bitmap, passes

#: Words of the longest phrase, which is the greatest depth of the sort.
DEPTH = 5
#: A prefix is hot that begins a 1,024th of all words, or this many: so many words' suffixes
#: fit a task's memory. So at most 1,024 prefixes of each length are hot, and of a larger
#: input one for so many words.
HOT_SHIFT, HOT_MOST = 10, 1 << 23
#: Buckets that suffixes are routed to: at least so many, and one for so many words.
BUCKETS, BUCKET_WORDS = 256, 1 << 18
#: Bytes of text whose suffixes are combined before they are sent.
SEND_BYTES = 2 << 20
DEAL = 8
UNKNOWN = "und"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, W.Words, np.ndarray, np.ndarray]]:
    """(rows, bytes, words, key of each word, whether the next word is of its piece) for
    slices of (lang, text) rows; a key stands for a word of a language."""
    ends = np.zeros(256, bool)
    ends[list(W.PIECE_ENDS)] = True
    for batch in batches:
        langs = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in batch.column(0).unique().to_pylist()}
        for a, b, data, bounds in text_slices(batch.column(1), SEND_BYTES):
            words = W.split(data, bounds, "pieces")
            own = np.array([langs[x] for x in batch.column(0)[a:b].to_pylist()], W.U64)
            text = words.texts()
            piece = np.concatenate([[0], np.cumsum(ends[data])])[words.start]
            follows = np.zeros(len(text), bool)
            if len(text):
                follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
            yield batch.slice(a, b - a), data, words, W.mix(words.hash + own[text]), follows


def vocabulary(texts: DataFrame) -> DataFrame:
    """(key, lang, word, n): every word of each language and its occurrences. Two words of
    one key would be taken for one another, so they raise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, words, key, _ in _slices(batches):
            distinct, first, n = np.unique(key, return_index=True, return_counts=True)
            low = data.tobytes().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
            said = [low[s:e].decode() for s, e in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)]
            lang = rows.column(0).take(pa.array(words.texts()[first], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), lang, pa.array(said, pa.string()), pa.array(n, pa.int64())],
                                             names=["key", "lang", "word", "n"])

    out = saved(texts.mapInArrow(run, "key bigint, lang string, word string, n bigint").groupBy("key", "lang", "word").agg(F.sum("n").alias("n")))
    if alike := out.groupBy("key").agg(F.count("*").alias("c"), F.min("word").alias("x"), F.max("word").alias("y")).where("c > 1").head(1):
        raise ValueError(f"words of one hash: {alike}")
    return out


def combined(words: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of ``words`` (depth, n), and the sum of weights of each."""
    total = np.zeros(words.shape[1], W.U64)
    for row, c in zip(words, W.constants(len(words), 41), strict=True):
        total += W.mix(row + c)
    _, first, place = np.unique(W.mix(total), return_index=True, return_inverse=True)
    if (words[:, first][:, place] != words).any():  # another of the same hash
        distinct, place = np.unique(words, axis=1, return_inverse=True)
    else:
        distinct = words[:, first]
    return distinct, np.bincount(place.ravel(), weights=weight, minlength=distinct.shape[1]).astype(np.int64)


class Prefixes:
    """A sorted set of word sequences up to ``DEPTH`` words, compared word by word."""

    def __init__(self, rows: list[tuple[int, ...]]):
        self.words = np.zeros((DEPTH, len(rows)), W.U64)
        for i, row in enumerate(rows):
            self.words[: len(row), i] = np.array(row, np.int64).view(W.U64)
        hashes = self.hashes(self.words)
        order = np.argsort(hashes)
        self.words, self.sorted = self.words[:, order], hashes[order]

    @staticmethod
    def hashes(words: np.ndarray) -> np.ndarray:
        total = np.zeros(words.shape[1], W.U64)
        for row, c in zip(words, W.constants(DEPTH, 43), strict=True):
            total = W.mix((total ^ row) * c)
        return total

    def holds(self, words: np.ndarray) -> np.ndarray:
        """Whether each column of ``words`` (depth, n) is in the set."""
        full = np.zeros((DEPTH, words.shape[1]), W.U64)
        full[: len(words)] = words
        if not len(self.sorted):
            return np.zeros(words.shape[1], bool)
        h = self.hashes(full)
        at = np.searchsorted(self.sorted, h)
        found = np.zeros(len(h), bool)
        for k in range(2):  # two sequences of one hash stand side by side
            place = np.minimum(at + k, len(self.sorted) - 1)
            found |= (self.words[:, place] == full).all(0)
        return found


def _runs(good: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """For each word the good ones from it on in its piece, ``DEPTH`` at most."""
    n = good.astype(np.int64)
    run = n.copy()
    for _ in range(DEPTH - 1):
        after = np.zeros_like(run)
        after[:-1] = np.where(follows[:-1], run[1:], 0)
        run = np.where(good, 1 + np.minimum(after, DEPTH - 1), 0)
    return run


def _suffixes(key: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(depth, n): the words that suffixes at ``at`` begin with, zero beyond ``length``."""
    out = np.zeros((DEPTH, len(at)), W.U64)
    for d in range(DEPTH):
        more = length > d
        out[d, more] = key[at[more] + d]
    return out


def hot_prefixes(texts: DataFrame, hot_words: list[int], bound: int) -> dict[tuple[int, ...], int]:
    """Occurrences of each sequence of 2 to ``DEPTH`` words that occurs ``bound`` times or
    more. All its words are hot; ``bound`` limits both to a fixed number."""
    if not hot_words:
        return {}
    shared = texts.sparkSession.sparkContext.broadcast(np.sort(np.array(hot_words, np.int64).view(W.U64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, key, follows in _slices(batches):
            place = np.minimum(np.searchsorted(shared.value, key), len(shared.value) - 1)
            length = _runs(shared.value[place] == key, follows)
            for d in range(2, DEPTH + 1):
                at = np.flatnonzero(length >= d)
                if len(at):
                    words, n = combined(_suffixes(key, at, np.full(len(at), d)), np.ones(len(at)))
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(words[:d].T).view(np.int64).ravel()), d).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([lists, pa.array(n)], names=["words", "n"])

    rows = texts.mapInArrow(run, "words array<bigint>, n bigint").groupBy("words").agg(F.sum("n").alias("n")).where(F.col("n") >= bound)
    return {tuple(x.words): x.n for x in rows.collect()}


def packed(words: np.ndarray, n: np.ndarray, depth: np.ndarray) -> bytes:
    """Suffixes (depth, n), zero beyond their ends, with their numbers and the lengths of
    their routing prefixes: their distinct words once, then small places among these."""
    distinct, place = np.unique(words, return_inverse=True)
    kind = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
    head = np.array([words.shape[1], len(distinct)], np.int64)
    return b"".join(x.tobytes() for x in (head, distinct, place.reshape(words.shape).astype(kind), n.astype(np.uint32), depth.astype(np.uint8)))


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What was ``packed``."""
    size, held = np.frombuffer(data, np.int64, 2).tolist()
    distinct = np.frombuffer(data, W.U64, held, 16)
    kind = np.dtype(np.uint16 if held <= 1 << 16 else np.uint32)
    at = 16 + 8 * held
    place = np.frombuffer(data, kind, DEPTH * size, at).reshape(DEPTH, size)
    at += kind.itemsize * DEPTH * size
    return distinct[place], np.frombuffer(data, np.uint32, size, at).astype(np.int64), np.frombuffer(data, np.uint8, size, at + 4 * size)


def _pairs(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit fragment of each word's hash with the next one."""
    h = W.mix((key[:-1] ^ W.mix(key[1:])) * W.U64(W.BASE))
    return (h % W.U64(buckets)).astype(np.int64), (h >> W.U64(32)).astype(np.uint32)


def _pair_key(bucket: np.ndarray, fragment: np.ndarray) -> np.ndarray:
    return W.mix((bucket.astype(W.U64) << W.U64(32)) | fragment.astype(W.U64))


def frequent_pairs(texts: DataFrame, frequent: np.ndarray, buckets: int, least: int) -> np.ndarray:
    """A ``bitmap`` of word pairs, each that occurs ``least`` times among them. Only hash
    fragments are sent, of a pair ``least`` from a slice at most; pairs that share one are
    counted together, which lets more through and none less."""
    common = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, key, follows in _slices(batches):
            good = passes(common.value, key)
            at = np.flatnonzero(good[:-1] & good[1:] & follows[:-1])
            if not len(at):
                continue
            bucket, fragment = (x[at] for x in _pairs(key, buckets))
            coded, n = np.unique(bucket.astype(W.U64) << W.U64(32) | fragment, return_counts=True)
            coded = np.repeat(coded, np.minimum(n, least))
            own, fragment = (coded >> W.U64(32)).astype(np.int64), coded.astype(np.uint32)
            cuts = np.flatnonzero(np.diff(own, prepend=-1, append=buckets + 1))
            parts = [fragment[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(own[cuts[:-1]]), pa.array(parts, pa.binary())], names=["bucket", "fragments"])

    def counted(bucket: pa.Table) -> pa.Table:
        fragment, n = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in bucket.column("fragments")]), return_counts=True)
        fragment = fragment[n >= least]
        own = np.full(len(fragment), bucket.column("bucket")[0].as_py())
        return pa.table({"hash": pa.array(_pair_key(own, fragment).view(np.int64))})

    return bitmap(saved(texts.mapInArrow(run, "bucket bigint, fragments binary").groupBy("bucket").applyInArrow(counted, "hash bigint")))


def routed(texts: DataFrame, frequent: np.ndarray, pairs: np.ndarray, hot: Prefixes, buckets: int) -> DataFrame:
    """(bucket, suffixes): suffix pointers with the words they lead to, by leading words.

    A suffix is cut before the first word, and within the first pair, that is too rare. It is routed by its first word,
    or by the fewest leading words that are no hot prefix; one that is hot in full is left
    out, as all its prefixes are counted. Equal suffixes of a slice are sent once, with
    their number (``packed``)."""
    spark = texts.sparkSession
    common, often, prefixes = (spark.sparkContext.broadcast(x) for x in (frequent, pairs, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, key, follows in _slices(batches):
            good = passes(common.value, key)
            near = np.flatnonzero(good[:-1] & good[1:] & follows[:-1])
            linked = np.zeros(len(key), bool)
            linked[near] = passes(often.value, _pair_key(*(x[near] for x in _pairs(key, buckets))))
            length = _runs(good, linked)
            at = np.flatnonzero(length > 1)
            if not len(at):
                continue
            words, n = combined(_suffixes(key, at, length[at]), np.ones(len(at)))
            length = (words != 0).sum(0)
            depth = np.ones(words.shape[1], np.int64)
            open_ = np.arange(words.shape[1])
            for d in range(1, DEPTH + 1):
                open_ = open_[prefixes.value.holds(words[:d, open_]) & (length[open_] >= d)]
                depth[open_] = d + 1
            route = np.zeros(words.shape[1], W.U64)
            for d in range(DEPTH):
                route = np.where(depth > d, W.mix((route ^ words[d]) * W.U64(W.BASE)), route)
            bucket = (route % W.U64(buckets)).astype(np.int64)
            keep = np.flatnonzero(depth <= length)
            order = keep[np.lexsort((words[1, keep], words[0, keep], bucket[keep]))]
            words, n, depth, own = words[:, order], n[order], depth[order], bucket[order]
            cuts = np.flatnonzero(np.diff(own, prepend=-1, append=buckets + 1))
            parts = [packed(words[:, i:j], n[i:j], depth[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(own[cuts[:-1]]), pa.array(parts, pa.binary())], names=["bucket", "suffixes"])

    return texts.mapInArrow(run, "bucket bigint, suffixes binary")


def sorted_counts(words: np.ndarray, weight: np.ndarray, depth: np.ndarray, least: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Multikey three-way quicksort of suffix pointers: (words, occurrences) of each phrase
    of two words and more, no shorter than the routing prefix, that occurs ``least`` times.

    A part of the pointers that agree so far is divided by the word at the next depth into
    lesser, equal and greater. The equal part's size is the count of the phrase that it
    agrees on; it goes on one word deeper. A part of fewer than ``least`` is abandoned,
    for no phrase in it can occur more often; so is the part of suffixes that end."""
    todo = [(np.arange(words.shape[1]), 0)]
    while todo:
        at, d = todo.pop()
        here = words[d, at]
        pivot = here[len(here) // 2]
        same = here == pivot
        equal = at[same]
        if len(equal) < len(at):
            rest, rest_words = at[~same], here[~same]
            less = rest_words < pivot
            for part in (rest[less], rest[~less]):
                if len(part) and weight[part].sum() >= least:
                    todo.append((part, d))
        total = int(weight[equal].sum())
        if pivot and total >= least:
            if d and depth[equal[0]] <= d + 1:
                yield tuple(words[: d + 1, equal[0]].view(np.int64).tolist()), total
            if d + 1 < DEPTH:
                todo.append((equal, d + 1))


def phrase_counts(routed_rows: DataFrame, least: int) -> DataFrame:
    """(words, a): the frequent phrases of every bucket of ``routed``, a bucket at a time."""

    def solved(bucket: pa.Table) -> pa.Table:
        parts = [unpacked(x.as_py()) for x in bucket.column("suffixes")]
        words, n, depth = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
        found = list(sorted_counts(words, n, depth, least))
        return pa.table({"words": pa.array([x for x, _ in found], pa.list_(pa.int64())), "a": pa.array([n for _, n in found], pa.int64())})

    return routed_rows.groupBy("bucket").applyInArrow(solved, "words array<bigint>, a bigint")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` collocations.

    A-Z is lower-cased, texts are split into pieces at ``[.,;:!?`` and line ends, and those
    into words at spaces and tabs. ``n`` counts a language's words, ``a`` the occurrences
    of a phrase within pieces, overlaps included. Candidates are phrases of 2 to ``DEPTH``
    words with ``a >= least``. A cut into two parts of ``l`` and ``r`` occurrences scores
    floor(1000 * a * n / (l * r)); the least score counts, of ties the shortest first part.
    Candidates inside a longer candidate that occurs as often are dropped (it is enough to
    look one word further: of the phrases between the two, each occurs as often). The rest
    are ranked by score and a, descending, and by phrase in byte order.

    Words are counted first, then pairs of frequent ones. Suffix pointers are routed by their
    leading words, cut where no candidate can go on, and sorted per bucket
    (``sorted_counts``). Prefixes that
    hold a large share of all words are counted by aggregation, and their suffixes are
    routed by more words, so no bucket grows with a common word or passage.

    A null or empty text has no words; a null language is ``und``. Rows that repeat count
    each. Other columns are ignored. An empty table, or one without candidates, gives no row.
    """
    texts = shipped(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text")))
    known = vocabulary(texts)
    totals = saved(known.groupBy("lang").agg(F.sum("n").alias("n")))
    every = totals.agg(F.sum("n")).first()[0] or 0
    common = saved(known.where(F.col("n") >= least))
    bound = max(least, min(every >> HOT_SHIFT, HOT_MOST))
    hot_words = [x.key for x in common.where(F.col("n") >= bound).select("key").collect()]
    hot = hot_prefixes(texts, hot_words, bound)
    frequent, buckets = bitmap(common.select(F.col("key").alias("hash"))), max(BUCKETS, every // BUCKET_WORDS)
    pairs = frequent_pairs(texts, frequent, buckets, least)
    suffixes = routed(texts, frequent, pairs, Prefixes([(x,) for x in hot_words] + list(hot)), buckets)
    counted = phrase_counts(suffixes, least)
    if hot:
        counted = counted.union(texts.sparkSession.createDataFrame([(list(k), v) for k, v in hot.items()], "words array<bigint>, a bigint"))
    found = saved(counted)
    return _ranked(found, common, totals, top)


def _ranked(found: DataFrame, common: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The output of ``collocations`` from the phrases (words, a), the frequent words and
    the languages' totals."""
    part = F.size("words")
    longer = found.where(part > 2).select(F.explode(F.array(F.slice("words", F.lit(1), part - 1), F.slice("words", F.lit(2), part - 1))).alias("words"), "a")
    longer = longer.groupBy("words").agg(F.max("a").alias("more"))
    kept = found.join(longer, "words", "left").where(F.col("more").isNull() | (F.col("more") < F.col("a"))).drop("more")
    counts = found.select("words", F.col("a").alias("f"), F.lit(None).cast("string").alias("lang")).union(
        common.select(F.array("key").alias("words"), F.col("n").alias("f"), "lang"))
    # a common word is the first or last part of many phrases: its count meets them in several tasks
    counts = counts.withColumn("deal", F.explode(F.expr(f"sequence(0, {DEAL - 1})")))
    cuts = kept.select("words", "a", F.pmod(F.xxhash64("words"), F.lit(DEAL)).cast("int").alias("deal"), F.explode(F.sequence(F.lit(1), part - 1)).alias("k"))
    cuts = (cuts.withColumn("left", F.slice("words", F.lit(1), F.col("k"))).withColumn("right", F.slice("words", F.col("k") + 1, part))
            .join(counts.select(F.col("words").alias("left"), "deal", F.col("f").alias("l"), "lang"), ["left", "deal"])
            .join(counts.select(F.col("words").alias("right"), "deal", F.col("f").alias("r")), ["right", "deal"]))
    whole = cuts.groupBy("words", "a").agg(F.max("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("k", "l", "r"))).alias("cuts")).join(totals, "lang")
    wide = lambda x: x.cast("decimal(19,0)")
    scored = whole.withColumn("product", wide(F.expr("1000L * a")) * wide(F.col("n"))).withColumn("cut", F.explode("cuts")).withColumn(
        "pairs", wide(F.col("cut.l")) * wide(F.col("cut.r"))).withColumn("score", F.expr("product div pairs"))
    best = scored.groupBy("words", "a", "lang", "n").agg(F.min(F.struct("score", "cut")).alias("best")).select(
        "words", "a", "lang", "n", "best.score", "best.cut.l", "best.cut.r")
    # first within shares of a language, then among what they leave
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("words"), F.lit(64))).orderBy(F.desc("score"), F.desc("a"))
    then = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = best.withColumn("at", F.rank().over(first)).where(F.col("at") <= top).withColumn("at", F.rank().over(then)).where(F.col("at") <= top).drop("at")
    said = best.select("*", F.posexplode("words").alias("i", "key")).join(common.select("key", "word"), "key").groupBy("words", "lang", "a", "l", "r", "n", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return said.withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
