"""SimHash near duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import saved, shipped, text_buffers
from ferry.llm.components import components

#: Fingerprint bits, greatest distance of linked ones, tables that cover that distance.
BITS, RADIUS = 64, 3
TABLES = (1 << (RADIUS + 1)) - 1
#: A bucket of more fingerprints is divided by a further covering of its open bits.
BUCKET = 1024
#: Words of a shingle; shingles whose bits are counted at once.
WORDS, AT_ONCE = 3, 1 << 16
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
FULL = (1 << BITS) - 1


def fingerprint(text: bytes) -> int:
    """Of all shingles' XXH64 (seed 42), repeats included, the bits that over half have."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[min(WORDS, len(words)) - 1 :]
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(ends), AT_ONCE):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[i : i + AT_ONCE], ends[i : i + AT_ONCE])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): every row's fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_buffers(batch.column(1))
            values = [fingerprint(data[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return shipped(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(
        run, "doc_id bigint, fp bigint")


def masks(mask: int = 0) -> list[int]:
    """The covering masks beyond ``mask``: each holds it and some of the bits it leaves open.

    The open bits are labelled in turn with the non-zero vectors of RADIUS + 1 bits; the
    mask of a non-zero vector v holds those whose label has an odd number of ones in
    common with v. The labels of RADIUS bits or fewer lie in a proper subspace, so some v
    is orthogonal to all of them: its mask holds none of these bits. Hence two fingerprints
    that agree on ``mask`` and differ in at most RADIUS bits agree on some mask in full.
    """
    open_ = [i for i in range(BITS) if not mask >> i & 1]
    return [mask | sum(1 << i for j, i in enumerate(open_) if ((j % TABLES + 1) & v).bit_count() & 1) for v in range(1, TABLES + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def buckets(classes: DataFrame) -> DataFrame:
    """(mask, key, fp, rep): the distinct fingerprints of ``classes`` (fp, rep) by what they
    agree on, only where two or more do.

    A bucket of more than ``BUCKET`` fingerprints is divided by the covering of the bits
    that its mask leaves open, which keeps every pair within the radius together in some
    part; a mask of the third step leaves at most 8 bits open, so 256 fingerprints at most
    agree on it. So no bucket grows with the data and no pair is left out.
    """
    spark = classes.sparkSession
    steps = [masks()]
    while max(BITS - m.bit_count() for m in steps[-1]) > 8:
        steps.append(sorted({x for m in steps[-1] for x in masks(m)}))
    rows, out = classes.withColumn("mask", F.lit(0).cast("long")), None
    for k in range(len(steps)):
        before = [0] if k == 0 else steps[k - 1]
        # a row per earlier mask: at most TABLES ** 2
        table = spark.createDataFrame([(_signed(m), [_signed(x) for x in masks(m)]) for m in before], "mask bigint, masks array<bigint>")
        rows = (rows.join(F.broadcast(table), "mask").withColumn("mask", F.explode("masks")).drop("masks")
                .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).dropDuplicates(["mask", "fp"]) if k else
                rows.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in steps[0]]))).withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
        held = rows.groupBy("mask", "key").agg(F.count("*").alias("held")).where("held > 1")
        # a crowded key's rows meet its count in several tasks
        held = held.withColumn("deal", F.explode(F.expr("sequence(0, 15)")))
        rows = saved(rows.withColumn("deal", F.pmod(F.xxhash64("fp"), F.lit(16)).cast("int")).join(held, ["mask", "key", "deal"]).drop("deal"))
        last = k == len(steps) - 1
        part = (rows if last else rows.where(F.col("held") <= BUCKET)).select("mask", "key", "fp", "rep")
        out = part if out is None else out.union(part)
        rows = rows.where(F.col("held") > BUCKET).select("mask", "fp", "rep")
        if last or not rows.head(1):
            return out


def near(fps: np.ndarray, reps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that join every connected set of the fingerprints of one bucket: each
    pair is compared, and each fingerprint is linked with the smallest id of its set."""
    order = np.argsort(reps)
    fps, reps = fps[order], reps[order]
    least = np.arange(len(fps))
    step = max(1, (1 << 20) // len(fps))
    pairs = [np.argwhere(np.bitwise_count(fps[i : i + step, None] ^ fps[None, :]) <= RADIUS) + [i, 0] for i in range(0, len(fps), step)]
    a, b = np.concatenate(pairs).T
    while True:
        np.minimum.at(least, a, least[b])
        least = least[least]
        if (least[a] == least[b]).all():
            break
    far = np.flatnonzero(least != np.arange(len(fps)))
    return reps[far], reps[least[far]]


def links(grouped: DataFrame) -> DataFrame:
    """(a, b): representatives in the rows of ``buckets`` whose fingerprints are connected
    within a bucket by links of at most ``RADIUS`` bits."""
    rows = grouped.repartition("mask", "key").sortWithinPartitions("mask", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = np.stack([batch.column(i).to_numpy() for i in range(4)])
            now = np.concatenate([held, now], axis=1) if held is not None else now
            if not now.shape[1]:
                continue
            cut = np.flatnonzero((now[0, 1:] != now[0, :-1]) | (now[1, 1:] != now[1, :-1])) + 1
            last = cut[-1] if len(cut) else 0
            yield from solved(now, [0, *cut.tolist()])
            held = now[:, last:]
        if held is not None:
            yield from solved(held, [0, held.shape[1]])

    def solved(rows: np.ndarray, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        found = [near(rows[2, i:j].view(np.uint64), rows[3, i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    The fingerprint is ``fingerprint`` of the text in 16 hex digits; fewer words than a
    shingle are one shingle, a null, empty or blank text has fingerprint zero, which is
    linked like any other. Fingerprints of at most ``RADIUS`` differing bits are linked;
    ``component_id`` is the smallest id that can be reached.

    Equal fingerprints are one class, found by aggregation. Classes meet in the buckets of
    a covering family of masks, which misses no pair within the radius. A bucket compares
    all its fingerprints, a bounded number, and returns links along which they are
    connected, fewer than its rows.

    Rows with a null id have a fingerprint and a null component, and link nothing. Rows
    that repeat an id are one document: what either is linked with is reached. Other
    columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    rows = saved(fingerprints(docs, id_col, text_col))
    classes = saved(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    several = rows.dropna().groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("doc_id")
    again = rows.join(several, "doc_id").join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # a class's smallest id may be held by several classes, so links are between ids
    known = components(links(buckets(classes)).union(again))
    member = classes.join(known.withColumnRenamed("id", "rep"), "rep", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"))
    salted = member.withColumn("deal", F.explode(F.expr("sequence(0, 15)")))
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("int"))
    return dealt.join(salted, ["fp", "deal"], "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
