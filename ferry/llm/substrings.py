"""Substring dedup by content-defined chunks (gear rolling hash)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import words as W
from ferry.llm.common import shipped, text_slices

#: Least, expected further and greatest bytes of a chunk.
LEAST, FURTHER, MOST = 16, 32, 1024
#: The gear hash at a byte depends on so many bytes up to it.
WINDOW = 16


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    return W.constants(256, 31) >> W.U64(16)


def boundaries(data: np.ndarray) -> np.ndarray:
    """For each byte, whether the gear hash of the ``WINDOW`` bytes that end there calls
    for a chunk to end after it."""
    h = _gear()[data]
    step = 1
    while step < WINDOW:  # h over 2 * step bytes from h over step bytes
        h[step:] += h[:-step] << W.U64(step)
        step *= 2
    return (h >> W.U64(WINDOW + 16)) % W.U64(FURTHER) == 0


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    out, last = [], 0
    for end in (np.flatnonzero(boundaries(data)) + 1).tolist():
        while end - last > MOST:
            last += MOST
            out.append(last)
        if end - last >= LEAST and end < n:
            out.append(end)
            last = end
    while n - last > MOST:
        last += MOST
        out.append(last)
    out.append(n)
    return np.array(out, np.int64)


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, seq, start, end, size, d1, d2, again) for each chunk: code points, bytes,
    the 128-bit digest, whether the same chunk stands earlier in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(1)):
                points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                ids, seq, at, digests, again = [], [], [], [], []
                for i in range(end - first):
                    lo, hi = bounds[i], bounds[i + 1]
                    ends = chunk_ends(data[lo:hi]) + lo
                    own = data[lo:hi].tobytes()
                    seen: set[bytes] = set()
                    start = lo
                    for e in ends.tolist():
                        d = hashlib.blake2b(own[start - lo : e - lo], digest_size=16).digest()
                        digests.append(d)
                        again.append(d in seen)
                        seen.add(d)
                        start = e
                    ids.append(np.full(len(ends), first + i))
                    seq.append(np.arange(len(ends)))
                    at.append(np.stack([np.append(lo, ends[:-1]), ends]) if len(ends) else np.zeros((2, 0), np.int64))
                starts, stops = np.concatenate(at, axis=1)
                base = bounds[np.concatenate(ids) - first]
                pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(ids), pa.int64())), pa.array(np.concatenate(seq), pa.int32()),
                     pa.array(points[starts] - points[base], pa.int32()), pa.array(points[stops] - points[base], pa.int32()),
                     pa.array(stops - starts, pa.int32()), pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(again, pa.bool_())],
                    names=["doc_id", "seq", "start", "end", "size", "d1", "d2", "again"])

    return shipped(docs).where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, seq int, start int, end int, size int, d1 bigint, d2 bigint, again boolean")


def repeated_spans(docs: DataFrame, min_bytes: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, end, n_chunks, n_bytes, first_doc_id, source_doc_ids): stretches of
    documents, in code points, that repeat text standing elsewhere.

    A text is cut where a gear hash of the last ``WINDOW`` bytes calls for it, so equal
    passages are cut alike wherever they stand. A chunk repeats if its digest stands
    earlier in the document or in a document of smaller id; the smallest id's first
    occurrence stays. Consecutive repeated chunks form a span; spans of fewer than
    ``min_bytes`` bytes are ordinary phrases and are not returned. ``source_doc_ids`` are the
    documents that keep the span's chunks, at most one each, ``first_doc_id`` the smallest.

    Null and empty texts have no chunks; rows with a null id are left out; rows that
    repeat an id count as one document, whose later row does not repeat the earlier.
    Columns beside id and text are ignored; an empty table gives an empty result.
    """
    rows = chunks(docs, id_col, text_col)
    first = rows.where("not again").groupBy("d1", "d2").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"))
    shared = first.where("first_doc_id <> last").drop("last")
    hit = rows.join(shared, ["d1", "d2"], "left").where("again or doc_id <> first_doc_id")
    spans = hit.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct(
        "seq", "start", "end", "size", F.coalesce("first_doc_id", "doc_id").alias("first_doc_id")))).alias("c"))
    runs = spans.select("doc_id", F.posexplode("c").alias("i", "c")).select(
        "doc_id", (F.col("c.seq") - F.col("i")).alias("run"), "c.*")
    return (runs.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_chunks"),
                                              F.sum("size").alias("n_bytes"), F.min("first_doc_id").alias("first_doc_id"),
                                              F.array_sort(F.collect_set("first_doc_id")).alias("source_doc_ids"))
            .where(F.col("n_bytes") >= min_bytes).drop("run"))


def without_repeats(docs: DataFrame, min_bytes: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated spans cut out of the text; other rows as they are."""
    spans = repeated_spans(docs, min_bytes, id_col, text_col).groupBy(F.col("doc_id").alias("__id")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__cut"))
    kept = F.aggregate("__cut", F.struct(F.lit("").alias("s"), F.lit(0).alias("p")), lambda a, x: F.struct(
        F.concat(a["s"], F.substring(F.col(text_col), a["p"] + 1, x["start"] - a["p"])).alias("s"), x["end"].alias("p")),
        lambda a: F.concat(a["s"], F.substring(F.col(text_col), a["p"] + 1, F.length(text_col))))
    return (docs.join(spans, docs[id_col].cast("long") == F.col("__id"), "left")
            .withColumn(text_col, F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(kept)).drop("__id", "__cut"))
