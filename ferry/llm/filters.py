"""Bitmaps of hashes: a semi-join reducer of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import words as W

#: Bits of a bitmap: at least so many per hash, within these bounds; bits set by a hash.
BITS_PER_HASH, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 27
PROBES, TURN = 8, 8


def bitmap(hashes: DataFrame, parts: int | None = None) -> np.ndarray:
    """A Bloom filter of ``hash`` (bigint): the bits that its leading bits name, after each
    of ``PROBES`` turns by ``TURN`` bits. Its size is bounded by ``MOST_BITS`` (16 MB)
    whatever the table's; a fuller one lets more rows through to the join behind it,
    never fewer. ``parts``: tasks that add its words up and hand them on, one at a time."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_HASH * max(hashes.count(), 1) - 1).bit_length()))
    shift = 65 - bits.bit_length()
    turned = F.array("hash", *[F.shiftleft("hash", TURN * k).bitwiseOR(F.shiftrightunsigned("hash", 64 - TURN * k)) for k in range(1, PROBES)])
    words = hashes.select(F.explode(turned).alias("h")).groupBy(F.shiftrightunsigned("h", shift + 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {shift}) & 63 as int))")).alias("mask"))
    words = words.coalesce(parts) if parts else words
    out = np.zeros(bits // 64, np.int64)
    for word, mask in words.toLocalIterator():
        out[word] = mask
    return out


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash (uint64) has all its bits set."""
    shift = W.U64(65 - (len(table) * 64).bit_length())
    left = np.arange(len(hashes))
    for k in range(PROBES):
        h = hashes[left]
        turned = (h << W.U64(TURN * k)) | (h >> W.U64(64 - TURN * k)) if k else h
        slot = (turned >> shift).astype(np.int64)
        left = left[(table[slot >> 6] >> (slot & 63)) & 1 == 1]
    out = np.zeros(len(hashes), bool)
    out[left] = True
    return out


def id_hash(ids: np.ndarray) -> np.ndarray:
    return W.mix(ids.astype(np.int64).view(W.U64))


def id_bitmap(ids: DataFrame, parts: int | None = None) -> np.ndarray:
    """The bitmap of the non-null ids in the first column of ``ids``; ``parts`` as in ``bitmap``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(id_hash(batch.column(0).to_numpy()).view(np.int64))], names=["hash"])

    ids = ids.dropna().distinct()
    return bitmap((ids.coalesce(parts) if parts else ids).mapInArrow(run, "hash bigint"), parts)
