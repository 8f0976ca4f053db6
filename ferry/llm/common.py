"""Helpers shared by the training-data operators: lineage cuts, Arrow text access."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.session import shared_dir

#: Bytes of text handled at once inside a task; a longer single text is handled alone.
SLICE_BYTES = 1 << 20


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder, its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after handing this package to the executors' Python workers once a session."""
    sc = df.sparkSession.sparkContext
    if not hasattr(sc, "_ferry_shipped"):
        root = Path(__file__).resolve().parents[2]
        to = Path(tempfile.mkdtemp(prefix="ferry-")) / "ferry.zip"
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted((root / "ferry").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(to))
        sc._ferry_shipped = True
    return df


def in_place(value: Column) -> Column:
    """``value``, computed where it stands. The optimizer copies deterministic columns into
    filters above them and, with that, into lambdas that run per element; the row number
    in the condition, never negative, keeps it from doing so."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the offsets of their bounds; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) for runs of rows of at most ``limit`` bytes, or one row."""
    data, offsets = text_buffers(column)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def binaries(parts: list[bytes | None]) -> pa.Array:
    return pa.array(parts, pa.binary())
