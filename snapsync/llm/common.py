"""Helpers of the operators on documents."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapsync.storage import workspace

# Bytes of text that a task works on at a time; one longer text stands alone.
SLICE_BYTES = 2 << 20
# Rows of numbers that the driver may hold for a broadcast, at some 100 bytes each.
BROADCAST_ROWS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines do not have that folder, send it along (``--py-files``).
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; NULL keys are in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: what follows does not compute it again."""
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def many(df: DataFrame) -> bool:
    """True if a written table has more rows than the driver should hold for a broadcast."""
    return df.count() > BROADCAST_ROWS


def dealt(df: DataFrame, when: bool = True) -> DataFrame:
    """``df`` as a side of a join of which neither side is broadcast, if ``when``.

    Spark broadcasts what it takes to be small. It goes by the size of files, where rows may
    be compressed to little, and takes an explode to make a row of each row.
    """
    return df.hint("merge") if when else df


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in order, in pieces of about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        piece = np.cumsum(sizes.astype(np.int64) + 64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
    # A worker goes on to other tasks: what Arrow holds of this one is of no use to them.
    pa.default_memory_pool().release_unused()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes; NULL is empty."""
    return pc.fill_null(batch.column(column).cast(pa.binary()), b"").to_pylist()


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of ranges, one range after another."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(total, dtype=np.int64)


# A bit map of row hashes is of 16 MB at most.
FILTER_BITS = 1 << 27


def bit_map(rows: DataFrame, column: str) -> np.ndarray:
    """A filter of the hashes in ``column``, of bounded size: 64 bits for each, up to its limit.

    It has every hash, and with it a few others: 1 in 64, and more beyond the limit, where
    it only saves less. Spark sets the bits; the driver gets the map, not the hashes.
    """
    wanted = rows.count()
    bits = min(FILTER_BITS, 1 << max(16, (64 * wanted).bit_length()))
    place = F.pmod(F.col(column), F.lit(bits))
    words = rows.select(
        F.floor(place / 32).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (place % 32).cast("int")).alias("bit"),
    )
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    filled = np.zeros(bits // 32, np.uint32)
    filled[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return filled


def mapped(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash is in a bit map, or seems to be."""
    place = hashes % (32 * len(filled))
    return ((filled[place // 32] >> (place % 32).astype(np.uint32)) & 1).astype(bool)
