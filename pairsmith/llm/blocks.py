"""Rows of numbers that travel through a shuffle as blocks.

A task deals its rows to shards, and the rows for one shard become one row with a few binary columns, so a shuffle
moves packed arrays and not millions of small rows. Arrays are laid out by byte planes (all first bytes, then all
second bytes, ...), which lets Spark's shuffle compression drop the many zero bytes of counts, positions and ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 25  # half a million words, whatever the size of the data


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All blocks of a binary column, one after the other."""
    return np.concatenate([unplanes(x, dtype) for x in column.to_pylist()] or [np.zeros(0, dtype)])


def deal(shard: np.ndarray, columns: dict[str, np.ndarray], name: str = "shard") -> pa.RecordBatch:
    """One row per shard, with each column's values for it as a block; values keep their order."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, int)
    ends = np.append(cut[1:], len(shard))
    out = [pa.array(shard[cut].astype(np.int64))]
    for values in columns.values():
        values = values[order]
        out.append(pa.array([planes(values[a:b]) for a, b in zip(cut, ends)], pa.binary()))
    return pa.RecordBatch.from_arrays(out, [name, *columns])


def shard_count(rows: int, per_shard: int) -> int:
    """A power of two, 256 at least."""
    return max(256, 1 << max(0, (rows // per_shard).bit_length()))


def only_some(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id may be among ``ids`` (others may stay as well), found without a shuffle of
    ``docs``: a bitmap of hashed ids, in words of 64 bits. It saves work before a join and decides nothing."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS))
    bitmap = ids.select(F.floor(bit / 64).cast("int").alias("_word"), (bit % 64).cast("int").alias("_bit")) \
        .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    # A word is one row, so no more than BITMAP_BITS / 64 rows are broadcast, whatever the number of ids.
    near = docs.join(F.broadcast(bitmap), F.floor(bit / 64).cast("int") == F.col("_word"))
    return near.where(F.getbit("_bits", (bit % 64).cast("int")) == 1).select(docs.columns)
