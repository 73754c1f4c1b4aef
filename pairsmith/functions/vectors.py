"""Pooling, truncation and normalising of token vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairsmith.functions.kernels import check_pooling

def truncate_tokens(tokens: Column, max_length: int) -> Column:
    return F.slice(tokens, 1, max_length)


def l2_normalise(vector: Column) -> Column:
    """Unit-length vector; a zero vector stays zero."""
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    # The norm enters as a repeated array: an outer expression inside a lambda runs once per element.
    norms = F.array_repeat(F.greatest(F.sqrt(squares), F.lit(1e-12)), F.size(vector))
    return F.zip_with(vector, norms, lambda x, n: x.cast("double") / n)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _masked_mean(tokens: pa.Array, mask: pa.Array) -> pa.Array:
    # One pass over the flat child buffers of the batch; no Python object per token.
    rows = len(tokens)
    token_lists = tokens.flatten()
    dims = np.unique(token_lists.value_lengths().to_numpy(zero_copy_only=False)) if len(token_lists) else [1]
    if len(dims) != 1:
        raise ValueError("token vectors differ in length")
    dim = int(dims[0])
    flat = token_lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    keep = mask.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(keep) != len(flat):
        raise ValueError("mask and tokens differ in length")
    lengths = np.nan_to_num(tokens.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    owner = np.repeat(np.arange(rows), lengths)
    # Unmasked vectors only: a masked-out NaN must not reach the sum.
    used = keep > 0
    sums = np.zeros((rows, dim))
    starts = np.flatnonzero(np.diff(owner[used], prepend=-1))
    if used.any():
        sums[owner[used][starts]] = np.add.reduceat(flat[used], starts, axis=0)
    counts = np.bincount(owner, weights=keep, minlength=rows)
    means = sums / np.maximum(counts, 1)[:, None]
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(counts > 0, dim, 0))]).astype(np.int32))
    values = pa.array(means[counts > 0].reshape(-1))
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array(counts == 0))


def pool_mean(tokens: Column, mask: Column) -> Column:
    """Mean of the token vectors whose mask is 1; null if there is none."""
    return _masked_mean(tokens, mask)


def pool_cls(tokens: Column, mask: Column | None = None) -> Column:
    """The first token's vector, whatever the mask says."""
    return F.try_element_at(tokens, F.lit(1)).cast("array<double>")


def pool(tokens: Column, mask: Column, strategy: str) -> Column:
    return {"mean": pool_mean, "cls": pool_cls}[check_pooling(strategy)](tokens, mask)
