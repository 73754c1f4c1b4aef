"""Pooling and scaling of one model batch inside a task. Plain numpy, so tasks need nothing else."""

from __future__ import annotations

import numpy as np

POOLING = ("mean", "cls")


def check_pooling(strategy: str) -> str:
    if strategy not in POOLING:
        raise ValueError(f"unknown pooling strategy {strategy!r}, expected one of {POOLING}")
    return strategy


def pool_batch(hidden: np.ndarray, mask: np.ndarray, strategy: str) -> np.ndarray:
    """Pool one model batch ``[rows, tokens, dim]`` inside a task. A row without a kept token has no mean: NaN, which
    ``embed`` turns into a null vector."""
    if strategy == "cls":
        return hidden[:, 0]
    keep = mask.astype(bool)[..., None]
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(keep, hidden, 0).sum(axis=1) / mask.sum(axis=1)[:, None]


def normalise_batch(vectors: np.ndarray) -> np.ndarray:
    """Unit-length rows of one model batch; zero rows stay zero."""
    vectors = np.asarray(vectors, dtype=np.float64)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.maximum(norms, 1e-12)[:, None]
