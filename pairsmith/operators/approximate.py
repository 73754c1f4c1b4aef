"""Approximate top-k inner products: an inverted index with product-quantised residuals, re-ranked exactly.

Coarse centroids cut the corpus into lists. What a vector differs from its centroid by is cut into parts, and each part is
stored as the number of its nearest code word: ``parts`` bytes a vector. A query meets the lists with the best
centroids, as many as it takes for the wished ``recall`` among the vectors that the index was fitted to; the product with
a vector there is estimated by the product with centroid plus code words. The ``rerank * k`` best by that estimate in a
slab of lists get their exact products, and the k best of those leave the task, so scores are right and only
the choice may miss something. Vectors ride along with their codes: a candidate costs no shuffle.

Centroids and code words are fitted by a few rounds of k-means on at most ``TRAIN`` vectors drawn by hash; every vector is
indexed. This is a choice of the caller (``neighbours.top_k`` is exact), never made by the size of the data. Lists of any
length are gathered in blocks and cut into slabs, which meet as those of ``neighbours.slab_join`` do, so a list that
holds a third of all vectors is many tasks. Vectors that ``neighbours.usable`` refuses have no neighbours and are
nobody's. Equal scores go to the lower id. An empty corpus gives empty lists.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairsmith.operators.neighbours import (DIGITS, TILE_ROWS, _best, _block_rows, _blocks, _k_best, _matrix, _met, _same_length, _sizes,
                                            _slab_rows, slab_join, usable)
from pairsmith.session import materialise

TRAIN = 32_768
WORDS = 256          # code words of a part; a code is one byte
LISTS = 1024         # most lists
ROUNDS = 8
ESTIMATES = 1 << 22  # at once in a task
JUDGED = 512         # vectors whose neighbours tell how many lists it takes


@dataclass
class Quantiser:
    """Centroids [lists, dim] and code words [parts, words, dim / parts]; both bounded, whatever the corpus. ``probes`` is the
    number of lists that a query meets."""

    centroids: np.ndarray
    words: np.ndarray
    probes: int

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return _nearest(vectors, self.centroids)

    def codes(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        parts = _cut(vectors - self.centroids[cells], len(self.words))
        return np.stack([_nearest(part, words) for part, words in zip(parts, self.words)], 1).astype(np.uint8)

    def decoded(self, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Centroid plus code words of each vector."""
        parts = np.concatenate([words[codes[:, i]] for i, words in enumerate(self.words)], 1)
        return self.centroids[cells] + parts[:, :self.centroids.shape[1]]


def _cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """[parts, rows, width], filled up with zeros."""
    width = math.ceil(vectors.shape[1] / parts)
    full = np.zeros((len(vectors), parts * width))
    full[:, :vectors.shape[1]] = vectors
    return full.reshape(len(vectors), parts, width).transpose(1, 0, 2)


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row by distance; ties go to the first."""
    half = (centres * centres).sum(1) / 2
    return np.concatenate([(vectors[a:a + TILE_ROWS] @ centres.T - half).argmax(1) for a in range(0, len(vectors), TILE_ROWS)] or [np.zeros(0, int)])


def _means(vectors: np.ndarray, count: int, seed: int) -> np.ndarray:
    """k-means from a seeded choice of rows; a centre without rows stays where it is."""
    centres = vectors[np.random.default_rng(seed).permutation(len(vectors))[:count]].copy()
    for _ in range(ROUNDS):
        own = _nearest(vectors, centres)
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, vectors)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


def _probes(vectors: np.ndarray, centroids: np.ndarray, k: int, share: float) -> int:
    """The fewest lists that hold ``share`` of the k nearest of some of the vectors among all of them. These lie less dense
    than the corpus, so near ones are farther, and the corpus needs no more lists."""
    asked = vectors[:JUDGED]
    products = asked @ vectors.T
    products[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    nearest = np.argsort(-products, axis=1, kind="stable")[:, :min(k, max(1, len(vectors) - 1))]
    place = np.argsort(np.argsort(-(asked @ centroids.T), axis=1, kind="stable"), axis=1)
    found = np.take_along_axis(place, _nearest(vectors, centroids)[nearest], axis=1)
    reached = np.cumsum(np.bincount(found.ravel(), minlength=len(centroids))) / found.size
    return int(np.searchsorted(reached, share - 1e-12)) + 1


def fit(corpus: DataFrame, rows: int, k: int = 10, recall: float = 0.95, lists: int | None = None, parts: int = 16) -> Quantiser:
    """Fit on at most ``TRAIN`` of the ``rows`` vectors; half of the share that may be missed is left to the estimates."""
    place = F.pmod(F.xxhash64("d"), F.lit(1 << 30))
    drawn = corpus.where(place < math.ceil(min(1.0, 2 * TRAIN / rows) * (1 << 30))).orderBy(F.xxhash64("d"), "d").limit(TRAIN).select("vector").toArrow()
    vectors = _matrix(drawn.column("vector"))
    lists = min(lists or max(1, round(math.sqrt(rows))), LISTS, len(vectors))
    centroids = _means(vectors, lists, 1)
    rest = _cut(vectors - centroids[_nearest(vectors, centroids)], min(parts, vectors.shape[1]))
    count = min(WORDS, len(vectors))
    words = np.stack([_means(part, count, 2 + i) for i, part in enumerate(rest)])
    return Quantiser(centroids, words, min(lists, _probes(vectors, centroids, k, (1 + recall) / 2)))


def build(corpus: DataFrame, quantiser: Quantiser) -> DataFrame:
    """The index, written once: (d, cell, code) of every usable vector of ``corpus`` (d long, vector)."""
    shared = corpus.sparkSession.sparkContext.broadcast(quantiser)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("vector"))
                cells = own.cells(vectors)
                codes = own.codes(vectors, cells)
                yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(cells.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], ["d", "cell", "code"])

    return materialise(corpus.where(usable("vector")).select("d", "vector").mapInArrow(run, "d long, cell int, code binary"), "index")


def _probed(queries: DataFrame, quantiser: Quantiser, blocks: np.ndarray) -> DataFrame:
    """(q, vector, cells, parts): the lists with the best centroids, and where those of each block lie among them."""
    shared, probes = queries.sparkSession.sparkContext.broadcast((quantiser.centroids, blocks)), quantiser.probes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, of = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(start, TILE_ROWS)
                near = _matrix(part.column("vector")) @ centroids.T
                cell = np.sort(np.argsort(-near, axis=1, kind="stable")[:, :probes], axis=1)
                row = np.repeat(np.arange(len(cell)), cell.shape[1])
                met = _met(row, cell.ravel(), of[cell.ravel()], len(cell))
                yield pa.RecordBatch.from_arrays([part.column("q"), part.column("vector"), *met], ["q", "vector", "cells", "parts"])

    return queries.select("q", "vector").mapInArrow(run, "q long, vector array<float>, cells array<long>, parts array<struct<block: long, start: int, length: int>>")


def _found(asked: DataFrame, index: DataFrame, quantiser: Quantiser, rows: int, k: int, keep: int) -> DataFrame:
    """(q, d, score): per query and slab of the index, exact products of the ``keep`` best by estimate, the k best of them."""
    spark, count, width = index.sparkSession, len(quantiser.centroids), quantiser.centroids.shape[1]
    slab = _slab_rows(width)
    full, counts = _block_rows(rows, slab), np.zeros(count, np.int64)
    for row in index.groupBy("cell").count().collect():  # at most LISTS rows
        counts[row["cell"]] = row["count"]
    blocks = _blocks(counts, full)
    cells = spark.createDataFrame([(i, int(n), int(b), slab, full) for i, (n, b) in enumerate(zip(counts, blocks)) if n],
                                  "cell int, count long, block long, slab int, full int")
    probed, shared = materialise(_probed(asked, quantiser, blocks), "probed"), spark.sparkContext.broadcast(quantiser)

    def meet(queries: pa.Table, docs: pa.Table, visited: Callable) -> pa.Table:
        held, wanted, ids = docs.column("vector").combine_chunks(), queries.column("vector").combine_chunks(), docs.column("d").to_numpy()
        _same_length(held, wanted)
        exact = _matrix(held).astype(np.float32)
        codes = np.stack([np.frombuffer(c, np.uint8) for c in docs.column("code").to_pylist()])
        guessed = shared.value.decoded(docs.column("cell").to_numpy(), codes).astype(np.float32)
        few, step = min(keep, len(ids)), max(1, min(TILE_ROWS, ESTIMATES // max(len(ids), keep * width)))
        rows, columns, scores = [], [], []
        for a in range(0, queries.num_rows, step):
            b = min(a + step, queries.num_rows)
            own = _matrix(wanted.slice(a, b - a))
            guess, asks = np.full((b - a, len(ids)), -np.inf, np.float32), own.astype(np.float32)
            for row, first, last in visited(a, b):
                guess[row, first:last] = asks[row] @ guessed[first:last].T
            best = np.argpartition(guess, len(ids) - few, axis=1)[:, len(ids) - few:]
            score = np.round(np.einsum("qd,qkd->qk", own, exact[best]), DIGITS)
            row, place = np.nonzero(np.isfinite(np.take_along_axis(guess, best, 1)))
            row, column, score = _k_best([(row, best[row, place], score[row, place])], ids, k)
            rows.append(a + row)
            columns.append(column)
            scores.append(score)
        return pa.table([queries.column("q").take(pa.array(np.concatenate(rows))), pa.array(ids[np.concatenate(columns)]), pa.array(np.concatenate(scores))], names=["q", "d", "score"])

    return slab_join(probed, index, F.broadcast(_sizes(probed, cells)), ["vector"], ["vector", "code"], meet, "q long, d long, score double")


def top_k(queries: DataFrame, corpus: DataFrame, k: int, recall: float = 0.95, rerank: int = 20, parts: int = 16,
          lists: int | None = None, quantiser: Quantiser | None = None, index: DataFrame | None = None) -> DataFrame:
    """All query rows with ``neighbours``, an array of (rank, d, score) in rank order, of which some may be missed.

    ``recall`` is what queries like the corpus may expect; 1 meets every list that held a neighbour in the fit.

    ``queries`` has ``q long, vector`` with unique q, ``corpus`` has ``d long, vector`` with unique d; both are read several
    times. ``quantiser`` and ``index``: those of an earlier call, from ``fit`` and ``build``.
    """
    usable_rows, kind = corpus.where(usable("vector")), T.ArrayType(T.StructType().add("rank", T.IntegerType()).add("d", T.LongType()).add("score", T.DoubleType()))
    rows = usable_rows.count()
    if not rows:
        return queries.withColumn("neighbours", F.array().cast(kind))
    quantiser = quantiser or fit(usable_rows, rows, k, recall, lists, parts)
    index = index or build(corpus, quantiser)
    asked = queries.where(usable("vector")).select("q", "vector")
    held = index.join(usable_rows.select("d", "vector"), "d")
    # A repeated q counts for each of its rows once more, as a repeated d does.
    hits = _best(_found(asked, held, quantiser, rows, k, rerank * k).join(asked.select("q"), "q"), k)
    lists_ = hits.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "d", "score"))).cast(kind).alias("neighbours"))
    return queries.join(lists_, "q", "left").select(*queries.columns, F.coalesce("neighbours", F.array().cast(kind)).alias("neighbours"))
