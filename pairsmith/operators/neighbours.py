"""Exact top-k inner-product join between two sets of vectors.

Vectors are grouped around pivots, and a query meets a group only if the group may hold one of its
k best. Let v be a vector of a group with pivot p, at most the angle r away from it: its product
with q is at most |q| |v| cos(angle(q, p) - r). The query's k-th best product over its own group
(and as many near groups as it takes to see k vectors) is a lower bound for the final k-th best.
Groups whose bound lies below it cannot matter. So no all-pairs join is planned, the result stays
exact, and vectors without any cluster structure only cost more visits.

Groups have ``CELL_TILES`` tiles of rows on average. Up to ``FAN`` groups form one level, whose pivots and bounds every task
holds. Above that there are two levels: the driver and the tasks hold the upper pivots, about the square root of the
number of groups, and lower pivots, their bounds and the numbers of their rows stay in tables that are joined by
upper group. Bounds hold on both levels, so the result is the same. A corpus of one group needs no pivot, and is
answered in one round by the same join of tiles.

Equal vectors are handled once: equal corpus vectors are one row that carries the k lowest ids, since no other can be
among the k best, and equal query vectors have equal results. For the shuffle, groups are gathered in blocks, and blocks of any
size are cut into slabs of bounded size. A slab of queries meets a slab of a block in one task, so a query is moved
once a slab, not once a group or a tile; there, a tile of queries and a tile of a group meet in one matrix product.
A side of up to ``SIDES`` slabs of queries or ``BLOCKS`` of corpus has that many however many rows they hold, so up to so many
full slabs what is moved grows in proportion to the rows. Each slab of corpus gives up to k rows a query, so those are few.

The matrix product is one of 32-bit floats that bounds every score from above: a last column adds the most that rounding
may take away. Only pairs whose bound reaches the k-th best score so far get their exact score, in 64 bits. Scores are rounded
to 6 digits, and ties go to the lower id, so that the order does not depend on the order of
floating-point sums.

A vector that is null or empty, or holds a null, NaN or infinite value, has no neighbours and is
nobody's neighbour. Vectors of different lengths are an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairsmith.operators.ordering import hot_hashes, join_to_unique
from pairsmith.session import materialise

TILE_ROWS = 2048      # expected rows per side of a tile
CELL_TILES = 4        # expected tiles of a group
SLAB_TILES = 32       # most tiles of a slab, about, on either side of the shuffle
SLAB_BYTES = 1 << 24  # of the vectors of a slab, about
WIDE = 2              # times those, slabs of exact search: fewer of them move fewer copies and give fewer rows
SIDES = 16            # slabs of queries that are too few to fill them
BLOCKS = 4            # slabs of a corpus that is too small to fill them
FAN = 2048            # most groups of one level; bounds what the driver and every task hold
DIGITS = 6
SLACK = 2 * 10.0**-DIGITS
BLOCK_COLUMNS = 32
PART_ROWS = 256       # rows of a tile whose products are compared while they are in the cache
RESCORED = 1 << 14    # pairs that get their exact scores at once
MOST_TASKS = 4096     # of a join of slabs
FEW = 1 << 13         # hits of a tile that are searched one after the other


def _rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a vector column as a matrix of its own type, the flat buffer itself."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if rows and not (lengths == lengths[0]).all():  # a null has no length, and NaN equals nothing
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an ``array<float>`` column as a float64 matrix."""
    return _rows(column).astype(np.float64)


def _unit(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    return matrix / np.maximum(norms, 1e-300)[:, None], norms


def usable(vector: str) -> Column:
    """Whether a vector can be compared: neither null nor empty, and all its values are finite."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def _hashed(df: DataFrame) -> DataFrame:
    """Equal vectors meet by hash and vector: the hash leads, so sorting rarely compares vectors."""
    return df.withColumn("hash", F.xxhash64("vector"))


VECTOR_KEY = ["hash", "vector"]


def _no_floor() -> Column:
    return F.lit(float("-inf"))


def _distinct_corpus(corpus: DataFrame, k: int) -> DataFrame:
    """``(d, vector, copies)``: of equal vectors the k lowest ids, with what else their rows hold, and the lowest as ``d``. The
    limit is applied before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(*VECTOR_KEY).orderBy("d"))
    kept = _hashed(corpus).withColumn("_copy", rank).where(F.col("_copy") <= k)
    copy = F.struct("d", *[c for c in corpus.columns if c not in ("d", "vector")])
    return kept.groupBy(*VECTOR_KEY).agg(F.min("d").alias("d"), F.collect_list(copy).alias("copies")).select("d", "vector", "copies")


def _distinct_queries(queries: DataFrame) -> DataFrame:
    return _hashed(queries).groupBy(*VECTOR_KEY).agg(F.min("q").alias("q"), F.count(F.lit(1)).alias("count"))


def _some(corpus: DataFrame, count: int, rows: int, tag: str) -> DataFrame:
    """About ``count`` distinct vectors of ``rows``, picked by hash; copies of one vector are picked together."""
    place = F.pmod(F.xxhash64(F.lit(tag), "vector"), F.lit(1 << 30))
    return corpus.select("vector").where(place < math.ceil(min(1.0, count / rows) * (1 << 30))).dropDuplicates()


def _pivots(corpus: DataFrame, count: int, rows: int) -> np.ndarray:
    """A repeatable choice of up to ``count`` distinct unit vectors, at least one, well spaced among four times as many."""
    order = [F.xxhash64("vector"), F.col("vector")]
    picked = _some(corpus, 4 * count, rows, "pivot").orderBy(*order).limit(4 * count).collect() or corpus.select("vector").orderBy(*order).limit(1).collect()
    unit, _ = _unit(np.array([r["vector"] for r in picked], dtype=np.float64).reshape(len(picked), -1))
    return unit[_spaced(unit, count)]


def _spaced(unit: np.ndarray, count: int) -> list[int]:
    """Up to ``count`` rows, each the farthest from those before it, so that no cluster is left without one."""
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return chosen


def _spaced_by_group(candidates: DataFrame) -> DataFrame:
    """A quarter of the candidates (vector, upper) of each upper group, well spaced; large groups in pieces."""
    sizes = candidates.groupBy("upper").agg(F.ceil(F.count(F.lit(1)) / F.lit(4 * TILE_ROWS)).cast("int").alias("n"))
    parted = _hashed(candidates.join(F.broadcast(sizes), "upper")).withColumn("piece", F.pmod("hash", F.col("n")).cast("int")).select("vector", "upper", "hash", "piece")

    def pick(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("hash")
        unit, _ = _unit(_matrix(rows.column("vector")))
        return rows.take(pa.array(_spaced(unit, math.ceil(len(unit) / 4)))).select(["vector", "upper"])

    return parted.groupBy("upper", "piece").applyInArrow(pick, "vector array<float>, upper int")


def _assign(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot ``cell``, the angle to it and the norm."""
    names = df.columns
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            unit, norms = _unit(_matrix(batch.column("vector")))
            cells = np.empty(len(unit), dtype=np.int32)
            angles = np.empty(len(unit))
            for start in range(0, len(unit), TILE_ROWS):
                near = unit[start:start + TILE_ROWS] @ centres.T
                best = near.argmax(axis=1)
                cells[start:start + TILE_ROWS] = best
                angles[start:start + TILE_ROWS] = np.arccos(np.clip(near[np.arange(len(best)), best], -1, 1))
            added = [pa.array(cells), pa.array(angles), pa.array(norms)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, "cell", "angle", "norm"])

    added_fields = T.StructType().add("cell", T.IntegerType()).add("angle", T.DoubleType()).add("norm", T.DoubleType())
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added_fields.fields]))


def _opening(near: np.ndarray, count: np.ndarray, k: int) -> np.ndarray:
    """For each query its nearest groups that hold k vectors together."""
    order = np.argsort(-near, axis=1, kind="stable")
    before = np.cumsum(count[order], axis=1) - count[order]
    opening = np.zeros_like(near, dtype=bool)
    np.put_along_axis(opening, order, before < k, axis=1)
    return opening & (count > 0)


def _reaching(near: np.ndarray, norms: np.ndarray, s: dict[str, np.ndarray], floor: np.ndarray) -> np.ndarray:
    """Groups whose bound reaches the query's ``floor``, the k-th best score so far."""
    gap = np.maximum(np.arccos(np.clip(near, -1, 1)) - s["angle"] - 1e-9, 0)
    bound = norms[:, None] * s["norm"] * np.maximum(np.cos(gap), 0)
    return (s["count"] > 0) & (bound >= floor[:, None] - SLACK)


def _visit(queries: DataFrame, pivots: np.ndarray, stats: dict[str, np.ndarray], k: int, first: bool, whole: bool = True) -> DataFrame:
    """``(q, vector, floor, cells, parts)``: the groups that a query has to meet, still one row per query, and where the
    groups of each block lie among them.

    ``first``: its nearest groups that hold k vectors together. Otherwise those whose bound reaches the floor; if the
    opening groups were met ``whole``, they are left out, and else they come as numbers below 0 (-1 - cell).
    """
    shared = queries.sparkSession.sparkContext.broadcast((pivots, stats))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, s = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(start, TILE_ROWS)
                unit, norms = _unit(_matrix(part.column("vector")))
                near = unit @ centres.T
                opening = _opening(near, s["count"], k)
                meet = opening if first else _reaching(near, norms, s, part.column("floor").to_numpy(zero_copy_only=False))
                if not first and whole:
                    meet &= ~opening
                row, cell = np.nonzero(meet)
                blocks = s["block"][cell].astype(np.int64)
                if not whole:
                    cell = np.where(opening[row, cell], -1 - cell, cell)
                columns = [part.column(name) for name in ("q", "vector", "floor")]
                yield pa.RecordBatch.from_arrays([*columns, *_met(row, cell, blocks, len(meet))], names=["q", "vector", "floor", "cells", "parts"])

    return queries.select("q", "vector", "floor").mapInArrow(run, VISITS)


VISITS = "q long, vector array<float>, floor double, cells array<long>, parts array<struct<block: long, start: int, length: int>>"


def _met(row: np.ndarray, cell: np.ndarray, block: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
    """``cells`` and ``parts`` of ``rows`` queries, from visits in the order of row and block."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (block[1:] != block[:-1])])[:len(row)])
    starts, lengths = first - offsets[row[first]] + 1, np.diff(np.append(first, len(row)))
    parts = pa.StructArray.from_arrays([pa.array(block[first]), pa.array(starts.astype(np.int32)), pa.array(lengths.astype(np.int32))], ["block", "start", "length"])
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=rows))])
    return (pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(cell.astype(np.int64))),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), parts))


def _slab_rows(width: int, times: int = 1) -> int:
    """Most rows of a slab of vectors of ``width`` values, about."""
    return max(TILE_ROWS, times * min(SLAB_TILES * TILE_ROWS, SLAB_BYTES // (4 * max(1, width))))


def _block_rows(rows: int, slab: int, blocks: int | None = None) -> int:
    """Rows of a block of a corpus of ``rows``."""
    return max(TILE_ROWS, min(slab, math.ceil(rows / (blocks or SIDES))))


def _pieces(rows: str) -> Column:
    return F.ceil(F.col(rows) / F.lit(TILE_ROWS)).cast("int")


def _piece(row_id: str, pieces: Column) -> Column:
    return F.pmod(F.xxhash64(row_id), pieces).cast("int")


def _every(pieces: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), pieces - 1))


def _tile_top(products: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and rounded score of the k best entries of each row, ties to the lower id.

    Entries below the row's ``floor``, the k-th best score it has elsewhere, are not needed. Without
    a useful floor, the k-th largest maximum of column blocks is a cheap one, and few entries reach
    it. Where many do (equal vectors), an exact selection is cheaper than sorting them.
    """
    rows, columns = products.shape
    scale, few = 10.0**DIGITS, rows * (k + 64)
    hit = products >= (floor - SLACK)[:, None]
    blocks = columns // BLOCK_COLUMNS
    if blocks > k and np.count_nonzero(hit) > few:
        tops = products[:, :blocks * BLOCK_COLUMNS].reshape(rows, blocks, BLOCK_COLUMNS).max(axis=2)
        own = np.partition(tops, blocks - k, axis=1)[:, blocks - k]
        hit = products >= (np.maximum(own, floor) - SLACK)[:, None]
    if np.count_nonzero(hit) <= few:
        row, column = np.nonzero(hit)
        rounded = np.rint(products[row, column] * scale)
        order = np.lexsort((ids[column], -rounded, row))
        row, column, rounded = row[order], column[order], rounded[order]
        best = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
        return row[best], column[best], rounded[best] / scale
    # One integer per entry that sorts by rounded score and then by lower id.
    rounded = np.rint(products * scale).astype(np.int64)
    rank_of_id = np.argsort(np.argsort(-ids))
    keep = min(k, columns)
    best = np.argpartition(rounded * columns + rank_of_id, columns - keep, axis=1)[:, columns - keep:]
    row = np.repeat(np.arange(rows), keep)
    return row, best.reshape(-1), np.take_along_axis(rounded, best, axis=1).reshape(-1) / scale


def _sizes(visits: DataFrame, cells: DataFrame) -> DataFrame:
    """``(cell, block, qn, dn)``: slabs of queries and of corpus of the block of every group; blocks that are not visited
    have none. ``cells`` has the rows of each group, its block and the most rows of both kinds of slabs."""
    asked = visits.select(F.explode("parts.block").alias("block")).groupBy("block").agg(F.count(F.lit(1)).alias("asked"))
    rows = cells.groupBy("block").agg(F.sum("count").alias("rows"), F.first("slab").alias("slab"), F.first("full").alias("full"))
    pieces = asked.join(rows, "block").select("block", F.least(_pieces("asked"), F.greatest(F.lit(SIDES), F.ceil(F.col("asked") / F.col("slab")).cast("int"))).alias("qn"),
                                              F.ceil(F.col("rows") / (1.5 * F.col("full"))).cast("int").alias("dn"))
    return cells.select("cell", "block").join(pieces, "block")


def slab_join(visits: DataFrame, corpus: DataFrame, sizes: DataFrame | tuple[int, int], asked: list[str], held: list[str],
              meet: Callable, ddl: str, pairs: int | None = None) -> DataFrame:
    """``meet(queries, docs, visited)`` of every slab of queries and every slab of corpus that they have to meet.

    ``visits`` has (q, cells, parts) and the columns ``asked``, ``corpus`` has (d, cell) and the columns ``held``. ``sizes`` is
    a table of slabs by cell, or the slabs of the only cell. ``docs`` come in the order of cell and d. ``visited(a, b)`` gives,
    for the queries a to b, (rows among them, first, last + 1 of the docs) of each cell that some of them visit.

    A pair of slabs is one group of a cogroup, keyed by (block, slab of queries, slab of corpus). Either side is copied
    once per slab of the other, so a cell with much of the data becomes many tasks of bounded size. With a number of
    ``pairs``, few of them share a task: they take long for their bytes, by which Spark would put them together.
    """
    left = visits.select("q", *asked, "cells", F.inline("parts"))
    if isinstance(sizes, tuple):
        pieces = {"qn": F.lit(sizes[0]), "dn": F.lit(sizes[1])}
        left, right = left.withColumns(pieces), corpus.withColumns({"block": F.lit(0).cast("long"), **pieces})
    else:
        left = left.join(F.broadcast(sizes.select("block", "qn", "dn").distinct()), "block")  # a row for a slab's worth of rows
        right = corpus.join(sizes, "cell")
    left = left.select("q", *asked, "block", F.slice("cells", F.col("start"), F.col("length")).alias("cells"), _piece("q", F.col("qn")).alias("qp"), _every(F.col("dn")).alias("dp"))
    right = right.select("d", *held, "cell", "block", _piece("d", F.col("dn")).alias("dp"), _every(F.col("qn")).alias("qp"))
    keys = ["block", "qp", "dp"]
    if pairs:
        left, right = (side.repartition(min(2 * pairs, MOST_TASKS), *keys) for side in (left, right))
    schema = _arrow_schema(ddl)

    def run(queries: pa.Table, docs: pa.Table) -> pa.Table:
        if not queries.num_rows or not docs.num_rows:
            return schema.empty_table()
        docs = docs.take(pa.array(np.lexsort((docs.column("d").to_numpy(), docs.column("cell").to_numpy()))))
        cells, first = np.unique(docs.column("cell").to_numpy(), return_index=True)
        last = np.append(first[1:], docs.num_rows)
        lists = queries.column("cells").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        wanted = lists.flatten().to_numpy()
        place = np.minimum(np.searchsorted(cells, wanted), len(cells) - 1)
        held_here = cells[place] == wanted

        def visited(a: int, b: int) -> Iterator[tuple[np.ndarray, int, int]]:
            mine = slice(ends[a], ends[b])
            row = np.repeat(np.arange(b - a), np.diff(ends[a:b + 1]))[held_here[mine]]
            cell = place[mine][held_here[mine]]
            order = np.argsort(cell, kind="stable")
            row, cell = row[order], cell[order]
            for j in np.unique(cell):
                yield row[np.searchsorted(cell, j):np.searchsorted(cell, j, "right")], first[j], last[j]

        return meet(queries, docs, visited).cast(schema)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, ddl)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _k_best(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (row, column, score) the k best of each row, ties to the lower id."""
    row, column, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids[column], -score, row))
    row, column, score = row[order], column[order], score[order]
    best = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[best], column[best], score[best]


class _Screen:
    """Bounds from above of the products of some vectors with those of a slab, as 32-bit matrix products.

    A product of unit vectors of n values, whatever the order of its sum, is off by less than n + 16 units of 2^-24, those of
    rounding the values included. Vectors of the slab are scaled by their greatest length, and a last column adds that
    much of their own length.
    """

    def __init__(self, docs: np.ndarray):
        norms = np.concatenate([np.sqrt((part * part).sum(axis=1)) for part in self._exact(docs)] or [np.zeros(0)])
        self.docs, self.margin = docs, (docs.shape[1] + 16) * 2.0**-24
        self.scale = max(float(norms.max(initial=0)), 1e-300)
        self.scaled = np.empty((len(docs), docs.shape[1] + 1), np.float32)
        for i, part in enumerate(self._exact(docs)):
            self.scaled[i * TILE_ROWS:(i + 1) * TILE_ROWS, :-1] = part / self.scale
        self.scaled[:, -1] = norms / self.scale
        self.products, self.raw = np.empty(PART_ROWS * TILE_ROWS, np.float32), bytearray(TILE_ROWS * TILE_ROWS)

    @staticmethod
    def _exact(docs: np.ndarray) -> Iterator[np.ndarray]:
        return (docs[a:a + TILE_ROWS].astype(np.float64) for a in range(0, len(docs), TILE_ROWS))

    def queries(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors, what stands for them in the products, and the score that a product of 1 is."""
        unit, norms = _unit(own)
        return own, np.concatenate([unit, np.full((len(own), 1), self.margin)], axis=1).astype(np.float32), np.maximum(norms, 1e-300) * self.scale

    def top(self, queries: tuple[np.ndarray, np.ndarray, np.ndarray], row: np.ndarray, start: int, stop: int, ids: np.ndarray, k: int,
            floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and rounded score of the entries of some rows and of the columns from ``start`` on that may be among the k
        best of their row; all that are, and not many others."""
        own, sides, scales = queries if len(row) == len(queries[0]) else [x[row] for x in queries]
        rows, columns = len(row), stop - start
        across, blocks, few, size = self.scaled[start:stop].T, columns // BLOCK_COLUMNS, rows * (k + 64), rows * columns
        hits = np.frombuffer(self.raw, bool, size).reshape(rows, columns)
        with np.errstate(over="ignore"):
            reached, slack = floor / scales, SLACK / scales
        unbounded = np.isneginf(floor) & (blocks > k)
        for a in range(0, rows, PART_ROWS):
            b = min(a + PART_ROWS, rows)
            products = np.matmul(sides[a:b], across, out=self.products[:(b - a) * columns].reshape(b - a, columns))
            if unbounded[a:b].any():
                without = np.flatnonzero(unbounded[a:b])
                tops = products[without, :blocks * BLOCK_COLUMNS].reshape(-1, blocks, BLOCK_COLUMNS).max(axis=2)
                reached[a + without] = np.partition(tops, blocks - k, axis=1)[:, blocks - k] - 2 * self.margin
            with np.errstate(over="ignore"):
                least = np.nextafter((reached[a:b] - slack[a:b] - 1e-35).astype(np.float32), np.float32(-np.inf))
            np.greater_equal(products, least[:, None], out=hits[a:b])
        count = np.count_nonzero(hits)
        if count > few:  # very many are equal, or nothing bounds them
            return _tile_top(own @ self.docs[start:stop].astype(np.float64).T, ids[start:stop], k, floor)
        r, c = np.divmod(self._few(size) if count < FEW else np.flatnonzero(hits), columns)
        score = np.concatenate([np.einsum("ij,ij->i", own[r[a:a + RESCORED]], self.docs[start + c[a:a + RESCORED]].astype(np.float64))
                                for a in range(0, len(r), RESCORED)] or [np.zeros(0)])
        kept = score >= floor[r] - SLACK
        return r[kept], c[kept], np.rint(score[kept] * 10.0**DIGITS) / 10.0**DIGITS

    def _few(self, size: int) -> np.ndarray:
        """The places of the hits, by a search for the next byte that is 1."""
        places, place = [], self.raw.find(1, 0, size)
        while place >= 0:
            places.append(place)
            place = self.raw.find(1, place + 1, size)
        return np.array(places, np.int64)


class _BestOfTile:
    """The k best entries so far of each row of a tile of queries, ties to the lower id."""

    def __init__(self, rows: int, k: int, ids: np.ndarray):
        self.k, self.ids, self.waiting, self.count = k, ids, [], 0
        self.score, self.column = np.full((rows, k), -np.inf), np.zeros((rows, k), np.int64)

    def add(self, row: np.ndarray, column: np.ndarray, score: np.ndarray, floor: np.ndarray, most: int) -> None:
        """Keep some more entries and raise the rows' ``floor``, once more than ``most`` entries wait."""
        self.waiting.append((row, column, score))
        self.count += len(row)
        if self.count > most:
            row, column, score = (np.concatenate(x) for x in zip(*self.waiting))
            self.waiting, self.count, own = [], 0, np.unique(row)
            row, column, score = _k_best([(np.repeat(own, self.k), self.column[own].ravel(), self.score[own].ravel()), (row, column, score)], self.ids, self.k)
            self.score[own], self.column[own] = score.reshape(-1, self.k), column.reshape(-1, self.k)
            floor[own] = np.maximum(floor[own], self.score[own, -1])

    def found(self, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.count:
            self.add(*(np.zeros(0, np.int64),) * 3, floor, 0)
        row, place = np.nonzero(np.isfinite(self.score))
        return row, self.column[row, place], self.score[row, place]


def _copied(row: np.ndarray, column: np.ndarray, score: np.ndarray, copies: pa.ListArray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of equal vectors, of the k best vectors: row, place among all copies, score."""
    sizes, starts = copies.value_lengths().to_numpy()[column], copies.offsets.to_numpy()[column] - copies.offsets[0].as_py()
    each = np.repeat(np.arange(len(row)), sizes)
    place = starts[each] + np.arange(len(each)) - (np.cumsum(sizes) - sizes)[each]
    return _k_best([(row[each], place, score[each])], copies.flatten().field("d").to_numpy(), k)


def _tile_join(visits: DataFrame, corpus: DataFrame, sizes: DataFrame | tuple[int, int], k: int, payload: list[str]) -> DataFrame:
    """Local top k of every query in every slab that it meets, as far as it reaches the floor: ``(q, d, score, *payload)``."""
    def meet(queries: pa.Table, docs: pa.Table, visited: Callable) -> pa.Table:
        ids, rows, places, scores = docs.column("d").to_numpy(), [], [], []
        vectors, asked = docs.column("vector").combine_chunks(), queries.column("vector").combine_chunks()
        _same_length(vectors, asked)
        floors, copies, screen = queries.column("floor").to_numpy(), docs.column("copies").combine_chunks(), _Screen(_rows(vectors))
        for a in range(0, queries.num_rows, TILE_ROWS):
            b = min(a + TILE_ROWS, queries.num_rows)
            own, floor = screen.queries(_matrix(asked.slice(a, b - a))), floors[a:b].copy()
            best = _BestOfTile(b - a, k, ids)
            for row, first, last in visited(a, b):
                for start in range(first, last, TILE_ROWS):
                    r, c, score = screen.top(own, row, start, min(start + TILE_ROWS, last), ids, k, floor[row])
                    best.add(row[r], start + c, score, floor, k * len(row) // 4)
            r, place, score = _copied(*best.found(floor), copies, k)
            rows.append(a + r)
            places.append(place)
            scores.append(score)
        chosen = copies.flatten().take(pa.array(np.concatenate(places)))
        q = queries.column("q").take(pa.array(np.concatenate(rows)))
        return pa.table([q, chosen.field("d"), pa.array(np.concatenate(scores)), *[chosen.field(p) for p in payload]], names=["q", "d", "score", *payload])

    types = dict(corpus.selectExpr("inline(copies)").dtypes)
    ddl = ", ".join(["q long", "d long", "score double", *[f"{p} {types[p]}" for p in payload]])
    pairs = sizes[0] * sizes[1] if isinstance(sizes, tuple) else sizes.select("block", (F.col("qn") * F.col("dn")).alias("n")).distinct().agg(F.sum("n")).first()[0]
    return slab_join(visits, corpus, sizes, ["vector", "floor"], ["vector", "copies"], meet, ddl, pairs or 1)


def _same_length(*columns: pa.Array) -> None:
    if len({n for c in columns for n in np.unique(c.value_lengths().to_numpy())}) > 1:
        raise ValueError("vectors differ in length")


def _best(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "d")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _cells(docs: DataFrame, *key: str) -> DataFrame:
    return docs.groupBy(*key).agg(F.count(F.lit(1)).alias("count"), F.max("angle").alias("angle"), F.max("norm").alias("norm"))


def _collected(rows: DataFrame, pivots: int) -> dict[str, np.ndarray]:
    """Bounds of the groups of the upper or only level, at most ``pivots`` rows."""
    stats = {name: np.zeros(pivots) for name in ("count", "angle", "norm", "block")}
    for row in rows.collect():
        for name in ("count", "angle", "norm"):
            stats[name][row["cell"]] = row[name]
    return stats


def _blocks(counts: np.ndarray, full: int) -> np.ndarray:
    """The block of each of some groups in a row: at most ``full`` rows, or one larger group."""
    blocks, block, size = np.zeros(len(counts), np.int64), 0, 0
    for i, count in enumerate(counts):
        if size and size + count > full:
            block, size = block + 1, 0
        blocks[i], size = block, size + count
    return blocks


def _chained(pivots: np.ndarray) -> np.ndarray:
    """Each pivot followed by the nearest one left, so that groups of a block are visited by much the same queries."""
    order, left = [0], np.ones(len(pivots), bool)
    while len(order) < len(pivots):
        left[order[-1]] = False
        order.append(int(np.where(left, pivots @ pivots[order[-1]], -np.inf).argmax()))
    return pivots[order]


class _OneLevel:
    """Groups around pivots that every task holds."""

    def __init__(self, corpus: DataFrame, docs: DataFrame, cells: int, rows: int, slab: int):
        self.pivots = _chained(_pivots(corpus, cells, rows))
        self.docs = materialise(_assign(docs, self.pivots), "corpus-cells")
        found = _cells(self.docs, "cell")
        self.stats = _collected(found, len(self.pivots))
        full = _block_rows(rows, slab, BLOCKS)
        self.stats["block"] = _blocks(self.stats["count"], full)
        kept = [(i, int(n), int(b), slab, full) for i, (n, b) in enumerate(zip(self.stats["count"], self.stats["block"])) if n]
        self.cells = corpus.sparkSession.createDataFrame(kept, "cell int, count long, block long, slab int, full int")

    def visits(self, asked: DataFrame, k: int, first: bool) -> DataFrame:
        return _visit(asked, self.pivots, self.stats, k, first)

    def sizes(self, visits: DataFrame) -> DataFrame:
        return F.broadcast(materialise(_sizes(visits, self.cells), "sizes"))  # at most FAN rows


class _TwoLevels:
    """Lower groups around pivots in a table, joined by upper group."""

    def __init__(self, corpus: DataFrame, docs: DataFrame, cells: int, rows: int, slab: int):
        self.pivots = _pivots(corpus, math.ceil(math.sqrt(cells)), rows)
        upper = materialise(_assign(docs, self.pivots), "corpus-upper")
        candidates = _assign(_some(corpus, 4 * cells, rows, "lower"), self.pivots).select("vector", F.col("cell").alias("upper"))
        lower = _spaced_by_group(materialise(candidates, "lower-candidates"))
        heads = corpus.sparkSession.createDataFrame([(-1 - i, [float(x) for x in v], i) for i, v in enumerate(self.pivots)], "low long, vector array<float>, upper int")
        low = materialise(lower.select(F.monotonically_increasing_id().alias("low"), "vector", "upper").unionByName(heads), "lower-pivots")
        # Each vector goes to the nearest of one piece of the lower pivots of its group.
        many = low.groupBy("upper").agg(F.count(F.lit(1)).alias("lower"))
        sizes = F.broadcast(upper.groupBy(F.col("cell").alias("upper")).agg(F.count(F.lit(1)).alias("rows")).join(many, "upper").select(
            "upper", _pieces("lower").alias("ln"), F.ceil(F.col("rows") / F.lit(CELL_TILES * TILE_ROWS)).cast("int").alias("dn")))  # a row an upper pivot
        left = upper.withColumnRenamed("cell", "upper").join(sizes, "upper")
        left = left.withColumns({"lp": _piece("d", F.col("ln")), "dp": F.pmod(F.xxhash64(F.lit("dp"), "d"), F.col("dn")).cast("int")}).drop("ln", "dn")
        right = low.join(sizes, "upper").select("low", "vector", "upper", _piece("low", F.col("ln")).alias("lp"), _every(F.col("dn")).alias("dp"))
        keys, names = ["upper", "lp", "dp"], [*docs.columns, "norm"]

        def nearest(rows: pa.Table, pivots: pa.Table) -> pa.Table:
            angle, cell = rows.column("angle").to_numpy().copy(), -1 - rows.column("upper").to_numpy().astype(np.int64)
            if rows.num_rows and pivots.num_rows:
                centres, _ = _unit(_matrix(pivots.column("vector")))
                ids = pivots.column("low").to_numpy()
                for start in range(0, rows.num_rows, TILE_ROWS):
                    unit, _ = _unit(_matrix(rows.column("vector").slice(start, TILE_ROWS)))
                    near = unit @ centres.T
                    best = near.argmax(axis=1)
                    cell[start:start + TILE_ROWS] = ids[best]
                    angle[start:start + TILE_ROWS] = np.arccos(np.clip(near[np.arange(len(best)), best], -1, 1))
            return pa.table([*[rows.column(c) for c in names], rows.column("upper"), pa.array(angle), pa.array(cell)], names=[*names, "upper", "angle", "cell"])

        schema = T.StructType([*[left.schema[c] for c in names], left.schema["upper"], left.schema["angle"], T.StructField("cell", T.LongType())])
        self.docs = materialise(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, schema), "corpus-cells")
        before, full = Window.partitionBy("upper").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1), _block_rows(rows, slab, BLOCKS)
        block = F.col("upper") * F.lit(1 << 32) + F.floor(F.coalesce(F.sum("count").over(before), F.lit(0)) / F.lit(full))
        found = _cells(self.docs, "cell", "upper").join(low.select(F.col("low").alias("cell"), "vector"), "cell")
        self.cells = materialise(found.withColumns({"block": block, "slab": F.lit(slab), "full": F.lit(full)}), "cells")
        self.stats = _collected(_cells(upper, "cell"), len(self.pivots))

    def visits(self, asked: DataFrame, k: int, first: bool) -> DataFrame:
        coarse = materialise(_visit(asked, self.pivots, self.stats, k, first, whole=False), "visits-upper")
        coarse = coarse.select("q", "vector", "floor", F.explode("cells").alias("u"))
        coarse = coarse.select("q", "vector", "floor", (F.col("u") < 0).alias("opened"), F.when(F.col("u") < 0, -1 - F.col("u")).otherwise(F.col("u")).cast("int").alias("upper"))
        sizes = coarse.groupBy("upper").agg(F.count(F.lit(1)).alias("asked")).join(self.cells.groupBy("upper").agg(F.count(F.lit(1)).alias("lower")), "upper")
        sizes = F.broadcast(sizes.select("upper", _pieces("asked").alias("qn"), _pieces("lower").alias("ln")))  # a row an upper pivot
        left = coarse.join(sizes, "upper").select("q", "vector", "floor", "opened", "upper", _piece("q", F.col("qn")).alias("qp"), _every(F.col("ln")).alias("lp"))
        right = self.cells.join(sizes, "upper").select("cell", F.col("vector").alias("pivot"), "count", "angle", "norm", "block", "upper",
                                                       _piece("cell", F.col("ln")).alias("lp"), _every(F.col("qn")).alias("qp"))
        keys = ["upper", "qp", "lp"]

        def meet(queries: pa.Table, cells: pa.Table) -> pa.Table:
            row = flat = blocks = np.zeros(0, np.int64)
            if queries.num_rows and cells.num_rows:
                unit, norms = _unit(_matrix(queries.column("vector")))
                centres, _ = _unit(_matrix(cells.column("pivot")))
                near = unit @ centres.T
                s = {name: cells.column(name).to_numpy() for name in ("count", "angle", "norm", "block")}
                # The order of rows in a group is not fixed; ties between pivots are settled by their numbers.
                order = np.argsort(cells.column("cell").to_numpy())
                near, s, ids = near[:, order], {name: v[order] for name, v in s.items()}, cells.column("cell").to_numpy()[order]
                found = _opening(near, s["count"], k)
                if not first:
                    opened = queries.column("opened").to_numpy()
                    found = _reaching(near, norms, s, queries.column("floor").to_numpy()) & ~(found & opened[:, None])
                row, column = np.nonzero(found)
                # Blocks follow the numbers of the groups of an upper group, so they are in order as well.
                flat, blocks = ids[column], s["block"][column]
            return pa.table([*[queries.column(c) for c in ("q", "vector", "floor")], *_met(row, flat, blocks, queries.num_rows)], names=["q", "vector", "floor", "cells", "parts"])

        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, VISITS)

    def sizes(self, visits: DataFrame) -> DataFrame:
        return materialise(_sizes(visits, self.cells), "sizes")


def _found(asked: DataFrame, corpus: DataFrame, corpus_size: int, slab: int, k: int, payload: list[str], pivots: int | None) -> DataFrame:
    """``(q, d, score, *payload)`` that holds the k best of every query."""
    docs, cells = _distinct_corpus(corpus, k), pivots or corpus_size // (CELL_TILES * TILE_ROWS)
    asked = asked.withColumn("floor", _no_floor())
    if cells >= 2:
        docs = corpus = materialise(docs, "corpus-vectors")
        corpus_size = docs.count()
        cells = pivots or corpus_size // (CELL_TILES * TILE_ROWS)
    if cells < 2:
        count = asked.count()
        sizes = max(1, min(math.ceil(count / TILE_ROWS), max(SIDES, math.ceil(count / slab)))), max(1, math.ceil(corpus_size / _block_rows(corpus_size, slab, BLOCKS)))
        only = F.array(F.struct(F.lit(0).cast("long").alias("block"), F.lit(1).alias("start"), F.lit(1).alias("length")))
        visits = asked.select("q", "vector", "floor", F.array(F.lit(0).cast("long")).alias("cells"), only.alias("parts"))
        return _tile_join(visits, docs.withColumn("cell", F.lit(0).cast("long")), sizes, k, payload)
    index = (_OneLevel if cells <= FAN else _TwoLevels)(corpus, docs, cells, corpus_size, slab)
    opening = materialise(index.visits(asked, k, first=True), "visits")
    near = materialise(_tile_join(opening, index.docs, index.sizes(opening), k, payload), "near")
    # A corpus below k vectors is opened whole, and then no group is left for the second round.
    floor = _best(near, k).groupBy("q").agg(F.min("score").alias("floor"))
    later = materialise(index.visits(asked.drop("floor").join(floor, "q"), k, first=False), "visits")
    return near.unionByName(_tile_join(later, index.docs, index.sizes(later), k, payload))


def _per_vector(queries: DataFrame, corpus: DataFrame, corpus_size: int, slab: int, k: int, payload: list[str],
                pivots: int | None) -> DataFrame:
    """``(hash, vector, count, neighbours)`` per distinct query vector."""
    asked = materialise(_distinct_queries(queries), "queries")
    found = _found(asked, corpus, corpus_size, slab, k, payload, pivots)
    return asked.join(_lists(found, k, payload), "q", "left").select(*VECTOR_KEY, "count", "neighbours")


def _lists(found: DataFrame, k: int, payload: list[str]) -> DataFrame:
    hit = F.struct("rank", "d", "score", *payload)
    return _best(found, k).groupBy("q").agg(F.array_sort(F.collect_list(hit)).alias("neighbours"))


def top_k(queries: DataFrame, corpus: DataFrame, k: int, payload: list[str] | None = None,
          pivots: int | None = None) -> DataFrame:
    """All query rows with ``neighbours``, an array of ``(rank, d, score, *payload)`` in rank order.

    ``queries`` has ``q long, vector`` and any other columns; ``corpus`` has ``d long, vector`` and
    the payload columns. Both are read several times, so they should be tables or materialised.
    ``k`` above the corpus size gives the whole corpus.
    """
    payload = payload or []
    corpus = corpus.where(usable("vector"))
    asked = queries.where(usable("vector")).select("q", "vector")
    size = corpus.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vector")).alias("width")).first()
    per_vector = materialise(_per_vector(asked, corpus, size["rows"], _slab_rows(size["width"] or 1, WIDE), k, payload, pivots), "neighbours")
    hot = hot_hashes(per_vector, VECTOR_KEY)
    joined = join_to_unique(_hashed(queries), per_vector.drop("count"), VECTOR_KEY, "q", hot)
    kind = dict(per_vector.dtypes)["neighbours"]
    return joined.select(*queries.columns, F.coalesce("neighbours", F.array().cast(kind)).alias("neighbours"))


def exploded(matched: DataFrame) -> DataFrame:
    """``(q, d, sim, rank)`` rows of a ``top_k`` result."""
    hits = matched.select("q", F.explode("neighbours").alias("n"))
    return hits.select("q", F.col("n.d").alias("d"), F.col("n.score").alias("sim"), F.col("n.rank").alias("rank"))
