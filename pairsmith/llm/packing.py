"""Best-fit packing by minimum bin slack.

Documents are token ids with an end id. One longer than a sequence is cut into whole sequences from its end, so only
its first piece may be shorter. Only the number of pieces of each length decides how they are packed, and there are
at most ``SEQUENCE`` lengths, so the plan is made from that histogram: per sequence, the longest piece left is set
and a subset-sum over the lengths left, kept as the bits of one integer, finds the fullest combination that fits. It
is taken as often as the pieces allow, which exhausts one of its lengths, so the plan stays small however many pieces
there are. Among equally full combinations the one with longer pieces is taken.

Pieces are then numbered within their length, in blocks that are counted first, and a number leads to sequence and
offset through the plan.

A null text is an empty one: its piece is the end id alone. Repeated rows are packed as often as they occur. An empty
table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairsmith.llm.tables import id_and_text, table, written
from pairsmith.llm.text import slices
from pairsmith.llm.tokens import default_path, encoder

SEQUENCE = 2048
END = 0
BLOCK = 20_000  # pieces numbered by one task at a time, about
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, size: int = SEQUENCE, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""
    vocabulary = vocabulary or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(vocabulary)
        end = np.array([END], tokenizer.dtype).tobytes()
        for batch in slices(batches):
            rows = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), tokenizer.encode([t or "" for t in batch.column("text").to_pylist()])):
                ids = np.frombuffer(raw + end, tokenizer.dtype).astype("<u4")
                first = len(ids) % size or size
                for k, a in enumerate([0, *range(first, len(ids), size)]):
                    part = ids[a:first if not k else a + size]
                    rows.append((doc_id, k, a, len(part), zlib.crc32(part.tobytes()), part))
            *numbers, ids = zip(*rows)
            columns = [pa.array(c, t) for c, t in zip(numbers, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])]
            columns += [pa.array([i.tolist() for i in ids], pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    return id_and_text(docs).mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def fullest(room: int, left: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of (length, count) in falling length, the (length, times) that fill ``room`` best."""
    limit, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length, count in left:
        if length > room:
            continue
        count, step = min(count, room // length), 1
        while count:
            step = min(step, count)
            more = reach | (reach << (length * step)) & limit
            if more != reach:
                steps.append((length, step, reach))
                reach = more
            count -= step
            step *= 2
        if reach >> room & 1:
            break
    best, taken = reach.bit_length() - 1, {}
    for length, step, before in reversed(steps):
        if not before >> best & 1:
            taken[length] = taken.get(length, 0) + step
            best -= length * step
    return list(taken.items())


def plan(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from, to, first sequence, pieces a sequence, offset): pieces from..to-1 of a length go there in turn."""
    left, used, rows, sequence = dict(sorted(histogram.items(), reverse=True)), {}, [], 0
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        rest = fullest(size - longest, [(k, n) for k, n in left.items() if n])
        left[longest] += 1
        combination = dict(rest)
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[k] // n for k, n in combination.items())
        offset = 0
        for length, n in combination.items():
            at = used.get(length, 0)
            rows.append((length, at, at + n * times, sequence, n, offset))
            used[length] = at + n * times
            offset += length * n
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
    return rows


def pack(cut: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Add sequence_id and offset to pieces; ``cut`` is read several times, so pass a written table."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``size`` rows
    blocks = max(1, sum(histogram.values()) // BLOCK)
    rows = cut.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = rows.groupBy("length", "_block").count().select("length", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_ahead"))
    place = F.row_number().over(Window.partitionBy("length", "_block").orderBy("doc_id", "piece", "ids_crc32")) - 1
    numbered = rows.withColumn("_place", place).join(ahead, ["length", "_block"]).withColumn("_number", F.col("_ahead") + F.col("_place"))
    made = spark.createDataFrame(plan(histogram, size), "length long, _from long, _to long, _first long, _each long, _offset long")
    found = numbered.join(F.broadcast(made), "length").where("_number >= _from and _number < _to")  # the plan is small, see above
    at = F.col("_number") - F.col("_from")
    return found.select(
        *[c for c in cut.columns],
        (F.col("_first") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + at % F.col("_each") * F.col("length")).cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, of packed pieces that carry ids; a sequence has at most ``SEQUENCE`` of them."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts")) \
        .select("sequence_id", F.flatten(F.col("_parts.ids")).alias("ids"))


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(written(pieces(docs), "pieces"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack_documents(table(spark, sf_dir, "documents"))
