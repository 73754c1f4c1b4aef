"""Token ids as length-delimited binary records, and a separate offset index for shuffled reads.

A shard file is a run of records in ascending order of doc_id. A record is

    length    8 bytes   of the body
    check     4 bytes   masked CRC-32 of the 8 bytes before
    body      length    doc_id (8), number of ids (4), bytes per id (4), ids
    check     4 bytes   masked CRC-32 of the body

all little-endian. The mask, rotate right by 15 and add a constant, keeps a checksum of data that itself holds
checksums from being trivial. Ids take 2 bytes where the vocabulary allows, else 4.

Each task writes its range of doc_id as one shard, under a name of its own first, so that a repeated or speculative
attempt replaces a whole file by the same file. The index is a Parquet table of (shard, doc_id, n_tokens, offset,
length). The folder must be reachable by pyarrow's file systems from every executor.

A null text is an empty one and still has its end id. Rows with one doc_id are all kept, ordered by their texts. A record
needs a doc_id, so rows without one are left out. An empty table gives no records. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.llm.tables import id_and_text, new_path, parts, table
from pairsmith.llm.text import slices
from pairsmith.llm.tokens import default_path, encoder

END = 0
MASK = 0xA282EAD8
INDEX = "shard int, doc_id long, n_tokens long, offset long, length long"
READ_BYTES = 1 << 20
SHARD_BYTES = 1 << 28  # of text in a shard, about


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF


def frame(doc_id: int, ids: bytes, width: int) -> bytes:
    body = struct.pack("<qII", doc_id, len(ids) // width, width) + ids
    length = struct.pack("<Q", len(body))
    return length + struct.pack("<I", masked(length)) + body + struct.pack("<I", masked(body))


def parse(body: bytes) -> tuple[int, np.ndarray]:
    doc_id, n, width = struct.unpack_from("<qII", body)
    return doc_id, np.frombuffer(body, f"<u{width}", n, 16)


def read_frame(stream) -> bytes | None:
    """The next body, or None at the end; raises ValueError where a checksum or a length is wrong."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != struct.unpack_from("<I", head, 8)[0]:
        raise ValueError("a record's length is damaged")
    n = struct.unpack_from("<Q", head)[0]
    rest = stream.read(n + 4)
    if len(rest) < n + 4 or masked(rest[:n]) != struct.unpack_from("<I", rest, n)[0]:
        raise ValueError("a record's body is damaged")
    return rest[:n]


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/part-{shard:06d}.records"


def write(docs: DataFrame, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Write the records of ``docs`` and their index (``folder/index``), and return the index."""
    spark, vocabulary = docs.sparkSession, vocabulary or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, shard = encoder(vocabulary), TaskContext.get().partitionId()
        files, root = _files(folder)
        files.create_dir(root, recursive=True)
        own, offset = f"{root}/.{uuid.uuid4().hex}", 0
        with files.open_output_stream(own) as out:
            for batch in slices(batches):
                ids = tokenizer.encode([t or "" for t in batch.column("text").to_pylist()])
                end, rows = np.array([END], tokenizer.dtype).tobytes(), []
                for doc_id, tokens in zip(batch.column("doc_id").to_pylist(), ids):
                    record = frame(doc_id, tokens + end, tokenizer.dtype.itemsize)
                    out.write(record)
                    rows.append((shard, doc_id, len(tokens) // tokenizer.dtype.itemsize + 1, offset, len(record)))
                    offset += len(record)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), *[pa.int64()] * 4])], ["shard", "doc_id", "n_tokens", "offset", "length"])
        files.move(own, shard_path(root, shard))

    rows = id_and_text(docs).where("doc_id is not null").withColumn("_tie", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranged = rows.repartitionByRange(max(parts(docs), size // SHARD_BYTES), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text").drop("_tie")
    ranged.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_in_order(index: DataFrame, folder: str) -> DataFrame:
    """Read every shard from its start: doc_id, start (ids of all records before), n_tokens, ids_crc32."""
    spark, base, starts = index.sparkSession, 0, []
    for r in sorted(index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()):  # one row per shard
        starts.append((r["shard"], base))
        base += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        for batch in batches:
            for shard, start in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist()):
                rows = []
                with files.open_input_stream(shard_path(root, shard), buffer_size=READ_BYTES) as stream:
                    while (body := read_frame(stream)) is not None:
                        doc_id, ids = parse(body)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    shards = spark.createDataFrame(starts, "shard int, start long")
    return shards.repartition(max(1, min(len(starts), parts(index))), "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_shuffled(index: DataFrame, folder: str, seed: int) -> DataFrame:
    """Read single records through the index, in an order drawn by ``seed``: doc_id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        opened: dict[int, object] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                found = []
                for row in batch.slice(a, 64).to_pylist():
                    if row["shard"] not in opened:
                        if len(opened) == 64:
                            opened.pop(next(iter(opened))).close()
                        opened[row["shard"]] = files.open_input_file(shard_path(root, row["shard"]))
                    opened[row["shard"]].seek(row["offset"])
                    found.append(parse(read_frame(opened[row["shard"]])))
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([i.tolist() for _, i in found], pa.list_(pa.int64()))], ["doc_id", "ids"])

    order = F.xxhash64(F.lit(seed), "shard", "offset")
    return index.withColumn("_order", order).repartitionByRange(parts(index), "_order").sortWithinPartitions("_order").drop("_order") \
        .mapInArrow(run, "doc_id long, ids array<long>")


def op5_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as records, and read them back."""
    folder = new_path(spark, "records")
    return read_in_order(write(table(spark, sf_dir, "documents"), folder), folder)
