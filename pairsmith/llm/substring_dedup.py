"""Substring dedup by runs of repeated word windows with consecutive sources.

An edge is a window of ``EDGE`` consecutive words. No De Bruijn graph is built: there are no nodes and no degrees. Equal
windows are one edge; its source is the occurrence with the least (doc_id, position). An edge that starts in several
documents is repeated. Walking along a document, repeated edges whose sources also follow one another in one document
compact into one piece, a run: (doc, start, source document, source start,
number of edges). Every piece is then verified through its source coordinates: words of the document and of the
source are read again and compared by a 128-bit digest, once for each distinct run. What verified pieces cover is
removed. Windows are judged on the input, so a word is removed if a window over it also starts in a document with a
smaller doc_id.

Windows travel as blocks dealt by their hash. In a task's own documents only the least one of equal windows is sent;
for the others the answer is known at once. So a window that a third of all documents share costs one entry a task.

Words are runs of other characters than blank and 0x09 to 0x0D. A null text has no words; a text of fewer than EDGE
words has no window. Rows with one doc_id count as one document (of differing texts the greatest); rows without a
doc_id are left out. An empty table gives an empty one. Other columns are ignored.

Window hashes have 64 bits. Verification keeps a chance equality from removing anything; it could hide another source
of the same window, at odds of about one in 10**19 per pair of windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.llm.blocks import deal, joined, only_some, shard_count
from pairsmith.llm.tables import free_shuffles, table, unique_documents, written
from pairsmith.llm.text import Words, grams, mix, owners, slices

EDGE = 13
WINDOWS_PER_SHARD = 1_000_000
WINDOWS_PER_TASK_STEP = 600_000  # windows of a task's documents that are compared before they are dealt
PIECE = ["doc", "start", "source", "source_start", "edges"]
PIECES = ", ".join(f"{c} long" for c in PIECE)


def _steps(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """doc_id, position and hash of windows, ordered by (doc_id, position), for so many documents at a time."""
    kept, total = [], 0
    for batch in slices(batches):
        words = Words(batch.column("text"))
        at, text = owners(words.first, size)
        kept.append((batch.column("doc_id").to_numpy()[text], (at - words.first[:-1][text]).astype(np.uint32), grams(words.hashes, size)[at]))
        total += len(at)
        if total >= WINDOWS_PER_TASK_STEP:
            yield _by_document(kept)
            kept, total = [], 0
    if total:
        yield _by_document(kept)


def _by_document(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc, pos, h = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(doc, kind="stable")
    return doc[order], pos[order], h[order]


def _sources(doc: np.ndarray, pos: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows ordered by (doc, pos): document and position of the first row with the same hash."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    first = np.empty(len(s), np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return doc[first], pos[first]


def compact(doc: np.ndarray, pos: np.ndarray, source: np.ndarray, source_pos: np.ndarray) -> list[np.ndarray]:
    """Pieces of repeated edges that are ordered by (doc, pos)."""
    if not len(doc):
        return [np.zeros(0, np.int64)] * 5
    pos, source_pos = pos.astype(np.int64), source_pos.astype(np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (source[1:] != source[:-1]) | (pos[1:] != pos[:-1] + 1) | (source_pos[1:] != source_pos[:-1] + 1)
    at = np.flatnonzero(new)
    return [doc[at], pos[at], source[at], source_pos[at], np.diff(np.append(at, len(doc)))]


def pieces(docs: DataFrame, edge: int = EDGE) -> DataFrame:
    """Runs of repeated edges in all documents (doc_id, text) but the edges' first ones."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = shard_count(size // 6, WINDOWS_PER_SHARD)  # about as many windows as words; decides only how they are dealt
    bits = shards.bit_length() - 1
    buckets = shards

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, pos, h in _steps(batches, edge):
            source, source_pos = _sources(doc, pos, h)
            later = source < doc
            known = compact(doc[later], pos[later], source[later], source_pos[later])
            batch = deal((h[~later] >> np.uint64(64 - bits)).astype(np.int64), {"doc": doc[~later], "pos": pos[~later], "h": h[~later]})
            told = np.stack(known, 1).tobytes() if len(known[0]) else b""
            yield batch.append_column("known", pa.array([told] + [b""] * (batch.num_rows - 1), pa.binary()))

    def match(group: pa.Table) -> pa.Table:
        doc, pos, h = joined(group["doc"], np.int64), joined(group["pos"], np.uint32), joined(group["h"], np.uint64)
        order = np.lexsort((pos, doc))
        doc, pos, h = doc[order], pos[order], h[order]
        source, source_pos = _sources(doc, pos, h)
        later = source < doc
        doc, pos, source, source_pos = doc[later], pos[later], source[later], source_pos[later]
        known = np.frombuffer(b"".join(group["known"].to_pylist()), np.int64).reshape(-1, 5)
        doc, pos = np.concatenate([doc, known[:, 0]]), np.concatenate([pos, known[:, 1].astype(np.uint32)])
        source, source_pos = np.concatenate([source, known[:, 2]]), np.concatenate([source_pos, known[:, 3].astype(np.uint32)])
        edges = np.concatenate([np.ones(len(later.nonzero()[0]), np.uint32), known[:, 4].astype(np.uint32)])
        return pa.Table.from_batches([deal(_bucket(doc, buckets), {"doc": doc, "pos": pos, "source": source, "source_pos": source_pos, "edges": edges}, "bucket")])

    def gather(group: pa.Table) -> pa.Table:
        doc, pos, source, source_pos, edges = (joined(group[c], t) for c, t in zip(["doc", "pos", "source", "source_pos", "edges"], [np.int64, np.uint32, np.int64, np.uint32, np.uint32]))
        one = edges == 1
        order = np.lexsort((pos[one], doc[one]))
        found = compact(*(x[one][order] for x in (doc, pos, source, source_pos)))
        columns = [np.concatenate([a, x[~one].astype(np.int64)]) for a, x in zip(found, (doc, pos, source, source_pos, edges))]
        return pa.table([pa.array(c) for c in columns], PIECE)

    windows = docs.where("text is not null").mapInArrow(cut, "shard long, doc binary, pos binary, h binary, known binary")
    repeated = windows.groupBy("shard").applyInArrow(match, "bucket long, doc binary, pos binary, source binary, source_pos binary, edges binary")
    out = written(repeated.groupBy("bucket").applyInArrow(gather, PIECES), "pieces")
    free_shuffles(spark)
    return out


def _bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def verified(docs: DataFrame, found: DataFrame, edge: int = EDGE) -> DataFrame:
    """The pieces whose words equal those at their source coordinates."""
    places = found.select(F.col("doc").alias("doc_id"), "start", "edges").unionByName(
        found.select(F.col("source").alias("doc_id"), F.col("source_start").alias("start"), "edges")).distinct()
    wanted = places.groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("edges").alias("edges"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for row in batch.to_pylist():
                words = row["text"].encode().split()  # bytes.split cuts at blank and 0x09 to 0x0D
                for start, edges in zip(row["starts"], row["edges"]):
                    text = b" ".join(words[start:start + edges + edge - 1])
                    rows.append((row["doc_id"], start, edges, hashlib.blake2b(text, digest_size=16).digest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int64(), pa.binary()])], ["doc", "start", "edges", "digest"])

    read = only_some(docs, wanted.select("doc_id")).join(wanted, "doc_id").select("doc_id", "text", "starts", "edges") \
        .mapInArrow(digests, "doc long, start long, edges long, digest binary")
    read = written(read, "digests")
    source = read.select(F.col("doc").alias("source"), F.col("start").alias("source_start"), "edges", F.col("digest").alias("source_digest"))
    return found.join(read, ["doc", "start", "edges"]).join(source, ["source", "source_start", "edges"]) \
        .where(F.col("digest") == F.col("source_digest")).select(*PIECE)


def spans(docs: DataFrame, edge: int = EDGE) -> DataFrame:
    """doc_id and the spans of words (from, to; to is after the last) that are repeats, verified, in order."""
    good = verified(docs, written(pieces(docs, edge).distinct(), "paths"), edge)
    return good.groupBy(F.col("doc").alias("doc_id")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("start").alias("from"), (F.col("start") + F.col("edges") + edge - 1).alias("to")))).alias("spans"))


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _kept(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for row in batch.to_pylist():
            words = (row["text"] or "").encode().split()
            kept, end = [], 0
            for span in row.get("spans") or []:
                if span["from"] > end:
                    kept += words[end:span["from"]]
                end = max(end, span["to"])
            kept += words[end:]
            text = b" ".join(kept)
            rows.append((row["doc_id"], len(words), len(words) - len(kept), text.decode() if with_text else hashlib.sha256(text).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int64(), pa.string()])],
                                         ["doc_id", "n_words", "n_removed", "text" if with_text else "kept_sha256"])


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words as text."""
    rows = unique_documents(docs)
    return rows.join(spans(rows), "doc_id", "left").select("doc_id", "text", "spans") \
        .mapInArrow(lambda b: _kept(b, True), RESULT.replace("kept_sha256", "text"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, how many go, and a digest of those that stay."""
    rows = unique_documents(table(spark, sf_dir, "documents"))
    repeats = spans(rows)
    repeats = written(repeats, "spans")
    # Documents without a repeat are judged where they are read; only the others move.
    cut = written(only_some(rows, repeats.select("doc_id")).join(repeats, "doc_id").select("doc_id", "text", "spans").mapInArrow(lambda b: _kept(b, False), RESULT), "cut")
    plain = rows.mapInArrow(lambda b: _kept(b, False), RESULT)
    pick = [F.coalesce(F.col(f"c.{c}"), F.col(f"p.{c}")).alias(c) for c in ("n_words", "n_removed", "kept_sha256")]
    return plain.alias("p").join(cut.alias("c"), "doc_id", "left").select("doc_id", *pick)
