"""Document fingerprints: threshold-scaled sketches of word shingles.

A document's shingles are its runs of five lower-cased words (fewer words: the whole run), hashed to 64 bits. The
sketch keeps every hash in the lowest 1 / ``SCALE`` of the hash range, however many there are, so sketches of very
unequal documents are samples of one and the same kind: they merge by union, and the share of one sketch that lies
in another estimates containment. Only if no hash is low enough does the sketch keep the least one instead, so that
short documents can be told apart; merging keeps such a hash only while there is no other.

A null text is an empty one. A text without words has an empty sketch; two empty sketches have likeness 1, an empty
and another one 0. Rows with the same doc_id and text get the same result; rows with the same doc_id and other texts
are ordered by a hash of the text. An empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.functions.binding import let
from pairsmith.llm.tables import id_and_text, table
from pairsmith.operators.ordering import dense_index

WORDS = 5
SCALE = 8
LIMIT = -(1 << 63) + (1 << 64) // SCALE  # hashes are signed; the lowest 1 / SCALE of them are below


def sketch(text: Column) -> Column:
    """Sorted array of the hashes that ``text`` keeps."""
    words = F.filter(F.split(F.lower(text), "[ \t-\r]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - WORDS), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WORDS)]))
        return F.when(F.size(h) >= WORDS, many).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return let(let(hashes, shingles), _kept)


def _kept(hashes: Column) -> Column:
    low = F.sort_array(F.array_distinct(F.filter(hashes, lambda x: x < LIMIT)))
    return let(low, lambda k: F.when((F.size(k) > 0) | (F.size(hashes) == 0), k).otherwise(F.array(F.array_min(hashes))))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two documents taken together."""
    return let(F.concat(a, b), _kept)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        F.size(F.array_intersect(a, b)).cast("double") / F.size(F.array_union(a, b)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first document's shingles that the second holds; 1 if the first has none."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)).cast("double") / F.size(a))


def printed(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars; of the next document in falling doc_id order: as many first characters as half of this
    text has (``donated``), and ``next_sketch``. After the last comes the first."""
    texts = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    sizes = texts.select("doc_id", "tie", F.char_length("text").cast("long").alias("n_chars")).distinct()
    placed, total = dense_index(sizes, [F.col("doc_id").desc_nulls_last(), F.col("tie").desc()], unique=True)
    wants = placed.select(((F.col("idx") + 1) % max(total, 1)).alias("idx"), F.col("doc_id").alias("to_id"), F.col("tie").alias("to_tie"),
                          F.floor(F.col("n_chars") / 2).cast("int").alias("wanted"))
    gives = placed.select("idx", F.col("doc_id").alias("from_id"), F.col("tie").alias("from_tie")).join(wants, "idx")
    giver = F.col("doc_id").eqNullSafe(F.col("from_id")) & (F.col("tie") == F.col("from_tie"))
    given = texts.join(gives, giver).select(
        "to_id", "to_tie", F.substr("text", F.lit(1), F.col("wanted")).alias("donated"), sketch(F.col("text")).alias("next_sketch")) \
        .groupBy("to_id", "to_tie").agg(F.first("donated").alias("donated"), F.first("next_sketch").alias("next_sketch"))
    taker = F.col("doc_id").eqNullSafe(F.col("to_id")) & (F.col("tie") == F.col("to_tie"))
    return texts.join(given, taker).select("doc_id", "text", F.char_length("text").cast("long").alias("n_chars"), "donated", "next_sketch")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are."""
    pairs = with_next(table(spark, sf_dir, "documents"))
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int")
    edited = pairs.select("doc_id", "n_chars", "text", "next_sketch", F.concat(F.substr("text", F.lit(1), kept), F.col("donated")).alias("edited"))
    made = edited.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                         sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("other"), "next_sketch")
    return made.select("doc_id", "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"), printed(F.col("other")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_sketch")).alias("near_next"))
