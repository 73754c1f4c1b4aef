"""Line dedup: repeated windows of three lines are cut from all but their first occurrence.

Lines are what lies between line feeds. Every three consecutive lines of a document are a window, known by a
128-bit hash of the three. Over all documents, the first occurrence of a window is the one with the least
(doc_id, position); the lines that a later occurrence covers are removed. Where an occurrence overlaps the first
one in the same document, the lines of the first stay. Windows are judged on the input, not on what is left.

Null text stays null and has no lines. Documents of fewer than three lines have no window and stay as they are. A
document that loses all its lines stays as a row with empty text. Rows with the same doc_id and text are one
document and get the same result; rows with the same doc_id and other text are documents of their own. Null ids
sort first. An empty table gives an empty one. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairsmith.functions.binding import let
from pairsmith.llm.tables import table

WINDOW = 3
PIECES = 4096  # a window's occurrences are dealt over so many pieces at most, so that a frequent one is no single task


def _keyed(docs: DataFrame) -> DataFrame:
    """The row as a struct, so that no name clashes, and beside it what the operator needs."""
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    return row.select("row", F.col("row.doc_id").cast("long").alias("id"), F.xxhash64("row.text").alias("text_hash"),
                      F.split("row.text", "\n").alias("lines"))


def windows(keyed: DataFrame) -> DataFrame:
    """id, text_hash, pos and the 128-bit hash (a, b) of every window; pos counts lines from 0."""
    rows = keyed.where(F.size("lines") >= WINDOW).select("id", "text_hash", "lines")
    hashed = let(F.col("lines"), lambda lines: F.transform(F.sequence(F.lit(0), F.size(lines) - WINDOW), lambda i: F.struct(
        F.xxhash64(*[F.get(lines, i + k) for k in range(WINDOW)]).alias("a"),
        F.xxhash64(F.lit(WINDOW), *[F.get(lines, i + k) for k in range(WINDOW)]).alias("b"))))
    return rows.select("id", "text_hash", F.posexplode(hashed).alias("pos", "h")).select("id", "text_hash", "pos", "h.a", "h.b")


def covered(keyed: DataFrame) -> DataFrame:
    """id, text_hash and the merged spans (from, to) of lines to remove, in order."""
    own = F.struct("id", "text_hash", "pos")
    every = windows(keyed).withColumn("piece", F.pmod(F.xxhash64("id", "text_hash", "pos"), F.lit(PIECES)).cast("int"))
    # A row for each piece of a window, with the first of all its pieces: at most PIECES rows meet.
    pieces = every.groupBy("a", "b", "piece").agg(F.min(own).alias("least"), F.count("*").alias("n"))
    whole = Window.partitionBy("a", "b")
    first = pieces.select("a", "b", "piece", F.min("least").over(whole).alias("first"), F.sum("n").over(whole).alias("n")) \
        .where("n > 1").select("a", "b", "piece", "first")
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))
    later = every.join(first, ["a", "b", "piece"]).where(~own.eqNullSafe(F.col("first"))).select(
        "id", "text_hash", F.when(same, F.greatest(F.col("pos"), F.col("first.pos") + WINDOW)).otherwise(F.col("pos")).alias("from"),
        (F.col("pos") + WINDOW - 1).alias("to")).where("from <= to")
    order = Window.partitionBy("id", "text_hash").orderBy("from", "to")
    before = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = later.withColumn("begins", F.when(F.col("from") <= before + 1, 0).otherwise(1))
    spans = begins.withColumn("span", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy("id", "text_hash", "span").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    return spans.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"))


def _kept(lines: Column, spans: Column) -> Column:
    """The lines between the spans: one slice before each and one after the last."""
    def piece(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["to"] + 1)
        end = F.when(i == F.size(spans), F.size(lines)).otherwise(F.get(spans, i)["from"])
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), piece))


def marked(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns), lines, kept (lines) and n_removed."""
    keyed = _keyed(docs)
    spans = covered(keyed).select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    joined = keyed.join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    lost = F.aggregate("spans", F.lit(0), lambda n, s: n + s["to"] - s["from"] + 1)
    kept = F.when(F.col("spans").isNull(), F.col("lines")).otherwise(let(F.col("lines"), lambda lines: _kept(lines, F.col("spans"))))
    return joined.select("row", "lines", kept.alias("kept"), F.coalesce(lost, F.lit(0)).alias("n_removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``."""
    text = F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.array_join("kept", "\n"))
    out = marked(docs).select(F.col("row").withField("text", text).alias("row"))
    return out.select("row.*")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many go, and a digest of those that stay, joined by line feeds."""
    return marked(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.col("n_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce(F.array_join("kept", "\n"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, p, lines[p] || chr(10) || lines[p + 1] || chr(10) || lines[p + 2] AS k FROM d, unnest(range(1, len(lines) - 1)) AS u(p)),
f AS (SELECT doc_id, p, first_value(doc_id) OVER x AS fd, first_value(p) OVER x AS fp FROM w WINDOW x AS (PARTITION BY k ORDER BY doc_id, p)),
c AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = fd THEN greatest(p, fp + 3) ELSE p END, p + 3)) AS i FROM f WHERE (doc_id, p) <> (fd, fp)),
l AS (SELECT doc_id, i, lines[i] AS line FROM d, unnest(range(1, len(lines) + 1)) AS u(i)),
k AS (SELECT doc_id, count(*) AS n_kept, sha256(string_agg(line, chr(10) ORDER BY i)) AS s FROM l ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n_kept, 0))::BIGINT AS n_removed, coalesce(s, sha256('')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
