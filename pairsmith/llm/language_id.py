"""Language ID with language-bitmask n-gram filters (bit-sliced Bloom filters).

One Bloom filter per language, all of the same shape, are stored side by side: slot i holds a bitmask with bit L
set if the filter of language L has bit i. An n-gram reads its ``PROBES`` slots and the AND of the masks is the
set of all languages whose filter holds it, at once. Per text and language the set bits are counted, the count is
corrected for the filter's false positives, (hits / n - f) / (1 - f) with f = fill ** PROBES, and the language
with the highest corrected share is predicted. Equal shares go to the language with more training texts, then to
the first by name.

N-grams are 3 and 4 code points of a lower-cased word with a blank before and after it, so none spans two words.
A language holds an n-gram if at least ``MIN_TEXTS`` of its training texts do (half of them, or a single one, where it has
few texts), at a rate of at least ``RATIO`` of
the highest rate that any language has.

Training texts are bounded: about ``TEXTS_PER_LANGUAGE`` a language, drawn by a hash of doc_id. Prediction reads
whole texts and nothing but the text.

Null text, or one without a letter: ``und``, score 0. A text with letters but no known n-gram gets the language
with most training texts, score 0. Without labelled texts everything is ``und``. Repeated rows are judged alike;
other columns are ignored. Rows without a doc_id are not held out: they are judged, and are trained on like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.llm.tables import bounded_batches, id_and_text, table
from pairsmith.llm.text import mix, release, slices

TEXTS_PER_LANGUAGE = 2000
MIN_TEXTS = 3
RATIO = 0.1
SLOTS = 1 << 20
PROBES = 3
UND = "und"
SIZES = (3, 4)
CHUNK = 1 << 18  # code points handled at a time

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the text of each, and for each text whether it has a letter."""
    known = _is_letter()
    codes = [_codes(t) if t else np.zeros(0, np.uint32) for t in texts]
    size = np.array([len(c) + 1 for c in codes])
    text = np.repeat(np.arange(len(codes)), size)
    blank = np.zeros(1, np.uint32)
    flat = np.concatenate([blank, *(x for c in codes for x in (c, blank))])
    text = np.concatenate([text[:1], text])
    letter = known[np.minimum(flat, 0x10FFFF)]
    has_letter = np.bincount(text[letter], minlength=len(codes)) > 0
    keep = letter | np.concatenate([[True], letter[:-1]])  # a run of other characters becomes one blank
    flat, letter, text = np.where(letter, flat, 0)[keep].astype(np.uint64), letter[keep], text[keep]
    hashes, whose = [], []
    for n in SIZES:
        m = len(flat) - n + 1
        if m <= 0:
            continue
        inner = np.ones(m, bool)
        for i in range(1, n - 1):
            inner &= letter[i:i + m]
        at = np.flatnonzero(inner)
        h = np.full(len(at), n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x110001) + flat[at + i]
        hashes.append(mix(h))
        whose.append(text[at + 1])
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.concatenate(whose or [np.zeros(0, int)]), has_letter


def _pieces(text: str) -> list[str]:
    """A long text in pieces that end at a blank where there is one."""
    out, a = [], 0
    while len(text) - a > CHUNK:
        b = text.rfind(" ", a + CHUNK // 2, a + CHUNK) + 1 or a + CHUNK
        out.append(text[a:b])
        a = b
    return [*out, text[a:]]


def slots_of(hashes: np.ndarray) -> np.ndarray:
    """The ``PROBES`` slots of every hash, one row per probe."""
    step = (hashes >> np.uint64(40)) | np.uint64(1)
    return np.stack([((hashes + np.uint64(i) * step) % np.uint64(SLOTS)).astype(np.int64) for i in range(PROBES)])


class Model:
    """Language names (by falling number of training texts, then name) and the bit-sliced filters."""

    def __init__(self, names: list[str], masks: np.ndarray):
        self.names, self.masks = names, masks
        fill = [np.mean(self.bit(masks, k)) for k in range(len(names))]
        self.false_rate = np.array(fill) ** PROBES

    @staticmethod
    def bit(masks: np.ndarray, k: int) -> np.ndarray:
        return (masks[..., k // 64] >> np.uint64(k % 64)) & np.uint64(1)

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: n-grams, hits by language, and whether there is a letter."""
        hashes, whose, has_letter = ngrams(texts)
        found = np.full((len(hashes), self.masks.shape[1]), ~np.uint64(0))
        for slot in slots_of(hashes):
            found &= self.masks[slot]
        n = np.bincount(whose, minlength=len(texts))
        hits = np.stack([np.bincount(whose, self.bit(found, k), len(texts)) for k in range(len(self.names))], 1) \
            if self.names else np.zeros((len(texts), 0))
        return n, hits, has_letter

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; long texts and large batches are read in pieces."""
        pieces, whose = [], []
        for i, t in enumerate(texts):
            for piece in _pieces(t) if t else [""]:
                pieces.append(piece)
                whose.append(i)
        n, hits, letter = np.zeros(len(texts)), np.zeros((len(texts), len(self.names))), np.zeros(len(texts), bool)
        a = 0
        while a < len(pieces):
            b, size = a, 0
            while b < len(pieces) and (b == a or size + len(pieces[b]) <= CHUNK):
                size += len(pieces[b])
                b += 1
            got = self.counts(pieces[a:b])
            for total, part in zip((n, hits, letter), got):
                np.add.at(total, whose[a:b], part)
            a = b
        if not self.names:
            return [UND] * len(texts), np.zeros(len(texts))
        share = (hits / np.maximum(n, 1)[:, None] - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
        share = np.clip(share, 0, 1)
        best = share.argmax(1)
        score = np.where(letter, share[np.arange(len(texts)), best], 0.0)
        return [self.names[b] if ok else UND for b, ok in zip(best, letter)], score


def train(labelled: DataFrame) -> Model:
    """Learn from (doc_id, text, lang); rows with a null among text and lang are left out."""
    spark = labelled.sparkSession
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    names = sorted(counts, key=lambda k: (-counts[k], k))
    words = max(1, -(-len(names) // 64))
    masks = np.zeros((SLOTS, words), np.uint64)
    if names:
        bounds = spark.createDataFrame(
            [(n, k, min(1.0, TEXTS_PER_LANGUAGE / counts[n])) for k, n in enumerate(names)], "lang string, k int, rate double")
        drawn = rows.join(F.broadcast(bounds), "lang").where(
            F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 20)) < F.col("rate") * (1 << 20)).select("k", "text")
        grams = drawn.mapInArrow(_texts_with, "k int, gram long, texts long").groupBy("k", "gram").agg(F.sum("texts").alias("texts"))
        taken = {r["k"]: r["count"] for r in drawn.groupBy("k").count().collect()}
        sizes = spark.createDataFrame([(k, v) for k, v in taken.items()], "k int, taken long")
        rated = grams.join(F.broadcast(sizes), "k").withColumn("rate", F.col("texts") / F.col("taken"))
        top = rated.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("k", "rate", "texts", "taken")).alias("all"))
        least = F.greatest(F.lit(1), F.least(F.lit(MIN_TEXTS), F.floor(F.col("e.taken") / 2)))
        held = top.select("gram", "top", F.explode("all").alias("e")).where(
            (F.col("e.rate") >= RATIO * F.col("top")) & (F.col("e.texts") >= least)).select("gram", F.col("e.k").alias("k"))
        slots = held.mapInArrow(_slot_rows, "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
        got = slots.toArrow()  # at most SLOTS rows for every 64 languages
        if got.num_rows:
            masks[got["slot"].to_numpy(), got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    return Model(names, masks)


def _texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each n-gram, how many texts of a language hold it."""
    for batch in slices(batches, limit=CHUNK):
        k = batch.column("k").to_numpy()
        hashes, whose, _ = ngrams(batch.column("text").to_pylist())
        order = np.lexsort((hashes, whose))
        h, w = hashes[order], whose[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        h, lang = h[new], k[w[new]]
        for one in np.unique(k):
            gram, n = np.unique(h[lang == one], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), one, np.int32)), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "gram", "texts"])


def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k = batch.column("k").to_numpy().astype(np.int64)
        slot = slots_of(batch.column("gram").to_numpy().view(np.uint64)).ravel()
        k = np.tile(k, PROBES)
        yield pa.RecordBatch.from_arrays([
            pa.array(slot), pa.array((k // 64).astype(np.int32)),
            pa.array(np.left_shift(np.uint64(1), (k % 64).astype(np.uint64)).view(np.int64))], ["slot", "word", "mask"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs``; only doc_id and text are read."""
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.masks))  # SLOTS x 8 bytes per 64 languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in slices(batches, limit=CHUNK):
            names, score = own.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def tagged(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` as a struct ``row``, with lang_pred and score beside it; whole rows, no join."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.masks))

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        own = Model(*shared.value)
        for some in texts:
            names, score = own.predict(some.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])
        release()

    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    return row.withColumn("found", predict(F.col("row.text"))).select("row", "found.lang_pred", "found.score")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def documents_model(spark: SparkSession, sf_dir: str) -> Model:
    """The model of the given documents, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return train(docs.where(~held_out()).select("doc_id", "text", "lang"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    found = identify(table(spark, sf_dir, "documents"), documents_model(spark, sf_dir))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
