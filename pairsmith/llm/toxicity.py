"""Toxicity by multiple-instance learning: labels stand on documents, scores on sentences.

A sentence ends at ``.``, ``!``, ``?``, a line break, or after ``SENTENCE_WORDS`` words. A document is toxic if at least one
sentence is: with p the score of a sentence, the score of its document is the noisy-or 1 - prod(1 - p). The sentence
model is a logistic one over words, the first 4 to 8 bytes of longer words, and how many marked words (words with a
feature of the model) stand in the sentence and the ``WINDOW`` sentences on either side. It is fitted to the labels
of documents alone, so it learns by itself which sentences of a toxic document are to blame, and locates them.

Fitting: features are those that more toxic documents hold than chance allows (``LEAST_G2`` of a log-likelihood
ratio test). Every round sends each document's gradient through the noisy-or to its sentences, sums it by feature on
Spark, and takes a step whose curvature bound is shared among the features of a sentence. At most about
``TRAIN_DOCS`` labelled documents, drawn by a hash of doc_id, and ``MAX_FEATURES`` features are used; these two bound
what the driver holds and broadcasts. All texts are scored whole.

A null text, an empty one, and one without a word have no sentence: score 0. Repeated rows are judged alike. A
document with several labels is toxic if one of them says so; null labels and labels without a document are left
out, and so are rows without a doc_id when fitting (they are scored). Without toxic or without clean labels nothing
can be told apart: then every sentence has the same score, the share of toxic documents spread over their sentences,
and 0 without any label. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.llm.tables import id_and_text, parts, table, written
from pairsmith.llm.text import PUNCTUATION, Words, mix, slices

TRAIN_DOCS = 20_000
MAX_FEATURES = 1 << 16
MIN_DOCS = 3
LEAST_G2 = 10.83  # one in a thousand by chance
PREFIXES = (4, 5, 6, 7, 8)
SENTENCE_WORDS = 50
WINDOW = 3
STEPS_OF_WINDOW = (2, 3, 5)  # marked words in the window, each step a feature of its own
PRIOR = 0.5
ROUNDS = 40
FLOOR = 0.3

_SEPARATOR = PUNCTUATION.copy()
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLOCK = 1 << 16


class Sentences:
    """Words of a column of texts, and the sentence of each: ``of_word``, the text of each sentence ``text``, and the
    first word of each sentence ``first`` with one entry more at the end."""

    def __init__(self, column: pa.Array):
        self.words = Words(column, lower=True, separator=_SEPARATOR)
        starts = self.words.starts
        text = np.repeat(np.arange(len(self.words)), self.words.counts())
        ends = np.concatenate([[0], np.cumsum(_END[self.words.data])])[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (ends[1:] != ends[:-1]) | (text[1:] != text[:-1])
        run = np.flatnonzero(new)
        place = np.arange(len(starts)) - np.repeat(run, np.diff(np.append(run, len(starts))))
        new |= place % SENTENCE_WORDS == 0
        self.first = np.append(np.flatnonzero(new), len(starts))
        self.of_word, self.text = np.cumsum(new) - 1, text[new]
        self.ends = np.searchsorted(self.text, np.arange(len(self.words) + 1))  # sentences before each text

    def __len__(self) -> int:
        return len(self.text)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (word, feature): the word itself and its first bytes where it is longer than those."""
        w = self.words
        for a in range(0, len(w.starts), _BLOCK):
            starts, ends = w.starts[a:a + _BLOCK], w.ends[a:a + _BLOCK]
            at = np.arange(a, a + len(starts))
            yield at, mix(w.hashes[a:a + _BLOCK])
            head, size = np.zeros(len(starts), np.uint64), ends - starts
            for i in range(max(PREFIXES)):
                byte = _LOWER[w.data[np.minimum(starts + i, ends - 1)]].astype(np.uint64)
                head |= byte << np.uint64(8 * i)
                if i + 1 in PREFIXES:
                    longer = size > i + 1
                    yield at[longer], mix(mix(head[longer]) + np.uint64(i + 1))

    def span(self, sentence: int) -> str:
        w = self.words
        return w.data[w.starts[self.first[sentence]]:w.ends[self.first[sentence + 1] - 1]].tobytes().decode("utf-8", "replace")


@dataclass
class Model:
    """Sorted feature hashes, their weights, the weights of the window's steps, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    bias: float

    def __post_init__(self):
        self.may = np.zeros(1 << 20, bool)
        self.may[self.features & np.uint64(len(self.may) - 1)] = True

    def found(self, s: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, column) once each: columns are features, then the window's steps. Sentences without a feature
        have none."""
        word, column = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        mask = np.uint64(len(self.may) - 1)
        for at, hashes in s.features() if len(self.features) else ():
            some = np.flatnonzero(self.may[hashes & mask])
            place = np.minimum(np.searchsorted(self.features, hashes[some]), len(self.features) - 1)
            same = self.features[place] == hashes[some]
            word.append(at[some[same]])
            column.append(place[same])
        word, column = np.concatenate(word), np.concatenate(column)
        k = len(self.features)
        marked = np.bincount(s.of_word[np.unique(word)], minlength=len(s))
        total = np.concatenate([[0], np.cumsum(marked)])
        own = np.flatnonzero(marked)
        low = np.maximum(own - WINDOW, s.ends[s.text[own]])
        high = np.minimum(own + WINDOW + 1, s.ends[s.text[own] + 1])
        near = total[high] - total[low]
        pairs = [s.of_word[word] * (k + len(STEPS_OF_WINDOW)) + column]
        pairs += [own[near >= n] * (k + len(STEPS_OF_WINDOW)) + k + i for i, n in enumerate(STEPS_OF_WINDOW)]
        return np.divmod(np.unique(np.concatenate(pairs)), k + len(STEPS_OF_WINDOW))

    def sentence_scores(self, s: Sentences) -> np.ndarray:
        sentence, column = self.found(s)
        z = np.full(len(s), self.bias)
        np.add.at(z, sentence, np.concatenate([self.weights, self.steps])[column])
        return _sigmoid(z)

    def document_scores(self, s: Sentences, p: np.ndarray) -> np.ndarray:
        clean = np.bincount(s.text, np.log1p(-np.minimum(p, 1 - 1e-12)), len(s.words))
        return np.round(-np.expm1(clean), 6)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


# --- fitting ---------------------------------------------------------------------------------

def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each feature, how many toxic and how many clean documents hold it; summed up within a task first."""
    empty = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
    held = empty

    def rows(feature, n):
        return pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])], ["feature", "clean", "toxic"])

    for batch in slices(batches):
        s, label = Sentences(batch.column("text")), batch.column("toxic").to_numpy().astype(np.int64)
        feature, text = [held[0]], [np.zeros(0, np.int64)]
        text_of_word = s.text[s.of_word]
        for at, hashes in s.features():
            feature.append(hashes)
            text.append(text_of_word[at])
        own, whose = np.concatenate(feature[1:] or [held[0][:0]]), np.concatenate(text)
        order = np.lexsort((own, whose))
        own, whose = own[order], whose[order]
        once = np.ones(len(own), bool)
        once[1:] = (own[1:] != own[:-1]) | (whose[1:] != whose[:-1])
        both = np.concatenate([held[0], own[once]])
        count = np.concatenate([held[1], np.eye(2, dtype=np.int64)[label[whose[once]]]])
        names, back = np.unique(both, return_inverse=True)
        held = names, np.stack([np.bincount(back, count[:, i], len(names)) for i in (0, 1)], 1).astype(np.int64)
        if len(names) > 1 << 20:
            yield rows(*held)
            held = empty
    yield rows(*held)


def _telling(counts: DataFrame, clean: int, toxic: int) -> np.ndarray:
    """Features that toxic documents hold more often than chance allows, the strongest ``MAX_FEATURES``, sorted."""
    n = clean + toxic
    holds, t, c = F.col("toxic") + F.col("clean"), F.col("toxic"), F.col("clean")

    def part(seen, row, column):
        return F.when(seen > 0, seen * F.log(seen * float(n) / (row * float(column)))).otherwise(0.0)

    g2 = 2 * (part(t, holds, toxic) + part(c, holds, clean) + part(F.lit(toxic) - t, F.lit(n) - holds, toxic) + part(F.lit(clean) - c, F.lit(n) - holds, clean))
    told = counts.where((holds >= MIN_DOCS) & (t * clean > c * toxic)).withColumn("g2", g2).where(F.col("g2") >= LEAST_G2)
    best = told.orderBy(F.desc("g2"), "feature").limit(MAX_FEATURES).select("feature").toArrow()
    return np.sort(best["feature"].to_numpy().view(np.uint64))


def _bags(docs: DataFrame, model: Model) -> DataFrame:
    """Per document its label, its sentences without a feature, and (sentence, column) of the others."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = Sentences(batch.column("text"))
            sentence, column = shared.value.found(s)
            own, place = np.unique(sentence, return_inverse=True)
            plain = np.bincount(s.text, minlength=batch.num_rows) - np.bincount(s.text[own], minlength=batch.num_rows)
            cut = np.searchsorted(s.text[sentence], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(plain.astype(np.int64)), pa.ListArray.from_arrays(pa.array(cut), pa.array(place.astype(np.int64))),
                 pa.ListArray.from_arrays(pa.array(cut), pa.array(column.astype(np.int32)))], ["toxic", "plain", "sentence", "column"])

    return docs.mapInArrow(run, "toxic int, plain long, sentence array<long>, column array<int>")


def _gradients(bags: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed gradient and curvature bound by column; the bias is the last one."""
    bias = len(weights) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, bound = np.zeros(len(weights)), np.zeros(len(weights))
        for batch in batches:
            toxic, plain = batch.column("toxic").to_numpy() == 1, batch.column("plain").to_numpy()
            size = batch.column("column").value_lengths().to_numpy()
            column = batch.column("column").flatten().to_numpy()
            whose = np.repeat(np.arange(batch.num_rows), size)
            sentence = batch.column("sentence").flatten().to_numpy()
            new = np.ones(len(column), bool)
            new[1:] = (sentence[1:] != sentence[:-1]) | (whose[1:] != whose[:-1])
            sentence, text = np.cumsum(new) - 1, whose[new]
            p = _sigmoid(np.bincount(sentence, weights[column], len(text)) + weights[bias])
            p0 = _sigmoid(weights[bias])
            clean = np.bincount(text, np.log1p(-np.minimum(p, 1 - 1e-12)), batch.num_rows) + plain * np.log1p(-p0)
            share = np.where(toxic, np.exp(clean) / np.maximum(-np.expm1(clean), 1e-9), -1.0)
            pull, members = p * share[text], np.bincount(sentence, minlength=len(text)) + 1
            slope += np.bincount(column, pull[sentence], len(weights))
            bound += np.bincount(column, (np.abs(pull) * members)[sentence], len(weights))
            slope[bias] += pull.sum() + (plain * p0 * share).sum()
            bound[bias] += (np.abs(pull) * members).sum() + (plain * p0 * np.abs(share)).sum()
        at = np.flatnonzero(bound)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(slope[at]), pa.array(bound[at])], ["column", "slope", "bound"])

    summed = bags.mapInArrow(run, "column long, slope double, bound double").groupBy("column").agg(F.sum("slope").alias("slope"), F.sum("bound").alias("bound"))
    got = summed.toArrow()  # a row for each column of the model at most
    slope, bound = np.zeros(len(weights)), np.zeros(len(weights))
    slope[got["column"].to_numpy()], bound[got["column"].to_numpy()] = got["slope"].to_numpy(), got["bound"].to_numpy()
    return slope, bound


def fit(labelled: DataFrame) -> Model:
    """Learn from (text, toxic) rows, toxic 0 or 1. The caller bounds their number."""
    steps = len(STEPS_OF_WINDOW)
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(steps), -50.0)
    docs = written(labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")), "labelled")
    seen = {r["toxic"]: r["count"] for r in docs.groupBy("toxic").count().collect()}
    clean, toxic = seen.get(0, 0), seen.get(1, 0)
    if not toxic:
        return nothing
    counts = docs.mapInArrow(_holders, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    features = _telling(counts, clean, toxic) if clean else nothing.features
    model = Model(features, np.zeros(len(features)), np.zeros(steps), 0.0)
    size = min(parts(docs), max(1, (clean + toxic) // 1000))
    bags = written(_bags(docs, model).repartition(size), "bags")
    sentences = bags.agg(F.sum(F.col("plain") + F.size(F.array_distinct("sentence")))).first()[0] or 1
    rate = (toxic + 0.5) / (clean + toxic + 1)
    weights = np.zeros(len(features) + steps + 1)
    weights[-1] = np.log(rate * (clean + toxic) / max(sentences, toxic + 1))
    for _ in range(ROUNDS):
        slope, bound = _gradients(bags, weights)
        prior = np.full(len(weights), PRIOR)
        prior[-1] = 0.0
        step = np.clip((slope - prior * weights) / (bound + prior + 1e-9), -2, 2)
        weights += step
        if np.abs(step).max() < 0.005:
            break
    return Model(features, weights[:len(features)], weights[len(features):-1], float(weights[-1]))


# --- scoring ---------------------------------------------------------------------------------

SCORED = "doc_id long, score double, n_sentences long, offending array<struct<sentence: long, score: double, text: string>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """For every row of ``docs`` its doc_id, score, number of sentences, and the sentences that score ``FLOOR`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES bounds it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            s = Sentences(batch.column("text"))
            p = own.sentence_scores(s)
            blamed = np.flatnonzero(p >= FLOOR)
            cut = np.searchsorted(s.text[blamed], np.arange(batch.num_rows + 1)).astype(np.int32)
            located = pa.StructArray.from_arrays([pa.array(blamed - s.ends[s.text[blamed]]), pa.array(np.round(p[blamed], 6)), pa.array([s.span(b) for b in blamed], pa.string())], ["sentence", "score", "text"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own.document_scores(s, p)), pa.array(np.bincount(s.text, minlength=batch.num_rows).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(cut), located)], ["doc_id", "score", "n_sentences", "offending"])

    return id_and_text(docs).mapInArrow(run, SCORED)


def held_out() -> F.Column:
    """Rows without a doc_id are not held out (and teach nothing)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def documents_model(spark: SparkSession, sf_dir: str) -> Model:
    """The model of the given labels, of documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where("doc_id is not null and toxic is not null").where(~held_out())
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    rate = min(1.0, TRAIN_DOCS / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 20)) < rate * (1 << 20))
    return fit(id_and_text(table(spark, sf_dir, "documents")).join(F.broadcast(drawn), "doc_id").select("text", "toxic"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    found = score(table(spark, sf_dir, "documents"), documents_model(spark, sf_dir))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= FLOOR).cast("int").alias("predicted"),
                        "n_sentences", F.size("offending").cast("long").alias("n_offending"))
