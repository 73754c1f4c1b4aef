"""Spelling variants: words one edit apart, by a bit-sliced position index.

A block of the vocabulary has, for each (position, letter), a bitset of the words that hold the letter there. A word is
looked up against all words of the block at once: one bitset of those that agree with it so far without an error,
and three of those with one error (a replaced, an inserted or a deleted code point), whose later letters are read at
the same position, one further on and one before. Each letter of the word is a handful of ANDs and ORs of
whole bitsets.

Which words meet in a block: of two words one edit apart, L code points long the shorter one, the halves of L // 2 code
points at their beginning or at their end are equal. So a word stands under its first and its last half, for L = its
own length and for L = its length less one, and words under one half form a block. Blocks of more than ``BLOCK``
words are cut into pieces, and every pair of pieces is a unit of work. A pair with both halves equal counts under the
first one. The result is exact; nothing is dropped, however many words share a half.

A word's form is the near word with the largest count (ties: the smallest in code-point order) if it occurs at least
``RATIO`` times as often; its root is where following forms ends. Counts grow by that factor at every step, so
there is no circle, and a few rounds of doubling reach every root.

``corpus_words``: null texts have no words; a null doc_id reads as an empty one. Texts of any length are read whole, in
bounded pieces. Rows are counted as they come, repeated ones too. An empty table gives no words. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.llm.tables import id_and_text, parts, table, written
from pairsmith.llm.text import slices

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
SLIP = 199           # a run loses a letter where this divides its checksum
BLOCK = 4096         # words on either side of a unit of work
HELD = 300_000       # words that a task sums up before it passes them on

_RUN = re.compile(r"[A-Za-z\u00C0-\u00FF]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_FEW = 1 << 20


# --- the words of a corpus -------------------------------------------------------------------

def _lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def _runs(text: str) -> dict[str, int]:
    """Lower-cased runs of a text and how often each occurs."""
    found: dict[str, int] = {}
    if len(text) <= _FEW:
        for run in _RUN.findall(text):
            found[run] = found.get(run, 0) + 1
    else:
        for match in _RUN.finditer(text):
            found[match[0]] = found.get(match[0], 0) + 1
    out: dict[str, int] = {}
    for run, n in found.items():
        run = _lowered(run)
        out[run] = out.get(run, 0) + n
    return out


def _misspelt(doc_id: int | None, run: str) -> str:
    """The run as it is counted: for one of ``SLIP`` checksums of document and run, a letter is missing."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    return run if h % SLIP else run[:h % len(run)] + run[h % len(run) + 1:]


def corpus_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least ``LEAST_LETTERS`` code points that occur ``LEAST_COUNT`` times or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, n in _runs(text or "").items():
                    if len(word) >= LEAST_LETTERS:  # what is shorter does not get longer
                        word = _misspelt(doc_id, word)
                        held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield rows(held)
                    held = {}
        yield rows(held)

    def rows(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    counted = id_and_text(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LETTERS))


# --- the index -------------------------------------------------------------------------------

class Index:
    """Bitsets over a block of words by (position, letter), by length and by first half."""

    def __init__(self, words: list[str], short: int):
        self.words, self.all = words, (1 << len(words)) - 1
        self.at: dict[tuple[int, str], int] = {}
        self.length: dict[int, int] = {}
        self.head: dict[str, int] = {}
        for i, word in enumerate(words):
            bit = 1 << i
            self.length[len(word)] = self.length.get(len(word), 0) | bit
            head = word[:short // 2]
            self.head[head] = self.head.get(head, 0) | bit
            for place in enumerate(word):
                self.at[place] = self.at.get(place, 0) | bit

    def near(self, word: str) -> tuple[int, int, int]:
        """Words that a replaced, an inserted or a deleted code point leads to from ``word``, as bitsets; the length
        of the words found tells which lengths take part."""
        at, exact = self.at, self.all
        replaced = inserted = deleted = 0
        for i, letter in enumerate(word):
            here = at.get((i, letter), 0)
            inserted = (inserted | exact) & at.get((i + 1, letter), 0)
            deleted = (deleted & at.get((i - 1, letter), 0)) | exact
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
            if not (exact or replaced or inserted or deleted):
                break
        n, length = len(word), self.length
        return replaced & length.get(n, 0), (inserted | exact) & length.get(n + 1, 0), deleted & length.get(n - 1, 0)


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def _look_up(asked: list[tuple[str, int]], block: list[tuple[str, int]], short: int, last: bool) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, count and spelling of the best) of each asked word that has any in the block.

    Of ``short`` and ``short + 1`` code points; two of the longer kind meet under ``short + 1`` instead. Under a last
    half, words whose first halves are equal too have met already.
    """
    index = Index([w for w, _ in block], short)
    for word, _ in asked:
        replaced, inserted, deleted = index.near(word)
        found = replaced | inserted if len(word) == short else deleted
        if found and last:
            found &= ~index.head.get(word[:short // 2], 0)
        if found:
            near = [block[i] for i in _bits(found)]
            best, n = min(near, key=lambda x: (-x[1], x[0]))
            yield word, len(near), n, best


def _halves(words: DataFrame) -> DataFrame:
    """Every word under its halves: (short, last, half, word, n)."""
    short = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1))
    both = words.select("word", "n", short.alias("short"))
    half = F.floor(F.col("short") / 2).cast("int")
    sides = F.explode(F.array(
        F.struct(F.lit(False).alias("last"), F.substring(F.col("word"), F.lit(1), half).alias("half")),
        F.struct(F.lit(True).alias("last"), F.right(F.col("word"), half).alias("half"))))
    return both.select("word", "n", "short", sides.alias("side")).select("short", "side.last", "side.half", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word of (word, n) that has a word one edit away."""
    key = ["short", "last", "half"]
    halves = written(_halves(words), "halves")
    sizes = halves.groupBy(*key).agg(F.count("*").alias("size"), F.count_if(F.char_length("word") == F.col("short")).alias("shorter"))
    # A block without a word of the shorter length, or of a single word, has no pair.
    sizes = sizes.where("size > 1 and shorter > 0").withColumn("pieces", F.ceil(F.col("size") / BLOCK).cast("int")).drop("size", "shorter")
    sizes = written(sizes, "sizes")  # from a table, both sides of the join are shuffled anew, and a half of very many words is split
    rows = halves.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
    every = F.sequence(F.lit(0), F.col("pieces") - 1)
    # A word of a block in one piece travels once, as both sides; else once to each piece as either side.
    as_asked = F.transform(every, lambda p: F.struct(F.col("own").alias("a"), p.alias("b"), (F.col("own") == p).alias("both"), F.lit(True).alias("asks")))
    as_block = F.transform(F.filter(every, lambda p: p != F.col("own")), lambda p: F.struct(p.alias("a"), F.col("own").alias("b"), F.lit(False).alias("both"), F.lit(False).alias("asks")))
    units = rows.select(*key, "word", "n", F.explode(F.concat(as_asked, as_block)).alias("u")).select(*key, "u.a", "u.b", "u.both", "u.asks", "word", "n")
    names = [*key, "a", "b"]
    dealt = units.repartition(parts(words), F.xxhash64(*names)).sortWithinPartitions(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, block, current = [], [], None
        out: list[tuple[str, int, int, str]] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in [*names, "both", "asks", "word", "n"]]
            for *unit, both, asks, word, n in zip(*columns):
                if unit != current:
                    if current:
                        out.extend(_look_up(asked, block, current[0], current[1]))
                    asked, block, current = [], [], unit
                if asks:
                    asked.append((word, n))
                if both or not asks:
                    block.append((word, n))
            if len(out) > 10_000:
                yield rows_of(out)
                out = []
        if current:
            out.extend(_look_up(asked, block, current[0], current[1]))
        if out:
            yield rows_of(out)

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "near", "n", "best"])

    found = dealt.mapInArrow(run, "word string, near long, n long, best string")
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by doubling: each round, a word's root becomes the root of its root."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = after.select("word", "root")
        if not after.where("moved").limit(1).count():
            return now


def variants(words: DataFrame) -> DataFrame:
    """For every word of (word, n), one row a word: word, n, n_near, form, form_n, root."""
    words = written(words, "words")
    joined = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= RATIO * F.col("n")
    known = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
                                  F.when(is_form, F.col("best_n")).alias("form_n")), "near")
    rooted = known.join(_roots(known.where("form is not null")), "word", "left")
    return rooted.withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(corpus_words(table(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")
