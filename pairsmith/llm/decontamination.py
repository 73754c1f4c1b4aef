"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

A document leaks a benchmark item if tiles, stretches of at least ``MIN_MATCH`` words that both share and that overlap
neither in the document nor in the item, cover at least ``THRESHOLD`` of the item's words, wherever they stand and in
whatever order.

Seeds, all runs of MIN_MATCH words of the items, are looked up in every document. The item's words that shared seeds
cover bound what tiles can cover, so only pairs whose bound reaches the threshold are tiled. Tiling looks for matches
of at least s words with rolling hashes of all unmarked stretches of s words, extends them, marks the longest first,
and repeats with smaller s down to MIN_MATCH; a match of more than 2 s words raises s.

Items are handled in blocks of about ``BLOCK_WORDS`` words, each sent to all tasks, and the documents are read once
for each block; so what is sent doesn't grow with the benchmark. Only a single item longer than a block makes a
larger one.

Words are runs of lower-cased letters, digits and non-ASCII characters. A null text has no words. Items of fewer than
MIN_MATCH words never match. Every text of a repeated item_id is searched, and every row of a repeated doc_id; a pair of
ids gets the result of the best coverage. Rows of an equal item are searched once for each item_id. Rows without an id are left out. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.llm.tables import id_and_text, table
from pairsmith.llm.text import PUNCTUATION, Words, grams, owners, rolling, slices

MIN_MATCH = 4
THRESHOLD = 0.6
FIRST_LENGTH = 20
BLOCK_WORDS = 1_000_000
SPELT_OUT = 1 << 18  # (text, seed, item) at a time, or those of one text
RESULT = "doc_id long, item_id long, matched long, item_words long, tiles long"


def words_of(column: pa.Array) -> Words:
    return Words(pc.utf8_lower(pc.fill_null(column, "")), separator=PUNCTUATION)


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Where a stretch of ``size`` words without a marked one begins."""
    total = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(total[size:] == total[:len(total) - size])


def tiles(item: np.ndarray, text: np.ndarray, shortest: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (length, place in item, place in text)."""
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    found, size = [], max(shortest, min(FIRST_LENGTH, len(item)))
    while size >= shortest:
        matches, longest = _matches(item, text, in_item, in_text, size)
        if longest > 2 * size:
            size = longest
            continue
        for length, p, t in sorted(matches, key=lambda m: m[1:]):
            if length == longest and not in_item[p:p + length].any() and not in_text[t:t + length].any():
                in_item[p:p + length] = in_text[t:t + length] = True
                found.append((length, p, t))
        if matches:
            continue  # with the next longest, among them what marked words have left of the others
        if size == shortest:
            break
        size = max(shortest, size // 2)
    return found


def _matches(item, text, in_item, in_text, size) -> tuple[list[tuple[int, int, int]], int]:
    """All maximal matches of at least ``size`` unmarked words, and the length of the longest."""
    if len(item) < size or len(text) < size:
        return [], 0
    a, b = _free(in_item, size), _free(in_text, size)
    ha, hb = rolling(item, size)[a], rolling(text, size)[b]
    order = np.argsort(ha, kind="stable")
    ha, a = ha[order], a[order]
    low, high = np.searchsorted(ha, hb, "left"), np.searchsorted(ha, hb, "right")
    out, longest = [], 0
    for k in np.flatnonzero(high > low):
        t = int(b[k])
        for p in a[low[k]:high[k]].tolist():
            if p and t and item[p - 1] == text[t - 1] and not in_item[p - 1] and not in_text[t - 1]:
                continue  # part of a match that begins earlier
            n = min(len(item) - p, len(text) - t)
            stop = np.flatnonzero((item[p:p + n] != text[t:t + n]) | in_item[p:p + n] | in_text[t:t + n])
            n = int(stop[0]) if len(stop) else n
            if n >= size:
                out.append((n, p, t))
                longest = max(longest, n)
    return out, longest


class Block:
    """Word hashes of some items, and their seeds in order."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, hashes: np.ndarray):
        self.ids, self.first, self.hashes = ids, first, hashes
        at, item = owners(first, MIN_MATCH)
        seed = grams(hashes, MIN_MATCH)[at] if len(at) else np.zeros(0, np.uint64)
        order = np.lexsort((at, seed))
        self.seed, self.item, self.place = seed[order], item[order], (at - first[:-1][item])[order]

    def candidates(self, words: Words) -> list[tuple[int, int]]:
        """(text, item) whose shared seeds cover enough of the item."""
        at, text = owners(words.first, MIN_MATCH)
        if not len(at) or not len(self.seed):
            return []
        h = grams(words.hashes, MIN_MATCH)[at]
        low = np.searchsorted(self.seed, h)
        hit = self.seed[np.minimum(low, len(self.seed) - 1)] == h
        pairs = np.unique(np.stack([text[hit], low[hit]], 1), axis=0)  # a seed counts once for each text
        if not len(pairs):
            return []
        n = np.searchsorted(self.seed, self.seed[pairs[:, 1]], "right") - pairs[:, 1]
        cut = np.append(np.flatnonzero(np.concatenate([[True], pairs[1:, 0] != pairs[:-1, 0]])), len(pairs))
        ahead, out, i = np.concatenate([[0], np.cumsum(n)])[cut], [], 0
        while i + 1 < len(cut):  # a seed of very many items is spelt out for a few texts at a time
            j = max(i + 1, int(np.searchsorted(ahead, ahead[i] + SPELT_OUT, "right")) - 1)
            out += self._covered(pairs[cut[i]:cut[j]], n[cut[i]:cut[j]])
            i = j
        return out

    def _covered(self, pairs: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
        row = np.repeat(np.arange(len(pairs)), n)
        entry = pairs[row, 1] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        who, item, place = pairs[row, 0], self.item[entry], self.place[entry]
        order = np.lexsort((place, item, who))
        who, item, place = who[order], item[order], place[order]
        same = np.zeros(len(who), bool)
        same[:-1] = (who[1:] == who[:-1]) & (item[1:] == item[:-1])
        reach = np.full(len(who), MIN_MATCH)
        reach[:-1][same[:-1]] = np.minimum(MIN_MATCH, np.diff(place)[same[:-1]])
        begin = np.flatnonzero(np.concatenate([[True], ~same[:-1]]))
        covered = np.add.reduceat(reach, begin)
        good = covered >= THRESHOLD * np.diff(self.first)[item[begin]]
        return list(zip(who[begin][good].tolist(), item[begin][good].tolist()))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched and item_words (words), tiles, coverage of all leaked items."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * BLOCK_WORDS)))
    rows = id_and_text(docs).where("doc_id is not null and text is not null")
    found = [_with_block(rows, items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)) for b in range(blocks)]
    best = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("matched") / F.col("item_words"), "matched", "tiles", "item_words")).alias("m"))
    return best.select("doc_id", "item_id", "m.matched", "m.item_words", "m.tiles", (F.col("m.matched") / F.col("m.item_words")).alias("coverage"))


def _with_block(rows: DataFrame, items: DataFrame) -> DataFrame:
    got = items.distinct().orderBy("item_id", "text").toArrow()  # one block, see above
    words = words_of(got["text"])
    shared = rows.sparkSession.sparkContext.broadcast((got["item_id"].to_numpy(), words.first, words.hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(*shared.value)
        for batch in slices(batches):
            words = words_of(batch.column("text"))
            out = []
            for text, item in block.candidates(words):
                own = block.hashes[block.first[item]:block.first[item + 1]]
                laid = tiles(own, words.hashes[words.first[text]:words.first[text + 1]])
                matched = sum(n for n, _, _ in laid)
                if matched >= THRESHOLD * len(own):
                    out.append((batch.column("doc_id")[text].as_py(), int(block.ids[item]), matched, len(own), len(laid)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "item_id", "matched", "item_words", "tiles"])

    return rows.mapInArrow(run, RESULT)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak benchmark items, and which."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
