"""Exact n-gram Jaccard join with a token-group matrix.

A document's set holds its distinct shingles of ``WORDS`` words (fewer words: the whole run), as 64-bit hashes. Two
documents link when 100 |A n B| >= 75 |A u B|. Every document gets the least doc_id that links lead to.

Linked sets share a token among the first n - ceil(0.75 n) + 1 of each, in any order common to all sets. Tokens that
very many documents share come last in that order, so they seldom bring unlike documents together; which ones these
are changes the work and not the result.

1. Equal sets are one (by a 128-bit digest of the set).
2. First tokens that occur in one set alone are dropped.
3. Similar documents are put into groups: for each token two of its documents lead, the others are compared to them
   where they share enough, and verified links connect them. A group is a component of these links.
4. The matrix holds, for each group, the union of its members' first tokens. A document is a query: the number of its
   first tokens in a group's union bounds its overlap with every member. Only where the bound allows a link is the
   group opened and its members of fitting size compared, with whole sets. This finds every link between groups that
   step 3 missed.

Texts are read again for whole sets. Groups of any size are opened in blocks of ``BLOCK`` queries and as many
members, so no task holds more, and copies or leaders with very many links are spread over tasks.

Words: A-Z are lower-cased, words are runs of other characters than blank and 0x09 to 0x0D. A null text or one
without words has an empty set and is linked with nothing. Rows with one doc_id count as one document (of differing
texts the greatest); rows without a doc_id are left out. An empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairsmith.llm.blocks import deal, joined, only_some, planes, shard_count, unplanes
from pairsmith.llm.components import components
from pairsmith.llm.tables import free_shuffles, table, unique_documents, written
from pairsmith.llm.text import Words, grams, mix, release, slices

WORDS = 5
SHARE = (75, 100)
TOKENS_PER_SHARD = 1_000_000
TOKENS_PER_TASK_STEP = 600_000  # tokens of a task's documents that are looked at together
FREQUENT = 64          # a token is put last from so many documents on, as far as they were seen together
MOST_FREQUENT = 1 << 20  # tokens put last at most (8 MB); others stay in their place, which is as exact
BLOCK = 256
PIECES = 512  # the rows of a set or token that very many documents share are dealt over so many pieces
LEADERS = (0, -1)  # the least and the greatest doc_id of a token's documents lead


def linked(both: np.ndarray, a, b) -> np.ndarray:
    return SHARE[1] * both >= SHARE[0] * (a + b - both)


def token_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words = Words(column, lower=True)
    every, out = grams(words.hashes, WORDS), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(every[a:b - WORDS + 1]))
        else:
            out.append(grams(words.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def _signature(tokens: np.ndarray) -> tuple[int, int]:
    both = np.array([mix(tokens).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64).view(np.int64)
    return int(both[0]), int(both[1])


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and the digest (a, b) of each set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = token_sets(batch.column("text"))
            marks = [_signature(s) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64())], ["doc_id", "n_shingles", "a", "b"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, a long, b long")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """doc_ids and sets of so many documents at a time, of equal sets the one with the least doc_id."""
    best, sets, total = {}, {}, 0
    for batch in slices(batches):
        for doc, tokens in zip(batch.column("doc_id").to_pylist(), token_sets(batch.column("text"))):
            if not len(tokens):
                continue
            key = _signature(tokens)
            if key not in best:
                sets[key] = tokens
                total += len(tokens)
            best[key] = min(best.get(key, doc), doc)
        if total >= TOKENS_PER_TASK_STEP:
            yield np.array(list(best.values())), list(sets.values())
            best, sets, total = {}, {}, 0
    if best:
        yield np.array(list(best.values())), list(sets.values())


def frequent_tokens(docs: DataFrame) -> np.ndarray:
    """Hashes of tokens that many documents share, counted over all documents where several lie in one task's step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _steps(batches):
            token, n = np.unique(np.concatenate(sets), return_counts=True)
            token, n = token[n > 1], n[n > 1]
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

    counted = docs.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    got = counted.orderBy(F.desc("n"), "token").limit(MOST_FREQUENT).select("token").toArrow()
    return np.sort(got["token"].to_numpy().view(np.uint64))


def first_tokens(tokens: np.ndarray, last: np.ndarray) -> np.ndarray:
    """As many of a set's tokens, in the common order, as hold one of every linked set's."""
    n = len(tokens)
    count = n + (-SHARE[0] * n // SHARE[1]) + 1
    if len(last):
        frequent = last[np.minimum(np.searchsorted(last, tokens), len(last) - 1)] == tokens
        if frequent.any():
            tokens = np.concatenate([tokens[~frequent], tokens[frequent]])
    return tokens[:count]


def shared_tokens(docs: DataFrame, last: np.ndarray) -> DataFrame:
    """(token, doc, n) of first tokens that occur in two sets at least; n is the size of the whole set."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = shard_count(size // 24, TOKENS_PER_SHARD).bit_length() - 1
    sent = spark.sparkContext.broadcast(last)  # MOST_FREQUENT x 8 bytes at most

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _steps(batches):
            firsts = [first_tokens(s, sent.value) for s in sets]
            length = [len(f) for f in firsts]
            h, doc, n = np.concatenate(firsts), np.repeat(ids, length), np.repeat([len(s) for s in sets], length).astype(np.uint32)
            order = np.argsort(h, kind="stable")
            s = h[order]
            same = np.zeros(len(s), bool)
            same[1:] = s[1:] == s[:-1]
            again = same.copy()
            again[:-1] |= same[1:]
            known = np.zeros(len(h), bool)
            known[order] = again
            marks = s[again & ~same]  # one entry stands for all that this step knows to be shared
            shard = np.concatenate([h[~known], mix(h[known] ^ mix(doc[known].view(np.uint64))), marks]) >> np.uint64(64 - bits)
            kind = np.concatenate([np.zeros((~known).sum(), np.uint8), np.full(known.sum(), 1, np.uint8), np.full(len(marks), 2, np.uint8)])
            zero = np.zeros(len(marks))
            yield deal(shard.astype(np.int64), {
                "h": np.concatenate([h[~known], h[known], marks]), "doc": np.concatenate([doc[~known], doc[known], zero.astype(np.int64)]),
                "n": np.concatenate([n[~known], n[known], zero.astype(np.uint32)]), "kind": kind})

    def match(group: pa.Table) -> pa.Table:
        h, doc, n, kind = joined(group["h"], np.uint64), joined(group["doc"], np.int64), joined(group["n"], np.uint32), joined(group["kind"], np.uint8)
        _, place, count = np.unique(h[kind != 1], return_inverse=True, return_counts=True)
        keep = kind == 1
        keep[kind != 1] = (count[place] > 1) & (kind[kind != 1] == 0)
        return pa.table([pa.array(h[keep].view(np.int64)), pa.array(doc[keep]), pa.array(n[keep].astype(np.int64))], ["token", "doc", "n"])

    blocks = docs.where("text is not null").mapInArrow(cut, "shard long, h binary, doc binary, n binary, kind binary")
    return blocks.groupBy("shard").applyInArrow(match, "token long, doc long, n long")


def compared(docs: DataFrame, queries: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between the queries (key, doc) and the members (key, doc) of the same key, by whole sets."""
    ids = written(queries.select("doc").unionByName(members.select("doc")).distinct().select(F.col("doc").alias("doc_id")), "wanted")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([planes(s) for s in token_sets(batch.column("text"))], pa.binary())], ["doc", "tokens"])

    sets = written(only_some(docs, ids).join(ids, "doc_id").select("doc_id", "text").mapInArrow(build, "doc long, tokens binary"), "sets")
    sizes = queries.groupBy("key").agg(F.count("*").alias("q")).join(members.groupBy("key").agg(F.count("*").alias("m")), "key") \
        .select("key", F.ceil(F.col("q") / BLOCK).cast("int").alias("q"), F.ceil(F.col("m") / BLOCK).cast("int").alias("m"))
    part = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = queries.join(sizes, "key").select("key", "doc", part("q").alias("qb"), every("m").alias("mb")).withColumn("role", F.lit(0))
    told = members.join(sizes, "key").select("key", "doc", part("m").alias("mb"), every("q").alias("qb")).withColumn("role", F.lit(1))
    rows = asks.select("key", "qb", "mb", "role", "doc").unionByName(told.select("key", "qb", "mb", "role", "doc")).join(sets, "doc")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, stack, flat = None, [], [], None
        for batch in batches:
            a, b = [], []
            names = [batch.column(c).to_pylist() for c in ("key", "qb", "mb", "role", "doc", "tokens")]
            for key, qb, mb, role, doc, tokens in zip(*names):
                if (key, qb, mb) != at:
                    at, ids, stack, flat = (key, qb, mb), [], [], None
                own = unplanes(tokens, np.uint64)
                if role == 0:
                    ids.append(doc)
                    stack.append(own)
                    continue
                if not ids:
                    continue  # no query fell into this block
                if flat is None:
                    flat = np.concatenate(stack)
                    length = np.array([len(s) for s in stack])
                    begin, who = np.cumsum(length) - length, np.array(ids)
                hits = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                both = np.add.reduceat(hits.astype(np.int64), begin)
                good = who[linked(both, length, len(own)) & (who != doc)]
                a += good.tolist()
                b += [doc] * len(good)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        release()

    ordered = rows.repartition("key", "qb", "mb").sortWithinPartitions("key", "qb", "mb", "role")
    return ordered.select("key", "qb", "mb", "role", "doc", "tokens").mapInArrow(compare, "a long, b long")


def with_least(rows: DataFrame, key: list[str], least: dict[str, F.Column], deal_by: str) -> DataFrame:
    """``rows`` with the least value that each expression has among all rows of the same key.

    The rows of a key are dealt over ``PIECES``, each piece gives one row to the search for the least, and the answer
    is joined to the pieces, so a key that a third of all rows hold is no single task.
    """
    dealt = rows.withColumn("_piece", F.pmod(F.xxhash64(deal_by), F.lit(PIECES)).cast("int"))
    pieces = dealt.groupBy(*key, "_piece").agg(*[F.min(c).alias(name) for name, c in least.items()])
    whole = Window.partitionBy(*key)  # PIECES rows at most
    answer = pieces.select(*key, "_piece", *[F.min(name).over(whole).alias(name) for name in least])
    return dealt.join(answer, [*key, "_piece"]).drop("_piece")


def _led(shared: DataFrame) -> DataFrame:
    """(key, doc): documents and the leaders among those that share tokens with them, where they share enough."""
    order = [F.col("doc").bitwiseXOR(F.lit(x)) for x in LEADERS]  # one to one, so the least value tells its document
    leaders = with_least(shared, ["token"], {f"l{k}": o for k, o in enumerate(order)}, "doc")
    who = F.array_distinct(F.array(*[F.col(f"l{k}").bitwiseXOR(F.lit(x)) for k, x in enumerate(LEADERS)]))
    pairs = leaders.select("doc", "n", F.explode(who).alias("key")).where("key <> doc") \
        .groupBy("key", "doc").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    # Sharing a third of the first tokens is a hint to compare; pairs left out here are the matrix's to find.
    return written(pairs.where(F.col("c") * 12 >= F.col("n")).select("key", "doc"), "led")


def _opened(rows: DataFrame) -> DataFrame:
    """(doc, key): queries and the groups other than their own that the bound allows to hold a linked document."""
    matrix = rows.groupBy("token", "g").agg(F.min("n").alias("low"), F.max("n").alias("high")).withColumnRenamed("g", "key")
    least = F.ceil(F.col("n") * SHARE[0] / SHARE[1])
    met = rows.join(matrix, "token").where("g <> key").groupBy("doc", "key").agg(
        F.count("*").alias("c"), F.first("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    # Of two linked sets, let the query be the one whose first tokens end earlier in the order. All of them that the
    # other holds are then among the other's first ones, and at most n - overlap of them are missing there.
    overlap = F.ceil(SHARE[0] * (F.col("n") + F.greatest("low", least)) / sum(SHARE))
    need = F.greatest(F.lit(1), (F.col("n") - least + 1) - F.col("n") + overlap)
    return written(met.where((F.col("c") >= need) & (F.col("high") >= least) & (F.col("low") * SHARE[0] <= F.col("n") * SHARE[1])).select("doc", "key"), "open")


def _shared(docs: DataFrame, named: DataFrame) -> DataFrame:
    found = shared_tokens(docs, frequent_tokens(docs))
    one = named.where("doc_id = rep").select(F.col("doc_id").alias("doc"))
    return written(found.join(one, "doc", "left_semi").select("token", "doc", "n"), "shared")


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and the least doc_id with an equal set."""
    sets = written(signatures(docs), "signatures")
    rep = F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id"))
    return written(with_least(sets, ["a", "b", "n_shingles"], {"rep": F.col("doc_id")}, "doc_id").select("doc_id", "n_shingles", rep.alias("rep")), "classes")


def _grouped(shared: DataFrame, groups: DataFrame) -> DataFrame:
    own = groups.select(F.col("id").alias("doc"), "component")
    return written(shared.join(own, "doc", "left").select("token", "doc", "n", F.coalesce("component", "doc").alias("g")), "grouped")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document. Each step's result is written, and its shuffles go."""
    spark = docs.sparkSession
    docs = unique_documents(docs)
    named = _named(docs)
    shared = _shared(docs, named)
    free_shuffles(spark)
    led = _led(shared)
    free_shuffles(spark)
    inner = written(compared(docs, led.select("key", F.col("key").alias("doc")).distinct(), led), "inner")
    free_shuffles(spark)
    rows = _grouped(shared, components(inner))
    opened = _opened(rows)
    free_shuffles(spark)
    members = rows.select(F.col("g").alias("key"), "doc").distinct().join(opened.select("key").distinct(), "key")
    links = written(inner.unionByName(compared(docs, opened, members)), "outer")
    free_shuffles(spark)
    found = components(links)
    return named.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under the links of its shingle set."""
    return near_duplicates(table(spark, sf_dir, "documents"))
