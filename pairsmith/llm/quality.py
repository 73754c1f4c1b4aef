"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's tokens are characters (white space runs become one blank; ORDER - 1 start marks stand before a text), so
its n-grams saturate as the corpus grows. Spark counts the n-grams of all trusted documents that train, and derives
continuation counts, the three discounts of each order, context weights and interpolated probabilities by joins of
the count tables: p(w | context) = max(c - D(c), 0) / c(context) + weight(context) p(w | shorter context), with counts
of distinct left neighbours below the highest order, down to a uniform distribution.

Scoring joins the characters of every whole document with the model in shards. All entries that one character needs
share the character before it, which picks the shard, so a shard's part of a document's log-probability is complete
in itself and parts add up. A character that stands before very many entries is split by the one before it; its few
shorter entries go to every shard. A shard has about ``SHARD_ENTRIES`` entries and is a folder of files that each
worker process reads for itself, so the model never passes through the driver; the documents are read once for each
shard, and a small model is one shard.

One in five trusted documents doesn't train. The ``QUANTILE`` of their perplexities, by language (null is a language
of its own), is the threshold that documents of the language have to keep to.

Null text or one without characters other than white space has no perplexity and is not kept. A language without
held-out trusted documents has no threshold, and keeps all. Repeated rows are judged alike, and each
comes back, by one shard as by many. Empty tables give an empty
one; without trusted text every character has the same probability. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.llm.blocks import only_some
from pairsmith.llm.tables import bounded_batches, new_path, table, written
from pairsmith.llm.text import mix, slices

ORDER = 5
QUANTILE = 0.99
SHARD_ENTRIES = 2_000_000
STEP_BYTES = 1 << 19
START = "\x00"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def codes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each text after ORDER - 1 start marks, and where each text begins (and the last ends)."""
    pad = START * (ORDER - 1)
    clean = [pad + " ".join((t or "").replace(START, " ").split()) for t in texts]
    codes = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return codes, np.concatenate([[0], np.cumsum([len(c) for c in clean])])


def hashes(codes: np.ndarray, order: int, at: np.ndarray) -> np.ndarray:
    """Hash of the ``order`` characters that end at each position of ``at``."""
    out = np.full(len(at), order, np.uint64)
    for i in range(order):
        out = (out + codes[at - order + 1 + i] + np.uint64(1)) * FACTOR
        out ^= out >> np.uint64(29)
    return mix(out)


def _scored(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that are characters of a text, and the text of each."""
    n = np.diff(first) - (ORDER - 1)
    text = np.repeat(np.arange(len(n)), n)
    ahead = np.cumsum(n) - n
    return np.arange(len(text)) - ahead[text] + first[:-1][text] + ORDER - 1, text


def counts(docs: DataFrame) -> DataFrame:
    """gram (ORDER characters) and how often it occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=STEP_BYTES):
            codes, first = codes_of(batch.column("text").to_pylist())
            at, _ = _scored(first)
            if len(at):
                _, where, n = np.unique(hashes(codes, ORDER, at), return_index=True, return_counts=True)
                ends, text = at[where], codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                grams = [text[e - ORDER + 1:e + 1] for e in ends.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([g.encode("utf-8", "replace").decode() for g in grams]), pa.array(n.astype(np.int64))], ["gram", "c"])

    return docs.where("text is not null").mapInArrow(run, "gram string, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(level: DataFrame) -> tuple[float, float, float]:
    n = [float(x or 0) for x in level.agg(*[F.sum((F.col("c") == i).cast("int")) for i in (1, 2, 3, 4)]).first()]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    return tuple(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), i) if n[i - 1] else 0.5 * i for i in (1, 2, 3))


def model(docs: DataFrame) -> DataFrame:
    """Entries (kind, level, gram, value): kind 0 is the log-probability of a gram's last character, 1 the log weight
    of a context."""
    levels = [written(counts(docs), "grams")]
    for k in range(ORDER - 1, 0, -1):
        longer = levels[0]
        levels.insert(0, written(longer.select(F.substring("gram", 2, k).alias("gram")).groupBy("gram").agg(F.count("*").alias("c")), "grams"))
    letters = levels[0].count() + 1
    lower, entries = None, []
    for k, level in enumerate(levels, 1):
        d1, d2, d3 = _discounts(level)
        taken = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        split = level.select("gram", "c", taken.alias("d"), F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("rest"))
        contexts = split.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("weight"))
        rated = split.join(contexts, "context")
        if k == 1:
            p = rated.select("gram", ((F.col("c") - F.col("d")) / F.col("total") + F.col("weight") / letters).alias("p"))
        else:
            p = rated.join(lower.select(F.col("gram").alias("rest"), F.col("p").alias("q")), "rest") \
                .select("gram", ((F.col("c") - F.col("d")) / F.col("total") + F.col("weight") * F.col("q")).alias("p"))
        lower = written(p, "probabilities")
        entries.append(lower.select(F.lit(0).alias("kind"), F.lit(k).alias("level"), "gram", F.log("p").alias("value")))
        entries.append(contexts.select(F.lit(1).alias("kind"), F.lit(k).alias("level"), F.col("context").alias("gram"), F.log("weight").alias("value")))
    rest = reduce(DataFrame.unionByName, entries)
    unseen = rest.sparkSession.createDataFrame([(2, 0, "", -float(np.log(letters)))], "kind int, level int, gram string, value double")
    return written(rest.unionByName(unseen), "model")


HASHED = "kind int, level int, h long, before long, earlier long, value double"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each entry's gram, and the two characters before the predicted one, -1 where the gram has none."""
    for batch in batches:
        level, kind = batch.column("level").to_numpy(), batch.column("kind").to_numpy()
        h, before = np.zeros(len(level), np.uint64), np.full(len(level), -1, np.int64)
        earlier = before.copy()
        grams = batch.column("gram").to_pylist()
        size = np.array([len(g) for g in grams])
        for n in np.unique(size[size > 0]):
            rows = np.flatnonzero(size == n)
            codes = np.frombuffer("".join(grams[i] for i in rows).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            ends = np.arange(1, len(rows) + 1) * n - 1
            h[rows] = hashes(codes, int(n), ends)
            place = ends - (kind[rows] == 0)
            for column, at in ((before, place), (earlier, place - 1)):
                inside = at >= ends - n + 1
                column[rows[inside]] = codes[at[inside]].astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("level"), pa.array(h.view(np.int64)), pa.array(before), pa.array(earlier), batch.column("value")], ["kind", "level", "h", "before", "earlier", "value"])


class Lookup:
    """Values by hash. The hashes are in order, and their first bits tell where to begin to look; as hashes are spread
    evenly, that is a step or two before the place."""

    def __init__(self, h: np.ndarray, value: np.ndarray):
        order = np.argsort(h)
        self.size, bits = len(h), max(1, len(h).bit_length())
        self.known, self.value = np.append(h[order], ~np.uint64(0)), np.append(value[order], 0.0)  # the last entry ends each search
        self.shift = np.uint64(64 - bits)
        firsts = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.begin = np.searchsorted(h[order], firsts).astype(np.int32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is known, and its value."""
        i = self.begin[h >> self.shift]
        rest = np.flatnonzero(self.known[i] < h)
        while len(rest):
            i[rest] += 1
            rest = rest[self.known[i[rest]] < h[rest]]
        return (self.known[i] == h) & (i < self.size), self.value[i]


class Shard:
    """The entries of a shard, by kind and level."""

    def __init__(self, entries: pa.Table):
        kind, level = entries["kind"].to_numpy(), entries["level"].to_numpy()
        h, value = entries["h"].to_numpy().view(np.uint64), entries["value"].to_numpy()
        self.of = {}
        for key in [(0, k) for k in range(1, ORDER + 1)] + [(1, k) for k in range(1, ORDER + 1)]:
            rows = np.flatnonzero((kind == key[0]) & (level == key[1]))
            self.of[key] = Lookup(h[rows], value[rows])
        self.uniform = float(value[kind == 2][0])

    def find(self, kind: int, level: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.of[kind, level].find(h)

    def log_probability(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(at)), np.arange(len(at))
        for k in range(ORDER, 0, -1):
            seen, value = self.find(0, k, hashes(codes, k, at[left]))
            out[left[seen]] += value[seen]
            left = left[~seen]
            if k > 1:
                known, weight = self.find(1, k, hashes(codes, k - 1, at[left] - 1))
                out[left[known]] += weight[known]
            else:  # an unknown character
                weight = self.of[1, 1]
                out[left] += self.uniform + (weight.value[0] if weight.size else 0.0)
        return out


def perplexities(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """doc_id, lang, characters and perplexity of every row."""
    hashed = written(entries.mapInArrow(_hashed, HASHED), "hashed")
    shards = max(1, -(-hashed.count() // SHARD_ENTRIES))
    # Characters before a quarter of a shard or more, so at most four for each shard.
    wide = [r["before"] for r in hashed.where("before >= 0").groupBy("before").count().where(F.col("count") * 4 > SHARD_ENTRIES).collect()] if shards > 1 else []
    folder = _sharded(hashed, shards, wide)
    parts = [_part(docs, folder, s, shards, wide) for s in range(shards)]
    if shards == 1:
        total = parts[0]
    else:
        # Every shard tells each row once, so a group of k equal rows has k x shards parts and comes back as k rows;
        # rows of one id with other texts differ in their mark.
        sums = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "lang", "mark").agg(
            F.sum("n").alias("n"), F.sum("logp").alias("logp"), F.expr(f"count(*) div {shards}").alias("rows"))
        total = sums.select("doc_id", "lang", "mark", F.expr("n div rows").alias("n"), (F.col("logp") / F.col("rows")).alias("logp"),
                            F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row"))
    return total.select("doc_id", "lang", "mark", F.col("n").alias("characters"), F.when(F.col("n") > 0, F.exp(-F.col("logp") / F.col("n"))).alias("perplexity"))


def _sharded(hashed: DataFrame, shards: int, wide: list[int]) -> str:
    """Write the entries of each shard to a folder of its own, and return the folder of all."""
    folder = new_path(hashed.sparkSession, "shards")
    split = F.col("before").isin(wide) if wide else F.lit(False)
    own = F.pmod(F.col("before") + F.when(split, F.col("earlier")).otherwise(0), F.lit(shards))
    # Of level 1, the uniform distribution and the bigrams of split characters: at most one for each pair of the latter.
    every = (F.col("before") < 0) | (split & (F.col("earlier") < 0))
    to = F.when(every, F.sequence(F.lit(0), F.lit(shards - 1))).otherwise(F.array(own.cast("int")))
    placed = hashed.select("kind", "level", "h", "value", F.explode(to).alias("shard"))
    placed.repartition(shards, "shard").write.partitionBy("shard").parquet(folder)
    return folder


_kept: dict[tuple[str, int], Shard] = {}  # the shard that this worker process read last


def _shard(folder: str, shard: int) -> Shard:
    from pyarrow import dataset, fs

    if (folder, shard) not in _kept:
        _kept.clear()
        files, root = fs.FileSystem.from_uri(folder)
        _kept[folder, shard] = Shard(dataset.dataset(f"{root}/shard={shard}", filesystem=files, format="parquet").to_table())
    return _kept[folder, shard]


def _part(docs: DataFrame, folder: str, shard: int, shards: int, wide: list[int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _shard(folder, shard)
        for batch in slices(batches, limit=STEP_BYTES):
            codes, first = codes_of(batch.column("text").to_pylist())
            at, text = _scored(first)
            if shards > 1:
                key = codes[at - 1] + np.where(np.isin(codes[at - 1], np.array(wide, np.uint64)), codes[at - 2], np.uint64(0))
                mine = key % np.uint64(shards) == shard
                at, text = at[mine], text[mine]
            logp = np.bincount(text, own.log_probability(codes, at), batch.num_rows).astype(float)
            n = np.bincount(text, minlength=batch.num_rows)
            mark = [hashlib.blake2b((t or "").encode("utf-8", "replace"), digest_size=16).digest() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(mark, pa.binary()), pa.array(n.astype(np.int64)), pa.array(logp)], ["doc_id", "lang", "mark", "n", "logp"])

    return docs.select("doc_id", "text", "lang").mapInArrow(run, "doc_id long, lang string, mark binary, n long, logp double")


def trusted_part() -> F.Column:
    """0 for the fifth of the trusted documents that doesn't train."""
    return F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(5))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, perplexity, threshold, keep of every document. Trusted are those labelled with quality 1."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    trusted = written(labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "trusted")
    training = trusted.where(trusted_part() != 0)
    entries = model(only_some(rows, training).join(training, "doc_id").select("doc_id", "text"))
    scored = written(perplexities(rows, entries), "perplexities")
    held_out = scored.join(trusted.where(trusted_part() == 0), "doc_id", "left_semi")
    limits = held_out.groupBy(F.col("lang").alias("of")).agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    return scored.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "lang", "perplexity", "threshold",
        (F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))).alias("keep"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document, and whether it keeps to its language's threshold."""
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
