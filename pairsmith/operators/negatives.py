"""Hard negatives: for every triple, a near document that is not its own positive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairsmith.functions import random_draw
from pairsmith.functions.template import render_row
from pairsmith.functions.text import is_blank
from pairsmith.operators import neighbours
from pairsmith.operators.model_map import EmbeddingConfig, embed
from pairsmith.operators.ordering import hot_hashes, join_to_unique
from pairsmith.session import materialise


RANGE_ROWS = 1_000_000  # of the ranges of ids that one task walks through, about


@dataclass
class HardNegativeConfig:
    """``avoid_own_positive`` skips the fallback that gives a row its own positive."""

    embedding: EmbeddingConfig | None = None
    top_k: int = 10
    query_template: str = "{query}"
    document_template: str = "{positive}"
    seed: int = 0
    avoid_own_positive: bool = False


def _marks(df: DataFrame) -> list[Column]:
    """``key`` stands for the positive where only equality matters, so that texts are not shuffled."""
    return [F.unhex(F.sha2("positive", 256)).alias("key"), is_blank(F.col("positive")).alias("blank")]


def embed_triples(df: DataFrame, config: HardNegativeConfig) -> DataFrame:
    """``(id, key, blank, query_vector, positive_vector)``, written once.

    A lost executor must not cost model calls. The marks of the positive ride along, which saves a
    join of the vectors with the triples.
    """
    texts = df.select(
        "id", *_marks(df),
        render_row(config.query_template, df.columns).alias("query_text"),
        render_row(config.document_template, df.columns).alias("document_text"),
    )
    both = {"query_text": "query_vector", "document_text": "positive_vector"}
    return materialise(embed(texts, config.embedding, both, keep=["id", "key", "blank"]), "vectors")


def choose(rows: DataFrame, config: HardNegativeConfig) -> DataFrame:
    """Add ``pick`` (id of the row whose positive is the negative) and ``negative_branch``.

    ``rows`` has ``id, key`` (of the own positive) and ``neighbours`` with ``d, key, blank``.
    ``pick`` is null where the cyclic fallback has to decide.
    """
    filled = F.filter("neighbours", lambda n: ~n["blank"])
    others = F.filter(filled, lambda n: n["key"] != F.col("key"))
    # Without another positive near by, what is left beyond rank 1 is the own positive again.
    own = F.filter(filled, lambda n: n["rank"] > 1) if not config.avoid_own_positive else F.slice(filled, 1, 0)
    rows = rows.withColumns({"_others": F.transform(others, lambda n: n["d"]), "_own": F.transform(own, lambda n: n["d"])})
    rows = rows.withColumn("_pool", F.when(F.size("_others") > 0, F.col("_others")).otherwise(F.col("_own")))
    u = random_draw.uniform(config.seed, "negative", F.col("id"))
    return rows.select(
        "id", "key",
        F.get("_pool", F.floor(u * F.size("_pool")).cast("int")).alias("pick"),
        F.when(F.size("_others") > 0, "neighbour").when(F.size("_own") > 0, "own_positive").otherwise("next_row")
        .alias("negative_branch"),
    )


def next_other(rows: DataFrame) -> DataFrame:
    """``(id, pick)``: the next row in cyclic id order whose positive is not blank and not the own one.

    ``rows`` has ``id, key, blank, open``; only open rows are answered. Within a range of ids, the
    answer is the next filled row, or, if that repeats the own positive, the first filled row
    after its run of equal positives. Beyond the range, two rows per range suffice: the first
    filled one and the first that differs from it.
    """
    spark = rows.sparkSession
    # With a set number of ranges, adaptive execution leaves them as they are.
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS)
    ranged = materialise(rows.repartitionByRange(ranges, "id").withColumn("range", F.spark_partition_id()), "ranges")
    after = Window.partitionBy("range").orderBy(F.desc("id")).rowsBetween(Window.unboundedPreceding, -1)
    here = F.struct("id", "key")
    step = ranged.withColumn("next", F.last(F.when(~F.col("blank"), here), ignorenulls=True).over(after))
    turns = ~F.col("blank") & (F.col("next.key") != F.col("key"))
    step = step.withColumn("turn", F.last(F.when(turns, F.col("next")), ignorenulls=True).over(after))

    firsts = ranged.where(~F.col("blank")).groupBy("range").agg(F.min(here).alias("first"))
    differing = (
        ranged.where(~F.col("blank")).join(F.broadcast(firsts), "range")
        .where(F.col("key") != F.col("first.key")).groupBy("range").agg(F.min(here).alias("second"))
    )
    summary = firsts.join(differing, "range", "left").orderBy("range").collect()  # one row per range
    first_of = {r["range"]: tuple(r["first"]) for r in summary}
    second_of = {r["range"]: tuple(r["second"]) for r in summary if r["second"] is not None}
    last_range = ranged.agg(F.max("range")).first()[0] or 0
    # Walk backwards twice around the ring, so that every range sees all that follow it.
    tails, first, second = {}, None, None
    for place in [*range(last_range, -1, -1)] * 2:
        tails[place] = (place, *(first or (None, None)), *(second or (None, None)))
        if place in first_of:
            ahead = second if first and first[1] == first_of[place][1] else first
            first, second = first_of[place], second_of.get(place) or ahead
    kind = dict(rows.dtypes)["key"]
    tail = spark.createDataFrame(list(tails.values()), f"range int, id1 long, key1 {kind}, id2 long, key2 {kind}")

    answer = (
        F.when(F.col("next.key") != F.col("key"), F.col("next.id"))
        .when(F.col("turn").isNotNull(), F.col("turn.id"))
        .when(F.col("key1") != F.col("key"), F.col("id1"))
        .when(F.col("key2") != F.col("key"), F.col("id2"))
    )
    return step.where("open").join(F.broadcast(tail), "range").select("id", answer.alias("pick"))


def pick_negatives(df: DataFrame, vectors: DataFrame, config: HardNegativeConfig) -> DataFrame:
    """``hard_negatives`` with given vectors: ``(id, query_vector, positive_vector)``, at most one row per triple.

    A triple without a vector has no neighbours, and its negative is the next differing row's positive.
    """
    for name, rows in (("triples", df), ("vectors", vectors)):
        if not rows.groupBy("id").count().where("count > 1").isEmpty():
            raise ValueError(f"ids of the {name} repeat")
    if "key" in vectors.columns:
        joined = vectors
    else:
        joined = materialise(df.select("id", *_marks(df)).join(vectors, "id", "left"), "keyed-vectors")
    queries = joined.select(F.col("id").alias("q"), F.col("query_vector").alias("vector"), "key")
    corpus = joined.select(F.col("id").alias("d"), F.col("positive_vector").alias("vector"), "key", "blank")
    near = neighbours.top_k(queries, corpus, config.top_k, payload=["key", "blank"])
    chosen = materialise(choose(near.withColumnRenamed("q", "id"), config), "picks")

    open_rows = chosen.where(F.col("pick").isNull()).select("id", F.lit(True).alias("open"))
    picks = chosen.select("id", "pick", "negative_branch")
    if not open_rows.isEmpty():
        marked = joined.select("id", "key", "blank").join(open_rows, "id", "left").fillna(False, ["open"])
        found = next_other(marked).withColumnRenamed("pick", "found")
        picks = picks.join(found, "id", "left").select(
            "id",
            F.coalesce("pick", "found").alias("pick"),
            F.when(F.col("pick").isNull() & F.col("found").isNull(), "unresolved").otherwise(F.col("negative_branch"))
            .alias("negative_branch"),
        )
    # A popular document may be the pick of very many rows.
    hot = hot_hashes(chosen.where(F.col("pick").isNotNull()).groupBy("pick").count(), ["pick"])
    texts = df.select(F.col("id").alias("pick"), F.col("positive").alias("negative"))
    negatives = join_to_unique(picks, texts, ["pick"], "id", hot).select("id", "negative", "negative_branch")
    rest = df.drop("negative", "negative_branch")
    order = [*df.columns, *[c for c in ("negative", "negative_branch") if c not in df.columns]]
    return rest.join(negatives, "id", "left").select(*order)


def hard_negatives(df: DataFrame, config: HardNegativeConfig) -> DataFrame:
    """Every input row with ``negative`` set and ``negative_branch`` added.

    Branches: ``neighbour`` (drawn from the top k), ``own_positive`` (nothing else was near),
    ``next_row`` (the next differing row by id), ``unresolved`` (no differing positive exists;
    the negative is null). The table needs an ``id``; see ``ordering.with_row_id``.
    """
    df = materialise(df, "triples")  # replies of a model must not be generated anew for each use
    return pick_negatives(df, embed_triples(df, config), config)
