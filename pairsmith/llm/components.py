"""Connected components of a table of links, by large-star and small-star steps on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsmith.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the least id that can be reached.

    A step replaces links by links to least neighbours; they keep the components and end as stars around the least
    ids. Each step's links are written, so a lost executor costs one step. A node of very many links is split by the
    shuffle join, and its minimum is summed up before the shuffle.
    """
    spark = links.sparkSession
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return written(found.unionByName(found.select(F.col("component").alias("id"), "component")).distinct(), "components")
