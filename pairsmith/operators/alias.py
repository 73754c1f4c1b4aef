"""Alias tables for weighted lists of any length, built and used as DataFrames.

Every one of the n slots holds a value, the share of the slot that the value keeps, and the value that has the rest. A draw
picks a slot and a place in it, so it is one join on a uniformly drawn slot: a value that holds a third of all weight is
no hot key.

A value of weight w in a list of total weight W has w * n / W slots' worth. Light values (less than one) lie one after the
other on a line by what they lack, heavy ones by what they have over. A light value is filled up by the heavy one
that lies where the light one begins. A heavy value may so give more than it has: what the last light value it fills
up reaches beyond its end. That much of its own slot goes to the next heavy value. All of it follows from prefix
sums and from what lies last before a point, so it needs neither a loop over the values nor one task that sees them
all: sums go by blocks of ``BLOCK`` places, with a row a block on the driver.

Weights count in whole units of 1e-9, so the table does not depend on the order of sums.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairsmith.operators.ordering import dense_index
from pairsmith.session import materialise

BLOCK = 200_000
EXACT = "decimal(38,0)"


def _before(df: DataFrame, place: str, amounts: list[str]) -> DataFrame:
    """Add ``<amount>_before``: the sum over all rows with a lower ``place`` (0, 1, 2, ...)."""
    spark, block = df.sparkSession, F.floor(F.col(place) / BLOCK)
    df = df.withColumn("_block", block)
    sums = df.groupBy("_block").agg(*[F.sum(a).cast(EXACT).alias(a) for a in amounts]).orderBy("_block").collect()  # a row a block
    offsets, total = [], {a: Decimal(0) for a in amounts}
    for row in sums:
        offsets.append((row["_block"], *total.values()))
        total = {a: total[a] + row[a] for a in amounts}
    fields = ", ".join(["_block long", *[f"_{a} {EXACT}" for a in amounts]])
    ahead = Window.partitionBy("_block").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumns({f"{a}_before": F.coalesce(F.sum(a).over(ahead), F.lit(0)).cast(EXACT) for a in amounts})
    joined = inner.join(F.broadcast(spark.createDataFrame(offsets, fields)), "_block")
    return joined.withColumns({f"{a}_before": (F.col(f"{a}_before") + F.col(f"_{a}")).cast(EXACT) for a in amounts}).drop("_block", *[f"_{a}" for a in amounts])


def _last_before(df: DataFrame, place: str, name: str) -> DataFrame:
    """Fill nulls of ``name`` with the value of the last row before that has one, over all blocks."""
    spark = df.sparkSession
    df = df.withColumn("_block", F.floor(F.col(place) / BLOCK))
    ends = df.where(F.col(name).isNotNull()).groupBy("_block").agg(F.max_by(name, place).alias("end")).orderBy("_block")
    kind, carried, rows = df.schema[name].dataType, None, {r["_block"]: r["end"] for r in ends.collect()}  # a row a block
    blocks = (df.agg(F.max("_block")).first()[0] or 0) + 1
    carry = []
    for b in range(blocks):
        carry.append((b, carried))
        carried = rows.get(b, carried)
    starts = spark.createDataFrame(carry, T.StructType([T.StructField("_block", T.LongType()), T.StructField("_carried", kind)]))
    seen = F.last(name, ignorenulls=True).over(Window.partitionBy("_block").orderBy(place).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, seen).join(F.broadcast(starts), "_block").withColumn(name, F.coalesce(name, "_carried")).drop("_block", "_carried")


def alias_table(values: DataFrame, length: int) -> DataFrame:
    """(slot, value, keeps, other, other_value) of a list (idx, value, weight) of ``length`` rows, written once.

    A draw at ``place`` in [0, 1) of a slot is ``value`` if place < ``keeps``, else ``other_value``.
    """
    weight = F.col("weight").cast("decimal(28,9)")
    units = (F.floor(weight).cast("decimal(19,0)") * F.lit(10**9) + ((weight - F.floor(weight)).cast("decimal(10,9)") * F.lit(10**9)).cast("decimal(10,0)")).cast("decimal(28,0)")
    values = values.withColumn("weight", units)
    total = values.agg(F.sum("weight").cast(EXACT)).first()[0]
    if not total or values.where("weight is null or weight < 0").limit(1).count():
        raise ValueError("the weights of a list must be at least 0, and not all of them 0")
    full = F.lit(total)
    own = (F.col("weight") * F.lit(length)).cast(EXACT)
    over = (own - full).cast(EXACT)
    parted = values.withColumns({"lacks": F.greatest(-over, F.lit(0)).cast(EXACT), "has": F.greatest(over, F.lit(0)).cast(EXACT)})
    placed = materialise(_before(parted, "idx", ["lacks", "has"]), "alias-places")
    light, heavy = placed.where("lacks > 0"), placed.where("has > 0")
    here = F.struct("idx", "value")
    nothing, unknown = F.lit(None).cast(EXACT), F.lit(None).cast(placed.select(here.alias("h")).schema["h"].dataType)

    def events(rows: DataFrame, at: Column, kind: int, heavy_here: Column, reach: Column) -> DataFrame:
        return rows.select(at.alias("at"), F.lit(kind).alias("kind"), "idx", heavy_here.alias("heavy"), reach.alias("reach"))

    # At one point: where a heavy value begins, then the end of the one before, then where a light value begins.
    line = events(heavy, F.col("has_before"), 0, here, nothing) \
        .unionByName(events(heavy, (F.col("has_before") + F.col("has")).cast(EXACT), 1, unknown, nothing)) \
        .unionByName(events(light, F.col("lacks_before"), 2, unknown, (F.col("lacks_before") + F.col("lacks")).cast(EXACT)))
    ordered, count = dense_index(line, [F.col("at"), F.col("kind"), F.col("idx")], name="_place", label="alias-line", unique=True)
    plain = values.select(F.col("idx").alias("slot"), "value")
    if not count:  # all weights are equal
        return plain.select("slot", "value", F.lit(1.0).alias("keeps"), F.col("slot").alias("other"), F.col("value").alias("other_value"))
    filled = _last_before(_last_before(ordered, "_place", "heavy"), "_place", "reach")
    beyond = F.greatest((F.coalesce("reach", "at") - F.col("at")).cast(EXACT), F.lit(0))
    ends = filled.where("kind = 1").select("idx", F.when(beyond > 0, F.col("heavy")).alias("next"), (1 - beyond.cast("double") / full.cast("double")).alias("keeps"))
    starts = filled.where("kind = 2").select("idx", F.col("heavy").alias("next"), F.lit(None).cast("double").alias("keeps"))
    share = own.cast("double") / full.cast("double")
    joined = values.join(ends.unionByName(starts), "idx", "left").select(
        F.col("idx").alias("slot"), "value", F.when(F.col("next").isNull(), 1.0).otherwise(F.coalesce("keeps", share)).alias("keeps"),
        F.coalesce("next.idx", "idx").alias("other"), F.coalesce("next.value", "value").alias("other_value"))
    return materialise(joined, "alias")
