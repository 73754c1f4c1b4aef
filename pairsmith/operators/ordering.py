"""Dense positions, and joins that stay even when one key holds much of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairsmith.session import materialise

HOT_SHARE = 1000       # a key is hot above 1/1000 of the rows, so at most 1000 keys are hot
HOT_MINIMUM = 100_000  # and never below this many rows
SPREAD = 256           # pieces that a hot key is split into


def dense_index(df: DataFrame, order_by: list[Column], name: str = "idx", label: str = "ordered",
                unique: bool = False) -> tuple[DataFrame, int]:
    """Number rows 0, 1, 2, ... in the given order, without one partition that holds them all.

    Unless the order is ``unique``, rows that tie could fill one range, however many they are. They
    are spread by their place in a table written for that, which stays the same when a task is
    retried. The range-sorted rows are written once with their partition and place in it, so that the
    offsets below fit them for sure. The offsets are one row per partition.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    rows = df
    if not unique:
        rows = materialise(df, label).withColumn("_tie", place)
        order_by = [*order_by, F.col("_tie")]
    placed = rows.orderBy(*order_by).select(
        *df.columns,
        F.shiftright(place, 33).cast("int").alias("_part"),
        place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    placed = materialise(placed, label)
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    offsets, total = [], 0
    for part, count in sizes:
        offsets.append((part, total))
        total += count
    if not offsets:
        return placed.select(*df.columns, F.col("_place").cast("long").alias(name)), 0
    starts = spark.createDataFrame(offsets, "_part int, _start long")
    numbered = placed.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_place")).alias(name)
    )
    return numbered, total


def with_row_id(df: DataFrame) -> DataFrame:
    """Give the rows of a table read from files an ``id``, in the order of the files and their lines."""
    names = df.columns
    if "id" in names:
        raise ValueError("the table has an id already")
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    numbered, _ = dense_index(placed, [F.col("_file"), F.col("_block"), F.col("_line")], name="id", label="row-id", unique=True)
    return numbered.select("id", *names)


def hot_hashes(counts: DataFrame, key: list[str], count_column: str = "count") -> list[int]:
    """Hashes of the keys that hold more than ``1/HOT_SHARE`` of all rows (at most HOT_SHARE of them)."""
    total = counts.agg(F.sum(count_column)).first()[0] or 0
    limit = max(HOT_MINIMUM, total // HOT_SHARE)
    if total <= limit:
        return []
    rows = counts.where(F.col(count_column) > limit).select(F.xxhash64(*key).alias("h")).collect()
    return [r["h"] for r in rows]


def join_to_unique(many: DataFrame, unique: DataFrame, key: list[str], salt_by: str,
                   hot: list[int], how: str = "left") -> DataFrame:
    """Join rows to a table that has one row per key, with the hot keys split over many tasks.

    The few hot keys of ``unique`` are copied ``SPREAD`` times, and the matching rows of ``many``
    pick a copy by ``salt_by``. Other keys are joined as they are.
    """
    if not hot:
        return many.join(unique, key, how)
    is_hot = F.xxhash64(*key).isin(hot)
    salted = many.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(salt_by), F.lit(SPREAD)).cast("int")).otherwise(0)
    )
    copies = unique.withColumn(
        "_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0))))
    )
    return salted.join(copies, [*key, "_salt"], how).drop("_salt")
