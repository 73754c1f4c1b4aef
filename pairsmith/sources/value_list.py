"""Argument values that live in a file or a table: ``(idx, value)`` rows with a known length."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairsmith.session import materialise


@dataclass
class ValueList:
    """A list of strings too long to inline; ``df`` has columns ``idx bigint, value string`` and, if the list is
    ``weighted``, ``weight decimal``."""

    df: DataFrame
    length: int
    weighted: bool = False

    def __len__(self) -> int:
        return self.length


WEIGHT = "decimal(28,9)"


def from_table(df: DataFrame, column: str, weight: str | None = None) -> ValueList:
    """Distinct values of a column, numbered in sorted order, so that later draws are reproducible.

    ``weight``: a column of weights of at least 0 with up to nine decimals; they need not sum to 1, and those of equal
    values add up. No weight ends up in a plan or on the driver.
    """
    from pairsmith.operators.ordering import dense_index

    rows = df.select(F.col(column).alias("value"), *([F.col(weight).cast(WEIGHT).alias("weight")] if weight else []))
    values = rows.groupBy("value").agg(F.sum("weight").cast(WEIGHT).alias("weight")) if weight else rows.dropDuplicates(["value"])
    numbered, length = dense_index(values, [F.col("value")], label="values", unique=True)
    return ValueList(numbered.select("idx", *values.columns), length, bool(weight))


def _placed(rows: DataFrame) -> DataFrame:
    """Lines with the split they begin in, and their order in it."""
    return rows.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_line"))


def _values(rows: DataFrame, *keep: str) -> DataFrame:
    """The values of pieces of an array, in the order of the rows; booleans read ``True`` and ``False``, as in inline lists."""
    inner = F.regexp_replace(F.regexp_replace("value", r"^\s*[\[,]?\s*", ""), r"\s*[\],]?\s*$", "")
    piece = F.concat(F.lit("["), inner, F.lit("]"))
    texts = F.from_json(piece, "array<string>", {"mode": "FAILFAST"})
    # Only a piece with true or false in it needs its values' kinds.
    kinds = F.when(inner.rlike("true|false"), F.from_json(piece, "array<variant>", {"mode": "FAILFAST"}))
    truth = F.coalesce(F.transform(kinds, lambda v: F.schema_of_variant(v) == "BOOLEAN"), F.array().cast("array<boolean>"))
    items = rows.select(*keep, F.explode(F.arrays_zip(texts.alias("value"), truth.alias("truth"))).alias("_item"))
    value = F.when(F.col("_item.truth"), F.initcap("_item.value")).otherwise(F.col("_item.value"))
    return items.select(*keep, F.coalesce(value, F.lit("None")).alias("value"))


def _before(sizes: DataFrame, amount: str) -> list[tuple]:
    """(file, block, sum of ``amount`` over all splits before); a row a split."""
    out, total = [], 0
    for row in sizes.orderBy("_file", "_block").collect():
        out.append((row["_file"], row["_block"], total))
        total += row[amount]
    return out


def _elements_of_a_line(spark: SparkSession, path: str) -> DataFrame:
    """(idx, value) texts of the elements of an array that stands on one line, read in splits.

    The file is cut at every comma. A comma is inside a string if an odd number of quotes lies before it, escaped ones
    aside: within a split that is a running sum, and over splits the sum of those before. Pieces from one comma
    outside of strings to the next are an element.
    """
    rows = _placed(spark.read.option("lineSep", ",").text(path))
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), r'[^"]', ""))
    rows = materialise(rows.withColumn("_quotes", quotes), "pieces")
    split = ["_file", "_block"]
    before = _before(rows.groupBy(*split).agg(F.sum("_quotes").alias("n")), "n")
    rows = rows.join(spark.createDataFrame(before, "_file string, _block long, _ahead long"), split)
    ahead = Window.partitionBy(*split).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    opens = ((F.coalesce(F.sum("_quotes").over(ahead), F.lit(0)) + F.col("_ahead")) % 2 == 0).cast("int")
    rows = materialise(rows.withColumn("_opens", opens).drop("_ahead"), "pieces")
    before = _before(rows.groupBy(*split).agg(F.sum("_opens").alias("n")), "n")
    rows = rows.join(spark.createDataFrame(before, "_file string, _block long, _ahead long"), split)
    so_far = Window.partitionBy(*split).orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("idx", F.col("_ahead") + F.sum("_opens").over(so_far) - 1)
    parts = F.array_sort(F.collect_list(F.struct("_file", "_block", "_line", "value")))
    return rows.groupBy("idx").agg(F.array_join(F.transform(parts, lambda p: p["value"]), ",").alias("value"))


def read_value_list(spark: SparkSession, path: str) -> ValueList:
    """Read a JSON array of scalars, in order.

    Lines are parsed on their own, which is exact because a JSON string holds no raw line break: each line is a piece of
    the array, with the outer bracket or a separating comma at its ends. An array on one line is cut at its commas, so it is
    split over tasks as well. Values are written once with their place in their split, and where a split begins in
    the list follows from the counts of those before it; nothing is sorted.
    """
    lines, place = _placed(spark.read.text(path)), F.struct("_file", "_block", "_line")
    edges = lines.where(F.trim("value") != "").agg(
        F.count(F.lit(1)).alias("lines"), F.min_by(F.substring(F.ltrim("value"), 1, 1), place).alias("head"),
        F.max_by(F.substring(F.rtrim("value"), -1, 1), place).alias("tail")).first()
    if edges["head"] != "[" or edges["tail"] != "]":
        raise ValueError(f"{path} is not a JSON array")
    if edges["lines"] == 1:
        found = materialise(_values(_elements_of_a_line(spark, path), "idx"), "value-list")
        return ValueList(found, found.count())
    found = materialise(_values(lines, "_file", "_block").withColumn("_place", F.monotonically_increasing_id()), "value-list")
    splits = found.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("first")).orderBy("_file", "_block").collect()  # a row a split
    starts, total = [], 0
    for r in splits:
        starts.append((r["_file"], r["_block"], total - r["first"]))
        total += r["n"]
    begun = spark.createDataFrame(starts, "_file string, _block long, _shift long")
    return ValueList(found.join(begun, ["_file", "_block"]).select((F.col("_place") + F.col("_shift")).alias("idx"), "value"), total)
