"""JSON Lines, JSON array and CSV tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairsmith.functions.binding import let

FORMATS = ("csv", "json", "jsonl")
GZIP_LEVEL = "THREE"  # of Hadoop's codec: less than half the time of its default, files a sixth larger

# Replies as written after generation; ``sample`` is a map because its keys differ by data type.
REPLY_SCHEMA = "id bigint, sample map<string,string>, formatted_prompt string, input string, output string"
TRIPLE_SCHEMA = "id bigint, data_type string, instruction string, query string, positive string, negative string"


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType = REPLY_SCHEMA) -> DataFrame:
    """One JSON object per line; a malformed line is an error. Fields not in the schema are not read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header and quoted line breaks, as written by ``write_table``."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("mode", "FAILFAST")
    # With a null mark that no cell holds, an empty cell is null and a quoted empty one is a text.
    return reader.option("quote", '"').option("escape", '"').option("nullValue", "\u0000").csv(path)


def check_format(output_format: str) -> str:
    if output_format not in FORMATS:
        raise ValueError(f"unknown output format {output_format!r}, expected one of {FORMATS}")
    return output_format


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a finished table or a plain file is there. A directory left by a failed write is not."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return False
    return fs.getFileStatus(target).isFile() or fs.exists(hadoop(path.rstrip("/") + "/_SUCCESS"))


def _flat(df: DataFrame) -> DataFrame:
    """CSV cells hold no nested values; those become JSON texts."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return df.select(*[
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema
    ])


def _element(df: DataFrame) -> Column:
    """A row as JSON: an object, or the bare value of a one-column table."""
    if len(df.columns) > 1:
        return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    text = F.to_json(F.array(df.columns[0]), {"ignoreNullFields": "false"})
    return let(text, lambda t: F.substring(t, F.lit(2), F.length(t) - 2))


def write_json_array(df: DataFrame, path: str, order_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """One JSON array over all part files: joined in name order, they are valid JSON.

    Each row is a line, with the bracket or comma before it, so no task holds the whole list and
    ``read_value_list`` can split it again. Rows are sorted and written once. A row that sorts behind all others is the
    closing bracket. The opening one stands before the first row of the first partition; a range sort leaves that
    partition empty only if there are no rows, since its upper bound is the key of one of them.
    """
    order_by = order_by or [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = df.select(F.lit(False).alias("_end"), _element(df).alias("_element"), *order_by)
    end = df.sparkSession.range(0, 1, 1, 1).select(F.lit(True).alias("_end"), F.lit("").alias("_element"), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order_by])
    order = ["_end", *(order_by or ["_element"])]
    ordered = rows.unionByName(end).orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    before = F.when(F.col("_place") == 0, "[").when(~F.col("_end"), ",").otherwise("")
    ordered.select(F.concat(before, "_element", F.when(F.col("_end"), "]").otherwise("")).alias("value")).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, output_format: str, mode: str = "overwrite",
                order_by: list[str] | None = None, compression: str | None = None) -> None:
    """``compression`` (such as gzip) of JSON Lines; readers tell it by the names of the files."""
    check_format(output_format)
    if output_format == "json":
        write_json_array(df, path, order_by, mode)
        return
    if order_by:
        df = df.orderBy(*order_by)
    if output_format == "jsonl" and [type(f.dataType) for f in df.schema] == [T.VariantType]:
        # A table of JSON values: each line is the value itself.
        df.select(F.to_json(df.columns[0]).alias("value")).write.mode(mode).option("zlib.compress.level", GZIP_LEVEL).text(path, compression)
    elif output_format == "jsonl":
        df.write.mode(mode).option("ignoreNullFields", "false").option("zlib.compress.level", GZIP_LEVEL).json(path, compression=compression)
    else:
        writer = _flat(df).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
        # The writer trims cells unless told otherwise.
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def run_step(spark: SparkSession, build: Callable[[], DataFrame], path: str | None = None,
             output_format: str = "jsonl", overwrite: bool = False, order_by: list[str] | None = None,
             compression: str | None = None) -> DataFrame | None:
    """Build a table and write it, unless a finished target exists and may not be overwritten.

    A skipped step builds no plan and returns None. Without a path the lazy table is returned.
    """
    check_format(output_format)
    if path is None:
        return build()
    if is_complete(spark, path) and not overwrite:
        return None
    result = build()
    write_table(result, path, output_format, order_by=order_by, compression=compression)
    return result
