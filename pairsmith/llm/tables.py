"""Reading tables, and the written tables that cut lineage between steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.session import bounded_batches, free_shuffles, shared_folder  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from that table: a lost executor costs no recomputation,
    and what is used twice is computed once."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(df: DataFrame) -> int:
    """Shuffle partitions of the session, at least one per core."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def id_and_text(df: DataFrame) -> DataFrame:
    """The two columns that the operators read, whatever else the table holds."""
    bounded_batches(df.sparkSession)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def unique_documents(df: DataFrame) -> DataFrame:
    """doc_id and text with one row per doc_id; of differing texts the greatest. Rows without an id are left out.

    Texts are moved only if an id does occur more than once.
    """
    rows = id_and_text(df).where("doc_id is not null")
    repeated = rows.select("doc_id").groupBy("doc_id").count().where("count > 1").limit(1).count()
    return rows.groupBy("doc_id").agg(F.max("text").alias("text")) if repeated else rows
