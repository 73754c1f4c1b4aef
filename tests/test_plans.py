"""The shape of physical plans, and rules for the library's source."""

import pathlib
import re

from pyspark.sql import functions as F

from checks import queries as q
from pairsmith.operators import neighbours
from pairsmith.operators.collect import collect_ideas, collect_json
from pairsmith.operators.triples import triples
from pairsmith.plans import presets

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).parent.parent


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_jobs_over_replies_are_narrow_and_stay_in_the_jvm(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").withColumnsRenamed({"text": "output", "doc_id": "id"})
    for job in (collect_json(df), triples(df, "bitext"), presets.schema_for("bitext").sample(spark, 10, 1)):
        assert "Exchange" not in plan(job) and "Python" not in plan(job)
    ideas = plan(collect_ideas(df))
    assert "Exchange" not in ideas and ideas.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in ideas


def test_only_needed_columns_are_read(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").withColumnsRenamed({"text": "output", "doc_id": "id"})
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(triples(df, "bitext"))).group(1)
    assert {f.split(":")[0] for f in schema.split(",")} == {"doc_id", "text"}


def test_a_filter_on_a_draw_does_not_repeat_the_draws(spark):
    drawn = presets.schema_for("bitext").sample(spark, 10, 1).where("sample.src_lang = sample.tgt_lang")
    assert plan(drawn).count("md5(") <= 6


def test_top_k_limits_groups_early_and_has_no_cross_join(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    queries = df.select(F.col("vec_id").alias("q"), F.col("embedding").alias("vector"))
    corpus = queries.withColumnRenamed("q", "d")
    assert "WindowGroupLimit" in plan(neighbours._distinct_corpus(corpus, 5))
    text = plan(neighbours.top_k(queries, corpus, 5))
    partial = spark.createDataFrame([(1, 2, 0.5)], "q long, d long, score double")
    assert "WindowGroupLimit" in plan(neighbours._best(partial, 5))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_library_never_uses_local_checkpoints_or_cross_joins():
    for path in (ROOT / "pairsmith").rglob("*.py"):
        code = path.read_text()
        for word in ("localCheckpoint", "crossJoin", ".toPandas(", ".rdd"):
            assert word not in code, (path, word)


def test_every_query_has_sql():
    from checks.oracle import oracle_sql

    assert set(oracle_sql()) == set(q.queries())
