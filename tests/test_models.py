import numpy as np
import pytest
from pyspark.sql import functions as F

import checks.stand_ins  # noqa: F401
from pairsmith.functions import vectors
from pairsmith.operators.model_map import (EmbeddingConfig, GenerationConfig, chat_messages, embed, generate, generate_resumable,
                                           merge_params, register_embedder, register_generator)


def test_registries_refuse_unknown_names(spark):
    df = spark.createDataFrame([(1, "x")], "id long, formatted_prompt string")
    with pytest.raises(ValueError):
        generate(df, GenerationConfig("nobody"))
    with pytest.raises(ValueError):
        embed(df, EmbeddingConfig("nobody"), {"formatted_prompt": "v"})
    with pytest.raises(ValueError):
        embed(df, EmbeddingConfig("hashed_words", pooling_strategy="max"), {"formatted_prompt": "v"})


def test_generation_is_aligned_and_batched(spark):
    def factory(options):
        def model(prompts, params):
            assert len(prompts) <= 3
            return [f"{p[-1]['content']}|{p[0]['role']}|{q['t']}|{q.get('s')}" for p, q in zip(prompts, params)]
        return model

    register_generator("aligned", factory)
    df = spark.range(50).withColumns({
        "formatted_prompt": F.concat(F.lit("p"), F.col("id").cast("string")),
        "own": F.when(F.col("id") % 2 == 0, F.create_map(F.lit("t"), F.lit("9"))),
    })
    config = GenerationConfig("aligned", default_system_prompt="s", default_sampling_params={"t": 1.5, "s": "x"}, batch_size=3, concurrency=4)
    out = generate(df, config, sampling_params="own")
    assert out.columns == [*df.columns, "output"]
    got = {r.id: r.output for r in out.collect()}
    assert got == {i: f"p{i}|system|{9 if i % 2 == 0 else 1.5}|x" for i in range(50)}
    assert generate(df.where("false"), config).count() == 0


def test_wrong_number_of_replies_is_an_error(spark):
    register_generator("short", lambda options: lambda prompts, params: ["x"])
    df = spark.range(5).withColumn("formatted_prompt", F.lit("p")).coalesce(1)
    with pytest.raises(Exception, match="replies"):
        generate(df, GenerationConfig("short", concurrency=1)).collect()


def test_message_and_parameter_columns(spark):
    df = spark.createDataFrame([(1, "u", {"a": "1"}), (2, "v", None)], "id int, text string, own map<string,string>")
    rows = df.select(chat_messages(F.col("text")).alias("m"), chat_messages(F.col("text"), "sys").alias("n"),
                     merge_params(F.col("own"), {"a": 0, "b": "x"}).alias("p"), merge_params(None, {}).alias("e")).collect()
    assert [tuple(x) for x in rows[0].m] == [("user", "u")]
    assert [tuple(x) for x in rows[1].n] == [("system", "sys"), ("user", "v")]
    assert rows[0].p == {"a": "1", "b": '"x"'} and rows[1].p == {"a": "0", "b": '"x"'} and rows[0].e == {}


def test_embedding_pools_and_normalises(spark):
    hidden = np.array([[[1.0, 0], [3, 4], [9, 9]]])

    def factory(options):
        assert options["max_length"] == 7
        return lambda texts: (np.repeat(hidden, len(texts), 0), np.repeat([[1, 1, 0]], len(texts), 0))

    register_embedder("tokens", factory)
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "id long, x string, y string")

    def run(**options):
        config = EmbeddingConfig("tokens", max_length=7, batch_size=1, **options)
        return {r.id: (list(r.v), list(r.w)) for r in embed(df, config, {"x": "v", "y": "w"}, keep=["id"]).collect()}

    assert run(normalize=False)[1] == ([2.0, 2.0], [2.0, 2.0])
    assert run(normalize=False, pooling_strategy="cls")[2] == ([1.0, 0.0], [1.0, 0.0])
    assert np.allclose(run()[2][0], [0.5**0.5] * 2)


def test_vector_columns(spark):
    rows = [(1, [[1.0, 0.0], [3.0, 4.0], [9.0, 9.0]], [1, 1, 0]), (2, [[1.0, 0.0], [3.0, 4.0], [9.0, 9.0]], [0, 1, 1]),
            (3, [[1.0, 1.0]], [0]), (4, [[float("nan"), 1.0], [5.0, 6.0]], [0, 1]), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, t array<array<float>>, m array<int>")
    got = {r.id: r for r in df.select("id", vectors.pool(F.col("t"), F.col("m"), "mean").alias("mean"),
                                      vectors.pool(F.col("t"), F.col("m"), "cls").alias("cls")).collect()}
    assert [got[i].mean for i in (1, 2, 3, 4, 5)] == [[2.0, 2.0], [6.0, 6.5], None, [5.0, 6.0], None]
    assert got[2].cls == [1.0, 0.0] and got[5].cls is None
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(vectors.l2_normalise(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    assert df.select(vectors.truncate_tokens(F.col("v"), 1)).first()[0] == [3.0]


def test_concurrency_leaves_the_partitions_alone(spark):
    from pairsmith.operators.model_map import cores_of_a_task

    register_generator("same", lambda options: lambda prompts, params: ["x"] * len(prompts), chat=False)
    rows = spark.range(100).withColumn("text", F.lit("t")).repartition(23, "id")
    counted = lambda n: generate(rows, GenerationConfig("same", concurrency=n), text="text").rdd.getNumPartitions()
    assert counted(None) == counted(8) == counted(50) == 23 and counted(2) == 2
    # 1,000 executors of 8 cores: 8,000 at once, 4,000, 1,000, and one on each executor at least
    assert [cores_of_a_task(n, 8000, 8) for n in (8000, 4000, 1000, 10)] == [1, 2, 8, 8]
    assert cores_of_a_task(3, 4, 4) == 1 and cores_of_a_task(2, 4, 4) == 2 and cores_of_a_task(1, 4, 4) == 4


def test_a_failed_run_goes_on_where_it_stopped(spark, tmp_path):
    asked, stop, journal = tmp_path / "asked", tmp_path / "stop", str(tmp_path / "journal")
    asked.mkdir()
    stop.write_text("")

    def factory(options):
        import pathlib
        import uuid

        def model(prompts, params):
            if "id 57" in prompts and pathlib.Path(options["stop"]).exists():
                import time
                time.sleep(3)  # others end meanwhile
                raise RuntimeError("out of memory")
            (pathlib.Path(options["asked"]) / uuid.uuid4().hex).write_text("\n".join(prompts))
            return [p.upper() for p in prompts]
        return model

    register_generator("failing", factory, chat=False)
    config = GenerationConfig("failing", {"asked": str(asked), "stop": str(stop)})
    rows = spark.range(200).withColumn("formatted_prompt", F.concat(F.lit("id "), "id"))
    calls = lambda: [line for f in asked.iterdir() for line in f.read_text().split("\n")]
    with pytest.raises(Exception, match="out of memory"):
        generate_resumable(rows, config, journal, pieces=40)
    first = set(calls())
    stop.unlink()
    got = {r.id: r.output for r in generate_resumable(rows, config, journal, pieces=40).collect()}
    assert got == {i: f"ID {i}" for i in range(200)}
    second = calls()
    assert len(first) > 20 and 200 <= len(second) < 200 + 60  # only what was not committed is asked again
    assert generate_resumable(rows, config, journal).count() == 200 and len(calls()) == len(second)


def test_batches_are_bounded_by_bytes(spark):
    """Ten thousand long texts would be too many for a worker at once."""
    register_generator("total", lambda options: lambda prompts, params: [str(sum(map(len, prompts)))] * len(prompts), chat=False)
    rows = spark.range(0, 40, 1, 1).select("id", F.repeat(F.lit("x"), 1 << 20).alias("text"))
    totals = [int(r.output) for r in generate(rows, GenerationConfig("total"), text="text").select("output").collect()]
    assert len(totals) == 40 and max(totals) <= 8 << 20


def test_hashed_words_counts_every_word():
    import hashlib
    from collections import Counter

    import numpy as np

    from checks.stand_ins import DIM, hashed_words

    texts = ["", " ", "a  b", " a", "a ", "\n x\ty", "é ü z", "a b a", "b"]
    expected = np.zeros((len(texts), DIM))
    for i, text in enumerate(texts):
        for word, n in Counter(text.split(" ")).items():
            expected[i, int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % DIM] += n
    assert np.array_equal(hashed_words({})(texts), expected)
