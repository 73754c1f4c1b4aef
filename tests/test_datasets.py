"""All six data types from prompts to final tables, with stand-in models."""

import hashlib
import json

import pytest

import checks.stand_ins  # noqa: F401
from pairsmith.operators.model_map import EmbeddingConfig, GenerationConfig, register_generator
from pairsmith.operators.triples import INSTRUCTIONS, REPLY_KEYS
from pairsmith.plans import datasets


def config_for(folder, data_type, n=40):
    def writer(options):
        """Lists of tasks for brainstorms, and a JSON object with the wanted keys otherwise."""
        def reply(text):
            if "Python list" in text:
                return str([f"task {options['keys'][0]} {i}" for i in range(5)])
            return json.dumps({k: f"{hashlib.md5(text.encode()).hexdigest()[:6]} {k}" for k in options["keys"]})
        return lambda prompts, params: [reply(p[-1]["content"]) for p in prompts]

    register_generator("writer", writer)
    keys = [k for k in REPLY_KEYS[data_type] if k]
    return datasets.DatasetConfig(
        str(folder), GenerationConfig("writer", {"keys": keys}), EmbeddingConfig("hashed_words"), n_brainstorms=3, n_samples=n, top_k=5)


def test_all_types(spark, tmp_path):
    configs = {name: config_for(tmp_path, name) for name in REPLY_KEYS}
    rows = datasets.build_all(spark, configs).collect()
    assert len(rows) == 40 * len(REPLY_KEYS)
    for r in rows:
        if r.data_type in INSTRUCTIONS:
            assert r.instruction == INSTRUCTIONS[r.data_type]
        else:
            assert r.instruction.startswith("task ")
        if r.data_type in datasets.WITH_HARD_NEGATIVES:
            assert r.negative.endswith("positive_document")
        else:
            assert r.negative
    assert sum(r.negative != r.positive for r in rows) > 0.8 * len(rows)  # copies near by may leave only the own positive
    # A second run finds every step complete.
    again = datasets.build(spark, "short_long", config_for(tmp_path, "short_long", n=7)).collect()
    assert len(again) == 40


def test_hard_negatives_need_an_embedder(spark, tmp_path):
    config = config_for(tmp_path, "short_short")
    config.embedding = None
    with pytest.raises(ValueError):
        datasets.build(spark, "short_short", config)
    with pytest.raises(ValueError):
        datasets.build_all(spark, {"other": config})


def test_steps_are_compressed_and_their_scratch_tables_go(spark, tmp_path):
    rows = datasets.build(spark, "short_long", config_for(tmp_path / "steps", "short_long")).collect()
    assert len(rows) == 40
    for step in ("brainstorm", "samples", "triples", "final"):
        parts = [p.name for p in (tmp_path / "steps" / f"short_long_{step}").iterdir() if p.name.startswith("part-")]
        assert parts and all(name.endswith(".json.gz") for name in parts), step


def test_lists_are_sorted_once_for_all_types(spark, tmp_path, monkeypatch):
    """Passages and names of parts are the same for the six types."""
    from checks import queries

    spark.createDataFrame([(i, f"text {i % 7}", "en", "web") for i in range(20)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(f"name {i % 3}",) for i in range(5)], "p_name string").write.parquet(f"{tmp_path}/part.parquet")
    made, original = [], queries.from_table
    monkeypatch.setattr(queries, "from_table", lambda df, column: made.append(column) or original(df, column))
    monkeypatch.setattr(queries.datasets, "build_all", lambda spark, configs: configs)
    configs = queries.dataset_all(spark, str(tmp_path))
    assert sorted(made) == ["p_name", "text"] and list(configs) == list(datasets.RUN_ORDER)
    for name, config in configs.items():
        assert (config.n_brainstorms, config.n_samples, len(config.schema.args["passage"])) == (5, 20, 7)
        assert (config.brainstorm is not None) == (name in datasets.BRAINSTORMED)


def test_triples_are_written_once_before_mining(spark, tmp_path, monkeypatch):
    from checks import queries
    from pairsmith.operators import negatives

    texts = [f"some text with number {i % 9}" for i in range(20)]
    spark.createDataFrame([(i, t, "en", "web") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, f"name {i}", "kind", "brand") for i in range(12)], "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    written = []
    for module in (queries, negatives):
        original = module.materialise
        monkeypatch.setattr(module, "materialise", lambda df, label, original=original: written.append(label) or original(df, label))
    rows = queries.short_long_pairs(spark, str(tmp_path)).collect()
    assert sorted(r.id for r in rows) == list(range(20)) and all(r.positive in texts and r.negative in texts for r in rows)
    assert written.count("triples") == 1


def test_steps_take_a_fast_level_of_gzip(spark, tmp_path):
    """Compressing took longer than what was compressed; the level is above the fastest, and the rows are the same."""
    import gzip

    from pairsmith.sources import files

    rows = spark.createDataFrame([(i, " ".join(hashlib.md5(f"{i} {j % 40}".encode()).hexdigest()[:5] for j in range(200))) for i in range(300)], "id long, text string").coalesce(1)
    files.write_table(rows, str(tmp_path / "steps"), "jsonl", compression="gzip")
    part = next(p for p in (tmp_path / "steps").iterdir() if p.name.endswith(".json.gz"))
    assert len(gzip.compress(gzip.decompress(part.read_bytes()), 6)) < part.stat().st_size
    assert sorted(files.read_jsonl(spark, str(tmp_path / "steps"), rows.schema).collect()) == sorted(rows.collect())
