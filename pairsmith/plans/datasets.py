"""Whole datasets: brainstorm, generate, collect and hard negatives, with a table per step."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.operators.collect import distinct_ideas
from pairsmith.operators.model_map import EmbeddingConfig, GenerationConfig, generate
from pairsmith.operators.negatives import HardNegativeConfig, hard_negatives
from pairsmith.operators.schema import PromptSchema
from pairsmith.operators.triples import REPLY_KEYS, triples
from pairsmith.plans import presets
from pairsmith.session import free_shuffles, scratch
from pairsmith.sources.files import REPLY_SCHEMA, TRIPLE_SCHEMA, read_jsonl, run_step

BRAINSTORMED = ("short_short", "short_long", "long_short", "long_long")
WITH_HARD_NEGATIVES = ("short_short", "short_long", "long_long")
RUN_ORDER = ("short_short", "short_long", "long_short", "long_long", "sts", "bitext")
COMPRESSION = "gzip"  # of the steps' JSON Lines: a prompt's arguments, the prompt and the reply repeat each other


@dataclass
class DatasetConfig:
    """``brainstorm`` and ``schema`` replace the presets; the collected ideas replace the values of its ``task``."""

    folder: str
    generation: GenerationConfig
    embedding: EmbeddingConfig | None = None
    brainstorm_generation: GenerationConfig | None = None
    n_brainstorms: int = 10_000
    n_samples: int = 10_000
    seed: int = 42
    top_k: int = 10
    overwrite: bool = False
    schema: PromptSchema | None = None
    brainstorm: PromptSchema | None = None


def _with_defaults(model: GenerationConfig, params: dict) -> GenerationConfig:
    """The step's usual sampling parameters and system prompt, where the configuration sets none."""
    prompt = presets.SYSTEM_PROMPT if model.default_system_prompt is None else model.default_system_prompt
    return replace(model, default_sampling_params={**params, **model.default_sampling_params}, default_system_prompt=prompt)


def _replies(spark: SparkSession, schema: PromptSchema, n: int, seed: int, model: GenerationConfig,
             path: str, overwrite: bool) -> DataFrame:
    """Sampled prompts with model replies, as a JSON Lines table."""
    run_step(spark, lambda: generate(schema.sample(spark, n, seed), model), path, "jsonl", overwrite, compression=COMPRESSION)
    free_shuffles(spark)
    return read_jsonl(spark, path, REPLY_SCHEMA)


def build(spark: SparkSession, data_type: str, config: DatasetConfig) -> DataFrame:
    """Run the steps of one data type; steps whose table is complete are skipped.

    Every step ends in a table, so that nothing is generated or embedded twice, whatever fails later. The result is
    read from the last one; the tables that steps wrote on their way go.
    """
    with scratch(spark):
        return _build(spark, data_type, config)


def _build(spark: SparkSession, data_type: str, config: DatasetConfig) -> DataFrame:
    folder = config.folder.rstrip("/")
    at = lambda step: f"{folder}/{data_type}_{step}"
    tasks = None
    if data_type in BRAINSTORMED:
        talk = _replies(spark, config.brainstorm or presets.brainstorm_schema(data_type), config.n_brainstorms,
                        config.seed, _with_defaults(config.brainstorm_generation or config.generation, presets.BRAINSTORM_PARAMS),
                        at("brainstorm"), config.overwrite)
        tasks = at("ideas")
        run_step(spark, lambda: distinct_ideas(talk), tasks, "json", config.overwrite)
    schema = config.schema or presets.schema_for(data_type, tasks)
    if config.schema is not None and tasks is not None:
        schema = replace(config.schema, args={**config.schema.args, "task": tasks})
    replies = _replies(spark, schema, config.n_samples, config.seed,
                       _with_defaults(config.generation, presets.GENERATION_PARAMS), at("samples"), config.overwrite)
    run_step(spark, lambda: triples(replies, data_type), at("triples"), "jsonl", config.overwrite, compression=COMPRESSION)
    result = read_jsonl(spark, at("triples"), TRIPLE_SCHEMA)
    if data_type in WITH_HARD_NEGATIVES:
        if config.embedding is None:
            raise ValueError(f"{data_type} needs an embedding model for its hard negatives")
        mining = HardNegativeConfig(config.embedding, config.top_k, presets.QUERY_TEMPLATE, presets.DOCUMENT_TEMPLATE, config.seed)
        run_step(spark, lambda: hard_negatives(result, mining), at("final"), "jsonl", config.overwrite, compression=COMPRESSION)
        result = read_jsonl(spark, at("final"), TRIPLE_SCHEMA)
    return result


def build_all(spark: SparkSession, configs: dict[str, DatasetConfig]) -> DataFrame:
    """All data types in order, stopping at the first error, as one table with ``data_type``.

    Row n of the k-th type has the id ``n * number of types + k``, so ids stay unique over the types.
    """
    for name in set(configs) - set(REPLY_KEYS):
        raise ValueError(f"unknown data type {name!r}")
    parts = [build(spark, name, configs[name]).withColumn("id", F.col("id") * len(RUN_ORDER) + place)
             for place, name in enumerate(RUN_ORDER) if name in configs]
    return reduce(DataFrame.unionByName, parts)
