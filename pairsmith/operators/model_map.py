"""Batch maps through models that the caller supplies: text generation and embedding.

A model is named in a registry and built once per worker process. Rows keep all their columns and their
``id``; nothing depends on row order.

``concurrency`` bounds how many models run at once over the whole cluster. It leaves the partitions as they are: a task that
runs a model asks for as many cores as keep other such tasks off (stage-level scheduling), so other stages use all
cores. A session in one process has no such scheduling; there the table is read in so many longer tasks.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairsmith.functions.kernels import check_pooling, normalise_batch, pool_batch
from pairsmith.session import bounded_batches, exists, spread

# A generator maps prompts and their sampling parameters to replies; a prompt is a list of chat
# messages or a plain text. An embedder maps texts to vectors [n, d], or to token vectors
# [n, tokens, d] with a mask [n, tokens].
Generator = Callable[[list, list[dict]], list[str]]
Embedder = Callable[[list[str]], Any]

_generators: dict[str, tuple[Callable[[dict], Generator], bool]] = {}
_embedders: dict[str, Callable[[dict], Embedder]] = {}


def register_generator(name: str, factory: Callable[[dict], Generator], chat: bool = True) -> None:
    """``factory(options)`` builds the model, once per worker process; ``chat`` models get message lists."""
    _generators[name] = (factory, chat)


def register_embedder(name: str, factory: Callable[[dict], Embedder]) -> None:
    _embedders[name] = factory


def _lookup(registry: dict, name: str, kind: str):
    if name not in registry:
        raise ValueError(f"{kind} {name!r} is not registered, known are {sorted(registry)}")
    return registry[name]


@dataclass
class GenerationConfig:
    model_type: str
    options: dict[str, Any] = field(default_factory=dict)
    default_system_prompt: str | None = None
    default_sampling_params: dict[str, Any] = field(default_factory=dict)
    batch_size: int | None = None
    concurrency: int | None = None


@dataclass
class EmbeddingConfig:
    model_type: str
    options: dict[str, Any] = field(default_factory=dict)
    batch_size: int | None = None
    concurrency: int | None = None
    max_length: int | None = None
    pooling_strategy: str = "mean"
    normalize: bool = True


def merge_params(row: Column | None, defaults: dict[str, Any]) -> Column:
    """Sampling parameters as ``map<string,string>`` of JSON texts; the row's own values win."""
    if defaults:
        items = [F.lit(x) for key, value in defaults.items() for x in (key, json.dumps(value))]
        base = F.create_map(*items)
    else:
        base = F.expr("cast(map() as map<string,string>)")
    if row is None:
        return base
    kept = F.map_filter(base, lambda key, _: ~F.map_contains_key(row, key))
    return F.when(row.isNull(), base).otherwise(F.map_concat(kept, row))


def chat_messages(text: Column, system_prompt: str | None = None) -> Column:
    """``array<struct<role, content>>``: the system message if there is one, then the user's."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user = message("user", text)
    return F.array(user) if system_prompt is None else F.array(message("system", F.lit(system_prompt)), user)


def cores_of_a_task(concurrency: int, cores: int, cores_of_an_executor: int) -> int:
    """Cores that a task has to ask for so that at most ``concurrency`` of them run, or one on each executor."""
    executors = max(1, cores // cores_of_an_executor)
    return cores_of_an_executor // max(1, min(cores_of_an_executor, concurrency // executors))


def _map(df: DataFrame, run: Callable, schema: T.StructType, concurrency: int | None) -> DataFrame:
    bounded_batches(df.sparkSession)
    context = df.sparkSession.sparkContext
    if not concurrency or concurrency >= context.defaultParallelism:
        return df.mapInArrow(run, schema)
    if context.master.split("[")[0] == "local":
        return df.coalesce(concurrency).mapInArrow(run, schema)
    per_executor = int(context.getConf().get("spark.executor.cores", "1")) if not context.master.startswith("local-cluster") else int(context.master.split(",")[1])
    needed = TaskResourceRequests().cpus(cores_of_a_task(concurrency, context.defaultParallelism, per_executor))
    return df.mapInArrow(run, schema, profile=ResourceProfileBuilder().require(needed).build)


def _chunks(length: int, size: int | None) -> Iterator[slice]:
    step = size or max(length, 1)
    return (slice(start, start + step) for start in range(0, length, step))


_loaded: dict[bytes, Any] = {}  # models of this worker process


def _model(key: bytes, factory: Callable[[dict], Any], options: dict) -> Any:
    """The model of a worker process, built by the first task that needs it and kept for later ones."""
    if key not in _loaded:
        _loaded[key] = factory(options)
    return _loaded[key]


def _model_key(factory: Callable[[dict], Any], options: dict) -> bytes:
    """The same for the same factory code and options in all tasks."""
    return hashlib.sha256(cloudpickle.dumps((factory, sorted(options.items(), key=repr)))).digest()


def _text_or_empty(text: str | bytes | None) -> str:
    """Binary input may hold what is no UTF-8; text from Spark can't."""
    return text.decode("utf-8", "replace") if isinstance(text, bytes) else text or ""


def generate(df: DataFrame, config: GenerationConfig, text: str = "formatted_prompt",
             sampling_params: str | None = None, output: str = "output") -> DataFrame:
    """Add the model's reply to every row. An empty table gives an empty table."""
    factory, chat = _lookup(_generators, config.model_type, "generator")
    options, batch_size = config.options, config.batch_size
    key = _model_key(factory, options)
    row_params = F.col(sampling_params) if sampling_params else None
    prompt = chat_messages(F.col(text), config.default_system_prompt) if chat else F.col(text)
    keep = df.columns
    ready = spread(df).select(
        *keep, prompt.alias("_prompt"), merge_params(row_params, config.default_sampling_params).alias("_params")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = _model(key, factory, options)
            prompts = batch.column("_prompt").to_pylist()
            params = [{k: json.loads(v) for k, v in (p or [])} for p in batch.column("_params").to_pylist()]
            replies: list[str] = []
            for part in _chunks(len(prompts), batch_size):
                got = model(prompts[part], params[part])
                if len(got) != len(prompts[part]):
                    raise ValueError(f"the model gave {len(got)} replies to {len(prompts[part])} prompts")
                replies.extend(got)
            columns = [batch.column(name) for name in keep] + [pa.array(replies, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, output])

    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])
    return _map(ready, run, schema, config.concurrency)


def generate_resumable(df: DataFrame, config: GenerationConfig, journal: str, text: str = "formatted_prompt",
                       sampling_params: str | None = None, output: str = "output", pieces: int | None = None) -> DataFrame:
    """``generate`` for a table with a unique ``id``, keeping what is done when it fails.

    The replies of a partition are moved to the folder ``journal`` as soon as its task ends, and stay there if the job
    fails later. A second call with the same journal asks the model for the open ids only, and returns the whole table.
    ``pieces``: the number of partitions, and so how much a failure may lose. The journal must be on a file system with
    renames. A task that is repeated after it has ended may leave rows twice; an id counts once.
    """
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])
    todo = df.join(spark.read.schema(schema).parquet(journal).select("id"), "id", "left_anti").select(*df.columns) if exists(spark, journal) else df
    found = generate(todo.repartition(pieces, "id") if pieces else todo, config, text, sampling_params, output)
    found.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(journal)
    return spark.read.schema(schema).parquet(journal).dropDuplicates(["id"])


def embed(df: DataFrame, config: EmbeddingConfig, texts: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Add a vector column per text column (``{text column: vector column}``), all in one pass.

    Token vectors are pooled by the configured strategy, and vectors are scaled to unit length.
    """
    factory = _lookup(_embedders, config.model_type, "embedder")
    strategy = check_pooling(config.pooling_strategy)
    options = {**config.options, "max_length": config.max_length}
    key = _model_key(factory, options)
    batch_size, normalize = config.batch_size, config.normalize
    keep = df.columns if keep is None else keep
    pairs = list(texts.items())
    ready = spread(df).select(*keep, *[F.col(t).alias(f"_text{i}") for i, (t, _) in enumerate(pairs)])

    def to_vectors(model: Embedder, words: list[str]) -> pa.Array:
        blocks = []
        for part in _chunks(len(words), batch_size):
            got = model(words[part])
            block = pool_batch(got[0], got[1], strategy) if isinstance(got, tuple) else np.asarray(got)
            if len(block) != len(words[part]):
                raise ValueError(f"the model gave {len(block)} vectors for {len(words[part])} texts")
            blocks.append(normalise_batch(block) if normalize else block)
        matrix = np.concatenate(blocks).astype(np.float32)
        offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
        nothing = np.isnan(matrix).all(axis=1) if matrix.shape[1] else np.zeros(len(matrix), bool)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)), mask=pa.array(nothing))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            model = _model(key, factory, options)
            columns = [batch.column(name) for name in keep]
            for i in range(len(pairs)):
                columns.append(to_vectors(model, [_text_or_empty(t) for t in batch.column(f"_text{i}").to_pylist()]))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *[v for _, v in pairs]])

    vector = T.ArrayType(T.FloatType())
    schema = T.StructType([*[df.schema[c] for c in keep], *[T.StructField(v, vector) for _, v in pairs]])
    return _map(ready, run, schema, config.concurrency)
