"""One query per operator, over whole test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import checks.stand_ins  # noqa: F401
from pairsmith.functions import vectors
from pairsmith.functions.template import render_row
from pairsmith.operators import approximate, neighbours
from pairsmith.operators.collect import collect_ideas, collect_json, distinct_ideas, read_list
from pairsmith.operators.model_map import (EmbeddingConfig, GenerationConfig, chat_messages, embed, generate,
                                           generate_resumable, merge_params)
from pairsmith.operators.negatives import HardNegativeConfig, hard_negatives, pick_negatives
from pairsmith.operators.ordering import dense_index
from pairsmith.operators.sampling import constraint_filter, draw_indices, draw_values
from pairsmith.operators.schema import PromptSchema
from pairsmith.operators.triples import REPLY_KEYS, derive_instruction, judge, rejected, triples
from pairsmith.plans import datasets, presets
from pairsmith.session import materialise, shared_folder, spread
from pairsmith.sources.files import read_csv, read_jsonl, run_step, write_json_array
from pairsmith.sources.value_list import from_table, read_value_list

SEED = 42
FENCE = "`" * 3
WORDS = EmbeddingConfig("hashed_words")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def new_path(spark: SparkSession, label: str) -> str:
    import uuid

    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents", F.col("doc_id").alias("id"), "text", "lang", "source"))


def ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return table(spark, sf_dir, name, F.col(key).alias("id"))


# --- sampling --------------------------------------------------------------------------------

def sample_uniform(spark, sf_dir):
    schema = PromptSchema("{clarity}, {num_words} words", {"clarity": presets.CLARITY, "num_words": presets.NUM_WORDS})
    drawn = draw_values(ids(spark, sf_dir, "orders", "o_orderkey"), schema, SEED)
    return drawn.select("id", "sample.clarity", "sample.num_words", "formatted_prompt")


def sample_weighted(spark, sf_dir):
    schema = PromptSchema("in {language}", {"language": list(presets.LANGUAGES)}, {"language": presets.LANGUAGE_WEIGHTS})
    drawn = draw_values(ids(spark, sf_dir, "orders", "o_orderkey"), schema, SEED)
    return drawn.select("id", F.col("sample.language").alias("language"))


def sample_constrained(spark, sf_dir):
    drawn = draw_values(ids(spark, sf_dir, "orders", "o_orderkey"), presets.schema_for("bitext"), SEED)
    return drawn.select("id", "sample.src_lang", "sample.tgt_lang", "sample.unit", "formatted_prompt")


def filter_unequal(spark, sf_dir):
    languages = list(presets.LANGUAGES)
    schema = PromptSchema("{a}{b}", {"a": languages, "b": languages}, {"a": presets.LANGUAGE_WEIGHTS})
    drawn = draw_indices(ids(spark, sf_dir, "orders", "o_orderkey"), schema, SEED)
    kept = constraint_filter(drawn, [{"type": "neq", "value1": "a", "value2": "b"}])
    return kept.select("id", F.col("_idx_a").alias("a"), F.col("_idx_b").alias("b"))


def sample_task_join(spark, sf_dir):
    parts = table(spark, sf_dir, "part", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("task"))
    schema = PromptSchema("Do: {task}", {"task": from_table(parts, "task")})
    drawn = draw_values(ids(spark, sf_dir, "orders", "o_orderkey"), schema, SEED)
    return drawn.select("id", F.col("sample.task").alias("task"), "formatted_prompt")


TIED_WEIGHTS = [1 - 4e-4, 1e-4, 1e-4, 1e-4, 1e-4]


def sample_tied(spark, sf_dir):
    """Three arguments that all differ; drawn independently, three in ten million rows would do so."""
    names = ("first", "second", "third")
    tied = [{"type": "neq", "value1": a, "value2": b} for a, b in (("first", "second"), ("second", "third"), ("first", "third"))]
    schema = PromptSchema("{first}{second}{third}", {n: list("vwxyz") for n in names}, {n: TIED_WEIGHTS for n in names}, tied)
    return draw_values(ids(spark, sf_dir, "orders", "o_orderkey"), schema, SEED).select("id", "formatted_prompt")


def sample_table_weights(spark, sf_dir):
    """Names of parts, drawn by the sizes that the table gives them."""
    schema = PromptSchema("about {name}", {"name": from_table(table(spark, sf_dir, "part"), "p_name", weight="p_size")})
    return draw_values(ids(spark, sf_dir, "orders", "o_orderkey"), schema, SEED).select("id", "formatted_prompt")


def brainstorm_prompts(spark, sf_dir):
    return draw_values(ids(spark, sf_dir, "part", "p_partkey"), presets.brainstorm_schema("short_long"), SEED).drop("sample")


def render_prompt(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", render_row("{{{p_name}}} by {p_brand}\nsize {p_size}", parts.columns).alias("prompt"))


# --- models ----------------------------------------------------------------------------------

def generate_chat(spark, sf_dir):
    config = GenerationConfig("echo_chat", default_system_prompt=presets.SYSTEM_PROMPT, batch_size=32)
    return generate(documents(spark, sf_dir).select("id", "text"), config, text="text").select("id", "output")


def generate_resumed(spark, sf_dir):
    """A journal holds the replies to English documents already; the rest is asked for now."""
    docs, journal = documents(spark, sf_dir).select("id", "text", "lang"), new_path(spark, "journal")
    config = GenerationConfig("echo_chat", default_system_prompt=presets.SYSTEM_PROMPT, batch_size=32, concurrency=8)
    generate_resumable(docs.where("lang = 'en'"), config, journal, text="text")
    return generate_resumable(docs, config, journal, text="text").select("id", "output")


def generate_base(spark, sf_dir):
    rows = table(spark, sf_dir, "events", F.col("event_id").alias("id"), F.col("event_type").alias("text"),
                 F.create_map(F.lit("temperature"), (F.col("event_id") % 10).cast("string")).alias("own"))
    params = F.when(F.col("id") % 3 == 0, F.col("own"))
    config = GenerationConfig("echo_base", default_sampling_params={"temperature": 0.5})
    return generate(rows.withColumn("own", params), config, text="text", sampling_params="own").select("id", "output")


def merged_params(spark, sf_dir):
    events = table(spark, sf_dir, "events", "event_id", "props")
    row = F.from_json("props", "map<string,string>")
    merged = events.select("event_id", merge_params(row, {"k": 5, "temperature": 0.8}).alias("params"))
    return merged.select("event_id", F.try_element_at("params", F.lit("k")).alias("k"),
                         F.try_element_at("params", F.lit("temperature")).alias("temperature"),
                         F.size("params").alias("n_params"))


def chat_prompts(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    messages = turns.select("conv_id", "turn", chat_messages(F.col("text"), presets.SYSTEM_PROMPT).alias("m"))
    return messages.select("conv_id", "turn", F.posexplode("m").alias("place", "message")).select(
        "conv_id", "turn", "place", "message.role", "message.content")


def restore_order(spark, sf_dir):
    shuffled = table(spark, sf_dir, "documents", "doc_id", "source").repartition(7, "source")
    return dense_index(shuffled, [F.col("doc_id")], name="place", unique=True)[0].select("doc_id", "place")


# --- replies ---------------------------------------------------------------------------------

def json_replies(docs: DataFrame) -> DataFrame:
    """A reply of one of twelve shapes around each document; a shape per way to read or to fail."""
    text, source = quoted(F.col("text")), quoted(F.col("source"))
    body = F.concat(F.lit('{"input":'), text, F.lit(',"positive_document":'), source)
    whole = F.concat(body, F.lit("}"))
    nested = F.concat(F.lit('{"input":'), text, F.lit(',"positive_document":{"a":['), source, F.lit("]}}"))
    shape = F.col("id") % 12
    reply = (
        F.when(shape == 0, whole)
        .when(shape == 1, F.concat(F.lit(f"Here:\n{FENCE}json\n"), whole, F.lit(f"\n{FENCE}\nDone")))
        .when(shape == 2, F.concat(F.lit(f"{FENCE}\n"), whole, F.lit(f"\n{FENCE}")))
        .when(shape == 3, F.concat(F.lit(f"{FENCE}python\n"), whole, F.lit(f"\n{FENCE}")))
        .when(shape == 4, F.concat(body, F.lit(",\n}")))
        .when(shape == 5, F.concat(F.lit('{"input":'), quoted(F.concat(F.lit("{x} "), "text")), F.lit(',"positive_document":'), source, F.lit("}")))
        .when(shape == 6, F.col("text"))
        .when(shape == 7, F.concat(F.lit(f"{FENCE}null{FENCE} "), whole))
        .when(shape == 8, F.concat(F.lit(f"{FENCE}["), text, F.lit(f"]{FENCE}")))
        .when(shape == 9, F.concat(F.lit('{"input":5,"positive_document":'), text, F.lit("}")))
        .when(shape == 10, F.concat(F.lit(f"{FENCE}json\n"), nested, F.lit(f"\n{FENCE}")))
    )  # and no reply at all
    return docs.withColumn("output", reply)


def json_rows(spark, sf_dir):
    found = collect_json(json_replies(documents(spark, sf_dir)))
    get = lambda key: F.try_variant_get("parsed", f"$.{key}", "string")
    return found.select("id", "parse_branch", get("input").alias("input"), get("positive_document").alias("document"))


def collect_list_json(spark, sf_dir):
    shape = F.col("id") % 6
    items = F.concat(F.lit("["), quoted(F.col("text")), F.lit(","), quoted(F.col("source")))
    tab = F.concat(F.substring_index(items, '","', 1), F.lit("\t"), F.col("source"), F.lit('"]'))
    reply = (
        F.when(shape == 0, F.concat(F.lit("List: "), items, F.lit("] end")))
        .when(shape == 1, F.concat(items, F.lit(" , ]")))
        .when(shape == 2, F.concat(F.lit(FENCE), items, F.lit(f"]{FENCE}")))
        .when(shape == 3, tab)
        .when(shape == 4, F.col("text"))
    )  # and no reply at all
    found = read_list(documents(spark, sf_dir).withColumn("output", reply))
    get = lambda i: F.try_variant_get("parsed", f"$[{i}]", "string")
    return found.select("id", "parse_branch", get(0).alias("first"), get(1).alias("second"))


def idea_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply of one of six shapes about each part."""
    parts = table(spark, sf_dir, "part", F.col("p_partkey").alias("id"), "p_name", "p_type", "p_brand")
    shape = F.col("id") % 6
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    reply = (
        F.when(shape == 0, F.concat(F.lit("['"), name, F.lit("', '"), kind, F.lit("']")))
        .when(shape == 1, F.concat(F.lit('["'), name, F.lit('", null, "'), brand, F.lit('"]')))
        .when(shape == 2, F.concat(F.lit('Take " '), name, F.lit('" or "'), kind, F.lit('".')))
        .when(shape == 3, F.concat(F.lit("- "), name, F.lit("\n2. "), brand, F.lit("\nother\n• 3. "), kind))
        .when(shape == 4, F.concat(F.lit('["'), name, F.lit(". "), kind, F.lit(". "), brand, F.lit('."]')))
        .otherwise(F.concat(F.lit('[0, "'), name, F.lit('", 7, "'), kind, F.lit('",]')))
    )
    return parts.withColumn("output", reply)


def idea_rows(spark, sf_dir):
    return collect_ideas(idea_replies(spark, sf_dir)).select("id", "parse_branch", "idea")


def idea_set(spark, sf_dir):
    return distinct_ideas(idea_replies(spark, sf_dir))


# --- triples ---------------------------------------------------------------------------------

def _triple_reply(data_type: str) -> Column:
    keys = [k for k in REPLY_KEYS[data_type] if k]
    values = [F.col("text"), F.col("source"), F.col("lang")]
    fields = [F.concat(F.lit(f'"{k}":'), quoted(v)) for k, v in zip(keys, values)]
    inner = F.when(F.col("id") % 7 == 0, F.concat_ws(",", *fields[:-1])).otherwise(F.concat_ws(", ", *fields))
    return F.concat(F.lit("{"), inner, F.lit("}"))


def triple_replies(docs: DataFrame, output: Column, data_type: Column) -> DataFrame:
    """Replies with the keys of a data type; every seventh lacks the last key it needs."""
    prompt = F.concat(F.lit("This is your task: about "), F.col("source"), F.lit("\nin "), F.col("lang"))
    task = F.when(F.col("id") % 2 == 0, F.create_map(F.lit("task"), F.concat(F.lit("task "), F.col("lang"))))
    return docs.select(
        "id", task.alias("sample"), prompt.alias("formatted_prompt"), output.alias("output"), data_type.alias("data_type")
    )


def triples_of(data_type):
    def query(spark, sf_dir):
        replies = triple_replies(documents(spark, sf_dir), _triple_reply(data_type), F.lit(data_type))
        return triples(replies, data_type)

    return query


def triples_mixed(spark, sf_dir):
    """Every document in each data type, in one table."""
    docs = documents(spark, sf_dir).withColumn("kind", F.explode(F.array(*[F.lit(n) for n in REPLY_KEYS])))
    output = F.coalesce(*[F.when(F.col("kind") == name, _triple_reply(name)) for name in REPLY_KEYS])
    return triples(triple_replies(docs, output, F.concat("kind", F.lit("_v2"))))


def triples_foreign(spark, sf_dir):
    """Replies of another program: the prompt stands in ``input``, and no drawn values are known."""
    replies = triple_replies(documents(spark, sf_dir), _triple_reply("short_short"), F.lit("short_short"))
    return triples(replies.select("id", F.col("formatted_prompt").alias("input"), "output"), "short_short")


def reply_rejects(spark, sf_dir):
    judged = judge(json_replies(documents(spark, sf_dir)), "short_short")
    return rejected(judged).select("id", "parse_branch", "reason")


def instructions(spark, sf_dir):
    docs = documents(spark, sf_dir)
    shape = F.col("id") % 3
    prompt = F.when(shape == 0, F.concat(F.lit("Task: "), F.col("lang"), F.lit(": more\nrest"))).when(
        shape == 1, F.concat(F.col("source"), F.lit("\n"), F.col("lang"))).otherwise(F.col("source"))
    task = F.when(F.col("id") % 5 == 0, F.col("lang"))
    return docs.select("id", derive_instruction(task, prompt).alias("instruction"))


# --- vectors ---------------------------------------------------------------------------------

def token_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each 64-value embedding as a sequence of 8 token vectors, some of them masked."""
    rows = table(spark, sf_dir, "embeddings")
    tokens = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, F.lit(8)))
    mask = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.when(
        (F.col("vec_id") % 50 == 7) | ((F.col("vec_id") + i) % 3 == 0), 0).otherwise(1))
    return rows.select("vec_id", "label", "embedding", tokens.alias("tokens"), mask.alias("mask"))


def _long(df: DataFrame, vector: Column) -> DataFrame:
    return df.select("vec_id", F.posexplode(vector).alias("dim", "v")).select(
        "vec_id", "dim", (F.round("v", 6) + 0.0).alias("v"))


def pool_mean(spark, sf_dir):
    return _long(token_vectors(spark, sf_dir), vectors.pool(F.col("tokens"), F.col("mask"), "mean"))


def pool_cls(spark, sf_dir):
    return _long(token_vectors(spark, sf_dir), vectors.pool(F.col("tokens"), F.col("mask"), "cls"))


def l2_normalise(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") % 4))
    return _long(rows.withColumn("scaled", scaled), vectors.l2_normalise(F.col("scaled")))


def truncate_tokens(spark, sf_dir):
    rows = documents(spark, sf_dir)
    cut = vectors.truncate_tokens(F.split("text", " "), 16)
    return rows.select("id", F.size(cut).alias("n_tokens"), F.array_join(cut, " ").alias("kept"))


def embed_words(spark, sf_dir):
    found = embed(documents(spark, sf_dir).select("id", "text"), WORDS, {"text": "vector"}, keep=["id"])
    long = found.select("id", F.posexplode("vector").alias("bucket", "v")).where(F.col("v") != 0)
    return long.select("id", "bucket", F.round(F.col("v").cast("double"), 6).alias("v"))


# --- neighbours ------------------------------------------------------------------------------

def topk_neighbours(spark, sf_dir):
    queries = table(spark, sf_dir, "embeddings", F.col("vec_id").alias("q"), F.col("embedding").alias("vector"))
    return neighbours.exploded(neighbours.top_k(queries, queries.withColumnRenamed("q", "d"), 10))


def topk_approximate(spark, sf_dir):
    """Approximate hits of every vector, judged by exact products and by the recall against exact neighbours."""
    rows = table(spark, sf_dir, "embeddings", F.col("vec_id").alias("q"), F.col("embedding").alias("vector"))
    docs = rows.withColumnRenamed("q", "d")
    found = materialise(neighbours.exploded(approximate.top_k(rows, docs, 10)), "approximate")
    exact = neighbours.exploded(neighbours.top_k(rows, docs, 10)).select("q", "d", F.lit(1).alias("hit"))
    product = F.aggregate(F.zip_with("vector", "other", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x)
    judged = found.join(rows, "q").join(docs.withColumnRenamed("vector", "other"), "d").join(exact, ["q", "d"], "left") \
        .select("q", (F.abs(product - F.col("sim")) > 2e-6).cast("long").alias("wrong"), "hit")
    per_query = judged.groupBy("q").agg(F.count("*").alias("hits"), F.sum("wrong").alias("wrong_scores"), F.sum("hit").alias("shared"))
    enough = per_query.agg((F.sum("shared") >= 0.9 * F.sum("hits")).alias("recall_reached"))
    return per_query.drop("shared").join(F.broadcast(enough))  # one row of one value


def pairwise_similarity(spark, sf_dir):
    """The three documents most similar to every conversation turn."""
    turns = table(spark, sf_dir, "conversations",
                  (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    queries = materialise(embed(turns, WORDS, {"text": "vector"}, keep=["id"]), "turn-vectors")
    docs = documents(spark, sf_dir).select("id", "text")
    corpus = materialise(embed(docs, WORDS, {"text": "vector"}, keep=["id"]), "document-vectors")
    found = neighbours.top_k(queries.withColumnRenamed("id", "q"), corpus.withColumnRenamed("id", "d"), 3)
    return neighbours.exploded(found)


def mined_negatives(spark, sf_dir):
    """Embeddings as the vectors of the documents with the same number; some documents are copies, and
    those without a vector get the next differing text."""
    docs = documents(spark, sf_dir)
    both = table(spark, sf_dir, "embeddings", F.col("vec_id").alias("id"), F.col("embedding").alias("query_vector"),
                 F.col("embedding").alias("positive_vector"))
    rows = docs.select(
        "id", F.concat(F.lit("about "), "source").alias("query"), F.col("text").alias("positive"), F.lit("old").alias("negative"))
    return pick_negatives(rows, both, HardNegativeConfig(top_k=10, seed=SEED)).select("id", "query", "negative", "negative_branch")


def mined_negatives_fallback(spark, sf_dir):
    """Few different positives, many of them blank, and a small k, so that all fallbacks occur."""
    rows = table(spark, sf_dir, "embeddings")
    positive = F.when(F.col("label") % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("group "), F.col("label")))
    triples_ = rows.select(F.col("vec_id").alias("id"), F.lit("q").alias("query"), positive.alias("positive"))
    both = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("query_vector"),
                       F.col("embedding").alias("positive_vector"))
    return pick_negatives(triples_, both, HardNegativeConfig(top_k=2, seed=SEED)).select("id", "positive", "negative", "negative_branch")


# --- files -----------------------------------------------------------------------------------

def jsonl_roundtrip(spark, sf_dir):
    path = new_path(spark, "jsonl")
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars")
    run_step(spark, lambda: docs, path, "jsonl")
    return read_jsonl(spark, path, docs.schema)


def csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "csv")
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars")
    run_step(spark, lambda: docs, path, "csv")
    return read_csv(spark, path, docs.schema)


def json_array_roundtrip(spark, sf_dir):
    path = new_path(spark, "array")
    write_json_array(table(spark, sf_dir, "documents", "text"), path)
    return read_value_list(spark, path).df


def idea_list_scan(spark, sf_dir):
    path = new_path(spark, "ideas")
    run_step(spark, lambda: idea_set(spark, sf_dir), path, "json")
    return read_value_list(spark, path).df


def write_mode_skip(spark, sf_dir):
    """The second step finds a complete target and must leave it alone; the third replaces it."""
    path = new_path(spark, "steps")
    first = table(spark, sf_dir, "documents", "doc_id", "lang")
    run_step(spark, lambda: first, path, "jsonl")
    skipped = run_step(spark, lambda: first.withColumn("lang", F.upper("lang")), path, "jsonl")
    kept = read_jsonl(spark, path, first.schema).withColumn("was_skipped", F.lit(skipped is None))
    other = new_path(spark, "steps")
    run_step(spark, lambda: first, other, "jsonl")
    run_step(spark, lambda: first.withColumn("lang", F.upper("lang")), other, "jsonl", overwrite=True)
    changed = read_jsonl(spark, other, first.schema).withColumnRenamed("lang", "replaced")
    return kept.join(changed, "doc_id")


# --- datasets --------------------------------------------------------------------------------

def _pairs(spark, sf_dir, data_type: str, tasks=None) -> DataFrame:
    """Prompts for every document id, stand-in replies, and their triples."""
    schema = presets.schema_for(data_type, tasks)
    keys = [k for k in REPLY_KEYS[data_type]]
    prompts = draw_values(ids(spark, sf_dir, "documents", "doc_id"), schema, SEED)
    return triples(generate(prompts, GenerationConfig("sentence_json", {"keys": keys})), data_type)


def bitext_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir, "bitext")


def sts_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir, "sts")


def long_short_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir, "long_short", from_table(idea_set(spark, sf_dir), "idea"))


PASSAGE_TEMPLATE = "This is your retrieval task: {task}\nin {language}\nPassage: {passage}"


def short_long_pairs(spark, sf_dir):
    """Tasks from collected ideas and passages from the documents, to triples with hard negatives."""
    docs = documents(spark, sf_dir)
    schema = PromptSchema(
        PASSAGE_TEMPLATE,
        {"task": from_table(idea_set(spark, sf_dir), "idea"), "language": list(presets.LANGUAGES),
         "passage": from_table(docs, "text")},
        {"language": presets.LANGUAGE_WEIGHTS},
    )
    prompts = draw_values(docs.select("id"), schema, SEED)
    rows = triples(generate(prompts, GenerationConfig("passage_json")), "short_long")
    mining = HardNegativeConfig(WORDS, 10, presets.QUERY_TEMPLATE, presets.DOCUMENT_TEMPLATE, SEED)
    return hard_negatives(rows, mining)


def dataset_lists(spark, sf_dir, names: bool = True) -> tuple:
    """The passages, the names of parts if asked for, and the numbers of documents and parts."""
    parts, docs = table(spark, sf_dir, "part"), documents(spark, sf_dir)
    return from_table(docs, "text"), from_table(parts, "p_name") if names else None, docs.count(), parts.count()


def dataset_config(data_type: str, folder: str, lists: tuple) -> datasets.DatasetConfig:
    """Tasks about the names of parts, and passages from the documents, one prompt per part and per document."""
    passages, names, n_docs, n_parts = lists
    args = {"passage": passages}
    constraints = None
    if data_type == "bitext":
        args |= {"src_lang": list(presets.LANGUAGES), "tgt_lang": list(presets.LANGUAGES)}
        constraints = [{"type": "neq", "value1": "src_lang", "value2": "tgt_lang"}]
    else:
        args["language"] = list(presets.LANGUAGES)
    weights = {name: presets.LANGUAGE_WEIGHTS for name in args if name != "passage"}
    if data_type in datasets.BRAINSTORMED:
        args["task"] = ["the ideas of the brainstorm"]
    return datasets.DatasetConfig(
        folder, GenerationConfig("passage_fields", {"keys": [k for k in REPLY_KEYS[data_type] if k]}), WORDS,
        GenerationConfig("task_list"), n_parts, n_docs, SEED,
        schema=PromptSchema(DATASET_TEMPLATES.get(data_type, PASSAGE_TEMPLATE), args, weights, constraints),
        brainstorm=PromptSchema("Tasks about {name}", {"name": names}) if data_type in datasets.BRAINSTORMED else None)


DATASET_TEMPLATES = {
    "sts": "in {language}\nPassage: {passage}",
    "bitext": "from {src_lang} to {tgt_lang}\nPassage: {passage}",
}


def dataset_of(data_type: str):
    """All steps of a data type, from brainstorm to final table."""
    return lambda spark, sf_dir: datasets.build(
        spark, data_type, dataset_config(data_type, new_path(spark, "dataset"), dataset_lists(spark, sf_dir, data_type in datasets.BRAINSTORMED)))


def dataset_all(spark, sf_dir):
    """The lists are sorted and written once for all data types."""
    folder, lists = new_path(spark, "dataset"), dataset_lists(spark, sf_dir)
    return datasets.build_all(spark, {name: dataset_config(name, folder, lists) for name in datasets.RUN_ORDER})


def queries() -> dict:
    return {
        "sample_uniform": sample_uniform,
        "sample_weighted": sample_weighted,
        "sample_constrained": sample_constrained,
        "constraint_filter": filter_unequal,
        "sample_task_join": sample_task_join,
        "sample_tied": sample_tied,
        "sample_table_weights": sample_table_weights,
        "brainstorm_prompts": brainstorm_prompts,
        "render_prompt": render_prompt,
        "generate_chat": generate_chat,
        "generate_resumed": generate_resumed,
        "generate_base": generate_base,
        "merge_params": merged_params,
        "chat_messages": chat_prompts,
        "restore_order": restore_order,
        "collect_json": json_rows,
        "collect_list_json": collect_list_json,
        "collect_ideas": idea_rows,
        "distinct_ideas": idea_set,
        **{f"triples_{name}": triples_of(name) for name in REPLY_KEYS},
        "triples_mixed": triples_mixed,
        "triples_foreign": triples_foreign,
        "reply_rejects": reply_rejects,
        "derive_instruction": instructions,
        "pool_mean": pool_mean,
        "pool_cls": pool_cls,
        "l2_normalise": l2_normalise,
        "truncate_tokens": truncate_tokens,
        "embed_stub": embed_words,
        "topk_neighbours": topk_neighbours,
        "topk_approximate": topk_approximate,
        "pairwise_similarity": pairwise_similarity,
        "hard_negatives": mined_negatives,
        "hard_negatives_fallback": mined_negatives_fallback,
        "jsonl_roundtrip": jsonl_roundtrip,
        "csv_roundtrip": csv_roundtrip,
        "json_array_roundtrip": json_array_roundtrip,
        "idea_list_scan": idea_list_scan,
        "write_mode_skip": write_mode_skip,
        "bitext_pairs": bitext_pairs,
        "sts_pairs": sts_pairs,
        "long_short_pairs": long_short_pairs,
        "short_long_pairs": short_long_pairs,
        **{f"pipeline_{name}": dataset_of(name) for name in datasets.RUN_ORDER},
        "pipeline_all": dataset_all,
    }
