"""From parsed replies to (instruction, query, positive, negative)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairsmith.functions.binding import only_if
from pairsmith.functions.strict_json import is_object, string_field
from pairsmith.operators.collect import read_json
from pairsmith.operators.sampling import settle

# The reply keys of each data type as (query, positive, negative). Types are told
# apart by prefix, in this order.
REPLY_KEYS = {
    "long_long": ("input", "positive_document", None),
    "long_short": ("input_text", "label", "misleading_label"),
    "short_long": ("user_query", "positive_document", None),
    "short_short": ("input", "positive_document", None),
    "sts": ("S1", "S2", "S3"),
    "bitext": ("S1", "S2", "S3"),
}
# The instruction of the types that take none from the prompt.
INSTRUCTIONS = {
    "sts": "Retrieve semantically similar text.",
    "bitext": "Retrieve parallel sentences.",
}
TRIPLE = "struct<instruction: string, query: string, positive: string, negative: string>"


def data_type_of(name: str) -> str:
    for data_type in REPLY_KEYS:
        if name.startswith(data_type):
            return data_type
    raise ValueError(f"unknown data type {name!r}")


def prompt_of(df: DataFrame) -> Column:
    """The prompt column of own (``formatted_prompt``) or foreign (``input``) replies."""
    present = [F.col(c) for c in ("formatted_prompt", "input") if c in df.columns]
    return F.coalesce(*present, F.lit(""))


def task_of(df: DataFrame) -> Column:
    """``sample.task`` where the table has one."""
    if "sample" in df.columns:
        kind = df.schema["sample"].dataType
        if isinstance(kind, T.StructType) and "task" in kind.names:
            return F.col("sample.task").cast("string")
        if isinstance(kind, T.MapType):
            return F.try_element_at("sample", F.lit("task"))
    return F.lit(None).cast("string")


def derive_instruction(task: Column, prompt: Column) -> Column:
    """The drawn task; else the first line after the first ``': '`` of the prompt; else its first line."""
    after_colon = F.get(F.split(prompt, ": ", 3), 1)
    return F.coalesce(task, F.substring_index(F.coalesce(after_colon, prompt), "\n", 1))


def _triple(data_type: str, derived: Column) -> Column:
    """The triple as a struct, or null if a key is missing or not a string."""
    query, positive, negative = (
        F.lit("") if key is None else string_field(F.col("parsed"), key) for key in REPLY_KEYS[data_type]
    )
    instruction = F.lit(INSTRUCTIONS[data_type]) if data_type in INSTRUCTIONS else derived
    triple = F.struct(
        instruction.alias("instruction"), query.alias("query"), positive.alias("positive"), negative.alias("negative")
    )
    return only_if(triple, lambda t: t["query"].isNotNull() & t["positive"].isNotNull() & t["negative"].isNotNull())


def judge(df: DataFrame, data_type: str | None = None, output: str = "output") -> DataFrame:
    """Every reply with ``parse_branch``, its ``triple`` or else the ``reason`` it has none.

    ``data_type`` names the type of the whole table; without it the table has such a column.
    Other columns pass through. To use both outcomes, materialise this result once.
    """
    derived = derive_instruction(task_of(df), prompt_of(df))
    if data_type is not None:
        triple, label = _triple(data_type_of(data_type), derived), F.lit(data_type)
    else:
        label = F.col("data_type")
        chain = None
        for name in REPLY_KEYS:
            test = label.startswith(name)
            chain = F.when(test, _triple(name, derived)) if chain is None else chain.when(test, _triple(name, derived))
        triple = chain.otherwise(F.raise_error(F.concat(F.lit("unknown data type "), label)).cast(TRIPLE))
    parsed = read_json(df, output)
    reason = (
        F.when(F.col("triple").isNotNull(), F.lit(None).cast("string"))
        .when(F.col("parsed").isNull(), "no_json")
        .when(F.is_variant_null("parsed"), "json_null")
        .when(~is_object(F.col("parsed")), "not_object")
        .otherwise("bad_field")
    )
    judged = parsed.withColumn("triple", triple).withColumn("data_type", label)
    return settle(judged.withColumn("reason", reason).drop("parsed"), ["triple", "reason"])


def accepted(judged: DataFrame) -> DataFrame:
    keep = [c for c in ("id", "data_type") if c in judged.columns]
    return judged.where(F.col("triple").isNotNull()).select(*keep, "triple.*")


def rejected(judged: DataFrame, output: str = "output") -> DataFrame:
    keep = [c for c in ("id", "data_type") if c in judged.columns]
    return judged.where(F.col("triple").isNull()).select(*keep, output, "parse_branch", "reason")


def triples(df: DataFrame, data_type: str | None = None, output: str = "output") -> DataFrame:
    """``(id, data_type, instruction, query, positive, negative)`` of the replies that give a triple."""
    return accepted(judge(df, data_type, output))
