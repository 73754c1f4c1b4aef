"""Named ways to turn a table of replies or triples into a result, for use with ``df.transform``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from pairsmith.operators.collect import collect_json, distinct_ideas
from pairsmith.operators.negatives import HardNegativeConfig, hard_negatives
from pairsmith.operators.triples import triples

_postprocessors: dict[str, Callable[..., Callable[[DataFrame], DataFrame]]] = {}


def register_postprocessor(name: str, factory: Callable[..., Callable[[DataFrame], DataFrame]]) -> None:
    """``factory(**options)`` returns a function from table to table."""
    _postprocessors[name] = factory


def postprocessor(name: str, **options) -> Callable[[DataFrame], DataFrame]:
    if name not in _postprocessors:
        raise ValueError(f"postprocessor {name!r} is not registered, known are {sorted(_postprocessors)}")
    return _postprocessors[name](**options)


register_postprocessor("brainstorming", lambda: distinct_ideas)
register_postprocessor("json", lambda: lambda df: collect_json(df).select("parsed"))
register_postprocessor("synthetic_embeddings_data", lambda data_type=None: lambda df: triples(df, data_type))
register_postprocessor(
    "hard_negative_retrieval", lambda **options: lambda df: hard_negatives(df, HardNegativeConfig(**options))
)
