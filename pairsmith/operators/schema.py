"""Prompt schema: a template, the values of its arguments, their weights, and constraints."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from pairsmith.functions import template as tpl
from pairsmith.sources.value_list import ValueList, read_value_list

CONSTRAINT_KEYS = {"type", "value1", "value2"}
CONSTRAINT_TYPES = {"neq"}
WEIGHT_TOLERANCE = 1e-6


@dataclass
class PromptSchema:
    """``args`` maps a name to a list of values, the path of a JSON array, or a ``ValueList``."""

    prompt_template: str
    args: dict[str, Any] = field(default_factory=dict)
    args_p: dict[str, list[float]] = field(default_factory=dict)
    constraints: list[dict[str, str]] | None = None

    def __post_init__(self):
        unknown = set(self.args_p) - set(self.args)
        if unknown:
            raise ValueError(f"weights for unknown arguments: {sorted(unknown)}")
        for name, values in self.args.items():
            if not isinstance(values, (list, str, ValueList)):
                raise ValueError(f"the values of {name!r} must be a list, a path or a ValueList")
            if isinstance(values, list) and not values:
                raise ValueError(f"the value list of {name!r} is empty")
        for name, weights in self.args_p.items():
            self._check_weights(name, weights)
        for constraint in self.constraints or []:
            self._check_constraint(constraint)
        missing = set(tpl.fields(self.prompt_template)) - set(self.args)
        if missing:
            raise KeyError(f"template fields without an argument: {sorted(missing)}")

    def _check_weights(self, name: str, weights: list[float]) -> None:
        if abs(sum(weights) - 1.0) > WEIGHT_TOLERANCE:
            raise ValueError(f"the weights of {name!r} sum to {sum(weights)}, not 1")
        if min(weights) < 0:
            raise ValueError(f"the weights of {name!r} hold a negative number")
        values = self.args[name]
        if not isinstance(values, str) and len(values) != len(weights):
            raise ValueError(f"{name!r} has {len(values)} values but {len(weights)} weights")

    def _check_constraint(self, constraint: dict[str, str]) -> None:
        if set(constraint) != CONSTRAINT_KEYS:
            raise ValueError(f"a constraint needs exactly the keys {sorted(CONSTRAINT_KEYS)}: {constraint}")
        if constraint["type"] not in CONSTRAINT_TYPES:
            raise ValueError(f"unknown constraint type in {constraint}")
        for side in ("value1", "value2"):
            if constraint[side] not in self.args:
                raise ValueError(f"constraint on the unknown argument {constraint[side]!r}")

    @classmethod
    def from_json(
        cls,
        path: str,
        extra_args: dict[str, Any] | None = None,
        extra_args_p: dict[str, list[float]] | None = None,
        spark: SparkSession | None = None,
    ) -> PromptSchema:
        """Load a schema file of a few kilobytes; the extra entries replace or add arguments.

        With ``spark`` the path may be on any file system that Spark reads.
        """
        if spark is not None:
            text = spark.read.text(path, wholetext=True).first()[0]
        else:
            with open(path, encoding="utf-8") as handle:
                text = handle.read()
        data = json.loads(text)
        return cls(
            data["prompt_template"],
            {**data.get("args", {}), **(extra_args or {})},
            {**data.get("args_p", {}), **(extra_args_p or {})},
            data.get("constraints"),
        )

    def resolve(self, spark: SparkSession) -> PromptSchema:
        """The same schema with every path read into a ``ValueList``."""
        args = {
            name: read_value_list(spark, values) if isinstance(values, str) else values
            for name, values in self.args.items()
        }
        for name, values in args.items():
            if len(values) == 0:
                raise ValueError(f"the value list of {name!r} is empty")
        return PromptSchema(self.prompt_template, args, self.args_p, self.constraints)

    def sample(self, spark: SparkSession, n: int, seed: int | None = None) -> DataFrame:
        from pairsmith.operators.sampling import sample

        return sample(spark, self, n, seed)
