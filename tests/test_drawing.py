"""Draws of tied arguments and of lists with weights in a table, against exact distributions."""

import itertools
import math
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pairsmith import PromptSchema
from pairsmith.operators import alias, sampling
from pairsmith.sources.value_list import from_table


def neq(*pairs):
    return [{"type": "neq", "value1": a, "value2": b} for a, b in pairs]


def within(observed, n, p):
    return abs(observed - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 1


def exact(weights, pairs):
    """Joint distribution of (index of each argument) that rejection would leave."""
    names = list(weights)
    joint = {}
    for choice in itertools.product(*[range(len(w)) for w in weights.values()]):
        at = dict(zip(names, choice))
        if all(at[a] != at[b] for a, b in pairs):
            joint[choice] = math.prod(w[i] for w, i in zip(weights.values(), choice))
    total = sum(joint.values())
    return {c: w / total for c, w in joint.items() if w}


def drawn(spark, weights, pairs, n, seed=5):
    schema = PromptSchema("".join(f"{{{k}}}" for k in weights), {k: [str(i) for i in range(len(w))] for k, w in weights.items()}, weights, neq(*pairs))
    rows = schema.sample(spark, n, seed).groupBy("formatted_prompt").count().collect()
    return {tuple(map(int, r.formatted_prompt)): r["count"] for r in rows}


@pytest.mark.parametrize("weights,pairs", [
    ({"a": [0.7, 0.1, 0.1, 0.1], "b": [0.7, 0.2, 0.1], "c": [0.1, 0.2, 0.7], "d": [0.25] * 4}, ["ab", "bc", "cd", "da"]),
    ({"a": [0.5, 0.5], "b": [0.2, 0.8], "c": [0.9, 0.1], "d": [0.3, 0.3, 0.4]}, ["ab", "bc", "bd"]),
    ({"a": [0.4, 0.3, 0.2, 0.1], "b": [0.4, 0.3, 0.2, 0.1], "c": [0.1, 0.2, 0.3, 0.4], "d": [0.25] * 4}, ["ab", "ac", "ad", "bc", "bd", "cd"]),
    ({"a": [0.0, 1.0], "b": [0.5, 0.0, 0.5], "c": [0.2, 0.3, 0.5]}, ["ab", "bc"]),
    ({"a": [1 - 2e-7, 1e-7, 1e-7], "b": [1 - 2e-7, 1e-7, 1e-7], "c": [1 - 2e-7, 1e-7, 1e-7]}, ["ab", "bc"]),
    ({"a": [1 - 2e-4, 1e-4, 1e-4], "b": [1 - 2e-4, 1e-4, 1e-4], "c": [1 - 2e-4, 1e-4, 1e-4]}, ["ab", "bc", "ac"]),
])
def test_tied_arguments_have_the_conditional_distribution(spark, weights, pairs):
    n, expected = 60_000, exact(weights, pairs)
    got = drawn(spark, weights, pairs, n)
    assert sum(got.values()) == n and set(got) <= set(expected)
    for choice, p in expected.items():
        assert within(got.get(choice, 0), n, p), (choice, got.get(choice, 0), n * p)


def test_unmet_constraints_are_found_without_drawing(spark):
    certain = {k: [1.0, 0.0, 0.0] for k in "abc"}
    for weights, pairs in ((certain, ["ab", "bc"]), ({k: [0.5, 0.5] for k in "abc"}, ["ab", "bc", "ac"])):
        with pytest.raises(ValueError):
            drawn(spark, weights, pairs, 1)
    square = drawn(spark, {k: [0.5, 0.5] for k in "abcd"}, ["ab", "bc", "cd", "da"], 400)
    assert set(square) == {(0, 1, 0, 1), (1, 0, 1, 0)}
    with pytest.raises(ValueError, match="too many"):
        names = "abcdefghijkl"
        drawn(spark, {k: [1 / 40] * 40 for k in names}, ["".join(p) for p in itertools.combinations(names, 2)], 1)


def test_no_rejection_in_the_plan(spark):
    schema = PromptSchema("{a}{b}{c}", {k: list("xyz") for k in "abc"}, {}, neq("ab", "bc"))
    plan = sampling.draw_values(spark.range(5), schema, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" not in plan


def test_pairs_of_long_lists_are_drawn_alike(spark):
    """An entry more without weight changes no draw, whatever the length."""
    def draw(n):
        weights = [2.0 / 200_000 if i < 100_000 else 0.0 for i in range(n)]
        schema = PromptSchema("{a}{b}", {k: [str(i) for i in range(n)] for k in "ab"}, {k: weights for k in "ab"}, neq("ab"))
        return sampling.draw_indices(spark.range(50), schema, 3).orderBy("id").collect()

    assert draw(199_999) == draw(200_001)


# --- weights in a table ----------------------------------------------------------------------

def shares(table, n):
    got = Counter()
    for r in table.collect():
        assert 0 <= r.keeps <= 1
        got[r.value] += r.keeps / n
        got[r.other_value] += (1 - r.keeps) / n
    return got


@pytest.mark.parametrize("block", [3, 200_000])
@pytest.mark.parametrize("weights", [
    [1, 1, 1, 1], [0, 0, 3], [100, 1, 1, 1, 0, 1, 1], [Decimal("0.000000001"), Decimal("3.5"), 2],
    [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9, 3, 2, 3, 8, 4] * 3,
])
def test_alias_table_holds_the_weights(spark, monkeypatch, weights, block):
    monkeypatch.setattr(alias, "BLOCK", block)
    values = spark.createDataFrame([(i, f"v{i}", Decimal(w)) for i, w in enumerate(weights)], "idx long, value string, weight decimal(28,9)")
    table = alias.alias_table(values, len(weights))
    assert sorted(r.slot for r in table.collect()) == list(range(len(weights)))
    got, total = shares(table, len(weights)), float(sum(weights))
    assert all(abs(got[f"v{i}"] - float(w) / total) < 1e-12 for i, w in enumerate(weights))


@pytest.mark.parametrize("weights", [[0, 0], [1, -1, 2], [None, 1]])
def test_alias_table_refuses(spark, weights):
    values = spark.createDataFrame([(i, "v", w if w is None else Decimal(w)) for i, w in enumerate(weights)], "idx long, value string, weight decimal(28,9)")
    with pytest.raises(ValueError):
        alias.alias_table(values, len(weights))


def test_draws_by_the_weights_of_a_table(spark):
    rows = spark.createDataFrame([("x", 1.5), ("y", 6.0), ("x", 0.5), ("z", 0.0), ("w", 2.0)], "name string, size double")
    schema = PromptSchema("{a}-{b}", {"a": from_table(rows, "name", weight="size"), "b": ["1", "2"]})
    n = 20_000
    got = {r["a"]: r["count"] for r in schema.sample(spark, n, 4).groupBy("sample.a").count().collect()}
    assert sum(got.values()) == n and set(got) == {"x", "y", "w"}
    assert all(within(got[k], n, p) for k, p in (("x", 0.2), ("y", 0.6), ("w", 0.2)))
    one, many = (sampling.draw_values(spark.range(500).repartition(p), schema, 4).collect() for p in (1, 9))
    assert sorted(one) == sorted(many)
    with pytest.raises(ValueError):
        PromptSchema("{a}{b}", {"a": from_table(rows, "name", weight="size"), "b": ["1", "2"]}, {}, neq("ab")).sample(spark, 3, 1)


def test_weights_of_a_table_stay_out_of_the_plan(spark):
    def plan_size(n):
        rows = spark.range(n).select(F.concat(F.lit("value "), "id").alias("name"), (F.col("id") % 7 + 1).alias("w"))
        schema = PromptSchema("{a}", {"a": from_table(rows, "name", weight="w")})
        return len(sampling.draw_values(spark.range(9), schema, 1)._jdf.queryExecution().optimizedPlan().toString())

    assert plan_size(20_000) < plan_size(100) + 200
