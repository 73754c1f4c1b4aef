import json
import math

import pytest
from pyspark.sql import functions as F

from pairsmith import PromptSchema
from pairsmith.functions import template
from pairsmith.operators import sampling
from pairsmith.plans import presets
from pairsmith.sources.value_list import from_table, read_value_list

NEQ = [{"type": "neq", "value1": "a", "value2": "b"}]


def pairs(df):
    return [(r.sample.a, r.sample.b) for r in df.collect()]


@pytest.mark.parametrize("arguments", [
    dict(args={"a": ["x"]}, args_p={"b": [1.0]}),
    dict(args={"a": ["x", "y"]}, args_p={"a": [0.5, 0.4]}),
    dict(args={"a": ["x", "y"]}, args_p={"a": [1.0]}),
    dict(args={"a": ["x", "y"]}, args_p={"a": [1.5, -0.5]}),
    dict(args={"a": 5}),
    dict(args={"a": []}),
    dict(args={"a": ["x"], "b": ["y"]}, constraints=[{"type": "eq", "value1": "a", "value2": "b"}]),
    dict(args={"a": ["x"]}, constraints=NEQ),
    dict(args={"a": ["x"], "b": ["y"]}, constraints=[{**NEQ[0], "more": 1}]),
])
def test_invalid_schemas(arguments):
    with pytest.raises(ValueError):
        PromptSchema("t", **arguments)


def test_template_fields():
    with pytest.raises(KeyError):
        PromptSchema("{a} {c}", {"a": ["x"]})
    for bad in ("{a.b}", "{a!r}", "{a:>5}", "{}", "{0}"):
        with pytest.raises(ValueError):
            template.fields(bad)
    assert template.fields("{{x}} {a} {b} {a}") == ["a", "b", "a"]


def test_render_null_and_braces(spark):
    df = spark.createDataFrame([(1, None)], "n int, s string")
    assert df.select(template.render_row("{{{n}}}-{s}", df.columns)).first()[0] == "{1}-None"


def test_no_arguments(spark):
    rows = PromptSchema("same").sample(spark, 3, 1).collect()
    assert [r.formatted_prompt for r in rows] == ["same"] * 3


def test_zero_rows(spark):
    schema = PromptSchema("{a}{b}", {"a": ["x", "y"], "b": ["x", "y"]}, constraints=NEQ)
    assert schema.sample(spark, 0, 1).count() == 0


def test_constraint_compares_places_not_values(spark):
    schema = PromptSchema("{a}{b}", {"a": ["x", "x"], "b": ["x", "x"]}, constraints=NEQ)
    drawn = pairs(schema.sample(spark, 50, 3))
    assert len(drawn) == 50 and set(drawn) == {("x", "x")}


def test_impossible_constraints(spark):
    with pytest.raises(ValueError):
        PromptSchema("{a}{b}", {"a": ["x"], "b": ["y"]}, constraints=NEQ).sample(spark, 5, 1)
    with pytest.raises(ValueError):
        PromptSchema("{a}", {"a": ["x", "y"]}, constraints=[{"type": "neq", "value1": "a", "value2": "a"}]).sample(spark, 5, 1)
    with pytest.raises(ValueError):
        PromptSchema("{a}{b}", {"a": ["x", "y"], "b": ["x", "y"]}, {"a": [1.0, 0.0], "b": [1.0, 0.0]}, NEQ).sample(spark, 5, 1)


def test_certain_weight(spark):
    schema = PromptSchema("{a}", {"a": ["x", "y", "z"]}, {"a": [0.0, 1.0, 0.0]})
    assert {r.formatted_prompt for r in schema.sample(spark, 200, 1).collect()} == {"y"}


def within(observed, n, p):
    return abs(observed - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 1


def test_frequencies_and_repeatability(spark):
    n = 100_000
    drawn = presets.schema_for("sts").sample(spark, n, 11)
    counts = {r["l"]: r["count"] for r in drawn.groupBy(F.col("sample.language").alias("l")).count().collect()}
    assert sum(counts.values()) == n
    for i, (name, p) in enumerate(zip(presets.LANGUAGES, presets.LANGUAGE_WEIGHTS)):
        if name != "Burmese":
            assert within(counts.get(name, 0), n, p), name
    ids = spark.range(1000)
    one = sampling.draw_values(ids.repartition(1), presets.schema_for("sts"), 11).collect()
    many = sampling.draw_values(ids.repartition(13), presets.schema_for("sts"), 11).collect()
    assert sorted(one) == sorted(many)
    assert sorted(one) != sorted(sampling.draw_values(ids, presets.schema_for("sts"), 12).collect())


def test_unequal_pair_has_the_conditional_distribution(spark):
    n, p, q = 200_000, [0.6, 0.3, 0.1], [0.5, 0.2, 0.2, 0.1]
    schema = PromptSchema("{a}{b}", {"a": list("012"), "b": list("0123")}, {"a": p, "b": q}, NEQ)
    drawn = schema.sample(spark, n, 5).groupBy("sample.a", "sample.b").count().collect()
    counts = {(int(r.a), int(r.b)): r["count"] for r in drawn}
    total = sum(p[i] * q[j] for i in range(3) for j in range(4) if i != j)
    assert all(i != j for i, j in counts)
    for i in range(3):
        for j in range(4):
            if i != j:
                assert within(counts[i, j], n, p[i] * q[j] / total)


def test_rejection_for_linked_constraints(spark):
    n = 50_000
    values, weights = list("0123"), [0.7, 0.1, 0.1, 0.1]
    constraints = [{"type": "neq", "value1": x, "value2": y} for x, y in ("ab", "bc", "ac")]
    schema = PromptSchema("{a}{b}{c}", {k: values for k in "abc"}, {k: weights for k in "abc"}, constraints)
    drawn = schema.sample(spark, n, 5).groupBy("formatted_prompt").count().collect()
    counts = {r.formatted_prompt: r["count"] for r in drawn}
    good = [(a, b, c) for a in range(4) for b in range(4) for c in range(4) if len({a, b, c}) == 3]
    total = sum(weights[a] * weights[b] * weights[c] for a, b, c in good)
    assert sum(counts.values()) == n and set(counts) <= {f"{a}{b}{c}" for a, b, c in good}
    for a, b, c in good:
        assert within(counts[f"{a}{b}{c}"], n, weights[a] * weights[b] * weights[c] / total)


def test_duplicate_language_may_meet_itself(spark):
    drawn = presets.schema_for("bitext").sample(spark, 100, 1)
    assert drawn.count() == 100
    schema = PromptSchema("{a}{b}", {"a": list(presets.LANGUAGES), "b": list(presets.LANGUAGES)},
                          {k: [0.5 if x == "Burmese" else 0.0 for x in presets.LANGUAGES] for k in "ab"}, NEQ)
    assert set(pairs(schema.sample(spark, 20, 1))) == {("Burmese", "Burmese")}


def test_guide_table_equals_search():
    import numpy as np

    weights = sampling.Weights.of(presets.LANGUAGE_WEIGHTS)
    assert weights.cdf[-1] == 1.0 and abs(np.diff(weights.cdf).min() - 0.0022857142857142824) < 1e-9


@pytest.mark.parametrize("weights", [presets.LANGUAGE_WEIGHTS, [1e-7] * 1000 + [1 - 1e-4], [0.25] * 4, [1.0]])
def test_index_is_first_place_above(spark, weights):
    import numpy as np

    w = sampling.Weights.of(weights)
    edges = np.unique(np.concatenate([w.cdf[:-1], np.nextafter(w.cdf[:-1], 0), np.random.default_rng(0).random(2000), [0.0]]))
    df = spark.createDataFrame([(float(x),) for x in edges], "u double").withColumn("i", w.index(F.col("u")))
    rows = df.collect()
    assert [r.i for r in rows] == np.searchsorted(w.cdf, [r.u for r in rows], side="right").tolist()


def test_value_lists(spark, tmp_path):
    values = ["b", 'say "hi", ok', "ü [x], ", "", "a\\", 'x", ']
    path = tmp_path / "list.json"
    path.write_text(json.dumps(values))
    assert [r.value for r in read_value_list(spark, str(path)).df.orderBy("idx").collect()] == values
    path.write_text(json.dumps(values, indent=2))
    assert [r.value for r in read_value_list(spark, str(path)).df.orderBy("idx").collect()] == values
    path.write_text(json.dumps(values, ensure_ascii=False).replace('", "', '",\n"', 1))
    assert [r.value for r in read_value_list(spark, str(path)).df.orderBy("idx").collect()] == values
    path.write_text("[]")
    assert len(read_value_list(spark, str(path))) == 0
    with pytest.raises(ValueError):
        PromptSchema("{a}", {"a": str(path)}).sample(spark, 3, 1)
    path.write_text('["open')
    with pytest.raises(Exception):
        read_value_list(spark, str(path)).df.collect()


def test_path_table_and_long_lists_give_the_same_draws(spark, tmp_path, monkeypatch):
    values = sorted(f"task {i:03}" for i in range(300))
    weights = [0.5] + [0.5 / 299] * 299
    path = tmp_path / "tasks.json"
    path.write_text(json.dumps(values))
    table = spark.createDataFrame([(v,) for v in values * 2], "v string")

    def draw(source, p=None):
        schema = PromptSchema("{task}", {"task": source}, {"task": p} if p else {})
        return sorted((r.id, r.formatted_prompt) for r in schema.sample(spark, 500, 9).collect())

    inline, weighted = draw(values), draw(values, weights)
    assert draw(str(path)) == inline and draw(from_table(table, "v")) == inline
    assert draw(str(path), weights) == weighted
    monkeypatch.setattr(sampling, "INLINE_VALUES", 10)
    assert draw(values) == inline and draw(values, weights) == weighted


def test_schema_file(spark, tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps({"prompt_template": "{a} {task}", "args": {"a": ["x"]}}))
    for session in (None, spark):
        schema = PromptSchema.from_json(str(path), {"task": ["t"], "a": ["y"]}, {"a": [1.0]}, spark=session)
        assert schema.sample(spark, 1, 1).first().formatted_prompt == "y t"


def test_presets_match_their_counts():
    assert len(presets.LANGUAGES) == 98 and len(set(presets.LANGUAGES)) == 97 and len(presets.LANGUAGE_WEIGHTS) == 98
    assert presets.LANGUAGES[26] == presets.LANGUAGES[27] == "Burmese"
    for name in presets.TEMPLATES:
        presets.schema_for(name, ["t"] if name in presets.BRAINSTORMS else None)
    with pytest.raises(ValueError):
        presets.schema_for("short_long")
    with pytest.raises(ValueError):
        presets.schema_for("other")


@pytest.mark.parametrize("length,power", [(1000, 1.2), (10_000, 1.5), (5, 0.0), (1, 0.0)])
def test_a_skewed_list_is_searched_exactly(spark, length, power):
    import numpy as np

    weights = sampling.Weights.of(1.0 / np.arange(1, length + 1) ** power)
    numbers = np.random.default_rng(4).random(2000)
    edges = weights.cdf[np.random.default_rng(5).integers(0, length, 200)]
    u = np.concatenate([numbers, edges[edges < 1], np.nextafter(edges, 0), [0.0]])
    df = spark.createDataFrame([(float(x),) for x in u], "u double")
    got = {r.u: r.i for r in df.select("u", weights.index(F.col("u")).alias("i")).collect()}
    assert all(got[float(x)] == int(np.searchsorted(weights.cdf, x, side="right")) for x in u)
