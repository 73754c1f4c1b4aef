import json

import pytest
from pyspark.sql import functions as F

from pairsmith.functions.strict_json import parse_strict
from pairsmith.functions.text import is_blank, strip, valid_utf8
from pairsmith.operators.collect import collect_json, distinct_ideas, read_ideas, read_json, read_list

T = "```"
JSON_CASES = [
    ('{"S1":"a","S2":"b","S3":"c"}', {"S1": "a", "S2": "b", "S3": "c"}, "braces"),
    (T + 'json\n{"input":"a","positive_document":"b"}\n' + T, {"input": "a", "positive_document": "b"}, "json_fence"),
    (T + '\n{"input":"a"}\n' + T, {"input": "a"}, "fence"),
    (T + 'python\n{"input":"a"}\n' + T, {"input": "a"}, "python_fence"),
    ('{"input":"a","positive_document":"b",}', {"input": "a", "positive_document": "b"}, "repaired_braces"),
    (T + '{"a":[1, {"b":2}, ], }' + T, {"a": "b"}, "quoted_pairs"),
    (T + '{"a":"1", }' + T, {"a": "1"}, "repaired_fence"),
    ('{"input":"a {x} b","positive_document":"c"}', {"input": "a {x} b", "positive_document": "c"}, "quoted_pairs"),
    ('{"input":"a","meta":{"k":"v"},"positive_document":"b"}', None, "none"),
    (T + "null" + T + ' {"input":"a"}', "null", "fence"),
    (T + "[1,2]" + T, [1, 2], "fence"),
    (T + "x" + T + " then " + T + "5" + T, 5, "fence"),
    ('{"input":"say \\"hi\\"","positive_document":"x" oops}', {"input": 'say \\"hi\\"', "positive_document": "x"}, "quoted_pairs"),
    ("no json here", None, "none"),
    ('{"a":"1"} and {"b":"2"}', {"a": "1"}, "braces"),
    ('{bad} {"b":"2"}', {"b": "2"}, "braces"),
    ('{"a":"1","a":"2"}', {"a": "2"}, "braces"),
    ('"k":"1" "k":"2"', {"k": "2"}, "quoted_pairs"),
    ('{"input":"line1\nline2","positive_document":"b"}', {"input": "line1\nline2", "positive_document": "b"}, "quoted_pairs"),
    (T + '{"a":1} tail' + T, {"a": 1}, "braces"),
    ("", None, "none"),
    ("{" * 300, None, "none"),
]


def test_first_json(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(JSON_CASES)], "id int, output string")
    found = read_json(df).select("id", "parse_branch", F.to_json("parsed").alias("v")).collect()
    got = {r.id: (None if r.v is None else "null" if r.v == "null" else json.loads(r.v), r.parse_branch) for r in found}
    assert got == {i: (c[1], c[2]) for i, c in enumerate(JSON_CASES)}
    kept = {r.id for r in collect_json(df).collect()}
    assert kept == {i for i, c in enumerate(JSON_CASES) if c[1] not in (None, "null")}


def test_rows_without_output_are_skipped(spark):
    df = spark.createDataFrame([(1, None), (2, "{}")], "id int, output string")
    assert [r.id for r in read_json(df).collect()] == [2]
    assert [r.id for r in read_ideas(df).collect()] == [2]


@pytest.mark.parametrize("text,valid", [
    ('{"a":"1"}', True), ("5", True), ("null", True), (" \n[1] ", True), ('"x"', True), ('{"a":"1"} xyz', False), ('{"a":1}]', False),
    ('{"a":1}}', False), ("1],[2", False), ("1,2", False), ("", False), ('json\n{"a":1}', False), ("{'a':1}", False), ('{"a":1,}', False),
])
def test_strict_json(spark, text, valid):
    df = spark.createDataFrame([(text,)], "s string").select(parse_strict(F.col("s")).alias("v"))
    assert df.select(F.col("v").isNotNull()).first()[0] is valid


IDEA_CASES = [
    ("['a', 'b']", ["a", "b"], "python_list"),
    ('["a", null]', ["a"], "json_list"),
    ('["a", null] then ["b", "c"]', ["b", "c"], "python_list"),
    ('Ideas: "foo" and " bar "', ["foo", "bar"], "quoted"),
    ("- one\n2. two\n• three\n- 4. four\nplain", ["one", "two", "three", "four"], "bullets"),
    ('["One. Two. Three"]', ["One", "Two", "Three"], "python_list"),
    ('["v1.0"]', ["v1", "0"], "python_list"),
    ('["a [b]", "c"]', ["a [b]", "c"], "quoted"),
    ("[]", [], "none"),
    ('["  ", "x"]', ["", "x"], "python_list"),
    ('[1, 0, "x"]', ["1", "x"], "python_list"),
    ('["a", "b",]', ["a", "b"], "python_list"),
    ('["a" "b", "c"]', ["ab", "c"], "python_list"),
    ("['it\\'s', \"x\"]", ["it's", "x"], "python_list"),
    ("['say \"hi\"', 'b']", ['say "hi"', "b"], "python_list"),
    ('[ "a",\n  "b"\n]', ["a", "b"], "python_list"),
    ("[True, None, 2.5, ['x'", [], "none"),
    ("[True, None, 2.5]", ["True", "2.5"], "python_list"),
    ('[true, "y"]', ["True", "y"], "json_list"),
    ('[""] "z"', ["]"], "quoted"),
    ("['']\n- z", ["z"], "bullets"),
    ('[x] ["a", "b"]', ["a", "b"], "python_list"),
    (" * uni \n١. zwei", ["uni", "zwei"], "bullets"),
    ("-no\n1.no\n- ", [], "none"),
    ("- only one. Here.", ["only one", "Here"], "bullets"),
    ('["\\ud800", "b"]', ["?", "b"], "python_list"),
    ("", [], "none"),
]


def test_ideas(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(IDEA_CASES)], "id int, output string")
    got = {r.id: (r.ideas, r.parse_branch) for r in read_ideas(df).collect()}
    for i, (reply, ideas, branch) in enumerate(IDEA_CASES):
        assert got[i] == (ideas, branch), reply
    assert {r.idea for r in distinct_ideas(df).collect()} == {x for c in IDEA_CASES for x in c[1]}


def test_long_list_does_not_exhaust_the_regex_stack(spark):
    reply = json.dumps([f"idea {i}" for i in range(50_000)])
    df = spark.createDataFrame([(reply,), ("{" + "a" * 500_000 + "}",)], "output string")
    assert distinct_ideas(df).count() == 50_000
    assert read_json(df).count() == 2


def test_first_list(spark):
    cases = [('x ["a","b"] y', ["a", "b"]), ('["a",]', ["a"]), ('["a\tb"]', ["a b"]), (T + '{"k":1}' + T, {"k": 1}), ("none", None),
             ('[bad] ["c"]', ["c"]), (T + "null" + T + '["a"]', "null")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "id int, output string")
    found = read_list(df).select("id", F.to_json("parsed").alias("v")).collect()
    got = {r.id: None if r.v is None else "null" if r.v == "null" else json.loads(r.v) for r in found}
    assert got == {i: c[1] for i, c in enumerate(cases)}


def test_strip_and_blank(spark):
    texts = ["", " ", " x ", "\x1c a b \x1f\n", "x", "\t\n", "a  b", "​z"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for r in df.select("s", strip(F.col("s")).alias("t"), is_blank(F.col("s")).alias("b")).collect():
        assert r.t == r.s.strip() and r.b == (r.s.strip() == "")


def test_valid_utf8(spark):
    df = spark.createDataFrame([(b"ok \xff",)], "raw binary")
    assert df.select(valid_utf8(F.col("raw"))).first()[0] == "ok �"
