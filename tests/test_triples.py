import pytest
from pyspark.sql import functions as F

from pairsmith.operators.triples import judge, rejected, triples

REPLIES = "id long, sample map<string,string>, formatted_prompt string, output string"
TASK = {"task": "T"}
CASES = [
    ("short_long", '{"user_query":"q","positive_document":"p","hard_negative_document":"n"}', "p", TASK, ("T", "q", "p", "")),
    ("long_short", '{"input_text":"i","label":"l","misleading_label":"m"}', "p", TASK, ("T", "i", "l", "m")),
    ("sts", '{"S1":"1","S2":"2","S3":"3"}', "p", TASK, ("Retrieve semantically similar text.", "1", "2", "3")),
    ("bitext", '{"S1":"1","S2":"2","S3":"3"}', "p", None, ("Retrieve parallel sentences.", "1", "2", "3")),
    ("short_short", '{"input":"a","positive_document":"b"}', "This is a task: Find X: Y\nmore: z", None, ("Find X", "a", "b", "")),
    ("short_short", '{"input":"a","positive_document":"b"}', "Just do it\nnow", None, ("Just do it", "a", "b", "")),
    ("short_short", '{"input":"a","positive_document":"b"}', "task: \nx", None, ("", "a", "b", "")),
    ("long_long", '{"input":5,"positive_document":"b"}', "p", TASK, None),
    ("long_long", '{"input":"a"}', "p", TASK, None),
    ("long_long", '{"input":null,"positive_document":"b"}', "p", TASK, None),
    ("short_short", '{"input":"","positive_document":""}', "p", {"other": "x"}, ("p", "", "", "")),
    ("bitext_v2", '{"S1":"1","S2":"2","S3":"3"}', "p", None, ("Retrieve parallel sentences.", "1", "2", "3")),
    ("long_short", '{"input_text":"i","label":"l"}', "p", TASK, None),
]


def values(row):
    return (row.instruction, row.query, row.positive, row.negative)


@pytest.mark.parametrize("case", range(len(CASES)))
def test_one_type(spark, case):
    data_type, reply, prompt, sample, expected = CASES[case]
    df = spark.createDataFrame([(1, sample, prompt, reply)], REPLIES)
    assert [values(r) for r in triples(df, data_type).collect()] == ([expected] if expected else [])


def test_mixed_table(spark):
    rows = [(i, s, p, r, t) for i, (t, r, p, s, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, REPLIES + ", data_type string")
    got = {r.id: values(r) for r in triples(df).collect()}
    assert got == {i: c[4] for i, c in enumerate(CASES) if c[4]}


def test_unknown_types(spark):
    df = spark.createDataFrame([(1, None, "p", "{}", "foo")], REPLIES + ", data_type string")
    with pytest.raises(ValueError):
        triples(df, "foo")
    with pytest.raises(Exception, match="unknown data type"):
        triples(df).collect()


def test_foreign_rows_use_input_as_prompt(spark):
    df = spark.createDataFrame([("do: this\nnow", '{"input":"a","positive_document":"b"}')], "input string, output string")
    assert values(triples(df, "long_long").first()) == ("this", "a", "b", "")


def test_struct_sample(spark):
    df = spark.createDataFrame([(1, "p", '{"input":"a","positive_document":"b"}')], "id int, formatted_prompt string, output string")
    df = df.withColumn("sample", F.struct(F.lit("T").alias("task"), F.lit("en").alias("language")))
    assert values(triples(df, "long_long").first()) == ("T", "a", "b", "")


def test_every_reply_is_kept_or_rejected(spark):
    fence = "```"
    replies = ["none", f"{fence}null{fence}", f"{fence}[1]{fence}", f'{fence}"s"{fence}', '{"input":1}', '{"input":"a","positive_document":"b"}']
    df = spark.createDataFrame([(i, None, "p", r) for i, r in enumerate(replies)], REPLIES)
    judged = judge(df, "long_long")
    reasons = {r.id: r.reason for r in rejected(judged).collect()}
    assert reasons == {0: "no_json", 1: "json_null", 2: "not_object", 3: "not_object", 4: "bad_field"}
    assert [r.id for r in triples(df, "long_long").collect()] == [5]
