import json
import os

import pytest
from pyspark.sql import functions as F

from pairsmith.plans.postprocessors import postprocessor, register_postprocessor
from pairsmith.session import materialise, prepare, scratch
from pairsmith.sources.files import is_complete, read_csv, read_jsonl, run_step, write_json_array, write_table
from pairsmith.sources.value_list import read_value_list

TEXTS = ["plain", 'quote " and \\ slash', "line\nbreak\r\nend", " padded ", "", "ü • 漢", "comma, [x] {y}", None]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")


def joined_parts(folder):
    names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    return "".join(open(os.path.join(folder, n), encoding="utf-8", newline="").read() for n in names)


def test_jsonl(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_table(table, path, "jsonl", order_by=["id"])
    assert sorted(read_jsonl(spark, path, table.schema).collect()) == sorted(table.collect())
    lines = [json.loads(x) for x in joined_parts(path).splitlines()]
    assert {"id": 7, "text": None} in lines
    (tmp_path / "bad").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path / "bad"), table.schema).collect()


def test_csv(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_table(table, path, "csv")
    assert {tuple(r) for r in read_csv(spark, path, table.schema).collect()} == {tuple(r) for r in table.collect()}
    nested = table.select("id", F.array("id").alias("a"))
    write_table(nested, path, "csv")
    assert "[3]" in {r.a for r in read_csv(spark, path, "id long, a string").collect()}
    write_table(table.where("false").coalesce(1), path, "csv")
    assert read_csv(spark, path, table.schema).count() == 0


def test_json_array(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_table(table.repartition(5), path, "json", order_by=["id"])
    assert json.loads(joined_parts(path)) == [{"id": i, "text": t} for i, t in enumerate(TEXTS)]
    words = table.where("text is not null").select("text")
    write_json_array(words.repartition(3), path)
    expected = sorted((t for t in TEXTS if t is not None), key=lambda t: t.encode())
    assert json.loads(joined_parts(path)) == expected
    values = read_value_list(spark, path)
    assert [r.value for r in values.df.orderBy("idx").collect()] == expected and len(values) == len(expected)
    write_json_array(words.where("false"), path)
    assert json.loads(joined_parts(path)) == [] and len(read_value_list(spark, path)) == 0


def test_steps(spark, table, tmp_path):
    path = str(tmp_path / "t")
    built = []

    def build():
        built.append(1)
        return table

    with pytest.raises(ValueError):
        run_step(spark, build, path, "xml")
    assert not built and not os.path.exists(path)
    os.makedirs(path)  # left by a failed write: no success mark
    assert not is_complete(spark, path)
    assert run_step(spark, build, path) is not None and is_complete(spark, path)
    assert run_step(spark, build, path) is None and len(built) == 1
    assert run_step(spark, build, path, overwrite=True) is not None and len(built) == 2
    assert run_step(spark, build).count() == len(TEXTS)


def test_a_block_deletes_its_own_tables_only(spark, table):
    at = lambda df: df.inputFiles()[0].removeprefix("file://")
    before = materialise(table, "kept")
    with scratch(spark):
        inside = materialise(table, "gone")
        path = at(inside)
        assert inside.count() == len(TEXTS) and os.path.exists(path)
    assert not os.path.exists(path) and before.count() == len(TEXTS)


def test_only_arrays_are_value_lists(spark, tmp_path):
    path = tmp_path / "list.json"
    path.write_text('["a", true, "true", 1, 2.5, null]')
    assert [r.value for r in read_value_list(spark, str(path)).df.orderBy("idx").collect()] == ["a", "True", "true", "1", "2.5", "None"]
    path.write_text('{"a": 1}')
    with pytest.raises(ValueError):
        read_value_list(spark, str(path))


def test_postprocessors(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, '{"input":"a","positive_document":"b"}'), (2, '["x","y"]')], "id long, output string")
    assert {r.idea for r in df.where("id = 2").transform(postprocessor("brainstorming")).collect()} == {"x", "y"}
    assert df.transform(postprocessor("json")).count() == 2  # two quoted strings are a key and its value
    assert df.transform(postprocessor("synthetic_embeddings_data", data_type="long_long")).first().query == "a"
    with pytest.raises(ValueError):
        postprocessor("nobody")
    register_postprocessor("count", lambda: lambda t: t.groupBy().count())
    assert df.transform(postprocessor("count")).first()[0] == 2


def test_table_of_json_values(spark, tmp_path):
    fence = "`" * 3
    replies = ['{"a":"1","b":[1,null]}', f"{fence}[1,2]{fence}", "nothing", f'{fence}"s"{fence}']
    df = spark.createDataFrame(list(enumerate(replies)), "id long, output string")
    values = df.transform(postprocessor("json"))
    expected = sorted(['{"a":"1","b":[1,null]}', "[1,2]", '"s"'])
    path = str(tmp_path / "t")
    write_table(values, path, "jsonl")
    assert sorted(joined_parts(path).splitlines()) == expected
    write_table(values, path, "json")
    assert sorted(json.dumps(v, separators=(",", ":")) for v in json.loads(joined_parts(path))) == expected
    write_table(values, path, "csv")
    assert {r.parsed for r in read_csv(spark, path, "parsed string").collect()} == set(expected)


def test_an_array_on_one_line_is_read_in_splits(spark, tmp_path):
    """As the line form is, wherever the splits fall."""
    import json
    import random

    from pairsmith.sources.value_list import read_value_list

    rng = random.Random(2)
    values = ["".join(rng.choice('a,"\\\\é[]{} \\n') for _ in range(rng.randint(0, 12))) for _ in range(300)] + [5, 1.5, True, None, "true", "x" * 900]
    rng.shuffle(values)
    expected = [{True: "True", None: "None"}.get(v, str(v)) if not isinstance(v, str) else v for v in values]
    for name, separators, ascii_only in (("a", (",", ":"), True), ("b", (", ", ": "), False)):
        (tmp_path / f"{name}.json").write_text(json.dumps(values, separators=separators, ensure_ascii=ascii_only), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        for name in "ab":
            assert spark.read.option("lineSep", ",").text(str(tmp_path / f"{name}.json")).rdd.getNumPartitions() > 4
            found = read_value_list(spark, str(tmp_path / f"{name}.json"))
            assert len(found) == len(values) and [r.value for r in found.df.orderBy("idx").collect()] == expected
        (tmp_path / "lines.json").write_text(json.dumps(values, indent=1), encoding="utf-8")
        found = read_value_list(spark, str(tmp_path / "lines.json"))
        assert len(found) == len(values) and [r.value for r in found.df.orderBy("idx").collect()] == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_an_array_is_sorted_and_written_once(spark, tmp_path):
    import json

    from pairsmith.sources.files import write_json_array

    for n in (0, 1, 2, 5000):
        path = tmp_path / f"n{n}"
        write_json_array(spark.range(n).selectExpr("cast(id % 17 as string) as a", "id").repartition(5), str(path), order_by=["id"])
        text = "\n".join(p.read_text() for p in sorted(path.glob("part-*")))
        assert [r["id"] for r in json.loads(text)] == list(range(n))
