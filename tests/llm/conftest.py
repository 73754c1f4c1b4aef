import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def given(spark):
    """The given documents as {doc_id: text}."""
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, a repeated row, a row without an id, and columns with clashing names."""
    long = " ".join(f"word{i % 977} and{i}" for i in range(60_000))
    rows = [(1, "one two three four five six\nb line\nc line\nd line", "en"), (2, None, None), (3, "", "en"), (4, long, "en"),
            (5, "one two three four five six\nb line\nc line\nd line", "de"), (6, "x\ty", None), (6, "x\ty", None),
            (7, "  \n \n\n", "fr"), (None, "no id at all", "en"), (8, "é" * 3000, "fr"), (9, "123 456 !", "en")]
    data = [(i, t, lang, None, "key", 1, 2, 3) for i, t, lang in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, key string, row int, _drop int, n int")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
