import numpy as np

from pairsmith.llm import language_id, quality
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = language_id.op3_language_id(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    right, n, low, high = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 200 and right > 0.98 and low >= 0 and high <= 1


def test_filters_hold_what_they_learnt(spark):
    docs = spark.createDataFrame([(i, t, k) for i in range(8) for t, k in (("the thing", "en"), ("das ding", "de"))], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    names, score = model.predict(["the thing", "das ding", "", None, "12!", "жук"])
    assert names[:2] == ["en", "de"] and names[2:5] == ["und"] * 3 and names[5] in ("en", "de")
    assert score[0] == 1 and score[2] == 0 and score[5] == 0


def test_more_languages_than_bits_of_a_word(spark):
    names = [f"l{k:02d}" for k in range(70)]
    docs = spark.createDataFrame([(i, chr(0x4E00 + 5 * k) * 6, n) for i in range(4) for k, n in enumerate(names)], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.masks.shape[1] == 2 and model.predict([chr(0x4E00 + 5 * k) * 6 for k in range(70)])[0] == names


def test_long_text_in_pieces_counts_as_whole(spark, odd):
    model = language_id.train(odd)
    text = "word and thing " * 200_000
    names, score = model.predict([text])
    assert len(language_id._pieces(text)) > 1 and 0 <= score[0] <= 1 and "".join(language_id._pieces(text)) == text


def test_odd_rows(odd, nothing):
    model = language_id.train(odd)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(odd, model).collect()}
    assert got[2] == got[3] == got[7] == got[9] == "und" and got[1] != "und"
    assert language_id.tagged(odd, model).select("row.*").columns == odd.columns
    empty = language_id.train(nothing)
    assert {r.lang_pred for r in language_id.identify(odd, empty).collect()} == {"und"}
    assert language_id.identify(nothing, model).count() == 0


def _labels(spark, ids):
    return spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id long, quality int, toxic int")


def test_probabilities_of_every_context_sum_to_one(spark):
    docs = spark.createDataFrame([(i, "abab abba baab" + "b" * i) for i in range(6)], "doc_id long, text string")
    entries = quality.model(docs)
    import numpy as np
    hashed = entries.mapInArrow(quality._hashed, quality.HASHED).toArrow()
    shard = quality.Shard(hashed)
    letters = sorted({c for r in entries.where("kind = 0 and level = 1").collect() for c in r.gram})
    for context in ["\x00\x00\x00\x00", "abab", "zzzz", "b ab"]:
        total = 0.0
        for c in [*letters, "￿"]:  # the last stands for all unknown ones
            codes = np.array([ord(x) for x in context + c], np.uint64)
            total += float(np.exp(shard.log_probability(codes, np.array([4])))[0])
        assert abs(total - 1) < 1e-9


def test_shards_add_up(spark, given, monkeypatch):
    docs = spark.createDataFrame([(i, t, "en") for i, t in list(given.items())[:60]], "doc_id long, text string, lang string")
    entries = quality.model(docs)
    one = {r.doc_id: r.perplexity for r in quality.perplexities(docs, entries).collect()}
    monkeypatch.setattr(quality, "SHARD_ENTRIES", entries.count() // 3)
    many = {r.doc_id: r.perplexity for r in quality.perplexities(docs, entries).collect()}
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-6 * one[k] for k in one)


def test_quality_parts_good_from_bad(spark):
    rows = quality.op2_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    kept = {r.quality: r.kept for r in rows.groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert kept[1] > 0.97 and kept[0] < 0.1


def test_quality_of_odd_rows(spark, odd, nothing):
    got = quality.judge(odd, _labels(spark, [1, 4, 5, 6, 8, 9, None]))
    assert got.count() == odd.count()
    assert {r.doc_id for r in got.where("perplexity is null").collect()} == {2, 3, 7} and got.where("perplexity is null and keep").count() == 0
    assert quality.judge(nothing, _labels(spark, [])).count() == 0
    assert quality.judge(odd, _labels(spark, [])).where("keep").count() == odd.count() - 3


def test_shards_give_every_row_back(spark, odd, monkeypatch):
    from collections import Counter
    rows = odd.select("doc_id", "text", "lang")
    docs = rows.unionByName(rows.where("doc_id is null")).unionByName(rows.where("doc_id = 6"))
    entries = quality.model(docs)

    def got():
        return Counter((r.doc_id, r.lang, r.characters, r.perplexity and round(r.perplexity, 6)) for r in quality.perplexities(docs, entries).collect())

    one = got()
    monkeypatch.setattr(quality, "SHARD_ENTRIES", entries.count() // 3)
    assert got() == one and sum(one.values()) == docs.count() and max(one.values()) == 4


def test_a_language_of_one_or_two_texts_is_learnt(spark):
    russian = ["жук ползёт по траве к дому", "вечером мы пойдём в кино"]
    for texts in (russian, russian[:1]):
        rows = [(i, f"the thing and that word number {i} of it all", "en") for i in range(40)] + [(100 + i, t, "ru") for i, t in enumerate(texts)]
        model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
        names, score = model.predict(texts)
        assert names == ["ru"] * len(texts) and min(score) > 0.9


def test_rows_without_an_id_are_judged_and_not_held_out(spark):
    rows = spark.createDataFrame([(None, "the thing"), (1, "the thing")], "doc_id long, text string")
    assert [r.h for r in rows.select(language_id.held_out().alias("h")).collect()] == [False, False]


def test_lookup_goes_straight_to_the_place():
    rng = np.random.default_rng(7)
    most = (1 << 64) - 1
    for h in (rng.integers(0, most, 50_000, np.uint64, endpoint=True), np.array([0, 5, most], np.uint64), np.array([7], np.uint64), np.zeros(0, np.uint64)):
        h = np.unique(h)
        value = rng.random(len(h))
        lookup = quality.Lookup(h[::-1], value[::-1])
        asked = np.concatenate([h, h + np.uint64(1), h - np.uint64(1), rng.integers(0, most, 1000, np.uint64, endpoint=True), np.array([0, most], np.uint64)])
        seen, got = lookup.find(asked)
        known = dict(zip(h.tolist(), value.tolist()))
        assert seen.tolist() == [x in known for x in asked.tolist()]
        assert got[seen].tolist() == [known[x] for x in asked.tolist() if x in known]
        if len(h) > 1000:  # a search begins close by, however many entries there are
            assert np.diff(lookup.begin).max() <= 12
