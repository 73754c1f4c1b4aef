import corpus_pipeline
import pyarrow as pa
from pairsmith.llm import language_id
from pairsmith.llm.tables import written
from pairsmith.llm.text import slices
from pyspark.sql import functions as F
from test_duplicates import brute_components

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), "stage"))
    return out


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known, lined, single, clean, packed = stages(spark, docs)[1:]
    for step in (known, lined, single, clean):
        assert step.columns == docs.columns
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert ids(known) == {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert ids(lined) <= ids(known) and lined.where("text = ''").count() == 0
    found = brute_components({r.doc_id: r.text for r in lined.collect()})
    assert ids(single) == {k for k, (_, c) in found.items() if k == c}
    assert ids(clean) < ids(single) and ids(packed) == ids(clean)


def test_run_equals_its_stages(spark):
    rows = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))[-1])


def test_odd_rows(spark, odd, nothing):
    out = stages(spark, odd)
    assert all(df.columns == odd.columns for df in out[:-1])
    assert out[-1].select("doc_id").distinct().count() >= 3
    assert stages(spark, nothing)[-1].count() == 0


def test_languages_never_learnt_go_and_labelled_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = docs.join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id", "left_semi").select("doc_id", "text")
    strange = spark.createDataFrame([(-1, "жук ползёт по траве к дому"), (-2, "日本語の文章です"), (-3, "zqxj xqzj qqxz jzqx")], "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.keep_known_language(spark, clean.unionByName(strange), sf).select("doc_id").collect()}
    ids = {r.doc_id for r in clean.collect()}
    assert len(ids) > 200 and kept == ids


def test_a_worker_gives_back_what_a_task_needed(spark):
    texts = spark.range(8, numPartitions=2).select(F.lit("some words " * 100).alias("text"))

    def run(batches):
        held = lambda: next(int(x.split()[1]) // 1024 for x in open("/proc/self/status") if x.startswith("VmRSS"))
        for _ in slices(batches):
            before = held()
            rows = [[bytes(1000 + k % 7)] for k in range(100_000)]  # 100 MB in small blocks
            last = rows[-1]  # noqa: F841  keeps the end of the heap in use
            del rows
        yield pa.RecordBatch.from_arrays([pa.array([held() - before])], ["mb"])

    assert max(r.mb for r in texts.mapInArrow(run, "mb long").collect()) < 30


def test_language_ids_are_those_of_the_model_and_need_no_pandas(spark, odd):
    model = language_id.documents_model(spark, SF)
    found = language_id.tagged(odd, model)
    rows = [(r.row.text, r.lang_pred, r.score) for r in found.collect()]
    names, score = model.predict([t for t, _, _ in rows])
    assert [(n, s) for _, n, s in rows] == list(zip(names, score.tolist())) and len(rows) == odd.count()
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
