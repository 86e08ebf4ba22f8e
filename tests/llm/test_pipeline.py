"""Every stage's decisions on a small table, and the whole run."""

import numpy as np

import corpus_pipeline
from motorpool.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_names_and_queries():
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "near_duplicates"
    assert sorted(QUERIES) == sorted(["pipeline", *(n for n in QUERIES if n.startswith("op"))])
    assert {n.split("_")[0] for n in QUERIES if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}


def test_stages_keep_columns_and_nulls(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = out
    assert docs.where("doc_id = 1000000").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_texts_far_from_all_languages_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(5)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz      "), n)) for n in (200, 2000, 20000)]
    far = [*noise, "Привет мир, это русский текст о погоде и людях.", "これは日本語の文章です。今日は天気がいいですね。", "Η γρήγορη αλεπού πηδά πάνω από τον σκύλο"]
    table = spark.createDataFrame([(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(far)], docs.schema)
    kept = {r[0] for r in corpus_pipeline.language_id(spark, docs.unionByName(table), SF).select("doc_id").collect()}
    assert not [i for i in kept if i >= 10**6]
    # Every given document is in a learned language, the held-out ones too.
    assert kept == {r[0] for r in docs.select("doc_id").collect()}


def test_run_is_the_stages_in_order(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert 0 < packed.select("doc_id").distinct().count() <= 200
