import numpy as np

from screenrank.llm import language
from screenrank.llm.catalogue import op2_language
from tests.conftest import SF_MID

SCHEMA = "doc_id long, text string, lang string, lang_pred int"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = op2_language(spark, SF_MID).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(rows) == 1000 and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_lang_is_no_input_of_a_prediction_and_odd_texts(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang").limit(300)
    detect = language.detector(language.train(docs))
    odd = spark.createDataFrame([(1, None, "en", 0), (2, "", "en", 0), (3, "123 ?!", "en", 0), (None, "日", None, 0),
                                 (5, "the and of " * 50_000, "fr", 0), (5, "the and of " * 50_000, None, 0)], SCHEMA)
    got = [(r.doc_id, r.p.lang_pred, r.p.score) for r in odd.select("doc_id", detect("text").alias("p")).collect()]
    assert got[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert got[3][1] != "und" and got[4][1:] == got[5][1:] and got[4][1] == "en"


def test_without_labels_with_one_language_and_empty(spark):
    none = spark.createDataFrame([(1, "some text", None, 0)], SCHEMA)
    detect = language.detector(language.train(none))
    assert none.select(detect("text").alias("p")).first().p.lang_pred == "und"
    one = spark.createDataFrame([(i, f"some text {i}", "xx", 0) for i in range(20)], SCHEMA)
    p = one.select(language.detector(language.train(one))("text").alias("p")).first().p
    assert (p.lang_pred, p.score) == ("xx", 1.0)
    assert none.limit(0).select(detect("text")).count() == 0


def test_machines_separate_and_families_come_first():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    y = np.where(x[:, 0] > 0.2, 1.0, -1.0)[:, None]
    w, b = language.fit_machines(x, y, steps=400)
    assert (np.sign(x @ w + b) == y).mean() > 0.97
    model = language.LanguageModel(x, [["en", "de", "fr"][i % 3] for i in range(300)])
    assert model.families == ["germanic", "romance"] and model.pairs == [(0, 1)]
    assert len(language._FAMILY) == sum(len(v.split()) for v in language.FAMILIES.values())


def test_a_fit_holds_its_sample_once():
    import tracemalloc

    x = np.random.default_rng(1).random((2000, language.WIDTH), dtype=np.float32)
    langs = [["en", "de", "fr"][i % 3] for i in range(2000)]
    tracemalloc.start()
    language.LanguageModel(x, langs, overwrite=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes / 2
