import numpy as np

from docquill.llm import catalog, language
from docquill.llm.common import held_out
from tests.conftest import SF, SF_SMALL


def test_held_out_accuracy_and_clean_documents_kept(spark, sf):
    rows = catalog.QUERIES["op5_language_centroids"](spark, SF).collect()
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    own = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in own]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert not [r for r in rows if r.rejected and any(c.isalpha() for c in truth[r.doc_id][1] or "")]


def test_far_texts_are_rejected_and_odd_ones_defined(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = language.fit(docs.where(~held_out()))
    far = "Съешь же ещё этих мягких французских булок да выпей чаю и подумай о погоде на завтра. " * 5
    found = model.predict([far, None, "", "12 -- 34", "the and of that", "x" * 3_000_000])
    assert found[0][3] and found[0][0] in model.languages
    assert [f[0] for f in found[1:4]] == ["und"] * 3 and all(f[1] == 0 and f[3] for f in found[1:4])
    assert found[4][0] == "en"
    odd = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "the", 2)], "doc_id int, text string, score int")
    rows = language.identify(odd, model, keep=["doc_id"]).collect()
    assert sorted(str(r.lang_pred) for r in rows)[-2:] == ["und", "und"]
    assert language.identify(odd.limit(0), model).count() == 0


def test_stretches_count_as_one_text(monkeypatch):
    text = "Ab c, déf gh1 " * 40
    whole = language.counts(text)
    monkeypatch.setattr(language, "_STRETCH", 17)
    assert (language.counts(text) == whole).all()


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, "abc", None)], "doc_id int, text string, lang string")
    assert language.fit(none).predict(["abc"]) == [("und", 0.0, 0.0, True)]
