import random

import numpy as np

from docquill.llm import catalog, toxicity
from tests.conftest import SF

CALM = "the tree grows near a quiet river where birds sing and people walk home in the evening light".split()
RUDE = ["idiot", "moron", "stupid"]


def sample(n, seed, rude):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        own = [rnd.choice(CALM) for _ in range(rnd.randrange(5, 80))]
        if i % 2:
            for _ in range(2):
                own.insert(rnd.randrange(len(own)), rnd.choice(rude))
        out.append((" ".join(own), i % 2))
    return out


def test_unseen_misspellings_are_found_in_long_texts():
    rows = sample(400, 1, RUDE)
    model = toxicity.train([t for t, _ in rows], np.array([y for _, y in rows]))
    scorer = toxicity.Scorer(model)
    own = [(scorer.score(t) >= 0.5) == bool(y) for t, y in sample(200, 2, ["idiott", "moronn", "stupidd"])]
    assert np.mean(own) > 0.85
    assert scorer.score(" ".join(CALM * 300 + ["idiot", "moron"] + CALM * 300)) >= 0.5 > scorer.score(" ".join(CALM * 600))
    assert scorer.score("") == scorer.score(" .,! ") == 0


def test_query_beats_the_share_of_clean_documents(spark, sf):
    rows = {r.doc_id: r for r in catalog.QUERIES["op6_subword_toxicity"](spark, SF).collect()}
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    rude = [d for d, t in docs.items() if rows[d].held_out and ("idiot" in t or "moron" in t)]
    assert np.mean([rows[d].predicted for d in rude]) > 0.5


def test_long_labelled_texts_are_learned_from(spark):
    docs = [(i, " ".join([t] * 40) if y else t, y) for i, (t, y) in enumerate(sample(300, 4, RUDE))]
    assert all(len(t) > 1000 for _, t, y in docs if y)
    df = spark.createDataFrame(docs, "doc_id int, text string, toxic int")
    scorer = toxicity.Scorer(toxicity.fit(df, df, max_chars=1000))
    assert scorer.score("the quiet river idiot moron") >= 0.5 > scorer.score("the quiet river where birds sing")


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "", 1), (3, "idiot " * 50_000, 1)], "doc_id int, text string, score int")
    rows = [(t, y) for t, y in sample(200, 3, RUDE)]
    model = toxicity.train([t for t, _ in rows], np.array([y for _, y in rows]))
    got = sorted((r.doc_id or 0, r.score >= 0.5) for r in toxicity.score(df, model, keep=["doc_id"]).collect())
    assert got == [(0, False), (1, False), (1, False), (3, True)]
    assert toxicity.score(df.limit(0), model).count() == 0
    one = spark.createDataFrame([(1, 1), (2, None), (3, 1)], "doc_id int, toxic int")
    assert not toxicity.fit(df, one).learned
