from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import test_decontamination, test_exact, test_similar
from tests.llm.test_bpe import PLAIN


def brute(rows, items):
    """Ids that stay, in the order of the stages."""
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    rows = [r for r, b in zip(rows, test_exact.brute(rows), strict=True) if b[3]]
    rows = [r for r, (n, c) in zip(rows, test_similar.brute(rows), strict=True) if not n or r[0] == c]
    return {i: t for (i, t), (_, hit, _) in zip(rows, test_decontamination.brute([t for _, t in rows], items, 10), strict=True) if not hit}


def test_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = brute(docs, items)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert 0 < len(want) < len(docs)
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.ids == PLAIN.encode_ordinary(r.text) and r.n_tokens == len(r.ids) for r in got.values())


def test_stages_keep_columns_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    extra = {"score": F.lit(1.5), "_row": F.lit("x"), "spans": F.lit(None).cast("array<int>"), "rejected": F.lit(True), "id": F.lit(7)}
    odd = spark.createDataFrame([(None, "the and of that", None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (2, "the and " * 50_000, "en", "s", 1)], docs.schema)
    docs = docs.unionByName(odd).unionByName(odd).withColumns(extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_SMALL)
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SF_SMALL).count() == docs.count()
    assert last(spark, docs.limit(0), SF_SMALL).count() == 0
