from collections import Counter

import corpus_pipeline
from barline.llm.mixing import mix


def test_stages_on_the_smallest_data(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    left = [docs.count()]
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, sf).cache()
        assert out.columns == columns
        assert out.exceptAll(docs).count() == 0
        left.append(out.count())
        docs = out
    assert all(a >= b for a, b in zip(left, left[1:])) and left[-1] > 0.5 * left[0]
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    expected = Counter({r.doc_id: r.copies for r in mix(docs.withColumn("doc_id", docs.doc_id)).collect() if r.copies})
    assert sum(r.taken for r in final) > 0 and {r.doc_id for r in final} <= {r.doc_id for r in docs.collect()}
    assert abs(sum(r.taken for r in final) - sum(c * len(r.text.encode().split()) for r in docs.collect() for c in [expected[r.doc_id]])) < 200


def test_run_is_the_stages(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 100


def test_stages_take_odd_rows(spark, sf, odd, none):
    for docs in (odd, none):
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, docs, sf)
            assert out.count() <= docs.count(), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
