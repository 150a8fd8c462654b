import math

import numpy as np
from pyspark.sql import functions as F

from barline.llm import lm_scoring
from barline.llm.lm_scoring import Classes, lm_scores, train, window_counts
from barline.llm.quality import Network, held_out, pooled, quality_scores


def test_window_counts_and_scores_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = docs.withColumnRenamed("doc_id", "id")
    words = lm_scoring.frequent_words(rows, 20)
    counts = window_counts(rows, words, 5)
    texts = {r.id: r.text.encode().lower().split() for r in rows.collect()}
    known, expected = Classes(words, 5), np.zeros((26 * 26, 26))
    for tokens in texts.values():
        ids = [0, *(known[t] for t in tokens), 0]
        for left, token, right in zip(ids, ids[1:], ids[2:]):
            expected[left * 26 + right, token] += 1
    assert (counts == expected).all()
    logs = train(counts, steps=40)
    assert np.allclose(np.exp(logs).sum(1), 1, atol=1e-4)
    unigram = counts.sum(0) / counts.sum()
    cross = lambda p: -(counts * p).sum() / counts.sum()
    assert cross(logs) < cross(np.log(unigram + 1e-12)[None, :]) - 0.01
    got = {r.doc_id: r for r in lm_scores(docs, classes=26, buckets=5, trainer=lambda c: train(c, steps=40)).collect()}
    for i, tokens in texts.items():
        ids = [0, *(known[t] for t in tokens), 0]
        total = sum(float(logs[a * 26 + c, b]) for a, b, c in zip(ids, ids[1:], ids[2:]))
        assert got[i].n_tokens == len(tokens) and math.isclose(got[i].log_likelihood, total, rel_tol=1e-5, abs_tol=1e-5)


def test_language_model_odd_rows(odd, none):
    got = lm_scores(odd, classes=16, buckets=4)
    assert got.count() == odd.count()
    assert got.filter("doc_id in (4, 5, 6) and (n_tokens > 0 or log_likelihood <> 0 or perplexity is not null)").count() == 0
    assert lm_scores(none, classes=16, buckets=4).count() == 0


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 1000 and (held.predicted == held.quality).mean() > 0.985
    assert ((got.score >= 0) & (got.score <= 1)).all()
    # Calibrated: among held-out rows the mean score is near the share of good labels.
    assert abs(held.score.mean() - held.quality.mean()) < 0.03


def test_labels_of_held_out_rows_are_never_learned(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_scores(docs, x).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (8, 1), (7, 0), (5, None), (None, 1)], "doc_id long, quality int")
    got = quality_scores(odd, labels)
    assert got.count() == odd.count() and got.filter("score is null or score < 0 or score > 1 or held_out is null").count() == 0
    empty = got.filter("doc_id in (4, 5, 6)").select("score").distinct()
    assert empty.count() == 1
    assert {r.score for r in quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(none, labels).count() == 0


def test_network_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = (rng.random(3000) < 1 / (1 + np.exp(-3 * x[:, 0]))).astype(float)
    network = Network(x, y)
    fresh = rng.normal(size=(3000, 4))
    scores, truth = network.scores(fresh), 1 / (1 + np.exp(-3 * fresh[:, 0]))
    assert np.abs(scores - truth).mean() < 0.06
    assert not pooled(np.array([], np.int64), np.ones((3, 2))).any()


def test_every_frequent_word_has_its_own_probability_and_rare_ones_go_by_their_letters(spark):
    words = [f"wort{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)]
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(words[k] for k in rng.permutation(600)[:200])) for i in range(60)]
    # Far beyond the 95 most frequent words: one three times as frequent as another, after the same neighbours.
    rows += [(1000 + i, "worta zzoft wortb") for i in range(90)] + [(2000 + i, "worta zzfew wortb") for i in range(30)]
    rows += [(4000 + i, f"haus{chr(97 + i // 20)}{chr(97 + i % 20)}") for i in range(400)]
    rows += [(3000, "worta haustor wortb"), (3001, "worta \x01\x02\x03#%~^ wortb"), (3002, ""), (3003, None)]
    got = {r.doc_id: r for r in lm_scoring.word_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows) and all(math.isfinite(r.log_likelihood) and r.log_likelihood <= 0 for r in got.values())
    assert got[1000].log_likelihood > got[2000].log_likelihood + 0.5
    assert got[3000].log_likelihood > got[3001].log_likelihood + 5
    assert got[3003].n_tokens == got[3002].n_tokens == 0 and got[3002].perplexity is None


def test_word_scores_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in lm_scoring.word_scores(docs).collect()}
    dealt = {r.doc_id: r for r in lm_scoring.word_scores(docs.repartition(5, "doc_id")).collect()}
    for r in docs.collect():
        assert got[r.doc_id].n_tokens == len((r.text or "").encode().lower().split())
        assert math.isclose(got[r.doc_id].log_likelihood, dealt[r.doc_id].log_likelihood, rel_tol=1e-4, abs_tol=1e-3)


def test_the_window_reaches_two_tokens(spark):
    # The middle word follows from the second neighbours only.
    rows = [(i, "aa x b1 y cc" if i % 2 else "dd x b2 y ee") for i in range(400)]
    rows += [(500, "aa x b2 y cc"), (501, "dd x b1 y ee")]
    got = {r.doc_id: r.log_likelihood for r in lm_scoring.word_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] > got[500] and got[0] > got[501]


def test_word_scores_of_odd_rows(odd, none):
    got = lm_scoring.word_scores(odd)
    assert got.count() == odd.count()
    assert got.filter("doc_id in (4, 5, 6) and (n_tokens > 0 or log_likelihood <> 0 or perplexity is not null)").count() == 0
    assert lm_scoring.word_scores(none).count() == 0


def test_word_gradients_by_hand(spark):
    """Summed over tokens one by one; rows in four and in eight bytes."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcdefgh"), n)) for n in (1, 2, 3, 40, 0, 7)] + ["a " * 70_000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    words = [bytes([c]) for c in b"abcdef"]
    known = lm_scoring.Vocabulary(words, np.full(6, 9), 5, 6, 2)
    size, hidden = known.classes, 5
    expected, slope = (rng.normal(0, 1, (size * size, hidden)).astype(np.float32) for _ in range(2))
    weights = (1000 * rng.normal(0, 1, (size, hidden))).astype(np.float32)
    context = spark.sparkContext
    got = lm_scoring._word_gradients(docs, context.broadcast(known), context.broadcast((expected, slope, weights)))
    want = np.zeros(got.shape)
    for text in texts:
        line = [0, 0, *(known.number.get(w.encode(), known.rare) for w in text.split()), 0, 0]
        kinds = known.kind[line]
        for t in range(2, len(line) - 2):
            pair = kinds[t - 1] * size + kinds[t + 1]
            back = (expected[pair].astype(float) - weights[kinds[t]]) * slope[pair]
            for k, o in enumerate(lm_scoring.PLACES):
                want[k, line[t + o]] += back
    assert np.abs(want * lm_scoring.UNIT).max() > 1 << 31
    np.testing.assert_allclose(got, want, rtol=1e-4, atol=1e-2)


def test_packed_sums_round_trip():
    rows = np.array([[0, -1, 5], [1 << 31, -(1 << 40), 3], [(1 << 31) - 1, 7, 0]])
    back = np.zeros_like(rows)
    for at, part in lm_scoring._unpacked(lm_scoring._packed(rows), 3):
        back[at] = part
    assert (back == rows).all()
