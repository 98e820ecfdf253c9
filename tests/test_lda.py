"""Topic model by variational Bayes against the same steps in plain numpy."""

import numpy as np
import pytest

from answerloom.operators import lda, tokens
from answerloom.plans import corpus as plans


def numpy_fit(counts, start, settings):
    """Batch variational Bayes on a dense count matrix (documents x words)."""
    lam = start.copy()
    for _ in range(settings.passes):
        weights = lda.expected_weights(lam, lam.sum(axis=0))
        stats = np.zeros_like(lam)
        for row in counts:
            held = np.flatnonzero(row)
            if len(held) == 0:
                continue
            _, add = lda.update_document(row[held], weights[held], settings.doc_prior)
            stats[held] += add
        lam = settings.word_prior + stats
    return lam


def small_corpus(spark):
    texts = ["apple banana fruit juice pear", "banana apple fruit fruit", "engine wheel motor", "motor engine brake wheel brake",
             "pear juice apple", "wheel wheel engine", "juice", ""] * 2
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, passage string")


def test_fit_equals_numpy(spark):
    documents = tokens.content_words(small_corpus(spark)).select("id", "tokens")
    vocabulary = tokens.vocabulary(documents, min_docs=1)
    words = lda.number_words(vocabulary)
    counts = lda.word_counts(tokens.bag_of_words(documents, words, "id"), words, "id")
    settings = lda.Settings(topics=3, passes=4, seed=7, tolerance=0.0)
    model = lda.fit(counts, words, settings)

    n_words = words.count()
    start = np.zeros((n_words, 3))
    for r in lda.initial_table(words, settings).collect():
        start[r.word] = r.lam
    dense = np.zeros((documents.count(), n_words))
    for r in counts.collect():
        dense[r.doc, r.word] = r.n
    want = numpy_fit(dense, start, settings)
    got = np.zeros_like(want)
    for r in model.table.collect():
        got[r.word] = r.lam
    assert np.allclose(got, want, rtol=1e-6, atol=1e-9)
    assert sorted(r.token for r in words.collect()) == [r.token for r in words.orderBy("word").collect()]


def test_a_pass_moves_a_word_once_a_block(spark):
    counts = spark.range(400).selectExpr("id % 100 AS doc", "id % 20 AS word", "1.0D AS n").distinct()
    words = spark.range(20).withColumnRenamed("id", "word")
    settings = lda.Settings(topics=2)
    documents, held = lda.lay_out(counts)
    table = lda.initial_table(words, settings)
    adds = lda.e_step(documents, held, table, lda._totals(table, 2), settings).collect()
    assert documents.count() == 100 and held.count() == len(adds) == 20  # one block of 100 documents
    assert sum(sum(r.add) for r in adds) == pytest.approx(counts.count())


def test_rows_without_document_stand_alone(spark):
    counts = spark.createDataFrame([(None, 0, 2.0), (None, 1, 1.0), (5, 0, 1.0), (5, 1, 1.0)], "doc long, word long, n double")
    documents, _ = lda.lay_out(counts)
    assert sorted((r.doc or 0, r.words) for r in documents.collect()) == [(0, [0]), (0, [1]), (5, [0, 1])]


def test_few_documents_of_unlike_length_step_as_one():
    rng = np.random.default_rng(3)
    lengths = np.array([200, 3, 40, 1])
    place = np.repeat(np.arange(4), lengths)
    counts, weights = rng.integers(1, 5, lengths.sum()).astype(float), rng.random((lengths.sum(), 3))
    gamma, add = lda.update_documents(place, counts, weights, 0.3)
    for i in range(4):
        alone, added = lda.update_document(counts[place == i], weights[place == i], 0.3)
        assert np.allclose(gamma[i], alone, rtol=1e-12) and np.allclose(add[place == i], added, rtol=1e-12)
    assert len(list(lda._alike(np.sort(lengths)))) == 1
    many = np.sort(rng.integers(1, 500, 3000))
    parts = list(lda._alike(many))
    assert [p.start for p in parts[1:]] == [p.stop for p in parts[:-1]] and (parts[0].start, parts[-1].stop) == (0, 3000)
    assert all(len(many[p]) * many[p].max() <= lda.GROUP_ROWS for p in parts)


def test_topics_separate(spark):
    described, leads = plans.topic_report(small_corpus(spark).withColumnRenamed("passage", "passage"), topics=2, passes=20)
    lead = {r.id: r.topic for r in leads.collect()}
    assert lead[0] == lead[1] == lead[4] != lead[2] == lead[3] == lead[5]
    assert lead[7] is None  # no words
    ranked = described.collect()
    assert {r.topic for r in ranked} == {0, 1}
    for topic in (0, 1):
        weights = [r.weight for r in sorted(ranked, key=lambda r: r.rank) if r.topic == topic]
        assert weights == sorted(weights, reverse=True)


def test_digamma():
    from math import lgamma

    x = np.array([0.01, 0.5, 1.0, 3.3, 10.0, 1e4])
    h = 1e-6
    numeric = np.array([(lgamma(v + h) - lgamma(v - h)) / (2 * h) for v in x])
    assert np.allclose(lda.digamma(x), numeric, rtol=1e-5)


def test_empty(spark):
    empty = spark.createDataFrame([], "id long, passage string")
    described, leads = plans.topic_report(empty, topics=2, passes=2)
    assert described.count() == 0 and leads.count() == 0
