"""Corpus cleaning, summaries, tokens and topics on small hand-made tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.operators import corpus, profile, tokens, topics
from answerloom.plans import corpus as plans


def passages(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, passage string")


def test_no_copy_of_a_group_stays(spark):
    frame = passages(spark, ["A b!", "a  B", "c", "d d d"])
    assert [r["id"] for r in corpus.drop_all_copies(frame).orderBy("id").collect()] == [2, 3]
    assert list(corpus.count_copies(frame).first()) == [4, 2, 2]
    prepared = plans.prepare_corpus(frame.union(passages(spark, [None])))
    assert [r["id"] for r in prepared.collect()] == [3]


def test_a_hot_group_of_copies_is_combined_before_the_shuffle(spark):
    frame = passages(spark, ["same text"] * 500 + [f"text {i}" for i in range(500)])
    assert corpus.drop_all_copies(frame.repartition(4)).count() == 500
    plan = corpus.drop_all_copies(frame)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("shape", ["small", "ties", "large"])
def test_summary_equals_pandas(spark, shape):
    rng = np.random.default_rng(3)
    values = {
        "small": np.array([4.0, 1.0, np.nan, 2.5]),
        "ties": rng.integers(0, 4, 5000).astype(float),
        "large": np.concatenate([rng.normal(size=250_000), [1e9]]),
    }[shape]
    frame = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(7)
    row = profile.describe(frame, ["v"]).first()
    want = pd.Series(values).describe()
    assert row["n"] == want["count"]
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max")]:
        assert row[ours] == pytest.approx(want[theirs])
    for ours, theirs in [("p25", "25%"), ("p50", "50%"), ("p75", "75%")]:
        assert row[ours] == pytest.approx(want[theirs], rel=1e-12)


def test_histogram_equals_numpy(spark):
    for values in ([1, 1, 2, 7, 11], [5, 5], list(range(101))):
        frame = spark.createDataFrame([(v,) for v in values], "v int")
        rows = profile.histogram(frame, "v").orderBy("bin").collect()
        counts, edges = np.histogram(values, bins=10)
        assert [r["n"] for r in rows] == list(counts)
        assert [r["bin_from"] for r in rows] == pytest.approx(list(edges[:-1]))


def test_tag_and_label_counts(spark):
    frame = spark.createDataFrame(
        [({"NOUN": 2, "VERB": 1}, [("Rome", "GPE"), ("Bob", "PERSON")]), ({"VERB": 4}, [("Ann", "PERSON")]), ({}, [])],
        "pos map<string,int>, entities array<struct<text:string,label:string>>",
    )
    assert [tuple(r) for r in profile.count_tags(frame, "pos").collect()] == [("VERB", 5), ("NOUN", 2)]
    assert [tuple(r) for r in profile.count_labels(frame, "entities").collect()] == [("PERSON", 2), ("GPE", 1)]


def test_words_vocabulary_and_bags(spark):
    frame = passages(spark, ["The cat9 sat. Cats sat on cat", "cat and dog", "dog cat bird", "cat", "go"])
    words = tokens.content_words(frame)
    assert [r["tokens"] for r in words.orderBy("id").collect()][0] == ["sat", "cats", "sat", "cat"]
    kept = tokens.vocabulary(words, max_share=0.8)
    assert [tuple(r) for r in kept.collect()] == [("cat", 4), ("dog", 2)]
    assert [tuple(r) for r in tokens.vocabulary(words, max_share=0.79).collect()] == [("dog", 2)]
    assert [tuple(r) for r in tokens.vocabulary(words, keep=1).collect()] == [("cat", 4)]
    bags = tokens.bag_of_words(words, tokens.vocabulary(words, min_docs=1, max_share=1.0))
    assert ("sat", 2) in {(r["token"], r["n"]) for r in bags.filter("id = 0").collect()}


def test_leading_topic(spark):
    schema = T.StructType([T.StructField("d", VectorUDT())])
    frame = spark.createDataFrame(
        [(Vectors.dense([0.2, 0.5, 0.3]),), (Vectors.dense([0.4, 0.4, 0.2]),), (Vectors.dense([0.05, 0.02]),)],
        schema,
    )
    leads = [tuple(r[0]) for r in frame.select(topics.leading_topic(F.col("d"))).collect()]
    assert leads == [(1, 0.5), (0, 0.4), (None, 0.0)]


def test_topic_report(spark):
    texts = ["apple banana fruit juice", "banana apple fruit", "engine wheel motor", "motor engine brake wheel"] * 3
    described, leads = plans.topic_report(passages(spark, texts), topics=2, passes=5)
    assert leads.count() == len(texts)
    shares = [r["share"] for r in leads.collect()]
    assert all(0.1 <= share <= 1 for share in shares)
    assert {r["topic"] for r in described.collect()} == {0, 1}
