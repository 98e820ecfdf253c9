"""The rows that the toxicity fit hands to MLlib."""

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import types as T

from answerloom.llm import toxicity


def test_arrow_rows_are_sparse_vectors(spark):
    def rows(batches):
        for _ in batches:
            pass
        ends, places = np.array([0, 2, 2, 3], np.int32), np.array([1, 4, 0], np.int32)
        vectors = toxicity.sparse_vectors(5, ends, places, np.array([0.5, -2.0, 3.0]))
        yield pa.RecordBatch.from_arrays([vectors], names=["features"])

    got = spark.range(1).coalesce(1).mapInArrow(rows, T.StructType([T.StructField("features", VectorUDT())])).collect()
    assert [r.features for r in got] == [SparseVector(5, [1, 4], [0.5, -2.0]), SparseVector(5, [], []), SparseVector(5, [0], [3.0])]


def test_fit_needs_one_python_worker_a_task(spark, monkeypatch):
    plans = []

    class Learner(toxicity.LogisticRegression):
        def fit(self, rows, params=None):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return super().fit(rows, params)

    monkeypatch.setattr(toxicity, "LogisticRegression", Learner)
    texts = [(i, "vile words" if i % 2 else "kind words") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.scores(["vile"])[0] > 0.5 > model.scores(["kind"])[0]
    assert plans and "MapInArrow" in plans[0] and "BatchEvalPython" not in plans[0]


def test_a_bucket_seen_once_tells_little(spark):
    """Whatever the shares of the classes: 90 texts and 10."""
    rows = [(0, "plain words" + (" quux" if i == 0 else "")) for i in range(90)] + [(1, "plain words vile")] * 10
    bucket, ratio = toxicity._ratios(spark.createDataFrame(rows, "y int, text string"), 90, 10)[:2]
    of = dict(zip(bucket.tolist(), ratio.tolist()))
    once, often = (min(abs(of[b]) for b in toxicity.gram_buckets([t])[1]) for t in ("quux", "vile"))
    assert once < 0.2 < 1 < often
