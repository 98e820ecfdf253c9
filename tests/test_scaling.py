"""Few pairs are scored in double precision, and an encoder runs once a row."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.operators import search, topk


def brute(queries, passages, k, metric):
    scores = topk.closeness(queries, passages, metric)
    return [
        (q, p, scores[q, p])
        for q in range(len(queries))
        for p in sorted(range(len(passages)), key=lambda p: (-scores[q, p], p))[:k]
    ]


@pytest.mark.parametrize("metric", ["IP", "L2"])
@pytest.mark.parametrize("scale", [1.0, 1e-12, 1e6, 1e19])
def test_shortlist_scores_few_pairs_in_double_precision(monkeypatch, metric, scale):
    rng = np.random.default_rng(5)
    passages = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, size=(3000, 1))
    passages[2000:2100] = passages[17]  # ties within and across slices
    queries = np.concatenate([rng.normal(size=(40, 16)), passages[15:20], np.zeros((2, 16))])
    passages, queries = passages * scale, queries * scale
    monkeypatch.setattr(topk, "GRID", 1e9 / scale**2)
    want = brute(queries, passages, 4, metric)
    monkeypatch.setattr(topk, "SLICE", 256, raising=False)
    cells = []
    plain = topk.closeness

    def counted(q, p, m):
        cells.append(len(q) * len(p))
        return plain(q, p, m)

    monkeypatch.setattr(topk, "closeness", counted)
    shortlist = topk.Shortlist(queries, 4, metric)
    for start in range(0, len(passages), 700):
        shortlist.add(pa.array(np.arange(start, min(start + 700, len(passages)))), passages[start : start + 700])
    got = list(zip(shortlist.rows, shortlist.ids, shortlist.scores))
    order = sorted(got, key=lambda h: (h[0], -h[2], h[1]))
    assert [(q, p) for q, p, _ in order] == [(q, p) for q, p, _ in want]
    if scale == 1.0 and metric == "L2":
        assert sum(cells) < len(queries) * len(passages) / 2


def counting_encoder(spark):
    seen = spark.sparkContext.accumulator(0)

    def vector(x):
        seen.add(1)
        return None if x is None else [float(x % 7), 1.0]

    made = F.udf(vector, T.ArrayType(T.DoubleType()))
    return seen, lambda df, key: df.select(key, made(F.col("x")).alias("embedding"))


@pytest.mark.parametrize("limit", [search.BROADCAST_BYTES, 0])
def test_an_encoder_runs_once_a_row(spark, monkeypatch, limit):
    monkeypatch.setattr(search, "few_queries", lambda q, few=search.few_queries: few(q, limit))
    rows = [(i, i if i % 5 else None) for i in range(60)]
    frame = spark.createDataFrame(rows, "pid long, x long")
    seen, encode = counting_encoder(spark)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "qid long, embedding array<double>")
    hits = search.search(queries, encode(frame, "pid"), 3).collect()
    assert [(r.qid, r.rank, r.pid) for r in sorted(hits)] == [(1, 1, 6), (1, 2, 13), (1, 3, 27)]
    assert seen.value == 60
