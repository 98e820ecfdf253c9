"""Stages of the pipeline hand texts to Python in small batches."""

from answerloom.llm import exact_dedup, toxicity
from answerloom.shared import BATCH_BYTES, BATCH_SETTING


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    seen = []
    plain, scores = exact_dedup.build_index, toxicity.score
    monkeypatch.setattr(exact_dedup, "build_index", lambda *a, **k: seen.append(spark.conf.get(BATCH_SETTING)) or plain(*a, **k))
    monkeypatch.setattr(toxicity, "score", lambda *a, **k: seen.append(spark.conf.get(BATCH_SETTING)) or scores(*a, **k))
    before = spark.conf.get(BATCH_SETTING)
    rows = [(i, "good words " * 5 if i % 2 else "bad zorgnak words") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, toxic int")
    assert {r.keep_id for r in exact_dedup.exact_groups(docs).collect()} == {0, 1}
    kept = toxicity.drop_toxic(docs, labels)
    # The scores are stored under the setting: a frame run later would hand over large batches.
    assert "ArrowEvalPython" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.columns == docs.columns and {r.doc_id % 2 for r in kept.collect()} == {1}
    assert seen == [BATCH_BYTES] * 2 and spark.conf.get(BATCH_SETTING) == before != BATCH_BYTES
