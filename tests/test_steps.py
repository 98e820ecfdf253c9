"""What is left on disk of steps that have been stored."""

import os
import time

from pyspark.sql import functions as F

from answerloom.operators import search
from answerloom.plans import qa
from answerloom.shared import session_folder, write_through


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for root in folders for _, _, names in os.walk(root) for f in names if f.startswith("shuffle_")}


def test_a_stored_step_leaves_no_shuffle(spark):
    before = shuffle_files(spark)
    stored = write_through(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "counted")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert stored.count() == 10


def test_vectors_are_dropped_once_hits_are_stored(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "other"))
    passages = spark.createDataFrame([(i, f"word{i} common") for i in range(9)], "pid long, passage string")
    questions = spark.createDataFrame([(1, "word3"), (2, "word5 common")], "qid long, question string")
    folder = session_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    hits = qa.find_hits(passages, questions, 2, qa.word_encoder(), search.search_blocks)
    left = set(os.listdir(folder)) - before
    assert [name.split("-")[0] for name in left] == ["hits"]
    assert {(r.qid, r.pid) for r in hits.filter("rank = 1").collect()} == {(1, 3), (2, 5)}


def test_answers_in_rounds_equal_answers_at_once(spark, monkeypatch):
    passages = spark.createDataFrame([(i, f"word{i} common text number{i % 3}") for i in range(8)], "pid long, passage string")
    rows = [(q if q % 9 else None, f"word{q % 8} common", f"gold {q}") for q in range(40)] + [(3, "word5 text", "again")]
    questions = spark.createDataFrame(rows, "qid long, question string, answer string")
    counted, seen = qa._text_rounds, []
    monkeypatch.setattr(qa, "_text_rounds", lambda pairs, texts: seen.append(counted(pairs, texts)) or seen[-1])
    rounds = sorted(map(str, qa.answer_reranked(passages, questions, abstain=True).collect()))
    monkeypatch.setattr(qa, "_text_rounds", lambda pairs, texts: 1)
    assert rounds == sorted(map(str, qa.answer_reranked(passages, questions, abstain=True).collect()))
    assert seen[0] > 5  # eight texts are moved for forty questions
    none = questions.filter("false")
    monkeypatch.setattr(qa, "_text_rounds", counted)
    assert qa.answer_reranked(passages, none).count() == 0
    assert {r.prediction for r in qa.answer_reranked(passages.filter("false"), questions).collect()} == {""}
