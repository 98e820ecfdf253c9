"""Texts are normalised and split once a row, and judge scores are worked out once."""

import pytest
from pyspark.sql import functions as F

from answerloom.catalog import queries
from answerloom.operators import judge, qa_metrics


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_answers_are_normalised_once_a_row(spark):
    rows = [("a", "1", "The red fox", "a red fox"), ("b", "1", "The red fox", "a red fox"), ("a", "2", None, None), ("a", "3", "red red", "blue red")]
    records = spark.createDataFrame(rows, "tag string, qid string, prediction string, gold string")
    scores = qa_metrics.scores_of_different(records)
    # One expression a side names the articles' pattern.
    assert plan(scores.drop("prediction", "gold")).count("(?:a|an|the)") == 2
    got = {(r.tag, r.qid): (round(r.f1, 6), r.em, round(r.squad_f1, 6), r.unknown) for r in scores.collect()}
    assert got == {
        ("a", "1"): (1.0, 100.0, 100.0, 0), ("b", "1"): (1.0, 100.0, 100.0, 0),
        ("a", "2"): (1.0, 100.0, 0.0, 0), ("a", "3"): (0.5, 0.0, 50.0, 0),
    }


def judge_rows(spark):
    rows = [("t", "1", "Which red fox", "a red Fox", ["red fox", "blue fox"], "red fox"), ("t", "2", "why", "so", ["fox"], None), ("t", "3", None, None, None, None)]
    return spark.createDataFrame(rows, "tag string, qid string, question string, answer string, contexts array<string>, ground_truth string")


def test_judge_texts_are_split_once_a_row(spark):
    scored = queries._overlap_metrics(judge_rows(spark))
    assert plan(scored.select("tag", "qid", *queries.fixed.JUDGE_METRICS)).count("regexp_extract_all") <= 5
    got = {r.qid: [r.faithfulness, r.context_precision, r.context_recall, r.answer_relevancy] for r in scored.collect()}
    assert got["1"] == pytest.approx([2 / 3, 2 / 3, 1.0, 2 / 3])
    assert scored.columns[:6] == judge_rows(spark).columns


def test_judge_scores_are_stored_before_they_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(queries, "_judge_rows", lambda spark, sf_dir: judge_rows(spark))
    seen = []
    monkeypatch.setattr(judge, "number_rows", lambda df, *a, **k: seen.append(plan(df) if "faithfulness" in df.columns else "Project [" + ", ".join(df.columns) + "]") or df.withColumn("_pos", F.lit(0)))
    queries._shards(spark, "", 2).collect()
    assert len(seen) == 1 and "regexp_extract_all" not in seen[0]
    rows = judge_rows(spark)
    monkeypatch.setattr(queries, "_judge_rows", lambda spark, sf_dir: rows)
    queries.batch_judge(spark, "").collect()
    assert seen[1].split("\n")[0] == "Project [tag, qid, question, answer]" and len(seen) == 2
