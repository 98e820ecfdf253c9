"""Re-ranking, contexts, prompts, judging, reports and end-to-end runs."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from answerloom.functions import fixed_values as fixed
from answerloom.operators import (
    contexts, judge, numbering, prompts, qa_metrics, reports, rerank, scoring,
)
from answerloom.plans import evaluate, qa
from answerloom.sources import tables, vector_table

PASSAGES = ["red fox runs", "blue whale swims far", "red whale sings", "green tree"]


@pytest.fixture()
def corpus(spark):
    return spark.createDataFrame(list(enumerate(PASSAGES)), "pid long, passage string")


@pytest.fixture()
def questions(spark):
    rows = [(1, "which red fox", "red fox"), (2, "whale", "blue whale"), (3, "", "none")]
    return spark.createDataFrame(rows, "qid long, question string, answer string")


def test_confidence_and_gate(spark):
    rows = [(1, 1, 7, 0.7), (2, 1, 5, 0.88), (2, 2, 6, 0.9), (4, 1, 1, 0.5), (4, 2, 2, 0.5)]
    scored = spark.createDataFrame(rows, "qid int, rank int, pid int, rerank_score double")
    ranked = rerank.rerank(scored, 1)
    assert {(r["qid"], r["pid"]) for r in ranked.collect()} == {(1, 7), (2, 6), (4, 1)}
    asked = spark.createDataFrame([(i,) for i in range(1, 5)], "qid int")
    sure = rerank.confidence(asked, ranked).withColumn(
        "low", rerank.low_confidence(F.col("conf"), F.col("margin"))
    )
    got = {r["qid"]: (r["conf"], round(r["margin"], 6), r["low"]) for r in sure.collect()}
    assert got == {
        1: (0.7, 1e9 + 0.7, False), 2: (0.9, 0.02, True), 3: (0.0, 0.0, True), 4: (0.5, 0.0, True),
    }


def test_context_steps_in_order(spark):
    passages = spark.createDataFrame([(1, "same text"), (2, "other"), (3, "same text"), (4, "")], "pid long, passage string")
    records = spark.createDataFrame(
        [(1, [1, 9, 2, 3]), (2, [9]), (3, []), (4, None), (5, [4, 3, 1, 2])], "qid long, context_ids array<long>"
    )
    found = contexts.look_up_contexts(records, passages, cap=1, max_chars=4)
    assert {r["qid"]: r["contexts"] for r in found.collect()} == {1: ["same"], 2: [], 3: [], 4: [], 5: ["same"]}
    every = contexts.look_up_contexts(records, passages, cap=0)
    assert {r["qid"]: r["contexts"] for r in every.collect()}[5] == ["same text", "other"]
    first = contexts.join_first_context(records, passages)
    assert {r["qid"]: r["context_text"] for r in first.collect()} == {
        1: "same text", 2: None, 3: None, 4: None, 5: "",
    }


def test_prompt_layout_and_grid(spark):
    frame = spark.createDataFrame([("why?", [(4, "four"), (2, "two")])], "q string, c array<struct<pid:long,passage:string>>")
    text = frame.select(prompts.build_prompt(F.col("q"), F.col("c"), "Be kind.")).first()[0]
    assert text == "Be kind.\n\nContext:\n[4] four\n\n[2] two\n\nQuestion: why?\nAnswer:"
    grid = prompts.expand_grid(frame, a=(1, 2, 3), b=("x", "y"))
    assert {(r["a"], r["b"]) for r in grid.collect()} == {(a, b) for a in (1, 2, 3) for b in "xy"}
    assert "Join" not in grid._jdf.queryExecution().executedPlan().toString()
    assert prompts.first_rows(frame, 0, F.asc("q")).count() == 1


def test_interval(spark):
    def interval(values):
        frame = spark.createDataFrame([("t", float(v), 0) for v in values], "tag string, f1 double, unknown int")
        row = qa_metrics.comparison_rows(frame).first()
        return row["f1_mean"], row["f1_lo"], row["f1_hi"], row["em_mean"]

    assert interval([1]) == (1.0, 1.0, 1.0, None)
    assert interval([0, 1])[:3] == (0.5, 0.0, 1.0)
    values = [0.4, 0.5, 0.6, 0.55]
    half = 1.959963984540054 * np.std(values, ddof=1) / 2
    assert interval(values)[1] == pytest.approx(np.mean(values) - half)


def test_weighted_mean_uses_full_shard_sizes(spark):
    rows = [("t", 0, 1.0), ("t", 0, None), ("t", 1, 0.0), ("t", 2, float("nan")), ("t", 2, None)]
    scored = spark.createDataFrame(rows, "tag string, shard long, m double")
    row = judge.weighted_means(judge.shard_means(scored, ["m"]), ["m"]).first()
    assert (row["n"], round(row["m"], 4)) == (5, 0.6667)
    blank = spark.createDataFrame([("t", 0, None)], "tag string, shard long, m double")
    assert judge.weighted_means(judge.shard_means(blank, ["m"]), ["m"]).first()["m"] is None


def test_positions_hold_for_any_partitioning(spark):
    rows = [(i, "hot" if i % 3 else "cold") for i in range(997)]
    frame = spark.createDataFrame(rows, "v int, tag string")
    for parts in (1, 5):
        numbered = numbering.number_rows(frame.repartition(parts), [F.desc("v")], "pos", within="tag")
        for tag in ("hot", "cold"):
            got = {r["v"]: r["pos"] for r in numbered.filter(F.col("tag") == tag).collect()}
            assert got == {v: i for i, v in enumerate(sorted(got, reverse=True))}
    everything = numbering.number_rows(frame.repartition(5), [F.asc("v")])
    assert all(r["v"] == r["pos"] for r in everything.collect())


def test_best_row_and_report_tables(spark, tmp_path):
    columns = "tag string, n long, faithfulness double, context_precision double, context_recall double, answer_relevancy double, ctx_char_cap int, sample_n int, ctx_max_chars int"
    rows = [
        ("a", 200, None, 0.9, 0.9, 0.9, 0, 1, 1), ("a", 200, 0.1, 0.0, 0.0, 0.0, 0, 1, 1),
        ("a", 200, float("nan"), 1.0, 1.0, 1.0, 0, 1, 1), ("a", 100, 0.9, 0.9, 0.9, 0.9, 0, 1, 1),
        ("b", 101, 0.5, 0.5, 0.5, 0.5, 0, 1, 1), ("b", 300, 0.9, 0.9, 0.9, 0.9, None, 1, 1),
    ]
    best = evaluate.clean_report(spark.createDataFrame(rows, columns))
    assert [(r["tag"], r["faithfulness"]) for r in best.collect()] == [("b", 0.5), ("a", 0.1)]
    assert "sample_n" not in best.columns
    path = str(tmp_path / "report")
    reports.append_rows(spark.createDataFrame([("x", 1)], "tag string, n long"), path)
    reports.append_rows(spark.createDataFrame([("y", 0.5)], "tag string, f1 double"), path)
    merged = {r["tag"]: (r["n"], r["f1"]) for r in reports.read_report(spark, path).collect()}
    assert merged == {"x": (1, None), "y": (None, 0.5)}


def test_sources_round_trip(spark, tmp_path):
    texts = ['say "hi"\nthere', "comma, and 'quote'", "NA", "back\\slash"]
    frame = spark.createDataFrame([(i * 10, t) for i, t in enumerate(texts)], "id long, passage string")
    tables.write_csv(frame.coalesce(1), str(tmp_path / "csv"))
    loaded = tables.load_passages(spark, str(tmp_path / "csv"))
    assert [r["id"] for r in loaded.orderBy("id").collect()] == [0, 10, 20, 30]
    assert [r["passage"] for r in loaded.orderBy("id").collect()] == texts
    placed = tables.load_passages(spark, str(tmp_path / "csv"), id_mode="position")
    assert [(r["id"], r["passage"]) for r in placed.orderBy("id").collect()] == list(enumerate(texts))

    records = [
        {"qid": 4, "prediction": "p", "gold": "[285]"}, {"id": 7, "gold": ["x", "y"]},
        {"gold": None, "prediction": "NA"}, {"gold": float("nan")}, {"gold": []}, {"gold": 12},
    ]
    array = tmp_path / "a.json"
    array.write_text(json.dumps(records, indent=1))
    lines = tmp_path / "l.json"
    lines.write_text("\n".join(json.dumps(r) for r in records))
    for path, layout in ((array, "array"), (lines, "lines")):
        golds = [r["gold"] for r in tables.load_results(spark, str(path), layout).collect()]
        assert golds == ["[285]", "x", "", "", "", "12"]
    scores = evaluate.evaluate_answers(spark, str(array), "t", str(tmp_path / "rep"), layout="array")
    assert sorted(r["qid"] for r in scores.collect()) == ["2", "3", "4", "4", "5", "7"]
    assert reports.read_report(spark, str(tmp_path / "rep")).first()["n"] == 6
    single = tmp_path / "o.json"
    single.write_text('{"qid": 1}')
    with pytest.raises(ValueError):
        tables.load_results(spark, str(single), "array")


def test_vector_table(spark, tmp_path):
    rows = [
        (1, "ok", [1.0, 2.0], "x"), (None, "t", [1.0, 2.0], "x"), (3, "t" * 11, [1.0, 2.0], "x"),
        (4, "t", [1.0], "x"), (5, "t", None, "x"), (6, None, [1.0, 2.0], "x"),
    ]
    frame = spark.createDataFrame(rows, "id long, passage string, embedding array<double>, extra string")
    path = str(tmp_path / "vectors")
    with pytest.raises(ValueError):
        vector_table.write_vectors(frame, path, dim=2, max_chars=10)
    left = str(tmp_path / "rejects")
    vector_table.write_vectors(frame, path, dim=2, drop_if_exists=True, max_chars=10, rejects=left)
    assert sorted(r["problem"] for r in spark.read.parquet(left).collect()) == [
        "no id", "no passage", "no vector", "passage too long", "wrong dimension",
    ]
    vector_table.write_vectors(frame.drop("extra"), path, dim=2, max_chars=10, rejects=left + "2")
    stored = vector_table.read_vectors(spark, path)
    assert list(vector_table.vector_stats(stored).first()) == [2, 2, 2]
    assert ("embedding", "array<float>") in vector_table.describe_columns(stored)
    long = spark.createDataFrame([(1, "t" * 5000, [1.0, 2.0])], frame.drop("extra").schema)
    vector_table.write_vectors(long, path, dim=2, drop_if_exists=True)
    assert vector_table.read_vectors(spark, path).count() == 1


def test_baseline_and_reranked_runs(spark, corpus, questions):
    base = {r["qid"]: r for r in qa.answer_baseline(corpus, questions, top_k=2).collect()}
    assert set(base) == {1, 2, 3}
    assert base[1]["context_ids"][0] == 0 and len(base[1]["context_ids"]) == 2
    assert base[1]["prediction"].startswith("red fox runs") and base[1]["gold"] == "red fox"

    seen = []

    def generate(df):
        seen.append(df.filter(F.col("prompt").isNotNull()).count())
        return scoring.generate(df, lambda: lambda batch: [p.upper() for p in batch])

    run = qa.answer_reranked(corpus, questions, candidates=4, top_k=1, abstain=True, generate=generate)
    got = {r["qid"]: r for r in run.collect()}
    assert got[3]["low_conf"] and got[3]["prediction"] == fixed.ABSTAIN_ANSWER
    assert len(got[3]["context_ids"]) == 1
    assert not got[1]["low_conf"] and "QUESTION: WHICH RED FOX" in got[1]["prediction"]
    assert got[1]["conf"] == pytest.approx(2 / 3) and got[1]["margin"] == pytest.approx(1 / 3)
    assert seen == [sum(not r["low_conf"] for r in got.values())]
    open_run = qa.answer_reranked(corpus, questions, candidates=4, top_k=1)
    assert all(r["prediction"] != fixed.ABSTAIN_ANSWER for r in open_run.collect())


def test_sweep_tags_every_setting(spark, corpus, questions):
    records = qa.sweep(corpus, questions, top_ks=(1, 3), new_tokens=(2, 5))
    assert records.count() == 3 * 2 * 2 * 3
    lengths = {(r["tag"], len(r["context_ids"])) for r in records.collect()}
    assert ("top_3_new_5_cot", 3) in lengths and ("top_1_new_2_persona", 1) in lengths
    assert qa.sweep_report(records).count() == 12


def test_user_models(spark, corpus):
    texts = corpus.unionByName(spark.createDataFrame([(9, None)], "pid long, passage string"))
    encoder = lambda: lambda batch: np.array([[len(t), 3.0] for t in batch], dtype="float32")
    raw = scoring.embed_texts(texts, "passage", encoder, normalize=False, batch_size=2)
    assert {r["pid"]: r["embedding"][0] for r in raw.collect()} == {
        **{i: len(p) for i, p in enumerate(PASSAGES)}, 9: 0,
    }
    for row in scoring.embed_texts(texts, "passage", encoder).collect():
        assert np.linalg.norm(row["embedding"]) == pytest.approx(1.0)
    counted = scoring.count_tokens(corpus, "passage", lambda: lambda batch: [t.split() for t in batch])
    assert {r["pid"]: r["tok_est"] for r in counted.collect()}[1] == 4
    tagger = lambda: lambda batch: [([(t[:3], "HEAD")], 2, {"X": 2}) for t in batch]
    tagged = {r["pid"]: r for r in scoring.tag_documents(texts, "passage", tagger).collect()}
    assert tagged[0]["entities"][0]["text"] == "red" and tagged[0]["pos_counts"] == {"X": 2}
    assert tagged[9]["entities"] == [] and tagged[9]["token_count"] == 0


def test_judged_run_survives_failing_shards(spark, corpus, tmp_path):
    rows = [(i, f"question {i}", "bad" if i == 3 else "fine", "gold", [i % 4, 99]) for i in range(7)]
    rows += [(7, "q", "", "gold", [1]), (8, "q", "a", "gold", [99])]
    records = spark.createDataFrame(
        rows, "qid long, question string, prediction string, gold string, context_ids array<long>"
    )

    def make():
        def score(batch: pd.DataFrame) -> pd.DataFrame:
            if (batch["answer"] == "bad").any():
                raise RuntimeError("judge is down")
            return pd.DataFrame({"faithfulness": [1.0] * len(batch), "context_recall": ["n/a"] * len(batch)})

        return score

    summary, scored = evaluate.judge_answers(
        records, corpus, make, "run", batch=2, report=str(tmp_path / "r"), scores_path=str(tmp_path / "s")
    )
    row = summary.first()
    assert (row["n"], row["faithfulness"], row["context_recall"]) == (7, 1.0, None)
    assert scored.filter(F.col("error").isNotNull()).count() == 2
    assert reports.read_report(spark, str(tmp_path / "r")).first()["judge"] == "judge"
    assert spark.read.parquet(str(tmp_path / "s")).filter("tag = 'run'").count() == 7
    with pytest.raises(ValueError):
        evaluate.judge_answers(records.filter("qid >= 7"), corpus, make, "none")


def test_results_do_not_depend_on_shuffle_partitions(spark, corpus, questions):
    def rows():
        return sorted(map(str, qa.answer_reranked(corpus, questions, candidates=3, top_k=2).collect()))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = rows()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert rows() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
