"""The package on workers, stored steps, models in tasks, and sizes above former limits."""

import os
import subprocess
import sys
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from answerloom import shared
from answerloom.operators import reports, scoring, search, tokens
from answerloom.operators.topk import dense
from answerloom.plans import corpus as corpus_plans
from answerloom.plans import qa
from answerloom.sources import tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_run_from_a_foreign_folder(tmp_path):
    """Workers find the package although neither they nor the driver start in its folder."""
    code = f"""
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
rows = [(i, [float(i), 1.0]) for i in range(20)]
import os
from answerloom.operators import search
from answerloom.shared import ship_package
ship_package(spark)
q = spark.createDataFrame(rows, "qid long, embedding array<double>")
print("hits", search.search(q, q.withColumnRenamed("qid", "pid"), 2).count())
"""
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    told = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "hits 40" in told.stdout, told.stderr[-2000:]


def test_steps_lie_apart_and_can_be_dropped(spark):
    before = spark.sparkContext.getCheckpointDir()
    stored = shared.write_through(spark.range(5), "step")
    folder = shared.session_folder(spark)
    assert stored.count() == 5 and spark.sparkContext.getCheckpointDir() == before
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.exists(path)
    shared.drop_steps(spark)
    assert not files.exists(path)


def test_temporary_steps_go_and_kept_ones_stay(spark):
    with shared.temporary_steps(spark) as steps:
        gone = shared.write_through(spark.range(3), "gone")
        kept = steps.keep(gone.filter("id > 0"), "kept")
    assert kept.count() == 2
    with pytest.raises(Exception):
        spark.read.parquet(*gone.inputFiles()).count()


def test_one_judge_a_task(spark):
    rows = spark.range(0, 200, 1, 2).select(F.lit("t").alias("tag"), (F.col("id") % 40).alias("shard"))

    def make():
        name = float(uuid.uuid4().int % 10**9)
        return lambda batch: pd.DataFrame({"m": [name] * len(batch)})

    scored = scoring.judge_shards(rows.repartition(2, "shard"), make, ["m"])
    assert scored.select("m").distinct().count() <= scored.select(F.spark_partition_id()).distinct().count() <= 8


def test_every_row_is_encoded_once_for_a_stored_index(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def encode(df, text):
        @F.udf("array<double>")
        def vector(t):
            (log / uuid.uuid4().hex).write_text(t)
            return [float(len(t)), 1.0]

        return df.withColumn("embedding", vector.asNondeterministic()(F.col(text)))

    passages = spark.createDataFrame([(i, "p" * (i + 1)) for i in range(12)], "pid long, passage string")
    questions = spark.createDataFrame([(i, "q" * (i + 1), "a") for i in range(5)], "qid long, question string, answer string")
    path = str(tmp_path / "index")
    qa.build_index(passages, path, encode, nlist=3)
    assert len(list(log.iterdir())) == 12
    index = search.load_cells(spark, path)
    answers = qa.answer_baseline(passages, questions, 2, encode=encode, index=index, max_queries=3)
    assert {r["qid"]: r["context_ids"] for r in answers.collect()} == {i: [11, 10] for i in range(3)}
    assert len(list(log.iterdir())) == 12 + 3
    more = spark.createDataFrame([(50, [99.0, 1.0])], "pid long, embedding array<double>")
    grown = search.append_cells(more, path)
    query = spark.createDataFrame([(0, [1.0, 0.0])], "qid long, embedding array<double>")
    assert search.search_cells(query, grown, 1, exact=True).first()["pid"] == 50


def test_cells_are_fitted_on_all_passages(spark):
    """More than 256 rows a cell, which once were sampled: a far group of one row has its own centre."""
    rows = [(i, [0.0, float(i % 2)]) for i in range(1200)] + [(5000, [900.0, 900.0])]
    cells = search.build_cells(spark.createDataFrame(rows, "pid long, embedding array<double>"), nlist=2)
    assert sorted(cells.rows.tolist()) == [1, 1200]


def test_vocabulary_keeps_every_word(spark):
    words = spark.range(101_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("w"))
    documents = words.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("id"), F.array("w").alias("tokens"))
    kept = tokens.vocabulary(documents, min_docs=2)
    assert kept.count() == 101_000 and tokens.bag_of_words(documents, kept).count() == 202_000
    assert tokens.vocabulary(documents, keep=7).count() == 7


def test_vectors_of_different_lengths_are_refused():
    import pyarrow as pa

    with pytest.raises(ValueError):
        dense(pa.array([[1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]))
    assert dense(pa.array([[1.0, 2.0], [3.0, 4.0]])).shape == (2, 2)


def test_corpus_from_file_to_file(spark, tmp_path):
    rows = [(1, "one two three four", "x"), (2, "One two, three four", "x"), (3, "five six seven", None), (4, "eight nine ten", "x"), (5, "no", "x"), (None, "a b c d", "x")]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, "id long, passage string, note string").write.parquet(source)
    corpus_plans.prepare_corpus_file(spark, source, target)
    assert [(r["id"], r["passage"]) for r in tables.read_csv(spark, target, ["id", "passage"], {"id": "long"}).collect()] == [(4, "eight nine ten")]
    again = str(tmp_path / "again")
    corpus_plans.prepare_corpus_file(spark, target, again, layout="csv")
    assert tables.read_csv(spark, again, ["id", "passage"]).count() == 1


def test_texts_are_not_sorted_to_drop_copies(spark, tmp_path):
    from answerloom.operators import corpus

    rows = spark.createDataFrame([(1, "a b"), (2, "A  b!"), (3, "c")], "id long, passage string")
    plan = corpus.drop_all_copies(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_csv_report_is_extended(spark, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([("x", 3, 0.5)], "tag string, n int, f1_mean double").write.option("header", True).csv(first)
    reports.extend_csv_report(spark.createDataFrame([("y", 0.25)], "tag string, em_mean double"), first, second)
    told = {r["tag"]: (r["n"], r["f1_mean"], r["em_mean"]) for r in reports.read_csv_report(spark, second).collect()}
    assert told == {"x": (3, 0.5, None), "y": (None, None, 0.25)}


def test_text_ids_and_odd_context_lists(spark, tmp_path):
    path = tmp_path / "answers.json"
    path.write_text(
        '{"qid": "c-1", "prediction": "x", "gold": "x", "context_ids": [1, "2", "zwei", null]}\n'
        '{"id": 7, "prediction": "x", "gold": ["y", "z"], "context_ids": "none"}\n'
        '{"prediction": null, "gold": null}\n'
    )
    rows = tables.load_results(spark, str(path)).collect()
    assert [(r["qid"], r["id"], r["context_ids"]) for r in rows] == [("c-1", None, [1, 2, None, None]), (None, "7", []), (None, None, [])]
    listed = tables.load_results(spark, str(path), context_type="string").first()
    assert listed["context_ids"] == ["1", "2", "zwei", None]


def test_summary_formula_of_stored_records(spark):
    """Mean, bounds and rates of hand-made records: two full hits, a half hit, a miss that admits it."""
    from answerloom.operators import qa_metrics

    rows = [(1, "red fox", "red fox"), (2, "Paris.", "paris"), (3, "b b", "b b"), (4, "I don't know", "blue")]
    frame = spark.createDataFrame(rows, "qid long, prediction string, gold string").withColumn("tag", F.lit("t"))
    row = qa_metrics.comparison_rows(qa_metrics.squad_scores(qa_metrics.question_scores(frame))).first()
    f1 = np.array([1.0, 1.0, 0.5, 0.0])
    half = 1.959963984540054 * f1.std(ddof=1) / 2
    assert row["n"] == 4 and row["f1_mean"] == pytest.approx(0.625) and row["unknown_rate"] == 0.25
    assert row["f1_lo"] == pytest.approx(0.625 - half) and row["f1_hi"] == 1.0
    assert row["em_mean"] == 0.75 and row["hf_f1"] == pytest.approx(0.75)
