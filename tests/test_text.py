"""Text functions against values worked out by hand, and by their properties."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from answerloom.functions import text as tx
from answerloom.operators import corpus, qa_metrics

# Prediction, gold, and the values by hand: f1, multiset f1, exact match.
SCORED = [
    ("b b c", "b c", 0.8, 80.0, 0.0),
    ("b b", "b b", 0.5, 100.0, 100.0),
    ("", "", 1.0, 0.0, 100.0),
    ("the", "", 1.0, 0.0, 100.0),
    ("x", "", 0.0, 0.0, 0.0),
    ("a b b b", "b b c", 1 / 3, 200 / 3, 0.0),
    ("“the” cat", "cat", 0.5, 50.0, 0.0),
    ("The Cat, the hat!", "cat hat", 1.0, 100.0, 100.0),
    ("naïve café", "Café NAÏVE", 1.0, 100.0, 0.0),
    ("under_score a_b", "underscore ab", 1.0, 100.0, 100.0),
    (None, "yes", 0.0, 0.0, 0.0),
    ("yes", None, 0.0, 0.0, 0.0),
]


def scored(spark, pairs):
    rows = [(i, p, g) for i, (p, g) in enumerate(pairs)]
    frame = spark.createDataFrame(rows, "qid int, prediction string, gold string")
    return qa_metrics.squad_scores(qa_metrics.question_scores(frame)).orderBy("qid").collect()


def test_scores_by_hand(spark):
    for row, (_, _, f1, squad, em) in zip(scored(spark, [r[:2] for r in SCORED]), SCORED):
        assert (row["f1"], row["squad_f1"], row["em"]) == (pytest.approx(f1), pytest.approx(squad), em)


def test_f1_traps(spark):
    rows = scored(spark, [("b b c", "b c"), ("b b", "b b"), ("the", ""), ("x", "")])
    assert [round(r["f1"], 6) for r in rows] == [0.8, 0.5, 1.0, 0.0]
    assert [round(r["squad_f1"], 6) for r in rows] == [80.0, 100.0, 0.0, 0.0]


@settings(max_examples=4, deadline=None)
@given(
    st.lists(
        st.tuples(*[st.text(alphabet="ab cthe.,'\né’_1 ", max_size=40)] * 2),
        min_size=30, max_size=60,
    )
)
def test_properties_of_scores_on_random_texts(spark, pairs):
    """In range, symmetric, and blind to case, articles and ASCII punctuation."""
    rows = scored(spark, pairs)
    turned = scored(spark, [(g, p) for p, g in pairs])
    dressed = scored(spark, [(p.upper() + " The", f"an {g}!") for p, g in pairs])
    for row, other, same in zip(rows, turned, dressed):
        assert 0 <= row["f1"] <= 1 and 0 <= row["squad_f1"] <= 100 and row["em"] in (0, 100)
        for name in ("f1", "squad_f1", "em"):
            assert row[name] == pytest.approx(other[name]) and row[name] == pytest.approx(same[name])


def test_equal_texts_without_repeats_score_full(spark):
    for row in scored(spark, [(t, t) for t in ("x", "one two", "é ’ b1", "under_score")]):
        assert (row["f1"], row["squad_f1"], row["em"]) == (pytest.approx(1.0), 100.0, 100.0)


def test_quality_counts_match_plain_python(spark):
    texts = ["Hi, you_1!\x0b é́ ٣", "a b\x1cc　d", "", "日本 🙂 5%", "x\ty\nz"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, passage string")
    rows = corpus.quality_ratios(frame).orderBy("id").collect()
    for row, text in zip(rows, texts):
        assert row["char_len"] == len(text)
        assert row["word_len"] == len(text.split())
        if text:
            assert row["non_ascii_pct"] == sum(ord(c) > 127 for c in text) / len(text)
            assert row["punct_pct"] == len(re.findall(r"[^\w\s]", text)) / len(text)
            assert row["digits_pct"] == len(re.findall(r"\d", text)) / len(text)
        else:
            assert row["punct_pct"] is None


def test_small_functions(spark):
    frame = spark.createDataFrame(
        [("I DON'T KNOW.",), ("do not know",), ("Unknown",), ("known",), (None,)], "t string"
    )
    assert [r[0] for r in frame.select(tx.unknown_flag(F.col("t"))).collect()] == [1, 1, 1, 0, 0]
    one = spark.range(1)
    gold = one.select(
        tx.first_gold(F.lit(None).cast("string"), False),
        tx.first_gold(F.array().cast("array<string>"), True),
        tx.first_gold(F.array(F.lit("x"), F.lit("y")), True),
        tx.first_gold(F.lit("x"), False),
    ).first()
    assert list(gold) == ["", "", "x", "x"]
    norm = one.select(
        tx.normalize_text(F.lit("A\n\tB  c")), tx.corpus_key(F.lit("Né  A!\tb")),
        tx.approx_token_count(F.lit("")), tx.approx_token_count(F.lit("123456789")),
    ).first()
    assert list(norm) == ["a  b  c", "n a b", 1, 2]


def test_last_prediction_wins_and_all_records_stay(spark):
    rows = [(1, 0, "x", "y"), (1, 1, "y", "y"), (1, 2, None, "y"), (2, 3, "z", "z")]
    frame = spark.createDataFrame(rows, "qid int, pos int, prediction string, gold string")
    filled = frame.na.fill("", ["prediction"])
    latest = qa_metrics.last_predictions(filled, "pos").orderBy("pos").collect()
    assert [r["prediction"] for r in latest] == ["", "", "", "z"]
