"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text as tx
from ..functions.vectors import encode_words, l2_normalize
from ..operators import (
    contexts,
    corpus,
    judge,
    numbering,
    profile,
    prompts,
    qa_metrics,
    reports,
    rerank,
    scoring,
    search,
    tokens,
    topics,
)
from ..plans import corpus as corpus_plans
from ..plans import evaluate, qa
from ..shared import fresh_path, write_through
from ..sources import tables, vector_table
from . import data
from .data import listed, six

QUERIES: dict = {}

# Stop words of the registered token queries; a parameter of the operator.
STOP_WORDS = "the and for are was with this that from have has not but".split()
TOKEN_SETTINGS = {"min_docs": fixed.MIN_DOCS, "max_share": fixed.MAX_DOC_SHARE}
CELLS = 16
LEAST_RECALL = 0.5  # of few probes, over the given vectors
MAX_CHARS = 4096  # longest passage of the registered check of rows to be stored
DIM = qa.DEFAULT_DIM


def query(function):
    QUERIES[function.__name__] = function
    return function


def _long(*names: str):
    return [F.col(n).cast("long").alias(n) for n in names]


def _sixes(*names: str):
    return [six(F.col(n)).alias(n) for n in names]


# ------------------------------------------------------------------ corpus


@query
def passage_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = corpus.passage_features(data.passages(spark, sf_dir, "id"))
    return features.select("id", "passage_norm", *_long("char_len", "tok_est"))


@query
def corpus_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = data.passages(spark, sf_dir, "id")
    return passages.select("id", tx.corpus_key(F.col("passage")).alias("passage_norm"))


@query
def corpus_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.drop_all_copies(data.passages(spark, sf_dir, "id"))


@query
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = corpus.count_copies(data.passages(spark, sf_dir, "id"))
    return counts.select(*_long("passages", "duplicates", "uniques"))


@query
def corpus_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_plans.prepare_corpus(data.passages(spark, sf_dir, "id"))


@query
def quality_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = corpus.quality_ratios(data.passages(spark, sf_dir, "id"))
    return rated.select(
        "id",
        *_long("char_len", "word_len", "token_count"),
        *_sixes("non_ascii_pct", "punct_pct", "digits_pct"),
    )


@query
def column_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = corpus_plans.profile_corpus(data.passages(spark, sf_dir, "id"))
    return summary.select(
        "column", *_long("n"), *_sixes("mean", "std", "min", "p25", "p50", "p75", "max")
    )


@query
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = corpus_plans.length_histograms(data.passages(spark, sf_dir, "id"))
    return bins.select("column", *_long("bin", "n"), *_sixes("bin_from", "bin_to"))


def make_regex_tagger():
    """Stand-in tagger: words, numbers and symbols; capitalised words as names."""
    parts = {"WORD": "[A-Za-z]+", "NUM": "[0-9]+", "PUNCT": r"[!-/:-@\[-`{-~]"}
    part = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in parts.items()))
    entity = re.compile("(?P<NAME>[A-Z][a-z]+)|(?P<NUMBER>[0-9]+)")

    def tag(text: str):
        counts = Counter(m.lastgroup for m in part.finditer(text))
        return [(m.group(), m.lastgroup) for m in entity.finditer(text)], counts.total(), dict(counts)

    return lambda texts: [tag(t) for t in texts]


@query
def batch_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = scoring.tag_documents(
        data.passages(spark, sf_dir, "id"), "passage", make_regex_tagger
    )
    return tagged.select(
        "id",
        F.size("entities").cast("long").alias("entities"),
        F.try_element_at("entities", F.lit(1))["text"].alias("first_entity"),
        *_long("token_count"),
        F.coalesce(F.try_element_at("pos_counts", F.lit("NUM")), F.lit(0)).cast("long").alias("numbers"),
    )


@query
def tag_counts_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per part of speech, from a map column built with expressions."""
    text = F.col("passage")

    def times(pattern):
        return F.regexp_count(text, F.lit(pattern))

    tagged = data.passages(spark, sf_dir).select(
        F.create_map(
            F.lit("WORD"), times(r"\p{L}+"),
            F.lit("NUM"), times(r"\p{Nd}+"),
            F.lit("PUNCT"), times(f"[^{tx.WORD}{tx.SPACE}]"),
        ).alias("pos_counts")
    )
    return profile.count_tags(tagged, "pos_counts").select("tag", *_long("n"))


@query
def label_counts_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per entity label, from an array of (text, label)."""

    def entities(pattern, label):
        matches = F.regexp_extract_all("passage", F.lit(pattern), F.lit(0))
        return F.transform(
            matches, lambda m: F.struct(m.alias("text"), F.lit(label).alias("label"))
        )

    tagged = data.passages(spark, sf_dir).select(
        F.concat(entities("[A-Z][a-z]+", "NAME"), entities("[0-9]+", "NUMBER")).alias("entities")
    )
    return profile.count_labels(tagged, "entities").select("label", *_long("n"))


def _content_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens.content_words(data.passages(spark, sf_dir, "id"), stop_words=STOP_WORDS)
    return words.select("id", "tokens")


@query
def content_tokens_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens.vocabulary(_content_words(spark, sf_dir), **TOKEN_SETTINGS)
    return words.select("token", *_long("docs"))


@query
def bag_of_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = write_through(_content_words(spark, sf_dir), "tokens")
    words = tokens.vocabulary(documents, **TOKEN_SETTINGS)
    return tokens.bag_of_words(documents, words).select("id", "token", *_long("n"))


def _topic_model(spark: SparkSession, sf_dir: str):
    passages = data.passages(spark, sf_dir, "id")
    return corpus_plans.topic_report(passages, STOP_WORDS)


@query
def lda_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 heaviest words of each topic of all passages, with their normalised weights."""
    words = _topic_model(spark, sf_dir)[0]
    return words.select(*_long("topic", "rank"), "token", six(F.col("weight")).alias("weight"))


@query
def dominant_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading topic of every passage and its share; no topic and share 0 without a vocabulary word."""
    lead = _topic_model(spark, sf_dir)[1]
    return lead.select("id", F.col("topic").cast("long").alias("topic"), six(F.col("share")).alias("share"))


@query
def leading_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest of the squares of a unit vector's components, as a topic's share; null below the limit."""
    squares = F.transform("embedding", lambda x: F.floor(x.cast("double") * x.cast("double") * 1e6) / 1e6)
    shares = data.vectors(spark, sf_dir, "id").select("id", array_to_vector(squares).alias("v"))
    lead = topics.leading_topic(F.col("v"))
    return shares.select("id", lead["topic"].cast("long").alias("topic"), six(lead["share"]).alias("share"))


# ------------------------------------------------------------------ vectors


def _hits(hits: DataFrame) -> DataFrame:
    return hits.select("qid", *_long("rank"), "pid", *_sixes("score"))


def _both(spark: SparkSession, sf_dir: str):
    return data.vectors(spark, sf_dir, "qid"), data.vectors(spark, sf_dir, "pid")


@query
def topk_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.search(*_both(spark, sf_dir), k=5))


@query
def topk_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.search(*_both(spark, sf_dir), k=5, metric="L2"))


@query
def topk_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top 5, passage tasks emitting only hits above each query's bound from a probe."""
    return _hits(search.search_bounded(*_both(spark, sf_dir), k=5))


@query
def topk_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.search_blocks(*_both(spark, sf_dir), k=5))


def _cells(spark: SparkSession, sf_dir: str):
    queries, passages = _both(spark, sf_dir)
    return queries, search.build_cells(passages, nlist=CELLS)


@query
def ivf_full_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.search_cells(*_cells(spark, sf_dir), k=5, nprobe=CELLS))


@query
def ivf_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.search_cells(*_cells(spark, sf_dir), k=5, nprobe=2, exact=True))


@query
def ivf_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the exact top 5 found with few probes."""
    queries, cells = _cells(spark, sf_dir)
    exact = search.search(queries, cells.passages, k=5)
    near = search.search_cells(queries, cells, k=5, nprobe=4).select(
        "qid", "pid", F.lit(1).alias("found")
    )
    recall = F.avg(F.coalesce("found", F.lit(0)))
    return exact.join(near, ["qid", "pid"], "left").agg(
        F.count(F.lit(1)).alias("expected"), (recall >= LEAST_RECALL).cast("int").cast("long").alias("enough"),
    )


@query
def index_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of cells: built on half of the vectors, appended to, opened and searched."""
    queries, passages = _both(spark, sf_dir)
    path = fresh_path(spark, "index")
    search.build_cells(passages.filter("pid % 2 = 0"), nlist=CELLS, path=path)
    search.append_cells(passages.filter("pid % 2 = 1"), path)
    return _hits(search.search_cells(queries, search.load_cells(spark, path), k=5, nprobe=2, exact=True))


@query
def l2_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    doubled = F.transform("embedding", lambda x: x.cast("double") * 3.0)
    scaled = data.vectors(spark, sf_dir, "id").withColumn("embedding", l2_normalize(doubled))
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    return scaled.select(
        "id", six(squares).alias("squared_length"), six(F.element_at("embedding", 1)).alias("head")
    )


@query
def embed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-zero entries of the default text vectors."""
    encoded = encode_words(data.passages(spark, sf_dir, "id"), "passage", "embedding", DIM)
    entries = encoded.select("id", F.posexplode("embedding").alias("bucket", "weight"))
    return entries.filter(F.col("weight") != 0).select("id", *_long("bucket"), *_sixes("weight"))


def make_length_encoder():
    """Stand-in for a user's encoder model: three length features per text."""
    import numpy as np

    def encode(texts):
        return np.array(
            [[len(t), t.count(" ") + 1, t.count("\n") + 1] for t in texts], dtype="float32"
        )

    return encode


@query
def batch_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = scoring.embed_texts(
        data.passages(spark, sf_dir, "id"), "passage", make_length_encoder, normalize=False
    )
    return encoded.select("id", *[
        F.get("embedding", F.lit(i)).cast("long").alias(name)
        for i, name in enumerate(["chars", "spaced", "lines"])
    ])


def _vector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = data.vectors(spark, sf_dir, "id")
    return data.passages(spark, sf_dir, "id").join(vectors, "id", "left")


@query
def vector_table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice with replacement, then appended to once: rows, dimensions and rejects."""
    path, rejects = fresh_path(spark, "vectors"), fresh_path(spark, "rejects")
    rows = _vector_rows(spark, sf_dir)
    for replace in (True, True, False):
        vector_table.write_vectors(rows, path, 64, replace, rejects=rejects)
    stats = vector_table.vector_stats(vector_table.read_vectors(spark, path))
    rejected = spark.read.parquet(rejects).agg(F.count(F.lit(1)).alias("rejected"))
    return stats.join(F.broadcast(rejected)).select(*_long("row_count", "min_dim", "max_dim", "rejected"))


@query
def vector_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = vector_table.check_rows(_vector_rows(spark, sf_dir), 64, MAX_CHARS)
    return checked.filter(F.col("problem").isNotNull()).select("id", "problem")


# ------------------------------------------------------------------ retrieval


@query
def context_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First passage found for each vector, with its document where there is one."""
    hits = search.search(*_both(spark, sf_dir), k=2)
    lists = rerank.collect_contexts(hits).select(
        "qid", F.transform("contexts", lambda c: c["pid"]).alias("context_ids")
    )
    joined = contexts.join_first_context(lists, data.passages(spark, sf_dir))
    return joined.select("qid", listed(F.col("context_ids")).alias("context_ids"), "top1_pid", "context_text")


@query
def context_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors' neighbours as contexts: unknown ids skipped, 3 kept, 200 characters each."""
    hits = search.search(*_both(spark, sf_dir), k=5)
    lists = rerank.collect_contexts(hits).select(
        "qid", F.transform("contexts", lambda c: c["pid"]).alias("context_ids")
    )
    found = contexts.look_up_contexts(lists, data.passages(spark, sf_dir), cap=3, max_chars=200)
    return found.select(
        "qid", F.size("contexts").cast("long").alias("n"), listed(F.col("contexts")).alias("contexts")
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = qa.find_candidates(
        data.passages(spark, sf_dir), data.questions(spark, sf_dir), fixed.RERANK_CANDIDATES,
        qa.word_encoder(), search.search, rerank.score_overlap, rerank.add_words,
    )
    return scored


@query
def retrieve_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = data.found(spark, sf_dir, fixed.BASELINE_TOP_K)
    return hits.select("qid", *_long("rank"), "pid", *_sixes("score"))


@query
def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rerank.rerank(_candidates(spark, sf_dir))
    return ranked.select("qid", *_long("rerank_rank", "rank"), "pid", *_sixes("rerank_score"))


@query
def confidence_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rerank.rerank(_candidates(spark, sf_dir))
    sure = rerank.confidence(data.questions(spark, sf_dir).select("qid"), ranked)
    return sure.select("qid", *_sixes("conf", "margin"))


@query
def abstain(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rerank.rerank(_candidates(spark, sf_dir))
    sure = rerank.confidence(data.records(spark, sf_dir).select("qid", "prediction"), ranked)
    low = rerank.low_confidence(F.col("conf"), F.col("margin"))
    answer = F.when(low, F.lit(fixed.ABSTAIN_ANSWER)).otherwise(F.col("prediction"))
    return sure.select("qid", low.cast("int").cast("long").alias("low_conf"), answer.alias("prediction"))


@query
def prompt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = data.found(spark, sf_dir, fixed.BASELINE_TOP_K)
    lists = rerank.collect_contexts(rerank.with_passages(hits, data.passages(spark, sf_dir)))
    asked = qa.with_contexts(data.questions(spark, sf_dir), lists)
    prompt = prompts.build_prompt(F.col("question"), F.col("contexts"))
    return asked.select("qid", prompt.alias("prompt"))


@query
def qa_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = qa.answer_baseline(data.passages(spark, sf_dir), data.questions(spark, sf_dir))
    return answers.select(
        "qid", "question", "prediction", "gold", listed(F.col("context_ids")).alias("context_ids")
    )


@query
def qa_reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = qa.answer_reranked(
        data.passages(spark, sf_dir), data.questions(spark, sf_dir), abstain=True
    )
    return answers.select(
        "qid", "question", "prediction", "gold",
        listed(F.col("context_ids")).alias("context_ids"),
        *_sixes("conf", "margin"),
        F.col("low_conf").cast("int").cast("long").alias("low_conf"),
    )


@query
def qa_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline run over a stored index."""
    passages, path = data.passages(spark, sf_dir), fresh_path(spark, "index")
    qa.build_index(passages, path, nlist=CELLS)
    answers = qa.answer_baseline(
        passages, data.questions(spark, sf_dir), index=search.load_cells(spark, path)
    )
    return answers.select(
        "qid", "question", "prediction", "gold", listed(F.col("context_ids")).alias("context_ids")
    )


def make_parrot():
    """Stand-in for a user's generator model: repeats the question of the prompt."""
    return lambda texts: [
        "You ask: " + t.rsplit("\n\nQuestion: ", 1)[1][: -len("\nAnswer:")] for t in texts
    ]


@query
def batch_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline run with a model of the caller's as generator."""
    answers = qa.answer_baseline(
        data.passages(spark, sf_dir), data.questions(spark, sf_dir),
        generate=lambda df: scoring.generate(df, make_parrot),
    )
    return answers.select("qid", "prediction", listed(F.col("context_ids")).alias("context_ids"))


def make_length_scorer():
    """Stand-in for a user's pair scorer: closeness of the two text lengths."""
    import numpy as np

    def score(questions, passages):
        lengths = [(len(q), len(p)) for q, p in zip(questions, passages)]
        return np.array([min(a, b) / max(a, b, 1) for a, b in lengths])

    return score


@query
def batch_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-ranked run with a model of the caller's as pair scorer."""
    answers = qa.answer_reranked(
        data.passages(spark, sf_dir), data.questions(spark, sf_dir),
        score=lambda pairs: scoring.score_pairs(pairs, make_length_scorer),
        prepare=lambda passages: passages, ask=lambda questions: questions,
    )
    return answers.select(
        "qid", listed(F.col("context_ids")).alias("context_ids"), *_sixes("conf", "margin")
    )


# ------------------------------------------------------------------ answer scores


@query
def answer_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = tx.first_gold(F.array_compact(F.array("gold")), is_array=True)
    return data.records(spark, sf_dir).select(
        tx.record_id(F.col("qid"), F.lit("none")).alias("qid"),
        tx.normalize_answer(gold).alias("gold"),
        F.size(tx.answer_tokens(gold)).cast("long").alias("tokens"),
    )


@query
def token_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_metrics.question_scores(data.records(spark, sf_dir)).select("qid", *_sixes("f1"))


@query
def unknown_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = qa_metrics.question_scores(data.records(spark, sf_dir))
    return scores.select("qid", *_long("unknown"))


@query
def squad_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = qa_metrics.squad_scores(data.records(spark, sf_dir))
    return scores.select("qid", *_sixes("em", "squad_f1"))


@query
def squad_last_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of a conversation under one id: each is scored with its last prediction."""
    turns = data.records(spark, sf_dir).select(
        F.col("qid").alias("turn"),
        F.split_part("qid", F.lit("-"), F.lit(1)).alias("qid"),
        F.split_part("qid", F.lit("-"), F.lit(2)).cast("int").alias("pos"),
        F.coalesce("prediction", F.lit("")).alias("prediction"),
        "gold",
    )
    latest = qa_metrics.last_predictions(turns, "pos")
    return qa_metrics.squad_scores(latest).select("turn", *_sixes("em", "squad_f1"))


def _comparison(spark: SparkSession, sf_dir: str, with_squad: bool) -> DataFrame:
    records = data.records(spark, sf_dir).withColumn("tag", F.lit("run"))
    return qa_metrics.comparison_rows(qa_metrics.record_scores(records, with_squad=with_squad))


@query
def macro_scores_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparison(spark, sf_dir, False).select(
        "tag", *_long("n"), *_sixes("f1_mean", "unknown_rate", "f1_lo", "f1_hi")
    )


@query
def comparison_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparison(spark, sf_dir, True).select(
        "tag", *_long("n"),
        *_sixes("f1_mean", "unknown_rate", "f1_lo", "f1_hi", "em_mean", "hf_f1"),
    )


@query
def first_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 200 questions of the table, as a run with ``max_queries`` takes them."""
    return prompts.first_rows(data.questions(spark, sf_dir), 200, F.asc("qid"))


@query
def prompt_grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 27 settings of the sweep, scored and reported."""
    records = qa.sweep(data.passages(spark, sf_dir), data.questions(spark, sf_dir))
    # Answers are stored before they are scored, as generating them is what costs.
    records = write_through(records.select("tag", "qid", "prediction", "gold"), "answers")
    return qa.sweep_report(records).select(
        "tag", *_long("n"),
        *_sixes("f1_mean", "unknown_rate", "f1_lo", "f1_hi", "em_mean", "hf_f1"),
    )


# ------------------------------------------------------------------ judging

CAPS = (1, 5)


def _judge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge rows under two context caps, tagged by cap."""
    records = data.records_with_contexts(spark, sf_dir)
    passages = data.passages(spark, sf_dir)
    found = contexts.look_up_contexts(records, passages, cap=0)
    tagged = prompts.expand_grid(judge.valid_rows(found), cap=CAPS)
    capped = tagged.withColumn("contexts", F.slice("contexts", F.lit(1), F.col("cap")))
    tag = F.format_string("cap_%d", "cap").alias("tag")
    return judge.judge_rows(capped.withColumn("tag", tag), "tag", "qid")


def _overlap_metrics(rows: DataFrame) -> DataFrame:
    """Stand-in judge scores by shared words; no score where an answer lacks the words."""
    texts = {
        "_question": F.col("question"),
        "_answer": F.col("answer"),
        "_gold": F.col("ground_truth"),
        "_joined": F.array_join("contexts", " "),
        "_first": F.element_at("contexts", 1),
    }
    # Columns of their own: inside the scores, Spark would split a text anew for each use.
    split = rows.withColumns({name: F.array_distinct(tx.words(text)) for name, text in texts.items()})
    question, answer, gold, joined, first = map(F.col, texts)
    spoken = F.size(F.array_intersect(question, answer)) > 0
    return split.withColumns(
        {
            "faithfulness": tx.overlap_score(answer, joined),
            "context_precision": tx.overlap_score(question, first),
            "context_recall": tx.overlap_score(gold, joined),
            "answer_relevancy": F.when(spoken, tx.overlap_score(question, answer)),
        }
    ).drop(*texts)


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge scores, stored: numbering reads its rows twice, once to find the ranges of its sort."""
    scored = _overlap_metrics(_judge_rows(spark, sf_dir))
    return write_through(scored.select("tag", "qid", *fixed.JUDGE_METRICS), "judged")


def _shards(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    return judge.assign_shards(_judged(spark, sf_dir), [F.asc("qid")], batch)


@query
def judge_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluate.judge_dataset(
        data.records_with_contexts(spark, sf_dir), data.passages(spark, sf_dir), max_chars=1800
    )
    return rows.select(
        "qid", "question", "answer", "response", listed(F.col("contexts")).alias("contexts"),
        "reference", listed(F.col("references")).alias("references"), "ground_truth",
        listed(F.col("ground_truths")).alias("ground_truths"),
    )


@query
def judge_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 valid judge rows, as a sampled judge run takes them."""
    rows = evaluate.judge_dataset(
        data.records_with_contexts(spark, sf_dir), data.passages(spark, sf_dir), sample=50
    )
    return rows.select("qid", "answer", F.size("contexts").cast("long").alias("contexts"))


@query
def judge_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = judge.shard_means(_shards(spark, sf_dir, fixed.JUDGE_BATCH), fixed.JUDGE_METRICS)
    return shards.select("tag", *_long("shard", "size"), *_sixes(*fixed.JUDGE_METRICS))


@query
def judge_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = judge.shard_means(_shards(spark, sf_dir, fixed.JUDGE_BATCH), fixed.JUDGE_METRICS)
    means = judge.weighted_means(shards, fixed.JUDGE_METRICS)
    return means.select("tag", *_long("n"), *_sixes(*fixed.JUDGE_METRICS))


def _summary(judged: DataFrame, batch: int) -> DataFrame:
    return judge.judge_summary(
        judge.assign_shards(judged, [F.asc("qid")], batch), ctx_cap=fixed.CONTEXT_CAP, ctx_char_cap=0, batch=batch,
        workers=4, judge="overlap",
    )


@query
def judge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(_judged(spark, sf_dir), 10).select(
        "tag", *_long("n"), *_sixes(*fixed.JUDGE_METRICS),
        *_long("ctx_cap", "ctx_char_cap", "batch", "workers"), "judge",
    )


ANSWER_LIMIT = 1500  # characters the stand-in judge accepts


def make_word_judge():
    """Stand-in for a user's judge: refuses a batch with an answer above its limit."""

    def judge_batch(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["answer"].str.len().max() > ANSWER_LIMIT:
            raise ValueError("answer too long")
        asked = rows["question"].str.split()
        said = rows["answer"].str.split()
        shared = [len(set(q) & set(a)) for q, a in zip(asked, said)]
        return pd.DataFrame(
            {
                "answer_relevancy": [n / len(set(q)) if q else None for n, q in zip(shared, asked)],
                "faithfulness": [float(n > 0) for n in shared],
            }
        )

    return judge_batch


@query
def batch_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards judged in batches, some of which fail; failed rows count in n only."""
    metrics = ["answer_relevancy", "faithfulness"]
    # The judge reads no contexts, so they are left behind before rows are numbered and stored.
    rows = _judge_rows(spark, sf_dir).select("tag", "qid", "question", "answer")
    sharded = judge.assign_shards(rows, [F.asc("qid")], 5)
    scored = scoring.judge_shards(
        sharded.select("tag", "shard", "qid", "question", "answer"), make_word_judge, metrics
    )
    scored = write_through(scored, "judged")  # read for the means and for the failures
    failed = scored.groupBy("tag").agg(F.count("error").alias("failed"))
    means = judge.judge_summary(scored, metrics).join(failed, "tag")
    return means.select("tag", *_long("n", "failed"), *_sixes(*metrics))


@query
def evaluate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers written with a qid, with an id only, or with neither; read, scored and reported."""
    records = data.records(spark, sf_dir).withColumn("sort", F.length("question") % 3)
    answers = records.select(
        F.when(F.col("sort") == 0, F.col("qid")).alias("qid"),
        F.when(F.col("sort") == 1, F.concat(F.lit("id-"), "qid")).alias("id"),
        "question", "prediction", "gold", F.array(F.lit(1), F.lit(2)).alias("context_ids"),
    )
    path, report = fresh_path(spark, "answers"), fresh_path(spark, "report")
    tables.write_results(answers, path)
    scores = evaluate.evaluate_answers(spark, path, "run", report)
    kinds = scores.agg(
        F.count_if(F.col("qid").startswith("id-")).alias("by_id"),
        F.count_if(F.col("qid").rlike("^[0-9]+$")).alias("by_position"),
    )
    row = reports.read_report(spark, report).join(F.broadcast(kinds))
    return row.select(
        "tag", *_long("n", "by_id", "by_position"),
        *_sixes("f1_mean", "unknown_rate", "f1_lo", "f1_hi", "em_mean", "hf_f1"),
    )


@query
def judge_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored answers read again, judged in shards of 5, with report and scores stored."""
    path, report = fresh_path(spark, "answers"), fresh_path(spark, "report")
    tables.write_results(data.records_with_contexts(spark, sf_dir), path)
    passages = tables.passage_lookup(data.passages(spark, sf_dir, "id"))
    scores = fresh_path(spark, "scores")
    metrics = ["answer_relevancy", "faithfulness"]
    evaluate.judge_answers(
        tables.load_results(spark, path), passages, make_word_judge, "cap_5", metrics, batch=5,
        report=report, scores_path=scores,
    )
    failed = spark.read.parquet(scores).groupBy("tag").agg(F.count("error").alias("failed"))
    row = reports.read_report(spark, report).join(failed, "tag")
    return row.select("tag", *_long("n", "failed"), *_sixes(*metrics), *_long("batch", "ctx_cap"))


# ------------------------------------------------------------------ reports


@query
def report_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer and judge report rows in one table with the columns of both."""
    answers = _comparison(spark, sf_dir, False).select(
        "tag", *_long("n"), *_sixes("f1_mean", "unknown_rate")
    )
    judged = _summary(_judged(spark, sf_dir), 25).select(
        "tag", *_long("n"), *_sixes("faithfulness", "answer_relevancy"), *_long("batch")
    )
    return reports.union_rows(answers, judged)


@query
def report_best_per_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the runs with three batch sizes, the best of each tag; smaller runs left out."""
    judged = _judged(spark, sf_dir)
    runs = reports.union_rows(*[_summary(judged, batch) for batch in (10, 25, 50)])
    # Reports hold six places, so that equal runs compare as equal.
    runs = runs.withColumns({m: six(F.col(m)) for m in fixed.JUDGE_METRICS})
    runs = runs.withColumns({"ctx_max_chars": F.lit(None), "sample_n": F.lit(None)})
    return evaluate.clean_report(runs).select(
        "tag", *_long("n"), *fixed.JUDGE_METRICS, *_long("batch")
    )


@query
def report_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends with different columns to a stored report, read back merged."""
    path = fresh_path(spark, "report")
    reports.append_rows(_comparison(spark, sf_dir, False).select("tag", "n", "f1_mean"), path)
    reports.append_rows(_summary(_judged(spark, sf_dir), 25).select("tag", "n", "faithfulness"), path)
    report = reports.read_report(spark, path)
    return report.select("tag", *_long("n"), *_sixes("f1_mean", "faithfulness"))


# ------------------------------------------------------------------ sources and sinks


@query
def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as CSV in id order, and numbered by file position on reading."""
    path = fresh_path(spark, "passages-csv")
    tables.write_csv(data.passages(spark, sf_dir, "id").orderBy(F.desc("id")), path)
    numbered = tables.load_passages(spark, path, id_mode="position")
    return numbered.select("id", F.length("passage").cast("long").alias("char_len"))


@query
def shard_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents numbered by length within their language."""
    lengths = data.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    order = [F.desc("n_chars"), F.asc("doc_id")]
    return numbering.number_rows(lengths, order, "pos", within="lang").select(
        "doc_id", "lang", *_long("pos")
    )


@query
def scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every format written and read back, row by row."""

    def rows(df, source, key, text):
        return df.select(F.lit(source).alias("source"), F.col(key).cast("string").alias("key"), F.md5(text).alias("text"))

    def stored(df, name, write):
        path = fresh_path(spark, name)
        write(df, path)
        return path

    passages, records = data.passages(spark, sf_dir, "id"), data.records(spark, sf_dir)
    number = F.split("qid", "-")
    number = (number[0].cast("long") * 1000 + number[1].cast("long")).alias("id")
    asked = records.select(number, "question", F.col("gold").alias("answer"))
    answers = records.select(
        "qid", "question", "prediction", "gold", F.array(F.lit(1).cast("long")).alias("context_ids")
    )
    scores = qa_metrics.question_scores(records).select(F.lit("run").alias("tag"), "qid", "f1", "unknown")

    passages_csv = stored(passages, "passages", tables.write_csv)
    queries_csv = stored(asked, "queries", tables.write_csv)
    lines = stored(answers, "answers", tables.write_results)
    parquet = stored(passages, "passages", lambda df, path: df.write.parquet(path))
    dump = stored(scores, "scores", tables.write_scores)
    return reports.union_rows(
        rows(tables.load_passages(spark, passages_csv), "passages csv", "id", F.col("passage")),
        rows(tables.load_queries(spark, queries_csv), "queries csv", "id", F.col("question")),
        rows(tables.load_results(spark, lines), "answers json", "qid", F.col("gold")),
        rows(tables.load_parquet(spark, parquet, "position"), "passages parquet", "id", F.col("passage")),
        rows(spark.read.parquet(dump), "scores parquet", "qid", F.col("unknown").cast("string")),
    )
