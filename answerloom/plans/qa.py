"""Question answering over a corpus: baseline, re-ranked, and parameter sweep.

Frames: passages ``(pid, passage)``, questions ``(qid, question, answer)``. Encoders,
re-rankers and generators are functions from frame to frame, so callers pass their
models through :mod:`answerloom.operators.scoring`; the defaults need no model.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.text import SPACE
from ..functions.vectors import encode_words
from ..operators import prompts, qa_metrics, rerank
from ..operators.search import CellTable, build_cells, search, search_cells
from ..shared import fresh_path, store_rows, temporary_steps, write_through

Encoder = Callable[[DataFrame, str], DataFrame]  # adds ``embedding`` for a text column
Finder = Callable[[DataFrame, DataFrame, int], DataFrame]  # hits of queries in passages
Scorer = Callable[[DataFrame], DataFrame]  # adds ``rerank_score`` to pairs (question, passage)
Generator = Callable[[DataFrame], DataFrame]  # adds ``prediction`` where there is a prompt

DEFAULT_DIM = 256
DEFAULT_NEW_TOKENS = 128


def word_encoder(dim: int = DEFAULT_DIM) -> Encoder:
    return partial(encode_words, output="embedding", dim=dim)


def leading_pieces(contexts: Column, limit: Column) -> Column:
    """The first ``limit`` pieces between white space of the joined contexts."""
    joined = F.array_join(F.transform(contexts, lambda c: c["passage"]), " ")
    text = F.regexp_replace(F.coalesce(joined, F.lit("")), f"^[{SPACE}]+", "")
    # Splitting stops once there are enough words; the piece after them is the rest.
    return F.slice(F.split(text, f"[{SPACE}]+", limit + 1), F.lit(1), limit)


def joined_words(pieces: Column, limit: Column) -> Column:
    return F.array_join(F.array_remove(F.slice(pieces, F.lit(1), limit), ""), " ")


def leading_words(contexts: Column, limit: Column) -> Column:
    """The first ``limit`` words of the joined contexts: what an echoing model would say."""
    return joined_words(leading_pieces(contexts, limit), limit)


def echo_generator(limit: Column | int = DEFAULT_NEW_TOKENS) -> Generator:
    """Stand-in generator: repeats the start of the contexts; stays in the JVM."""
    limit = F.lit(limit) if isinstance(limit, int) else limit

    def answer(df: DataFrame) -> DataFrame:
        said = leading_words(F.col("contexts"), limit)
        return df.withColumn("prediction", F.when(F.col("prompt").isNotNull(), said))

    return answer


def build_index(
    passages: DataFrame, path: str, encode: Encoder | None = None, nlist: int = fixed.NLIST
) -> CellTable:
    """Encode the passages once and store them by cell; ``search.load_cells`` opens the table later."""
    vectors = (encode or word_encoder())(passages.select("pid", "passage"), "passage")
    return build_cells(vectors.select("pid", "embedding"), nlist, path=path)


def find_hits(
    passages: DataFrame,
    questions: DataFrame,
    k: int,
    encode: Encoder,
    find: Finder,
    index: CellTable | None = None,
) -> DataFrame:
    """The k closest passages of each question, stored: the search is the dearest step,
    and what follows uses its few rows more than once.

    With a stored ``index`` only questions are encoded, and cells that may hold something
    better than what was found are searched too, so hits are exact.
    """
    queries = encode(questions.select("qid", "question"), "question").select("qid", "embedding")
    with temporary_steps(questions.sparkSession) as scope:  # vectors are of no use once hits are stored
        if index is not None:
            return scope.keep(search_cells(queries, index, k, exact=True), "hits")
        vectors = encode(passages.select("pid", "passage"), "passage").select("pid", "embedding")
        return scope.keep(find(queries, vectors, k), "hits")


def find_candidates(
    passages: DataFrame,
    questions: DataFrame,
    candidates: int,
    encode: Encoder,
    find: Finder,
    score: Scorer,
    prepare: Callable[[DataFrame], DataFrame],
    index: CellTable | None = None,
    ask: Callable[[DataFrame], DataFrame] = rerank.add_question_words,
) -> tuple[DataFrame, DataFrame]:
    """Scored candidates ``(qid, rank, pid, text_id, rerank_score)`` and the stored texts found,
    ``(text_id, pid, passage, ...)``.

    ``prepare`` runs once per passage found, ``ask`` once per question, ``score`` per pair.
    Questions come to the hits before the texts do, and texts are left behind after scoring:
    a text is moved once, not once per pair, and joined again to the pairs that are kept.
    """
    hits = find_hits(passages, questions, candidates, encode, find, index)
    texts = prepare(rerank.found_passages(hits, passages.select("pid", "passage")))
    # Stored, so that a text is prepared once; fused into the join below, that would be
    # repeated for every hit of it. Ids of passages may repeat, so each text is numbered.
    texts = write_through(texts.withColumn("text_id", F.monotonically_increasing_id()), "found")
    asked = hits.join(ask(questions.select("qid", "question")), "qid")
    scored = score(rerank.with_passages(asked, texts))
    return scored.select("qid", "rank", "pid", "text_id", "rerank_score"), texts


def with_contexts(questions: DataFrame, contexts: DataFrame) -> DataFrame:
    """Questions with their contexts; those without any get an empty list."""
    empty = F.array().cast(contexts.schema["contexts"].dataType)
    joined = questions.join(contexts, "qid", "left")
    return joined.withColumn("contexts", F.coalesce("contexts", empty))


def _context_ids() -> Column:
    return F.transform("contexts", lambda c: c["pid"]).alias("context_ids")


def _text_rounds(pairs: DataFrame, texts: DataFrame) -> int:
    """How often the characters of ``texts`` are in the texts of ``pairs``, rounded up; 1 at least."""
    times = pairs.groupBy("text_id").agg(F.count(F.lit(1)).alias("times"))
    sized = texts.select("text_id", F.length("passage").alias("chars")).join(times, "text_id", "left")
    moved = sized.agg(F.sum(F.col("chars") * F.coalesce("times", F.lit(0))).alias("moved"), F.sum("chars").alias("held")).first()
    return max(1, -(-(moved["moved"] or 0) // (moved["held"] or 1)))


def _in_rounds(answer: Callable[[DataFrame, DataFrame], DataFrame], questions: DataFrame, pairs: DataFrame, rounds: int) -> DataFrame:
    """``answer(questions, pairs)``; in several rounds, each for a share of the questions, stored.

    Texts move once for each pair; what a round moves is off the disk before the next one.
    """
    if rounds == 1:
        return answer(questions, pairs)
    path = fresh_path(questions.sparkSession, "answers")
    turn = F.pmod(F.xxhash64("qid"), F.lit(rounds))
    for i in range(rounds):
        answers = answer(questions.filter(turn == i), pairs.filter(turn == i))
        store_rows(answers, path)
    return questions.sparkSession.read.schema(answers.schema).parquet(path)


def answer_baseline(
    passages: DataFrame,
    questions: DataFrame,
    top_k: int = fixed.BASELINE_TOP_K,
    system: str | None = None,
    encode: Encoder | None = None,
    find: Finder = search,
    generate: Generator | None = None,
    index: CellTable | None = None,
    max_queries: int = 0,
) -> DataFrame:
    """Retrieve, prompt, generate: ``(qid, question, prediction, gold, context_ids)``.

    ``max_queries`` takes the first questions by id only; 0 takes all.
    """
    questions = write_through(prompts.first_rows(questions, max_queries, F.asc("qid")), "questions")
    hits = find_hits(passages, questions, top_k, encode or word_encoder(), find, index)
    hits = rerank.with_passages(hits, passages)
    asked = with_contexts(questions, rerank.collect_contexts(hits))
    prompt = prompts.build_prompt(F.col("question"), F.col("contexts"), system)
    answered = (generate or echo_generator())(asked.withColumn("prompt", prompt))
    return answered.select(
        "qid", "question", "prediction", F.col("answer").alias("gold"), _context_ids()
    )


def answer_reranked(
    passages: DataFrame,
    questions: DataFrame,
    candidates: int = fixed.RERANK_CANDIDATES,
    top_k: int = fixed.RERANK_TOP_K,
    min_conf: float = fixed.MIN_CONF,
    min_margin: float = fixed.MIN_MARGIN,
    abstain: bool = False,
    system: str | None = None,
    encode: Encoder | None = None,
    find: Finder = search,
    score: Scorer = rerank.score_overlap,
    prepare: Callable[[DataFrame], DataFrame] = rerank.add_words,
    generate: Generator | None = None,
    index: CellTable | None = None,
    max_queries: int = 0,
    ask: Callable[[DataFrame], DataFrame] = rerank.add_question_words,
) -> DataFrame:
    """Retrieve widely, re-rank, gate by confidence, then prompt and generate.

    Adds ``conf``, ``margin`` and ``low_conf`` to the baseline columns. With ``abstain``,
    unsure questions get no prompt and a fixed answer; their contexts are still reported.
    """
    questions = write_through(prompts.first_rows(questions, max_queries, F.asc("qid")), "questions")
    scored, texts = find_candidates(
        passages, questions, candidates, encode or word_encoder(), find, score, prepare, index, ask
    )
    # Stored, so that what scoring moved is off the disk before the texts are moved once more.
    ranked = write_through(rerank.rerank(scored, top_k), "ranked")

    def answer(questions: DataFrame, ranked: DataFrame) -> DataFrame:
        contexts = rerank.collect_contexts(
            ranked.join(texts.select("text_id", "passage"), "text_id"),
            "rerank_rank", F.max("conf").alias("conf"), F.max("margin").alias("margin"),
        )
        zero = F.lit(0.0)
        judged = with_contexts(questions, contexts).withColumns(
            {"conf": F.coalesce("conf", zero), "margin": F.coalesce("margin", zero)}
        )
        low = rerank.low_confidence(F.col("conf"), F.col("margin"), min_conf, min_margin)
        gated = judged.withColumn("low_conf", low)
        closed = F.col("low_conf") & F.lit(abstain)
        prompt = prompts.build_prompt(F.col("question"), F.col("contexts"), system)
        answered = (generate or echo_generator())(
            gated.withColumn("prompt", F.when(~closed, prompt))
        )
        prediction = F.when(closed, F.lit(fixed.ABSTAIN_ANSWER)).otherwise(F.col("prediction"))
        return answered.select(
            "qid", "question", prediction.alias("prediction"), F.col("answer").alias("gold"),
            _context_ids(), "conf", "margin", "low_conf",
        )

    return _in_rounds(answer, questions, ranked, _text_rounds(ranked, texts))


def sweep(
    passages: DataFrame,
    questions: DataFrame,
    top_ks=fixed.GRID_TOP_K,
    new_tokens=fixed.GRID_MAX_NEW_TOKENS,
    strategies: dict[str, str] = fixed.PROMPT_STRATEGIES,
    encode: Encoder | None = None,
    find: Finder = search,
    generate: Generator | None = None,
) -> DataFrame:
    """Answer every question under every setting, as one job with tagged rows.

    Passages are searched once, for the largest ``top_k``; each setting uses its share.
    """
    hits = find_hits(passages, questions, max(top_ks), encode or word_encoder(), find)
    hits = rerank.with_passages(hits, passages)
    asked = with_contexts(questions, rerank.collect_contexts(hits))
    # Contexts are cut before rows are repeated for the settings that use them alike.
    asked = asked.select("qid", "question", F.col("answer").alias("gold"), "contexts")
    chosen = prompts.expand_grid(asked, top_k=top_ks)
    chosen = chosen.withColumn("contexts", F.slice("contexts", F.lit(1), F.col("top_k")))
    chosen = chosen.withColumn("context_ids", _context_ids())
    rest = {"strategy": strategies, "max_new_tokens": new_tokens}
    if generate is None:
        # The echo needs no prompt: the leading words are taken once for all other settings.
        most = max(new_tokens)
        said = chosen.withColumn("pieces", leading_pieces(F.col("contexts"), F.lit(most))).drop("contexts")
        said = prompts.expand_grid(said, max_new_tokens=new_tokens)
        said = said.withColumn("prediction", joined_words(F.col("pieces"), F.col("max_new_tokens")))
        answered = prompts.expand_grid(said.drop("pieces"), strategy=strategies)
    else:
        settings = prompts.expand_grid(chosen, **rest)
        system = F.lit(None).cast("string")
        for name, text in strategies.items():
            system = F.when(F.col("strategy") == name, F.lit(text)).otherwise(system)
        prompt = prompts.build_prompt(F.col("question"), F.col("contexts"), system)
        answered = generate(settings.withColumn("prompt", prompt))
    tag = F.format_string("top_%d_new_%d_%s", "top_k", "max_new_tokens", "strategy")
    return answered.select(tag.alias("tag"), "qid", "question", "prediction", "gold", "context_ids")


def sweep_report(records: DataFrame, alpha: float = 0.05, with_squad: bool = True) -> DataFrame:
    """Comparison row per tag of :func:`sweep` records."""
    return qa_metrics.comparison_rows(qa_metrics.scores_of_different(records, with_squad), alpha)
