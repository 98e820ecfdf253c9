"""Topic model by batch variational Bayes, with the topic-word table as a stored table by word.

Words are numbered by their place in the sorted vocabulary, from per-partition counts; a
document becomes a list of words and counts, and documents are dealt to blocks of about
``BLOCK_ROWS`` pairs, stored once. The topic-word table holds one row a word: the K variational
parameters of its topic weights. Each pass sends a word's row once to each block that holds the
word, updates the topic parameters of the block's documents (numpy, documents of like length
together, each document until its parameters change less than ``DOC_TOLERANCE``), and sends
back what the block adds to each word's weights; summed by word, these are the next table,
written to the shared folder partitioned by word. The driver holds K totals a pass, never words
or vectors.

Defined cases: documents without a vocabulary word have no topic and share 0. Words are ordered
bytewise; ties in topic weight go to the smaller word. An empty corpus gives no topics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import write_through
from .numbering import number_rows

DOC_TOLERANCE = 1e-4  # mean change of a document's topic parameters at which its update stops
DOC_STEPS = 10_000  # guard against a document whose update never settles; not reached in practice
TABLE_PARTS_ROWS = 50_000  # words a partition of the stored table
BLOCK_ROWS = 1_000_000  # (document, word) pairs a block, about
SMALL_ROWS = 20_000  # pairs that are worth a block of their own while there are few
STEP_ROWS = 400_000  # pairs that step at once, and of them
GROUP_ROWS = 20_000  # pairs of documents of like length, as one stack
SPARE_ROWS = 2_000  # filled up places that cost less than a stack of their own
SHORT = 64  # words a document below which a stack is multiplied as a whole


@dataclass(frozen=True)
class Settings:
    topics: int = 5
    passes: int = 10
    seed: int = 42
    tolerance: float = 1e-6  # relative change of the topic totals at which passes stop
    alpha: float | None = None  # document prior; 1 / topics if not given
    eta: float | None = None  # topic-word prior; 1 / topics if not given

    @property
    def doc_prior(self) -> float:
        return self.alpha if self.alpha is not None else 1.0 / self.topics

    @property
    def word_prior(self) -> float:
        return self.eta if self.eta is not None else 1.0 / self.topics


def digamma(x: np.ndarray) -> np.ndarray:
    """Digamma by six steps of the recurrence and the asymptotic series."""
    x = np.asarray(x, dtype=np.float64)
    out = -1.0 / x
    for i in range(1, 6):
        out -= 1.0 / (x + i)
    x = x + 6.0
    f = 1.0 / (x * x)
    series = f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))
    return out + np.log(x) - 0.5 / x - series


def _alike(lengths: np.ndarray) -> Iterator[slice]:
    """Stretches of documents, sorted by length, whose filling up to the longest costs little."""
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        before = ends[first - 1] if first else 0
        held = ends[first : first + GROUP_ROWS] - before
        full = lengths[first : first + GROUP_ROWS] * np.arange(1, len(held) + 1)
        fits = (full - held <= np.maximum(held // 8, SPARE_ROWS)) & (full <= GROUP_ROWS)
        last = first + max(1, len(fits) if fits.all() else int(fits.argmin()))
        yield slice(first, last)
        first = last


def update_documents(place: np.ndarray, counts: np.ndarray, weights: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Topic parameters of documents and what each adds to its words' weights.

    Rows are (document, word) pairs sorted by document; ``place`` is the document's number
    (0, 1, ...) of each row and ``weights`` holds exp(E[log beta]) of the row's word. Each
    document steps until its parameters change by less than ``DOC_TOLERANCE`` on average,
    then keeps them while the others go on. All documents step together, those of like length
    as one stack of matrices, the shorter ones filled up with words of count 0.
    """
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    lengths = np.diff(np.r_[starts, len(place)])
    gamma = _settle(starts, lengths, counts, weights, alpha)
    theta = np.repeat(_shares(gamma), lengths, axis=0)
    norms = np.einsum("ij,ij->i", weights, theta) + 1e-100
    return gamma, (counts / norms)[:, None] * theta * weights


def _shares(gamma: np.ndarray) -> np.ndarray:
    topics = gamma.shape[1]
    both = digamma(np.concatenate([gamma, gamma.sum(axis=1, keepdims=True)], axis=1))
    return np.exp(both[:, :topics] - both[:, topics:])


def _stack(starts: np.ndarray, lengths: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (document, word) and weights (document, topic, word) of documents, filled up to the longest."""
    at = np.arange(lengths.max())
    held = at < lengths[:, None]
    rows = np.where(held, starts[:, None] + at, starts[:, None])
    return np.where(held, counts[rows], 0.0), np.ascontiguousarray(weights[rows].transpose(0, 2, 1))


def _found(theta: np.ndarray, n: np.ndarray, stack: np.ndarray) -> np.ndarray:
    """What the words of each document in a stack say for its topics, before the document's own shares."""
    if n.shape[1] < SHORT:  # one call for each document would cost more than its words
        ratio = np.einsum("dk,dkw->dw", theta, stack)
        np.divide(n, ratio + 1e-100, out=ratio)
        return np.einsum("dkw,dw->dk", stack, ratio)
    ratio = np.matmul(theta[:, None, :], stack)[:, 0, :]
    np.divide(n, ratio + 1e-100, out=ratio)
    return np.matmul(stack, ratio[:, :, None])[:, :, 0]


def _settle(starts: np.ndarray, lengths: np.ndarray, counts: np.ndarray, weights: np.ndarray, alpha: float) -> np.ndarray:
    """Topic parameters of documents; settled ones leave the work, which is stacked anew once
    they are a quarter of it, so that a few slow documents do not hold many small stacks."""
    gamma = np.ones((len(starts), weights.shape[1]))
    ids = np.argsort(lengths, kind="stable")  # documents in the work, by length
    steps = 0
    while len(ids) and steps < DOC_STEPS:
        stacks = [(part, *_stack(starts[ids[part]], lengths[ids[part]], counts, weights)) for part in _alike(lengths[ids])]
        g, live = gamma[ids], np.ones(len(ids), dtype=bool)
        new = np.empty_like(g)
        while steps < DOC_STEPS and live.sum() * 4 > len(live) * 3:
            theta = _shares(g)
            for part, n, stack in stacks:
                new[part] = _found(theta[part], n, stack)
            new *= theta
            new += alpha
            change = np.abs(new - g).mean(axis=1)
            g = np.where(live[:, None], new, g)
            live &= change >= DOC_TOLERANCE
            steps += 1
        gamma[ids] = g
        ids = ids[live]
    return gamma


def update_document(counts: np.ndarray, weights: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """:func:`update_documents` for the words of one document."""
    gamma, add = update_documents(np.zeros(len(counts), dtype=np.int64), counts, weights, alpha)
    return gamma[0], add


def expected_weights(table: np.ndarray, totals: np.ndarray) -> np.ndarray:
    return np.exp(digamma(table) - digamma(totals)[None, :])


def number_words(vocabulary: DataFrame) -> DataFrame:
    """(token, word): the place of each token in bytewise order."""
    return number_rows(vocabulary.select("token"), [F.col("token")], "word")


def word_counts(bags: DataFrame, words: DataFrame, key: str = "id") -> DataFrame:
    """(doc, word, n) from rows (key, token, n), of the words that have a number."""
    return bags.join(words, "token").select(F.col(key).alias("doc"), "word", F.col("n").cast("double").alias("n"))


def initial_table(words: DataFrame, settings: Settings) -> DataFrame:
    """(word, lam): weights near 1, drawn from the word's number and the seed."""
    draws = [
        F.lit(0.5) + (F.abs(F.xxhash64("word", F.lit(k), F.lit(settings.seed))) % 1_000_000) / F.lit(1_000_000.0)
        for k in range(settings.topics)
    ]
    return words.select("word", F.array(*draws).alias("lam"))


def _store(table: DataFrame, words: int) -> DataFrame:
    parts = max(1, -(-words // TABLE_PARTS_ROWS))
    return write_through(table.repartition(parts, "word"), "topic-words")


def _totals(table: DataFrame, topics: int) -> np.ndarray:
    row = table.agg(*[F.sum(F.col("lam")[k]) for k in range(topics)]).first()
    return np.array([row[k] or 0.0 for k in range(topics)])


def _flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy()


def _lists(rows: np.ndarray) -> pa.ListArray:
    width = rows.shape[1] if rows.ndim == 2 else 0
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), pa.float64()))


def lay_out(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The counts for the passes, stored: documents ``(block, doc, words, ns)``, and the words
    ``(block, word)`` that each block of documents holds, each once.

    Rows without a document stand alone.
    """
    rows = counts.count()
    tasks = 3 * counts.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-rows // BLOCK_ROWS), min(tasks, rows // SMALL_ROWS))
    alone = F.when(F.col("doc").isNull(), F.col("word"))
    block = F.pmod(F.xxhash64("doc", "alone"), F.lit(blocks)).cast("int").alias("block")
    bags = counts.withColumn("alone", alone).groupBy("doc", "alone").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("bag"))
    documents = write_through(bags.select(block, "doc", F.col("bag.word").alias("words"), F.col("bag.n").alias("ns")), "topic-documents")
    held = documents.select("block", F.explode("words").alias("word")).distinct()
    return documents, write_through(held, "topic-held")


def e_step(documents: DataFrame, held: DataFrame, table: DataFrame, totals: np.ndarray, settings: Settings, gammas: bool = False) -> DataFrame:
    """One pass over all documents: (word, add) rows, or (doc, gamma) rows with ``gammas``.

    The weights of a word go once to each block of documents that holds it, not once to each
    document, and what the block adds to the word is summed there.
    """
    alpha, topics = settings.doc_prior, settings.topics
    sent = held.join(table, "word").select("block", "word", "lam")

    def update(docs: pa.Table, words: pa.Table) -> pa.Table:
        number = words.column("word").to_numpy()
        order = np.argsort(number)
        number = number[order]
        weights = expected_weights(_flat(words.column("lam")).reshape(-1, topics)[order], totals)
        lists = docs.column("words").combine_chunks()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        at, n = np.searchsorted(number, _flat(lists)), _flat(docs.column("ns"))
        added, found = np.zeros_like(weights), []
        first = 0
        while first < len(ends):  # some documents at once, so that what is held beside the block is bounded
            start = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, start + STEP_ROWS, side="right")))
            part = slice(start, ends[last - 1])
            place = np.repeat(np.arange(last - first), np.diff(np.r_[start, ends[first:last]]))
            gamma, add = update_documents(place, n[part], weights[at[part]], alpha)
            if gammas:
                found.append(gamma)
            else:
                for k in range(topics):
                    added[:, k] += np.bincount(at[part], add[:, k], len(number))
            first = last
        if gammas:
            gamma = np.concatenate(found) if found else np.zeros((0, topics))
            return pa.Table.from_arrays([docs.column("doc"), _lists(gamma)], names=["doc", "gamma"])
        return pa.Table.from_arrays([pa.array(number), _lists(added)], names=["word", "add"])

    schema = f"doc {documents.schema['doc'].dataType.simpleString()}, gamma array<double>" if gammas else "word long, add array<double>"
    return documents.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(update, schema)


@dataclass
class Model:
    table: DataFrame  # (word, lam), stored by word
    documents: DataFrame  # (block, doc, words, ns), stored
    held: DataFrame  # (block, word), stored
    totals: np.ndarray  # sum of lam over words, a topic
    history: list[float]  # sum of all lam after each pass
    settings: Settings

    def gammas(self) -> DataFrame:
        """(doc, gamma) of every document with a vocabulary word."""
        return e_step(self.documents, self.held, self.table, self.totals, self.settings, gammas=True)


def fit(counts: DataFrame, words: DataFrame, settings: Settings = Settings()) -> Model:
    """The topic-word table after the passes, stored, with what the passes left."""
    documents, held = lay_out(write_through(counts, "topic-counts"))
    n_words = words.count()
    table = _store(initial_table(words, settings), n_words)
    totals = _totals(table, settings.topics)
    history = [float(totals.sum())]
    eta = settings.word_prior
    for _ in range(settings.passes):
        adds = e_step(documents, held, table, totals, settings)
        summed = adds.groupBy("word").agg(*[F.sum(F.col("add")[k]).alias(f"s{k}") for k in range(settings.topics)])
        fresh = words.select("word").join(summed, "word", "left").select(
            "word", F.array(*[F.lit(eta) + F.coalesce(F.col(f"s{k}"), F.lit(0.0)) for k in range(settings.topics)]).alias("lam")
        )
        table = _store(fresh, n_words)
        new_totals = _totals(table, settings.topics)
        change = np.abs(new_totals - totals).sum() / max(np.abs(totals).sum(), 1e-300)
        totals = new_totals
        history.append(float(totals.sum()))
        if change < settings.tolerance:
            break
    return Model(table, documents, held, totals, history, settings)


def topic_words(table: DataFrame, words: DataFrame, topics: int, top: int) -> DataFrame:
    """(topic, rank, token, weight): the ``top`` heaviest words of each topic, weights normalised.

    The best of each topic are picked in slices of the words first, so that no task sorts a
    whole topic.
    """
    totals = _totals(table, topics)  # K numbers
    long = table.select(
        "word",
        F.explode(F.array(*[F.struct(F.lit(k).alias("topic"), (F.col("lam")[k] / F.lit(float(totals[k]))).alias("weight")) for k in range(topics)])).alias("t"),
    ).select("word", "t.topic", "t.weight")
    slices = max(1, TABLE_PARTS_ROWS // max(top, 1))
    local = Window.partitionBy("topic", F.col("word") % slices).orderBy(F.desc("weight"), "word")
    near = long.withColumn("r", F.row_number().over(local)).filter(F.col("r") <= top)
    best = Window.partitionBy("topic").orderBy(F.desc("weight"), "word")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(words, "word").select("topic", "rank", "token", "weight")


def leading_topics(gammas: DataFrame, documents: DataFrame, key: str, least: float) -> DataFrame:
    """(key, topic, share): each document's largest topic share if it reaches ``least``."""
    shares = F.transform("gamma", lambda g: g / F.aggregate("gamma", F.lit(0.0), lambda a, b: a + b))
    best = F.array_max(F.filter(F.transform(shares, lambda s, i: F.struct(s.alias("share"), (-i).alias("back"))), lambda c: c["share"] >= least))
    led = gammas.select("doc", (-best["back"]).alias("topic"), F.coalesce(best["share"], F.lit(0.0)).alias("share"))
    return documents.select(F.col(key).alias("doc")).join(led, "doc", "left").select(
        F.col("doc").alias(key), "topic", F.coalesce("share", F.lit(0.0)).alias("share")
    )
