"""Toxicity by a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text is its set of lower-cased n-grams, hashed to buckets. From labelled texts come the
smoothed log ratios of how often each bucket occurs in toxic and in other texts. A logistic
regression on all buckets of these texts, each scaled by its ratio, gives the weights; smoothing
and regularisation damp the rare ones. Smoothing is dealt to the classes by their shares, so that
a bucket seen once tells little whatever the shares. The vectors of all texts have one length, so
that a long text, with its many buckets of small ratios, outweighs no short one. A score is the
logistic of the sum of weights of a text's buckets, at that length.

Fitting takes at most ``TRAIN_ROWS`` labelled texts a class, those with the smallest hash of
their id; the class shares of all labelled rows set the intercept. Scoring takes whole texts
where they are, without a shuffle, and needs only the tables of weights and ratios, 12 MB whatever the data.

Defined cases: null text is empty text, whose score comes from the intercept. A null label is
no label; if an id has several labels the largest counts. With labels of one class only every
score is that class (0 or 1), without labels 0. Repeated rows get equal scores. A null id has
no label. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import small_batches, temporary_steps, write_through

SIZES = (3, 4, 5)
BUCKET_BITS = 20
TRAIN_ROWS = 10_000  # labelled texts of each class, at most
FIT_TASKS = 4  # of the bounded fit; MLlib sums gradients of so few tasks without a shuffle
SMOOTHING = 10.0  # texts that hold a bucket in advance, dealt to the classes by their shares
LENGTH = 10.0  # of each text's vector
REGULARISATION = 1e-3
STEPS = 40
THRESHOLD = 0.3
CHARS_AT_ONCE = 1 << 18


def gram_buckets(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each n-gram occurrence of the texts: place of its text, and bucket."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(padded), dtype=np.int32), [len(t) for t in padded])
    docs, buckets = [], []
    with np.errstate(over="ignore"):
        rolling = codes.copy()
        for n in range(2, max(SIZES) + 1):
            rolling = rolling[:-1] * np.uint32(0x01000193) + codes[n - 1 :]
            if n in SIZES and len(rolling):
                mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
                mixed ^= mixed >> np.uint32(13)
                mixed *= np.uint32(0xC2B2AE35)
                inside = doc[: len(rolling)] == doc[n - 1 :]
                docs.append(doc[: len(rolling)][inside])
                buckets.append((mixed[inside] >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
    if not docs:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(docs), np.concatenate(buckets)


def runs(texts: Sequence[str]) -> Iterator[tuple[int, Sequence[str]]]:
    """Texts in runs of bounded length together, each with the place of its first; a longer text is its own run."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHARS_AT_ONCE:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def distinct_buckets(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket of each text once: places of the texts, and buckets, in order."""
    doc, bucket = gram_buckets(texts)
    key = doc.astype(np.int64) << BUCKET_BITS | bucket
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return (key >> BUCKET_BITS).astype(np.int64), (key & ((1 << BUCKET_BITS) - 1)).astype(np.int64)


def stretch(doc: np.ndarray, values: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """What brings the vector of each text to ``LENGTH``, and the share of it that is reached:
    near 1, but less where a text holds next to nothing that tells the classes apart."""
    squares = np.bincount(doc, np.square(values, dtype=np.float64), texts)
    factor = LENGTH / np.sqrt(squares + 1.0)
    return factor, factor * np.sqrt(squares) / LENGTH


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BUCKET_BITS))  # of each bucket
    ratios: np.ndarray = field(default_factory=lambda: np.zeros(1 << BUCKET_BITS, np.float32))  # that its vectors hold
    intercept: float = -math.inf  # of texts without a weighted bucket; infinite if labels do not tell
    offset: float = 0.0  # of texts whose vector has the full length

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        if math.isinf(self.intercept):
            return np.full(len(texts), float(self.intercept > 0))
        return 1.0 / (1.0 + np.exp(-np.clip(self.sums(texts), -700, 700)))

    def sums(self, texts: Sequence[str]) -> np.ndarray:
        """Of each text the intercept and the weights of its buckets, at the length of all vectors."""
        total = np.full(len(texts), self.intercept)
        for first, part in runs(texts):
            doc, bucket = distinct_buckets(part)
            factor, share = stretch(doc, self.ratios[bucket], len(part))
            total[first : first + len(part)] += np.bincount(doc, self.weights[bucket], len(part)) * factor + self.offset * share
        return total


def training_rows(documents: DataFrame, labels: DataFrame, text: str, id_column: str, label: str) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """The bounded sample (label, text), stored, and for each class its rows: labelled, sampled."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    per_id = known.groupBy(F.col(id_column).alias("id")).agg(F.max((F.col(label) == 1).cast("int")).alias("y"))
    per_id = write_through(per_id, "labels")
    totals = {r["y"]: r["count"] for r in per_id.groupBy("y").count().collect()}
    order = F.xxhash64(F.col("id").cast("string"))
    picked = [per_id.filter(F.col("y") == y).orderBy(order, "id").limit(TRAIN_ROWS) for y in (0, 1)]
    sample = picked[0].unionAll(picked[1])  # at most twice TRAIN_ROWS rows, so sent to the texts
    rows = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    stored = write_through(rows.join(F.broadcast(sample), "id").select("y", "text"), "labelled")
    sampled = {r["y"]: r["count"] for r in stored.groupBy("y").count().collect()}
    return stored, {y: (totals.get(y, 0), sampled.get(y, 0)) for y in (0, 1)}


def sparse_vectors(size: int, ends: np.ndarray, places: np.ndarray, values: np.ndarray) -> pa.StructArray:
    """MLlib's sparse vectors in Arrow: vector i holds the entries from ``ends[i]`` to ``ends[i + 1]``."""
    n = len(ends) - 1
    return pa.StructArray.from_arrays(
        [
            pa.array(np.zeros(n, np.int8)),
            pa.array(np.full(n, size, np.int32)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(places, pa.int32())),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.float64())),
        ],
        names=["type", "size", "indices", "values"],
    )


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    for batch in batches:
        y, texts = batch.column("y").to_numpy(), batch.column("text").to_pylist()
        for first, part in runs(texts):
            doc, bucket = distinct_buckets(part)
            for c in (0, 1):
                counts[c] += np.bincount(bucket[y[first + doc] == c], minlength=1 << BUCKET_BITS)
    at = np.flatnonzero(counts.sum(axis=0))
    for s in range(0, len(at), 10_000):
        part = at[s : s + 10_000]
        yield pa.RecordBatch.from_pydict({"bucket": part, "n0": counts[0][part], "n1": counts[1][part]})


def _ratios(sample: DataFrame, n0: int, n1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets that occur in the sample, in order, the log ratio of each and whether several texts
    hold it. The counts are let go here."""
    counted = sample.mapInArrow(_bucket_counts, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    seen = counted.toArrow()  # one row a bucket at most
    bucket, k0, k1 = (seen[c].to_numpy() for c in ("bucket", "n0", "n1"))
    order = np.argsort(bucket)
    bucket, k0, k1 = bucket[order].astype(np.int32), k0[order], k1[order]
    per_text = SMOOTHING / (n0 + n1)
    return bucket, (np.log(k1 / n1 + per_text) - np.log(k0 / n0 + per_text)).astype(np.float32), k0 + k1 > 1


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "toxic") -> ToxicityModel:
    """The classifier for ``label`` = 1, from the rows of ``labels`` (id, label) that have a text."""
    with temporary_steps(documents.sparkSession):
        return _fitted(documents, labels, text, id_column, label)


def _fitted(documents: DataFrame, labels: DataFrame, text: str, id_column: str, label: str) -> ToxicityModel:
    sample, classes = training_rows(documents, labels, text, id_column, label)
    (all0, n0), (all1, n1) = classes[0], classes[1]
    if not n0 or not n1:
        return ToxicityModel(intercept=math.inf if n1 else -math.inf)
    bucket, ratio, shared = _ratios(sample, n0, n1)
    if not len(bucket):
        return ToxicityModel(intercept=math.log(all1 / all0))
    place = np.full(1 << BUCKET_BITS, -1, np.int32)
    place[bucket] = np.arange(len(bucket), dtype=np.int32)

    size = len(bucket)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, part in runs(texts.to_pylist()):
                doc, found = distinct_buckets(part)
                ends = np.searchsorted(doc, np.arange(len(part) + 1)).astype(np.int32)
                known = place[found]  # in order within a text, as buckets are
                values = ratio[known] * stretch(doc, ratio[known], len(part))[0][doc]
                label = batch.column("y").slice(first, len(part)).cast(pa.float64())
                yield pa.RecordBatch.from_arrays([label, sparse_vectors(size, ends, known, values)], names=["label", "features"])

    # The task that cuts the texts also lays out the vectors: no second worker, no object an entry.
    rows = sample.coalesce(FIT_TASKS).mapInArrow(features, T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())]))
    learner = LogisticRegression(maxIter=STEPS, regParam=REGULARISATION, standardization=False)
    model = learner.fit(rows)
    weights, ratios = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS, np.float32)
    weights[bucket], ratios[bucket] = model.coefficients.toArray() * ratio, ratio
    alone = bucket[~shared]
    return _calibrated(sample, ToxicityModel(weights, ratios, 0.0), alone, math.log(all1 / all0), math.log(n1 / n0))


def _calibrated(sample: DataFrame, model: ToxicityModel, alone: np.ndarray, odds: float, sampled_odds: float) -> ToxicityModel:
    """The model with its sums stretched and moved to tell the chances of the sample's texts.

    The steps of the fit end while weights are still short, so that its sums rank texts well but
    stay near the share of toxic ones. The buckets that only one text of the sample holds
    (``alone``) are left out here, as a text not fitted has none of them. Texts that tell nothing get the log odds of all labels.
    """

    plain = ToxicityModel(model.weights.copy(), model.ratios.copy(), model.intercept)
    plain.weights[alone] = plain.ratios[alone] = 0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = plain.sums(batch.column("text").to_pylist())
            ends = np.arange(len(total) + 1, dtype=np.int32)
            vectors = sparse_vectors(1, ends, np.zeros(len(total), np.int32), total)
            yield pa.RecordBatch.from_arrays([batch.column("y").cast(pa.float64()), vectors], names=["label", "features"])

    rows = sample.coalesce(FIT_TASKS).mapInArrow(sums, T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())]))
    line = LogisticRegression(maxIter=STEPS, regParam=REGULARISATION).fit(rows)
    return ToxicityModel(model.weights * line.coefficients[0], model.ratios, odds, line.intercept - sampled_odds)


def score(documents: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``documents`` with the score of each text (0 to 1) in the column ``out``."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts.to_list()), dtype="float64")

    return documents.withColumn(out, scores(F.coalesce(F.col(text), F.lit(""))))


def held_out(id_column: str = "doc_id"):
    """Whether an id belongs to the fold that is kept from fitting: CRC-32 of its text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_scores(documents: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted), fitted on the labels outside the held-out fold."""
    model = fit(documents, labels.filter(~held_out(id_column)), text, id_column)
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    return score(rows, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(documents: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``documents`` without those whose score reaches the threshold, columns as they were.

    The rows are stored here, as only a step run here hands texts to Python in small batches.
    """
    spark = documents.sparkSession
    with small_batches(spark), temporary_steps(spark) as steps:
        model = fit(documents, labels.filter(~held_out(id_column)), text, id_column)
        clean = score(documents, model, text, "__toxicity").filter(F.col("__toxicity") < THRESHOLD).drop("__toxicity")
        return steps.keep(clean, "clean")
