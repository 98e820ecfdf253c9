"""Personal data: base patterns, and a skip-chain conditional random field that adds to them.

The field stands over the tokens of a document that hold a digit or an ``@``; other tokens
are no personal data. Its labels are the kinds of the base patterns, and none. Neighbouring
tokens are joined in a chain. Skip edges join distant tokens that are the same or similar:
each to the next one with the same text, the same letters and digits, or the same six first
letters and digits, so edges are few even if a token repeats a thousand times. Tokens in a
base match are clamped to its kind. Loopy message passing spreads what is known of a token to
its like across the document; a token whose belief in a kind is at least ``BELIEF`` becomes an
added span, together with neighbours of that kind.

The field is trained piece by piece, with the base matches as labels. Potentials of chain and
skip edges tell how much more often two labels meet there than by chance, counted over all whole
texts. Token weights come from multinomial logistic regression on shape and context over a
sample: of the texts with the same set of kinds, those without one included, the ``STRATUM_ROWS``
with the smallest hash, whole. Labels weigh the same in the fit, so that rare ones are learnt; their
shares are then corrected to those of all tokens.

Whole texts are scanned where they are. Defined cases: null text is empty text and has no
spans. Equal rows get equal results. Positions count code points, ends are exclusive. Without
any base match in all the texts nothing is added. An empty table gives an empty result.
Null ids are ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import temporary_steps, write_through

KINDS = ("email", "ip", "card", "phone")  # in the order in which they are listed
NONE = len(KINDS)
LABELS = NONE + 1
BELIEF = 0.95
ROUNDS = 12
DAMPING = 0.5
STRATUM_ROWS = 1_000  # training texts of each set of kinds
FEATURE_BITS = 11
ROWS_AT_ONCE = 500
RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, n_added long"

Span = tuple[int, int, int]  # start, kind, end

# The base patterns. A number is never entered half-way, so runs of digits are met once.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile("[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches, from one ``@`` to the next: the local part reaches back to the last match at most."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        end = max(end, at + 1)
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Matches of all kinds, by start and then kind."""
    told: list[Span] = [(s, 0, e) for s, e in emails(text)]
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                told.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = digits_of(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                told.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                told.append((m.start(), 3, m.end()))
    return sorted(told)


# ------------------------------------------------------------------ tokens


TRIM = ".,;:!?\"'()[]{}<>|"


@dataclass
class Tokens:
    """Tokens of some texts that may be personal data: place of the text, start, end, and what is known."""

    doc: list[int] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    label: list[int] = field(default_factory=list)  # kind of the base match, NONE without
    before: list[str] = field(default_factory=list)  # last letters in front

    def add(self, doc: int, content: str, base: Sequence[Span]) -> None:
        """Take up the tokens of a text."""
        done, b = 0, 0
        cover = sorted((s, e, k) for s, k, e in base)
        for hint in HINT.finditer(content):
            if hint.start() < done:
                continue
            start, end = hint.start(), hint.end()
            while start > done and not content[start - 1].isspace():
                start -= 1
            found = SPACE.search(content, end)
            done = end = found.start() if found else len(content)
            core = content[start:end]
            start += len(core) - len(core.lstrip(TRIM))
            core = core.strip(TRIM)
            end = start + len(core)
            while b < len(cover) and cover[b][1] <= start:
                b += 1
            kind = NONE
            at = b
            while at < len(cover) and cover[at][0] < end:
                if cover[at][1] > start:
                    kind = cover[at][2]
                    break
                at += 1
            self.doc.append(doc)
            self.start.append(start)
            self.end.append(end)
            self.text.append(core)
            self.label.append(kind)
            self.before.append(content[max(0, start - 12) : start].lower())


SPACE = re.compile(r"\s")


def shape_of(text: str) -> str:
    """Kind of each character, runs put together: digits, letters, or the mark itself."""
    told = re.sub("[0-9]+", "0", text[:64])
    return re.sub(r"[^\W\d_]+", "a", told)


def features(tokens: Tokens) -> np.ndarray:
    """Hashed features of each token, the same number for each: shapes of it and its neighbours, sizes, checks, context."""
    shapes = [shape_of(t) for t in tokens.text]
    rows = []
    for i, text in enumerate(tokens.text):
        digits = digits_of(text[:64])
        same = lambda j: 0 <= j < len(shapes) and tokens.doc[j] == tokens.doc[i]
        parts = text.split(".")
        names = (
            "shape " + shapes[i],
            f"shape {shapes[i]} {len(digits)}",
            f"digits {len(digits)}",
            f"luhn {12 <= len(digits) <= 19 and luhn(digits)} {len(digits) >= 12}",
            f"octets {len(parts) == 4 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in parts)} {len(parts)}",
            f"at {text.count('@')} {'.' in text.rpartition('@')[2]}",
            "left " + (shapes[i - 1] if same(i - 1) and tokens.start[i] - tokens.end[i - 1] <= 4 else ""),
            "right " + (shapes[i + 1] if same(i + 1) and tokens.start[i + 1] - tokens.end[i] <= 4 else ""),
            "mark " + tokens.before[i][-2:],
            "word " + "".join(re.findall(r"[^\W\d_]+", tokens.before[i])[-1:]),
        )
        rows.append([_hashed(n) for n in names])
    return np.array(rows, np.int64).reshape(len(rows), 10)


def _hashed(name: str) -> int:
    h = 2166136261
    for c in name.encode():
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) & (1 << FEATURE_BITS) - 1


def edges(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Chain edges (neighbours a few characters apart) and skip edges (the next same or similar token)."""
    chain, skip = [], set()
    last: dict[tuple, int] = {}
    for i, (doc, text) in enumerate(zip(tokens.doc, tokens.text)):
        if i and tokens.doc[i - 1] == doc and tokens.start[i] - tokens.end[i - 1] <= 4:
            chain.append((i - 1, i))
        bare = "".join(filter(str.isalnum, text.lower()))
        keys = [(doc, 0, text), (doc, 1, bare)] + ([(doc, 2, bare[:6])] if len(bare) >= 6 else [])
        for key in keys:
            if key in last:
                skip.add((last[key], i))
            last[key] = i
    as_rows = lambda pairs: np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return as_rows(chain), as_rows(skip)


# ------------------------------------------------------------------ field


@dataclass(frozen=True)
class Field:
    """Token weights by hashed feature and label, and potentials of the two sorts of edges."""

    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, tokens: Tokens) -> np.ndarray:
        """Belief of each token in each label, after rounds of messages along all edges."""
        found = features(tokens)
        own = self.weights[found].sum(axis=1)
        label = np.array(tokens.label)
        known = label != NONE
        own[known] = -30.0
        own[known, label[known]] = 0.0
        own -= own.max(axis=1, keepdims=True)
        chain, skip = edges(tokens)
        pairs = np.concatenate([chain, skip])
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        table = np.stack([self.chain, self.skip])[np.repeat([0, 1], [len(chain), len(skip)])]
        tables = np.concatenate([table, table.transpose(0, 2, 1)]) if len(pairs) else np.zeros((0, LABELS, LABELS))
        messages = np.zeros((len(source), LABELS))
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        total = own
        for _ in range(ROUNDS if len(pairs) else 0):
            out = (total[source] - messages[back])[:, :, None] + tables
            top = out.max(axis=1)
            sent = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            sent -= sent.max(axis=1, keepdims=True)
            messages = DAMPING * messages + (1 - DAMPING) * sent
            total = own.copy()
            np.add.at(total, target, messages)
        told = np.exp(total - total.max(axis=1, keepdims=True))
        return told / told.sum(axis=1, keepdims=True)

    def added(self, contents: Sequence[str], base: Sequence[Sequence[Span]]) -> list[list[Span]]:
        """Spans that the field adds to the base ones of each text."""
        tokens, told = Tokens(), [[] for _ in contents]
        for i, (content, spans) in enumerate(zip(contents, base)):
            tokens.add(i, content, spans)
        if not tokens.doc or not self.weights.any():
            return told
        believed = self.beliefs(tokens)
        best = believed.argmax(axis=1)
        sure = believed[np.arange(len(best)), best] >= BELIEF
        for i in np.flatnonzero(sure & (best != NONE) & (np.array(tokens.label) == NONE)):
            doc, start, end, kind = tokens.doc[i], tokens.start[i], tokens.end[i], int(best[i])
            if end <= start:
                continue
            last = told[doc][-1] if told[doc] else None
            if last and last[1] == kind and start - last[2] == 1:
                told[doc][-1] = (last[0], kind, end)
            else:
                told[doc].append((start, kind, end))
        return told


def _meeting(counts: np.ndarray) -> np.ndarray:
    """Log of how much more often two labels meet on such edges than by chance, smoothed, from how often they meet."""
    counts = counts + 1.0
    counts = (counts + counts.T) / 2
    alone = counts.sum(axis=0)
    return np.log(counts * counts.sum() / np.outer(alone, alone))


def _strata(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task counts: (sort, a, b, n) of labels (sort 0) and of pairs that meet on chain (1) and skip edges (2);
    and (3, set of kinds, hash, 0) of the texts with the smallest hashes."""
    labels, meet = np.zeros(LABELS, np.int64), np.zeros((3, LABELS, LABELS), np.int64)
    least: dict[int, list[int]] = {}
    for batch in (b.slice(s, ROWS_AT_ONCE) for b in batches for s in range(0, b.num_rows, ROWS_AT_ONCE)):
        tokens = Tokens()
        for i, (content, h) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            base = base_spans(content)
            tokens.add(i, content, base)
            own = least.setdefault(sum({1 << k for _, k, _ in base}), [])
            own.append(h)
            if len(own) > 4 * STRATUM_ROWS:
                own[:] = sorted(set(own))[:STRATUM_ROWS]
        label = np.array(tokens.label, np.int64)
        labels += np.bincount(label, minlength=LABELS)
        for sort, pairs in zip((1, 2), edges(tokens)):
            np.add.at(meet[sort], (label[pairs[:, 0]], label[pairs[:, 1]]), 1)
    told = [(0, k, 0, int(n)) for k, n in enumerate(labels)]
    told += [(sort, a, b, int(meet[sort, a, b])) for sort in (1, 2) for a in range(LABELS) for b in range(LABELS)]
    told += [(3, kinds, h, 0) for kinds, own in least.items() for h in sorted(set(own))[:STRATUM_ROWS]]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*told)], names=["sort", "a", "b", "n"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label and features of each token, equal ones of a run together with their number."""
    for batch in (b.slice(s, ROWS_AT_ONCE) for b in batches for s in range(0, b.num_rows, ROWS_AT_ONCE)):
        tokens = Tokens()
        for i, content in enumerate(batch.column(0).to_pylist()):
            tokens.add(i, content, base_spans(content))
        rows, n = np.unique(np.column_stack([np.array(tokens.label, np.int64), features(tokens)]), axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.list_(pa.int64())), pa.array(n)], names=["told", "n"])


def fit_field(documents: DataFrame, text: str = "text") -> Field:
    """The field for these documents: meetings of labels from all of them, token weights from a sample."""
    content = F.col(text)
    rows = documents.filter(F.rlike(content, F.lit("[0-9@]"))).select(content.alias("t"), F.xxhash64(content).alias("h"))
    with temporary_steps(documents.sparkSession):
        counted = rows.mapInArrow(_strata, "sort long, a long, b long, n long").groupBy("sort", "a", "b").agg(F.sum("n").alias("n"))
        counted = write_through(counted, "pii-counts")
        labels, meet = np.zeros(LABELS), np.zeros((3, LABELS, LABELS))
        for r in counted.filter("sort < 3").collect():  # 55 rows at most
            if r.sort == 0:
                labels[r.a] = r.n
            else:
                meet[r.sort, r.a, r.b] = r.n
        weights = np.zeros((1 << FEATURE_BITS, LABELS))
        if not labels[:NONE].any():
            return Field(weights, np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
        hashes = [counted.filter((F.col("sort") == 3) & (F.col("a") == k)).orderBy("b").limit(STRATUM_ROWS).select("b") for k in range(1 << NONE)]
        few = hashes[0]
        for more in hashes[1:]:
            few = few.unionAll(more)
        few = write_through(few, "pii-hashes")
        taken = rows.join(F.broadcast(few), rows["h"] == few["b"], "left_semi").select("t").distinct()
        seen = write_through(taken.mapInArrow(_examples, "told array<long>, n long"), "pii-sample")
        seen = seen.groupBy("told").agg(F.sum("n").alias("n")).toArrow()  # different tokens of the sample
    told = np.array(seen["told"].to_pylist(), np.int64).reshape(-1, 11)
    n = seen["n"].to_numpy().astype(float)
    told, n = told[order := np.lexsort(told.T)], n[order]
    label, found = told[:, 0], told[:, 1:]
    sampled = np.bincount(label, n, LABELS)
    even = 1 / np.count_nonzero(sampled)
    goal, share = np.eye(LABELS)[label], even * n / sampled[label]
    speed = np.zeros_like(weights)
    for _ in range(200):  # gradient steps with momentum on the mean log-likelihood, weights shrunk
        scores = weights[found].sum(axis=1)
        shares = np.exp(scores - scores.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        apart = (shares - goal) * share[:, None]
        slope = np.zeros_like(weights)
        for j in range(found.shape[1]):
            np.add.at(slope, found[:, j], apart)
        speed = 0.9 * speed - 0.5 * (slope + 1e-4 * weights)
        weights += speed
    shift = np.log(np.maximum(labels, 1) / labels.sum()) - np.log(even)
    weights += shift / found.shape[1]  # each token has so many features
    return Field(weights, _meeting(meet[1]), _meeting(meet[2]))


# ------------------------------------------------------------------ documents


def listed(spans: Sequence[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)])


def found_in(contents: Sequence[str], model: Field) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans and added spans of each text."""
    base = [base_spans(c) if HINT.search(c) else [] for c in contents]
    return base, model.added(contents, base)


def personal_data(documents: DataFrame, model: Field, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row for each document: counts of base spans, base spans, all spans, number of added ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(s, ROWS_AT_ONCE) for b in batches for s in range(0, b.num_rows, ROWS_AT_ONCE)):
            base, added = found_in(batch.column(1).to_pylist(), model)
            counts = [pa.array([sum(k == kind for _, k, _ in b) for b in base], pa.int64()) for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *counts,
                    pa.array([listed(b) for b in base], pa.string()),
                    pa.array([listed([*b, *a]) for b, a in zip(base, added)], pa.string()),
                    pa.array([len(a) for a in added], pa.int64()),
                ],
                names=[c.split()[0] for c in RESULT.split(", ")],
            )

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(run, RESULT)


def masked(content: str, spans: Sequence[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are one, of the first's kind."""
    told, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            told.append(f"{content[at:start]}[{KINDS[kind].upper()}]")
        at = max(at, end)
    return "".join(told) + content[at:]


def mask(documents: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``documents`` with the personal data in ``text`` masked; null stays null, columns as they were."""

    @F.pandas_udf("string")
    def hide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for contents in batches:
            values = [c or "" for c in contents]
            told: list[str] = []
            for s in range(0, len(values), ROWS_AT_ONCE):
                some = values[s : s + ROWS_AT_ONCE]
                told += [masked(c, [*b, *a]) if b or a else c for c, b, a in zip(some, *found_in(some, model))]
            yield pd.Series(told, dtype=object)

    content = F.col(text)
    return documents.withColumn(text, F.when(content.isNotNull(), hide(F.coalesce(content, F.lit("")))))
