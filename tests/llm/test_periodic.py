"""Periodic runs against a comparison of every period."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from answerloom.llm import periodic_runs as pr


def brute_runs(ids):
    n, found = len(ids), set()
    for q in range(1, n // 3 + 1):
        eq = ids[:-q] == ids[q:]
        x = 0
        while x < len(eq):
            if not eq[x]:
                x += 1
                continue
            y = x
            while y < len(eq) and eq[y]:
                y += 1
            s, e = x, y + q
            if e - s >= 3 * q and not any(np.array_equal(ids[s : e - p], ids[s + p : e]) for p in range(1, q)):
                found.add((s, e, q))
            x = y
    return sorted(found)


def brute_describe(text, doc_id):
    words = pr.planted(pr.WORD.findall(text or ""), doc_id)
    ids = np.array([hash(w) for w in words], dtype=np.int64)
    runs = sorted(((s, e - s, q) for s, e, q in brute_runs(ids) if e - s >= max(24, 3 * q)), key=lambda r: (r[0], r[2]))
    keep = [True] * len(words)
    for s, length, q in runs:
        for i in range(s + q, s + length):
            keep[i] = False
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listing = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
    kept = " ".join(w for w, k in zip(words, keep) if k)
    return (len(runs), *head, hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(30):
        alphabet = rng.choice([2, 3, 5, 50])
        parts = []
        for _ in range(rng.randrange(1, 6)):
            if rng.random() < 0.6:
                block = [f"w{rng.randrange(alphabet)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 20, 40]))]
                reps = rng.choice([2, 3, 4, 7, 30])
                parts += (block * reps)[: len(block) * reps - rng.randrange(len(block))]
            else:
                parts += [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(0, 60))]
        out.append(rng.choice([" ", "\n", "\t ", "  "]).join(parts))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_every_period(seed):
    for text in texts(seed):
        ids = pr.word_ids(pr.WORD.findall(text))
        assert pr.cubic_runs(ids) == brute_runs(ids), text


def test_describe_planted_and_odd_cases():
    cases = [(10, None), (None, "a b a b a b"), (3, ""), (4, " \n "), (5, "x " * 300), (6, "é\x1cé " * 40)]
    planted = [i for i in range(1, 3000) if pr.zlib.crc32(str(i).encode()) % 10 == 0][:12]
    cases += [(i, " ".join(f"v{(i * k) % 37}" for k in range(200 + i % 50))) for i in planted]
    for doc_id, text in cases:
        assert pr.describe(text, doc_id) == brute_describe(text, doc_id), (doc_id, text)


def test_frame(spark):
    rows = [(1, "a b " * 30), (None, None), (1, "a b " * 30), (2, "")]
    df = spark.createDataFrame([r + ("clash", 0) for r in rows], "doc_id long, text string, t string, n_runs int")
    got = sorted((tuple(r) for r in pr.periodic_runs(df).collect()), key=str)
    assert got == sorted(((i,) + pr.describe(t, i) for i, t in rows), key=str)
    assert pr.describe("a b " * 30, 1)[:5] == (1, 0, 60, 2, 30000)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pr.periodic_runs(empty).collect() == []
