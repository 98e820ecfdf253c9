"""Large sets are told apart by wide signatures before they move, and no link is lost by that."""

import random

import numpy as np

from answerloom.llm import jaccard_join


def test_wide_signatures_bound_what_differs():
    rng = np.random.default_rng(5)
    for n in (900, 940, 2_000, 5_000, 20_000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for share in (0.05, 0.16, 1.0):
            gone = int(share * n)
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, gone + n // 20, dtype=np.uint64)]))
            x, y = jaccard_join.wide_signature(a), jaccard_join.wide_signature(b)
            if x is None or y is None:
                assert n < 1_000
                continue
            assert jaccard_join.wide_distance(x, y) == jaccard_join.wide_distance(y, x) <= len(np.setxor1d(a, b))
            if share == 1.0:  # nothing in common: told apart at 80 and at 85 percent
                assert 180 * jaccard_join.wide_distance(x, y) > 20 * (len(a) + len(b))


def test_large_sets_that_share_little_are_not_fetched(spark, monkeypatch):
    rng, tried = random.Random(4), []
    plain = jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *rest: tried.append(pairs.count()) or plain(pairs, *rest))
    levels = np.zeros(1 << jaccard_join.SLOT_BITS, np.uint8)  # no token told to be rare, as in large tables
    monkeypatch.setattr(jaccard_join, "token_levels", lambda sets: levels)
    shared = " ".join(f"common{i}" for i in range(400))
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(3_600)) + " " + shared for _ in range(6)]
    texts += [texts[0].replace("common7 ", "other "), texts[1] + " tail"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(docs, 4, 85).collect()}
    assert groups == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 0, 7: 1}
    assert sum(tried) == 2  # the two links, of 28 pairs


def test_tokens_that_agree_in_40_bits_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TOKEN_MASK", np.uint64(0xF << 60))  # nearly all rows meet
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(60)) for _ in range(30)]
    texts += [t + " tail" for t in texts[:9]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    groups = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(docs, 4, 85).collect()}
    assert groups == {i: i if i < 30 else i - 30 for i in range(39)}
