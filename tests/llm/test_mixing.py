"""Mixing against plain Python: iterative re-sharing of targets and a stream read in order."""

import hashlib
import math
import random
import re

import pytest

from answerloom.llm import mixing

SCHEMA = "doc_id long, source string, text string, size int, at string"  # clashing extra columns


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    fixed, free = {}, set(names)
    while True:  # share what is left by weight, cap those above, again
        left = total - sum(fixed.values())
        share = {s: left / sum(weight[x] for x in free) * weight[s] for s in free} if free else {}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {**{s: float(v) for s, v in fixed.items()}, **share}
        for s in over:
            fixed[s] = cap * sizes[s]
            free.discard(s)


def brute(rows):
    sizes = {}
    for doc_id, source, text in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    goal = targets(sizes)
    out = []
    for source in sizes:
        members = sorted(
            ((doc_id, words(text)) for doc_id, s, text in rows if s == source),
            key=lambda r: (hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest(), r[0] is not None, r[0] or 0, r[1]),
        )
        demand, at = math.floor(goal[source]), 0
        for doc_id, size in members:
            taken = sum(max(0, min(size, demand - e * sizes[source] - at)) for e in range(4))
            out.append((doc_id, size, sizes[source], goal[source], taken))
            at += size
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([r + (7, "x") for r in rows], SCHEMA)
    plan = mixing.plan_mix(df, **kw)
    return plan.select("doc_id", "size", "source_size", "target", "taken").collect()


def same(got, want):
    key = lambda r: (str(r[0]), r[1], r[2], r[4])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] == w[:3] and g[4] == w[4] and abs(g[3] - w[3]) <= 1e-9 * max(1, w[3]), (g, w)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        source = rng.choice(["web", "web", "web", "books", "code", "é-wiki", None])
        text = rng.choice([None, "", " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 300)))])
        rows.append((i if rng.random() > 0.05 else None, source, text))
    rows += [rows[3]] * 5 + [(None, "web", "a b c")] * 3  # repeated rows and copies without id
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_plan_equals_stream(spark, seed):
    rows = corpus(seed)
    got = run(spark, rows, block_rows=7)  # many blocks a source
    same(got, brute(rows))
    by_source = {}
    for doc_id, size, source_size, target, taken in got:
        assert taken <= 3 * size
        by_source.setdefault(source_size, [0, target])[0] += taken
    for total, target in by_source.values():
        assert total == math.floor(target)


def test_caps_reshare():
    goal = targets({"a": 1, "b": 100, "c": 1000})
    assert goal["a"] == 3.0 and abs(sum(goal.values()) - 1101) < 1e-9 and goal["b"] <= 300


def test_one_large_source_and_copies(spark):
    rows = [(i % 5, "hot", "x y z") for i in range(400)] + [(1000, "cold", "q")]
    same(run(spark, rows, block_rows=10), brute(rows))


def test_empty(spark):
    assert run(spark, []) == []
    got = run(spark, [(1, "a", None), (2, None, "")])
    assert sorted((r.doc_id, r.taken, r.target) for r in got) == [(1, 0, 0.0), (2, 0, 0.0)]


def test_positions_follow_schedule(spark):
    rows = [(i, "a", "w " * 10) for i in range(50)]
    df = spark.createDataFrame([r + (1, "x") for r in rows], SCHEMA)
    rising = mixing.Schedule(((0.0, 0.0), (1.0, 2.0)))
    plan = mixing.plan_mix(df, schedules=(rising,))
    first = [r.first_position for r in plan.collect()]
    assert first == sorted(first) and first[0] == 0.0
    # with weight 2t the share due by t is t^2, so positions are square roots of the demand
    stream = mixing.mixture(plan, schedules=(rising,)).collect()
    assert sum(r.words for r in stream) == 500
    for r in stream:
        at = [p.at for p in plan.collect() if p.doc_id == r.doc_id][0] + r["pass"] * 500
        assert abs(r.position - math.sqrt(at / 500)) < 1e-9
