"""Merkle manifest against a plain Python tree."""

import hashlib
import zlib

import pytest

from answerloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, pos int"  # clashing extra columns


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value) -> str:
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def leaf(row) -> str:
    return h("".join(field(v) for v in row[:5]))


def tree(hashes):
    """Levels of a list of nodes, from the nodes up to the one on top."""
    levels = [list(hashes)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def climb(levels, pos, start):
    """Siblings from ``pos`` up and the hash folded from ``start``."""
    proof, cur = "", start
    for level in levels[:-1]:
        run = pos - pos % 2
        left = "".join(level[run:pos])
        right = "".join(level[pos + 1 : run + 2])
        proof += left + right
        cur = h(left + cur + right)
        pos //= 2
    return proof, cur


def brute(rows, tamper):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    inner = {}
    for g in langs:
        members = sorted(by_lang[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        inner[g] = (members, tree([leaf(r) for r in members]))
    outer = tree([inner[g][1][-1][0] for g in langs])
    root = outer[-1][0]
    result = []
    for gi, g in enumerate(langs):
        members, levels = inner[g]
        for pos, row in enumerate(members):
            changed = tamper(row)
            p1, c1 = climb(levels, pos, leaf(changed))
            p2, c2 = climb(outer, gi, c1)
            result.append((row[0], leaf(row), levels[-1][0], root, h(p1 + p2), c2, c2 == root))
    return sorted(result, key=str)


def tamper(row):
    doc_id, source, lang, n_chars, text = row[:5]
    if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
        return (doc_id, source, lang, n_chars + 1, text)
    return row


def run(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([r + ("x", 1) for r in rows], SCHEMA)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = merkle.manifest(df, changed={"n_chars": tampered}).collect()
    return sorted((tuple(r) for r in got), key=str)


CASES = {
    "odd": [(i, "web" if i % 3 else None, ["en", "de", None, "é", "fr"][i % 5], None if i % 11 == 0 else 10 * i, "t" * i if i % 4 else None) for i in range(1, 38)],
    "one": [(5, "a", "en", 3, "abc")],
    "one_lang": [(i, "s", "en", i, f"text {i}") for i in range(1, 10)],
    "repeats": [(1, "s", "en", 1, "a"), (1, "s", "en", 1, "a"), (None, "s", "en", 2, "b"), (None, None, None, None, None), (7, "s", "de", 5, "é" * 5000)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_manifest_equals_plain_tree(spark, name):
    rows = CASES[name]
    assert run(spark, rows) == brute(rows, tamper)


def test_empty(spark):
    assert run(spark, []) == []


def test_few_rows_lead_to_the_root(spark):
    """A leaf climbs a block of 16 nodes a step: 7 blocks and one above them, not a row a node."""
    base = spark.range(100).selectExpr("0L AS grp", "id AS pos", "unhex(sha2(string(id), 256)) AS hash", "100L AS n")
    blocks, tops = merkle._levels(base, 0)
    assert sorted((r.level, r.block) for r in blocks.collect()) == [(0, i) for i in range(7)] + [(4, 0)]
    top = tops.collect()
    assert [(r.level, r.hash.hex()) for r in top] == [(7, tree([h(str(i)) for i in range(100)])[-1][0])]


def test_large_group_equals_plain_tree(spark):
    rows = [(i, "s", "en" if i % 50 else "de", i, f"text {i}") for i in range(1, 306)]
    assert run(spark, rows) == brute(rows, tamper)


def test_tampered_rows_fail(spark):
    rows = CASES["odd"]
    for doc_id, *_, verified in run(spark, rows):
        row = next(r for r in rows if r[0] == doc_id)
        assert verified == (tamper(row) == row)
