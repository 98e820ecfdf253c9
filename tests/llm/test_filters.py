"""URL rules, top-k search, personal data, toxicity, secrets and the pipeline on small tables."""

import hashlib
import json
import os
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.llm import exact_topk, pii, secret_scan, toxicity, url_filters
from answerloom.llm.queries import URL_RULES
from answerloom.shared import fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, blob string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "p", "b", 0.5) for i, t in rows], SCHEMA)


# ------------------------------------------------------------------ URLs


def brute_verdict(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for i, r in enumerate(URL_RULES):
        place = r.place is None or ((host == r.host or host.endswith("." + r.host)) and path.startswith(r.path))
        if url is not None and place and (r.pattern is None or re.search(r.pattern, url.lower())):
            key = (len(r.place or ""), len(r.pattern or ""), -i)
            best = max(best or (key, r), (key, r), key=lambda x: x[0])
    return host, path, best[1].place if best else None, best[1].verdict if best else "allow"


def test_url_verdicts(spark):
    urls = [
        None, "", "no scheme", "http://", "http://NET/x", "http://net", "http://a.net/", "http://anet/", "https://Example.NET/en/1?x#y",
        "https://m.example.net/en", "http://x.example.com/de/a", "http://example.com/de", "http://example.org/fr/q", "http://é.org/fr/",
        "http://example.org:80/fr/", "http://a.com/login", "http://a.com/login/x", "http://a.com/relogin", "http://a.com/p?sessionid=1",
        "http://a.com/psessionid=1", "x://y://net/z", "http://a.com?q=http://b.net/", "http://a.com/cgi-bin/x", "http://a.com/CGI-BIN/x",
        "http://a.net/login", "http://example.net/en/login", "http://example.net/\nen/",
    ]
    rows = list(enumerate(urls)) + [(99, urls[6]), (None, urls[6])]
    pages = spark.createDataFrame([(i, u, "h", "v", "t") for i, u in rows], "page_id long, url string, host string, verdict string, token string")
    got = url_filters.filter_urls(pages, URL_RULES)
    assert {"page_id", "url", "token"} <= set(got.columns) and len(got.columns) == 8
    told = sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()], key=repr)
    assert told == sorted([(i, *brute_verdict(u)) for i, u in rows], key=repr)
    assert [r.verdict for r in url_filters.filter_urls(pages.limit(2), []).collect()] == ["allow", "allow"]
    assert url_filters.filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_url_columns_of_any_name(spark):
    """Input columns named like the operator's inner columns are kept and change nothing."""
    urls = ["http://a.net/x", "http://example.org/fr/q", None, "http://a.com/login"]
    schema = "page_id long, url string, __url_won string, __url_known string, __url_text string, count long"
    pages = spark.createDataFrame([(i, u, "w", "k", "t", 7) for i, u in enumerate(urls)], schema)
    got = url_filters.filter_urls(pages, URL_RULES)
    assert {"__url_won", "__url_known", "__url_text", "count"} <= set(got.columns)
    told = sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()], key=repr)
    assert told == sorted([(i, *brute_verdict(u)) for i, u in enumerate(urls)], key=repr)


def test_rules_are_filed_under_their_rarest_token(spark):
    table = url_filters.rule_table(spark, URL_RULES)
    seen = spark.createDataFrame([("example", 9), ("net", 5), ("en", 7), ("com", 4), ("de", 4), ("org", 1), ("fr", 3)], "token string, seen long")
    filed = {r.place or r.pattern: r.token for r in url_filters.rarest_token_index(table, seen).collect()}
    assert filed["example.net/en/"] == "net" and filed["example.com/de/"] == "com" and filed["org/fr/"] == "org"
    assert filed[r"[?&]sessionid="] == "sessionid" and filed[r"/(login|signin|logout)([./?#]|$)"] == ""


# ------------------------------------------------------------------ search


def brute_top(rows, asked, k):
    import math

    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    told = []
    for q in sorted({i for i, _ in usable if asked(i)}):
        own = min(v for i, v in usable if i == q)
        scored = sorted([(-sum(a * b for a, b in zip(own, v)), i) for i, v in usable if i != q])[:k]
        told += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return told


@pytest.mark.parametrize("ranges", [1, 2, 3])
def test_top_k(spark, monkeypatch, ranges):
    monkeypatch.setattr(exact_topk, "VECTOR_BLOCK", 20)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 7)
    rng = random.Random(ranges)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    rows += [(i, [0.5, -0.25, 0.125, 0.0, 0.0, 1.0]) for i in range(120, 190)]  # one very common vector: ties
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (204, [0.9, 0.9]), (None, [1.0] * 6), (205, [])]
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, id string, score int")
    got = exact_topk.top_k(vectors, vectors.filter("vec_id % 10 = 0"), 5, ranges=ranges)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, lambda i: i % 10 == 0, 5)


def test_top_k_with_few_vectors(spark):
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in exact_topk.top_k(vectors, vectors.filter("vec_id = 0"), 5).collect()] == [(0, 1, 1, 128 * 256 + 128 * 512)]
    assert exact_topk.top_k(vectors.limit(0), vectors, 5).count() == 0
    assert exact_topk.top_k(vectors, vectors.limit(0), 5).count() == 0


# ------------------------------------------------------------------ personal data


def plain_spans(t):
    """The base patterns as they are written, on any text."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(map(int, d[::-1]))) % 10 == 0
    told = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    told += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if max(map(int, m.group().split("."))) <= 255]
    told += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    told += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m.group())) <= 15]
    return sorted(told)


def test_base_spans():
    rng = random.Random(8)
    for _ in range(20_000):
        t = "".join(rng.choice("0123459.@a-+ %é(") for _ in range(rng.randrange(40)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("a" * 200_000 + "@" * 1000 + "1" * 200_000) == []


def private_rows():
    rng = random.Random(6)
    rows = []
    for i in range(160):
        mail, ip = f"user{rng.randrange(999)}@mail{i % 7}.example.com", ".".join(str(rng.randrange(1, 255)) for _ in range(4))
        rows.append((i, f"write to {mail} or é call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} now, from {ip} of {rng.randrange(90)} things"))
    return rows + [(500, None), (501, ""), (None, "a@b.cd"), (3, rows[3][1]), (502, "no data in here " * 3000)]


def test_personal_data_and_masks(spark):
    rows = private_rows()
    documents = frame(spark, rows)
    model = pii.fit_field(documents)
    got = pii.personal_data(documents, model).collect()
    want = sorted([(i, pii.listed(plain_spans(t or ""))) for i, t in rows], key=repr)
    assert sorted([(r.doc_id, r.base) for r in got], key=repr) == want
    assert all(set(filter(None, r.base.split(","))) <= set(r.spans.split(",")) for r in got)
    hidden = pii.mask(documents, model)
    assert hidden.columns == documents.columns
    for r in hidden.collect():
        assert r.text is None or (not pii.base_spans(r.text) and (r.doc_id != 7 or "[EMAIL] or é call [PHONE] now, from [IP]" in r.text))
    assert pii.personal_data(documents.limit(0), pii.fit_field(documents.limit(0))).count() == 0


def test_skip_edges_carry_labels_across_a_document(spark):
    """A number that is known from a base match is found again where the pattern does not fit."""
    rows = [(i, f"call +1 ({200 + i % 700}) 555-{1000 + 7 * i} or take {i % 60} of {i} things then (555) {i % 50}") for i in range(300)]
    model = pii.fit_field(frame(spark, rows))
    text = "call +1 (312) 555-4444 today " + "and so on " * 40 + "ask for 555-4444 please, not for 17"
    base = pii.base_spans(text)
    added = model.added([text, text.replace("ask for 555-4444", "ask for 12")], [base, base])
    at = text.rindex("555-4444")
    assert (at, 3, at + 8) in added[0] and not any(text[s:e] == "17" for s, _, e in added[0])
    assert added[1] == []


def test_the_field_learns_from_rare_and_late_matches(spark):
    """Base matches in few of many texts with digits, and behind 60 other numbers, are trained on."""
    rows = [(i, f"in {1000 + i} there were {i} and") for i in range(6000)]
    rows += [(7000 + i, " ".join(f"n{k}" for k in range(60)) + f" write to a{i}@example.com or so") for i in range(30)]
    model = pii.fit_field(frame(spark, rows))
    assert model.weights.any()
    tokens = pii.Tokens()
    tokens.add(0, "write to zz@example.com or so", [])
    score = model.weights[pii.features(tokens)].sum(axis=1)[0]
    assert score.argmax() == 0  # an address


def test_meetings_are_counted_on_whole_texts(spark):
    text = "call +1 234 567 8901 now, " + " ".join(f"w {k} x" for k in range(100, 180)) + " and call +1 234 567 8901 then"
    model = pii.fit_field(frame(spark, [(1, text)]))
    assert model.skip[3, 3] > 0  # the second number stands behind the 80 others


# ------------------------------------------------------------------ toxicity


def test_toxicity(spark):
    rng = random.Random(9)
    syllables = "en th er an re on in ou ed nd ha to or ti as".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(rng.randrange(20, 120))]
        bad = i % 5 == 0
        for _ in range(rng.randrange(1, 4) if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["zorg", "blaxity"]) + rng.choice(["", "s", "es"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(2000, None), (2001, ""), (None, "zorg zorg"), (0, rows[0][1]), (2002, "en " * 50_000)]
    labels += [(3, None), (None, 1), (5, 1), (5, 0)]
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity_scores(frame(spark, rows), known).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    tested = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(tested) > 150
    assert sum((r.doc_id % 5 == 0) == bool(r.predicted) for r in tested) / len(tested) > 0.97
    by_id = {r.doc_id: r.predicted for r in got}
    assert by_id[None] == 1 and by_id[2000] == by_id[2001] == by_id[2002] == 0
    left = toxicity.drop_toxic(frame(spark, rows), known)
    assert left.columns == frame(spark, []).columns and {r.doc_id for r in left.collect()} == {i for i, p in by_id.items() if not p}


def test_long_texts_outweigh_no_short_ones(spark):
    rng = random.Random(5)
    syllables = "en th er an re on in ou ed nd ha to or ti as".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows = []
    for i in range(600):
        words = [word() for _ in range(3000 if i % 7 == 0 else rng.randrange(20, 60))]
        words[rng.randrange(len(words))] = "blaxity" if i % 5 == 0 else word()
        rows.append((i, " ".join(words)))
    known = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    got = [r for r in toxicity.toxicity_scores(frame(spark, rows), known).collect() if r.held_out and r.doc_id % 7]
    assert sum((r.doc_id % 5 == 0) == bool(r.predicted) for r in got) / len(got) > 0.95


def test_every_term_of_the_training_texts_has_a_weight(spark):
    """A term in 4 toxic training texts counts, and so do all buckets and not the best thousand."""
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abcdefghijklm", k=6)) for _ in range(40)) for _ in range(80)]
    rows = [(i, t + (" zyxwv" if i < 4 else "")) for i, t in enumerate(texts)]
    known = spark.createDataFrame([(i, int(i < 8)) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.fit(frame(spark, rows), known)
    term = toxicity.gram_buckets(["zyxwv"])[1]
    assert (model.weights[term] > 0).all()
    seen = np.unique(toxicity.gram_buckets([t for _, t in rows])[1])
    assert (model.weights[seen] != 0).mean() > 0.9 and len(seen) > 5000
    with_term, without = model.scores(["zyxwv", "nopqr"])
    assert with_term > without


def test_toxicity_without_labels_of_both_classes(spark):
    rows = frame(spark, [(1, "a b c"), (2, None)])
    for labels, score in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1)], 1.0)):
        known = spark.createDataFrame(labels, "doc_id long, toxic int")
        model = toxicity.fit(rows, known)
        assert [r.score for r in toxicity.score(rows, model).collect()] == [score, score]
    assert toxicity.toxicity_scores(rows.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0


# ------------------------------------------------------------------ secrets


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def plain_secrets(t):
    told = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    told += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    told += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return [x for _, _, x in sorted(told)]


def secret_rows():
    rng = random.Random(10)
    parts = ["password", "API_KEY", "token", "apikey", "Secret", ": ", "=", '"', "'", "abc", "abcdef", "é", "\x01", "\x02", " ", "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "\n", "😀"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for i in range(400)]
    return rows + [(900, None), (901, ""), (None, "token=abcdefg"), (902, "secret=token:abcdefgh"), (903, "x" * 100_000 + " token=abcdef" * 300), (4, rows[4][1]), (5, "token=zzzzzzz")]


def test_secrets(spark):
    rows = secret_rows()
    ledger = secret_scan.BlobLedger(spark, fresh_path(spark, "ledger"))
    got = ledger.report(ledger.ingest(frame(spark, rows))).collect()
    assert sorted([(r.path, r.spans) for r in got], key=repr) == sorted([(i, ",".join(plain_secrets(t or ""))) for i, t in rows], key=repr)
    assert all(r.n_assign + r.n_access + r.n_hex == len(list(filter(None, r.spans.split(",")))) for r in got)


def test_ledger_scans_only_what_is_new(spark):
    folder = fresh_path(spark, "ledger")
    ledger = secret_scan.BlobLedger(spark, folder)
    first = frame(spark, [(1, "token=abcdefg"), (2, "token=abcdefg"), (3, "clean")])
    ledger.ingest(first)
    assert ledger.scanned().count() == 2 * 3
    again = ledger.ingest(frame(spark, [(4, "token=abcdefg"), (1, "clean"), (5, "AKIA" + "A" * 16)]))
    assert ledger.scanned().count() == 3 * 3  # one new content
    told = {r.path: r.spans for r in ledger.report(again).collect()}
    assert told == {4: "assign:0:13", 1: "", 5: "access:0:20"}
    newer = [secret_scan.SecretRule("hex", "[0-9a-f]{4,}", version=2) if r.kind == "hex" else r for r in secret_scan.RULES]
    later = secret_scan.BlobLedger(spark, folder, newer)
    told = {r.path: r.spans for r in later.report(later.ingest(frame(spark, [(6, "beef"), (7, "token=abcdefg")]))).collect()}
    assert told == {6: "hex:0:4", 7: "assign:0:13,hex:6:12"}
    assert later.scanned().filter("kind = 'hex' and version = 2").count() == 2  # the two contents of the batch
    assert later.scanned().filter("kind = 'assign'").count() == 4
    assert ledger.report(ledger.ingest(first.limit(0))).count() == 0


# ------------------------------------------------------------------ pipeline


def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    base = [text(rng.randrange(20, 120)) for _ in range(120)]
    rows = [(i, t + (" zorgnak" if i % 6 == 0 else "")) for i, t in enumerate(base)]
    rows += [(200, rows[1][1].replace(" ", "\n")), (201, rows[2][1] + " tail"), (202, None), (203, ""), (204, "mail me at a.b@example.com")]
    plain = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(plain, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(120)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id for r in docs.collect()}
    clean = {i for i, _ in rows if not (i < 120 and i % 6 == 0)}
    assert kept["toxicity"] == clean
    assert kept["exact_dedup"] == clean - {200, 203}  # the empty text copies the null one
    assert kept["near_dedup"] == kept["pii"] == kept["exact_dedup"] - {201}
    masked = docs.filter("doc_id = 204").first()
    assert (masked.text, masked.n_chars) == ("mail me at [EMAIL]", 18)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == kept["pii"]
    assert max(r.offset + r.length for r in got) <= 2048
    assert json.dumps([s for s, _ in corpus_pipeline.STAGES]) and os.path.exists(corpus_pipeline.__file__)


def test_digests_are_of_whole_texts(spark):
    got = frame(spark, [(1, "a"), (2, None)]).select(secret_scan.blob_of(F.col("text")).alias("b")).collect()
    assert [r.b for r in got] == [hashlib.sha256(x).hexdigest() for x in (b"a", b"")]
