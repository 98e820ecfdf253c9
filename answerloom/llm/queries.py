"""The registered queries of this subpackage, each over the whole of its table, and their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import fresh_path
from . import bpe, exact_dedup, exact_topk, jaccard_join, merkle, mixing, packing, periodic_runs, pii, secret_scan, sharding, toxicity, url_filters

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ 1

# The four places are fixed; the patterns judge what no place decides.
URL_RULES = (
    url_filters.Rule("block", "net/"),
    url_filters.Rule("allow", "example.net/en/"),
    url_filters.Rule("block", "example.com/de/"),
    url_filters.Rule("allow", "org/fr/"),
    url_filters.Rule("block", pattern=r"/(login|signin|logout)([./?#]|$)"),
    url_filters.Rule("block", pattern=r"[?&]sessionid=", literals=("sessionid",)),
    url_filters.Rule("block", pattern=r"/cgi-bin/", literals=("cgi", "bin")),
)


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op1_url_filters"] = r"""
WITH cut AS (
  SELECT page_id, lower(coalesce(url, '')) AS low,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
judged AS (
  SELECT *, '.' || host AS dotted FROM cut)
SELECT page_id, host, path,
  CASE WHEN dotted LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN dotted LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN dotted LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN dotted LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE WHEN dotted LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'block'
       WHEN dotted LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'allow'
       WHEN dotted LIKE '%.org' AND starts_with(path, '/fr/') THEN 'allow'
       WHEN dotted LIKE '%.net' AND starts_with(path, '/') THEN 'block'
       WHEN regexp_matches(low, '/(login|signin|logout)([./?#]|$)|[?&]sessionid=|/cgi-bin/') THEN 'block'
       ELSE 'allow' END AS verdict
FROM judged
"""


# ------------------------------------------------------------------ 2


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op2_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


# ------------------------------------------------------------------ 3


@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors for each vector whose id 50 divides."""
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


ORACLE["op3_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


# ------------------------------------------------------------------ 4 and 5


def vocabulary() -> str:
    """File of the public byte-level vocabulary that the two queries use."""
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


# ------------------------------------------------------------------ 6

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


# ------------------------------------------------------------------ 7


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document; the counts are those of the base patterns."""
    documents = table(spark, sf_dir, "documents")
    found = pii.personal_data(documents, pii.fit_field(documents))
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], digest, "spans", "n_added")


# ------------------------------------------------------------------ 8


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), labels)


# ------------------------------------------------------------------ 9


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of similar documents of every document: 4-word shingles, 85 of 100."""
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"), 4, 85).drop("text_key")


# ------------------------------------------------------------------ 10


@query
def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by a ledger that starts empty. This method adds no spans."""
    ledger = secret_scan.BlobLedger(spark, fresh_path(spark, "ledger"))
    paths = ledger.ingest(table(spark, sf_dir, "documents"))
    return ledger.report(paths).select(
        F.col("path").alias("doc_id"),
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
ORACLE["op10_secret_scans"] = rf"""
WITH rules(kind, place, pattern, grp, least) AS (VALUES
  ('assign', 0, '{_ASSIGN}', 2, 6), ('access', 1, 'AKIA[A-Z0-9]+', 0, 20), ('hex', 2, '[0-9a-f]+', 0, 24)),
texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT doc_id, kind, place, least, regexp_extract_all(t, pattern) AS found,
         regexp_extract_all(t, pattern, grp) AS told, string_split_regex(t, pattern) AS gaps
  FROM texts, rules WHERE regexp_matches(t, pattern)),
pieces AS (
  SELECT doc_id, kind, place, least, unnest(found) AS f, unnest(told) AS v,
         unnest(gaps[:len(found)]) AS g, generate_subscripts(found, 1) AS i
  FROM cut),
placed AS (
  SELECT *, sum(length(g) + length(f)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop FROM pieces),
spans AS (
  SELECT doc_id, kind, place, stop - length(f) AS start, stop FROM placed WHERE length(v) >= least),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN told USING (doc_id)
"""


# ------------------------------------------------------------------ 11


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents by language; rows whose id's crc32 7 divides are checked with
    ``n_chars`` one larger."""
    documents = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.manifest(documents, changed={"n_chars": tampered})


# ------------------------------------------------------------------ 12


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of three periods and 24 words or more in every document, a periodic tail planted
    where the id's crc32 ends in 0."""
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 13

# Weights and schedules go to the sources in turn, in order of their names.
MIX_WEIGHTS = (1, 2, 3)
MIX_CAP = 3.0
MIX_SCHEDULES = (
    mixing.Schedule(((0.0, 1.0), (1.0, 1.0))),  # even
    mixing.Schedule(((0.0, 0.5), (1.0, 1.5))),  # rising
    mixing.Schedule(((0.0, 1.5), (0.5, 1.0), (1.0, 0.5))),  # falling
)


@query
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, the documents range-sorted by their first
    training position."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_CAP, MIX_SCHEDULES)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op13_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
r AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS src
  FROM d GROUP BY source),
w AS (
  SELECT *, [1, 2, 3][(src % 3) + 1]::BIGINT AS weight, floor(3.0 * source_size)::BIGINT AS lim,
         sum(source_size) OVER ()::BIGINT AS total FROM r),
o AS (
  SELECT *, total - coalesce(sum(lim) OVER (ORDER BY lim / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(weight) OVER (ORDER BY lim / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         row_number() OVER (ORDER BY lim / weight, src) AS room_rank FROM w),
f AS (SELECT *, min(CASE WHEN lim * rest >= lft * weight THEN room_rank END) OVER () AS first_fit FROM o),
t AS (
  SELECT source, source_size,
         CASE WHEN room_rank < first_fit THEN lim::DOUBLE
              ELSE max(CASE WHEN room_rank = first_fit THEN lft::DOUBLE / rest END) OVER () * weight END AS target
  FROM f),
u AS (
  SELECT d.doc_id, d.size, t.source_size, coalesce(t.target, 0.0) AS target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id NULLS FIRST, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS w_at
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target)::BIGINT - w_at)) + greatest(0, least(size, floor(target)::BIGINT - source_size - w_at))
        + greatest(0, least(size, floor(target)::BIGINT - 2 * source_size - w_at))
        + greatest(0, least(size, floor(target)::BIGINT - 3 * source_size - w_at)))::BIGINT AS taken
FROM u
"""


# ------------------------------------------------------------------ pipeline


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, each written and read again."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
