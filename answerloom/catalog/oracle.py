"""The registered queries once more, as SQL for DuckDB over the same tables."""

from __future__ import annotations

from ..functions import fixed_values as fixed
from .queries import ANSWER_LIMIT, DIM, MAX_CHARS, STOP_WORDS

SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
METRICS = fixed.JUDGE_METRICS


def r6(expression: str, name: str | None = None) -> str:
    rounded = f"floor(({expression}) * 1000000.0::DOUBLE + 0.5) / 1000000.0::DOUBLE"
    return f"{rounded} AS {name}" if name else rounded


def normal(text: str) -> str:
    return f"translate(lower({text}), chr(10) || chr(9), '  ')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def count_matches(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))::BIGINT"


def key(text: str) -> str:
    return (
        f"regexp_replace(regexp_replace(lower({text}), '[{SPACE}]+', ' ', 'g'), "
        "'[^a-z0-9 ]', '', 'g')"
    )


def answer_tokens(text: str) -> str:
    bare = rf"regexp_replace(lower(coalesce({text}, '')), '[!-/:-@\[-`{{-~]', '', 'g')"
    dropped = ", ".join(quoted(a) for a in ("", *fixed.ARTICLES))
    return (
        f"list_filter(regexp_split_to_array({bare}, '[{SPACE}]+'), "
        f"lambda t: t NOT IN ({dropped}))"
    )


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[{WORD}]+')"


def overlap(question: str, passage: str) -> str:
    """Share of the distinct words of one list that occur in another."""
    shared = f"len(list_intersect(list_distinct({question}), list_distinct({passage})))"
    size = f"len(list_distinct({question}))"
    return f"CASE WHEN {size} = 0 THEN 0.0 ELSE {shared}::DOUBLE / {size} END"


TOKENS_PER_TEXT = count_matches("text", f"[{WORD}]+|[^{WORD}{SPACE}]")

COPIES = f"""
keyed AS (SELECT doc_id AS id, text AS passage, {key('text')} AS k FROM documents),
singles AS (SELECT k FROM keyed GROUP BY k HAVING count(*) = 1),
uniques AS (SELECT id, passage FROM keyed WHERE k IN (SELECT k FROM singles))
"""

RATED = f"""
rated AS (
  SELECT doc_id AS id,
    length(text)::BIGINT AS char_len,
    {count_matches('text', f'[^{SPACE}]+')} AS word_len,
    {TOKENS_PER_TEXT} AS token_count,
    {count_matches('text', r'[^\x00-\x7f]')}::DOUBLE / nullif(length(text), 0) AS non_ascii_pct,
    {count_matches('text', f'[^{WORD}{SPACE}]')}::DOUBLE / nullif(length(text), 0) AS punct_pct,
    {count_matches('text', r'\p{Nd}')}::DOUBLE / nullif(length(text), 0) AS digits_pct
  FROM documents)
"""

STOPS = ", ".join(quoted(w) for w in STOP_WORDS)
BAGS = f"""
content AS (
  SELECT doc_id AS id, unnest(list_filter(string_split({key('text')}, ' '),
    lambda t: regexp_full_match(t, '[a-z]{{3,}}') AND t NOT IN ({STOPS}))) AS token
  FROM documents),
frequency AS (SELECT token, count(DISTINCT id)::BIGINT AS docs FROM content GROUP BY token),
vocabulary AS (
  SELECT token, docs FROM frequency
  WHERE docs >= {fixed.MIN_DOCS}
    AND docs <= (SELECT floor(count(*) * {fixed.MAX_DOC_SHARE}::DOUBLE) FROM documents))
"""

RECORDS = """
records AS (
  SELECT q.conv_id || '-' || q.turn AS qid, q.text AS question, g.text AS gold,
    p.text AS prediction
  FROM conversations q
  LEFT JOIN conversations g
    ON g.conv_id = q.conv_id AND g.turn = q.turn + 1 AND g.role = 'assistant'
  LEFT JOIN conversations p
    ON p.conv_id = q.conv_id AND p.turn = q.turn + 3 AND p.role = 'assistant'
  WHERE q.role = 'user')
"""


def neighbours(k: int, metric: str = "IP") -> str:
    """CTE ``hits`` of every vector among all vectors."""
    closeness = "list_dot_product(q.embedding::DOUBLE[], p.embedding::DOUBLE[])"
    if metric == "L2":
        closeness = "-pow(list_distance(q.embedding::DOUBLE[], p.embedding::DOUBLE[]), 2)"
    score = "sqrt(-s)" if metric == "L2" else "s"
    return f"""
pairs AS (
  SELECT q.vec_id AS qid, p.vec_id AS pid, round({closeness}, 9) AS s
  FROM embeddings q, embeddings p),
ranked AS (
  SELECT qid, pid, s, row_number() OVER (PARTITION BY qid ORDER BY s DESC, pid) AS rank
  FROM pairs),
hits AS (SELECT qid, rank, pid, {score} AS score FROM ranked WHERE rank <= {k})
"""


VECTOR_HITS = "SELECT qid, rank::BIGINT AS rank, pid, " + r6("score", "score") + " FROM hits"

BUCKETS = f"""
doc_bucket AS (
  SELECT pid, ('0x' || substr(md5(w), 1, 8))::BIGINT % {DIM} AS b, count(*)::DOUBLE AS c
  FROM (SELECT doc_id AS pid, unnest({words('text')}) AS w FROM documents) GROUP BY ALL),
doc_norm AS (SELECT pid, sqrt(sum(c * c)) AS norm FROM doc_bucket GROUP BY pid)
"""


def found(k: int) -> str:
    """CTEs ``records`` and ``hits`` of every question among all documents."""
    return f"""
{RECORDS}, {BUCKETS},
question_bucket AS (
  SELECT qid, ('0x' || substr(md5(w), 1, 8))::BIGINT % {DIM} AS b, count(*)::DOUBLE AS c
  FROM (SELECT qid, unnest({words('question')}) AS w FROM records) GROUP BY ALL),
question_norm AS (SELECT qid, sqrt(sum(c * c)) AS norm FROM question_bucket GROUP BY qid),
dots AS (
  SELECT q.qid, d.pid, sum((q.c / qn.norm) * (d.c / dn.norm)) AS dot
  FROM question_bucket q JOIN doc_bucket d USING (b)
  JOIN question_norm qn ON qn.qid = q.qid JOIN doc_norm dn ON dn.pid = d.pid
  GROUP BY q.qid, d.pid),
pairs AS (
  SELECT r.qid, d.doc_id AS pid, round(coalesce(dots.dot, 0.0), 9) AS score
  FROM records r CROSS JOIN documents d
  LEFT JOIN dots ON dots.qid = r.qid AND dots.pid = d.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS rank FROM pairs),
hits AS (SELECT qid, rank, pid, score FROM ranked WHERE rank <= {k}),
context_lists AS (
  SELECT h.qid, list(h.pid ORDER BY h.rank) AS ids, list(d.text ORDER BY h.rank) AS texts
  FROM hits h JOIN documents d ON d.doc_id = h.pid GROUP BY h.qid)
"""


def listed(expression: str) -> str:
    return f"array_to_string({expression}, '|')"


def leading_words(texts: str, limit: str) -> str:
    return (
        f"array_to_string(regexp_extract_all(array_to_string({texts}, ' '), "
        f"'[^{SPACE}]+')[1:{limit}], ' ')"
    )


RERANKED = f"""
{found(fixed.RERANK_CANDIDATES)},
question_words AS (SELECT qid, list_distinct({words('question')}) AS qw FROM records),
passage_words AS (SELECT doc_id AS pid, list_distinct({words('text')}) AS pw FROM documents),
scored AS (
  SELECT h.qid, h.rank, h.pid, {overlap('qw', 'pw')} AS rerank_score
  FROM hits h JOIN question_words USING (qid) JOIN passage_words USING (pid)),
reranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rerank_score DESC, rank) AS rerank_rank
  FROM scored),
sure AS (
  SELECT r.qid, coalesce(a.rerank_score, 0.0) AS conf,
    CASE WHEN a.qid IS NULL THEN 0.0
         ELSE a.rerank_score - coalesce(b.rerank_score, {fixed.NO_RUNNER_UP}) END AS margin
  FROM records r
  LEFT JOIN reranked a ON a.qid = r.qid AND a.rerank_rank = 1
  LEFT JOIN reranked b ON b.qid = r.qid AND b.rerank_rank = 2)
"""
LOW = f"(conf < {fixed.MIN_CONF} OR margin < {fixed.MIN_MARGIN})"
TOP_RERANKED = f"""
top_reranked AS (
  SELECT r.qid, list(r.pid ORDER BY rerank_rank) AS ids,
    list(d.text ORDER BY rerank_rank) AS texts
  FROM reranked r JOIN documents d ON d.doc_id = r.pid
  WHERE rerank_rank <= {fixed.RERANK_TOP_K} GROUP BY r.qid)
"""


def token_f1(source: str, extra: str = "") -> str:
    """CTE ``scores``: f1, unknown, em and squad_f1 of each row of ``source``."""
    said = " OR ".join(
        f"contains(lower(coalesce(prediction, '')), {quoted(p)})" for p in fixed.UNKNOWN_PHRASES
    )
    return f"""
tokenized AS (
  SELECT *, row_number() OVER () AS rid, {answer_tokens('prediction')} AS pt,
    {answer_tokens('gold')} AS gt FROM {source}),
token_counts AS (
  SELECT rid, token, sum(p) AS p, sum(g) AS g
  FROM (SELECT rid, unnest(pt) AS token, 1 AS p, 0 AS g FROM tokenized
        UNION ALL SELECT rid, unnest(gt), 0, 1 FROM tokenized)
  GROUP BY rid, token),
multiset AS (SELECT rid, sum(least(p, g))::DOUBLE AS same FROM token_counts GROUP BY rid),
shares AS (
  SELECT *, len(pt) AS np, len(gt) AS ng,
    len(list_intersect(list_distinct(pt), list_distinct(gt)))::DOUBLE AS shared
  FROM tokenized LEFT JOIN multiset USING (rid)),
scores AS (
  SELECT *,
    CASE WHEN np = 0 OR ng = 0 THEN (np = ng)::INT::DOUBLE WHEN shared = 0 THEN 0.0
         ELSE 2 * (shared / np) * (shared / ng) / ((shared / np) + (shared / ng) + {fixed.F1_EPSILON})
    END AS f1,
    ({said})::INT AS unknown,
    (array_to_string(pt, ' ') = array_to_string(gt, ' '))::INT * 100.0::DOUBLE AS em,
    CASE WHEN np + ng = 0 THEN 0.0 ELSE 200.0::DOUBLE * coalesce(same, 0) / (np + ng) END AS squad_f1
  FROM shares)
"""


Z = "1.959963984540054::DOUBLE"


def comparison(squad: bool) -> str:
    half = f"{Z} * stddev_samp(f1) / sqrt(count(*))"
    columns = [
        "count(*)::BIGINT AS n",
        r6("avg(f1)", "f1_mean"),
        r6("avg(unknown)", "unknown_rate"),
        r6(f"CASE WHEN count(*) <= 1 THEN avg(f1) ELSE greatest(0.0, avg(f1) - {half}) END", "f1_lo"),
        r6(f"CASE WHEN count(*) <= 1 THEN avg(f1) ELSE least(1.0, avg(f1) + {half}) END", "f1_hi"),
    ]
    if squad:
        columns += [r6("avg(em) / 100.0", "em_mean"), r6("avg(squad_f1) / 100.0", "hf_f1")]
    return ", ".join(columns)


JUDGE_BASE = f"""
{found(5)},
contexts AS (
  SELECT h.qid, d.text AS context, min(h.rank) AS pos
  FROM hits h JOIN documents d ON d.doc_id = h.pid WHERE d.text <> '' GROUP BY h.qid, d.text),
context_texts AS (SELECT qid, list(context ORDER BY pos) AS texts FROM contexts GROUP BY qid),
valid AS (
  SELECT qid, question, prediction AS answer, gold, texts
  FROM records JOIN context_texts USING (qid)
  WHERE question <> '' AND prediction <> '' AND gold <> '')
"""
CAPPED = """
capped AS (
  SELECT 'cap_' || cap AS tag, qid, question, answer, gold, texts[1:cap] AS texts
  FROM valid, (VALUES (1), (5)) AS caps(cap))
"""
JUDGE_SCORES = f"""
{JUDGE_BASE}, {CAPPED},
judge_words AS (
  SELECT tag, qid, {words('question')} AS qw, {words('answer')} AS aw, {words('gold')} AS gw,
    {words("array_to_string(texts, ' ')")} AS cw, {words('texts[1]')} AS fw
  FROM capped),
judged AS (
  SELECT tag, qid, {overlap('aw', 'cw')} AS faithfulness, {overlap('qw', 'fw')} AS context_precision,
    {overlap('gw', 'cw')} AS context_recall,
    CASE WHEN len(list_intersect(qw, aw)) > 0 THEN {overlap('qw', 'aw')} END AS answer_relevancy
  FROM judge_words)
"""


def shards(batch: int, suffix: str = "") -> str:
    means = ", ".join(f"avg({m}) AS {m}" for m in METRICS)
    weighted = ", ".join(
        f"sum({m} * size) / sum(CASE WHEN {m} IS NOT NULL THEN size END) AS {m}" for m in METRICS
    )
    return f"""
sharded{suffix} AS (
  SELECT *, ((row_number() OVER (PARTITION BY tag ORDER BY qid) - 1) // {batch}) AS shard FROM judged),
shard_means{suffix} AS (
  SELECT tag, shard, count(*) AS size, {means} FROM sharded{suffix} GROUP BY tag, shard),
summary{suffix} AS (
  SELECT tag, sum(size)::BIGINT AS n, {weighted}, {batch}::BIGINT AS batch
  FROM shard_means{suffix} GROUP BY tag)
"""


METRICS6 = ", ".join(r6(m, m) for m in METRICS)

ORACLE: dict[str, str] = {
    "passage_features": r"""
SELECT doc_id AS id, replace(replace(lower(text), chr(10), ' '), chr(9), ' ') AS passage_norm,
  length(text)::BIGINT AS char_len, greatest(1, length(text) // 4)::BIGINT AS tok_est
FROM documents""",
    "corpus_key": f"SELECT doc_id AS id, {key('text')} AS passage_norm FROM documents",
    "corpus_unique": f"WITH {COPIES} SELECT id, passage FROM uniques",
    "duplicate_count": f"""
WITH {COPIES}, sizes AS (SELECT k, count(*) AS c FROM keyed GROUP BY k)
SELECT sum(c)::BIGINT AS passages, coalesce(sum(c) FILTER (c > 1), 0)::BIGINT AS duplicates,
  count(*) FILTER (c = 1)::BIGINT AS uniques
FROM sizes""",
    "corpus_prepare": f"""
WITH {COPIES} SELECT id, passage FROM uniques
WHERE {count_matches('passage', f'[{WORD}]+|[^{WORD}{SPACE}]')} >= {fixed.MIN_PASSAGE_TOKENS}""",
    "quality_ratios": f"""
WITH {RATED} SELECT id, char_len, word_len, token_count, {r6('non_ascii_pct', 'non_ascii_pct')},
  {r6('punct_pct', 'punct_pct')}, {r6('digits_pct', 'digits_pct')} FROM rated""",
    "column_summary": f"WITH {RATED} "
    + " UNION ALL ".join(
        f"""
SELECT '{c}' AS "column", count({c})::BIGINT AS n, {r6(f'avg({c})', 'mean')},
  {r6(f'stddev_samp({c})', 'std')}, {r6(f'min({c})::DOUBLE', 'min')},
  {r6(f'quantile_cont({c}::DOUBLE, 0.25)', 'p25')}, {r6(f'quantile_cont({c}::DOUBLE, 0.5)', 'p50')},
  {r6(f'quantile_cont({c}::DOUBLE, 0.75)', 'p75')}, {r6(f'max({c})::DOUBLE', 'max')}
FROM rated"""
        for c in ["char_len", "word_len", "token_count", "non_ascii_pct", "punct_pct", "digits_pct"]
    ),
    "length_histogram": f"""
WITH sizes AS (
  SELECT unnest([{{'c': 'char_len', 'v': length(text)::DOUBLE}},
    {{'c': 'norm_len', 'v': length({normal('text')})::DOUBLE}},
    {{'c': 'token_count', 'v': {count_matches('text', f'[{WORD}]+|[^{WORD}{SPACE}]')}::DOUBLE}}]) AS s
  FROM documents),
edges AS (SELECT s.c AS "column", min(s.v) AS lo, max(s.v) AS hi FROM sizes GROUP BY 1),
binned AS (
  SELECT s.c AS "column", least(floor((s.v - lo) * 10 / (hi - lo)), 9)::BIGINT AS bin, count(*) AS n
  FROM sizes JOIN edges ON s.c = "column" GROUP BY 1, 2)
SELECT e."column", b.range AS bin, coalesce(n, 0)::BIGINT AS n, {r6('lo + b.range * ((hi - lo) / 10)', 'bin_from')},
  {r6('lo + (b.range + 1) * ((hi - lo) / 10)', 'bin_to')}
FROM range(10) b CROSS JOIN edges e LEFT JOIN binned ON binned.bin = b.range AND binned."column" = e."column"
""",
    "batch_tags": rf"""
SELECT doc_id AS id, {count_matches('text', '[A-Z][a-z]+|[0-9]+')} AS entities,
  nullif(regexp_extract(text, '[A-Z][a-z]+|[0-9]+'), '') AS first_entity,
  {count_matches('text', r'[A-Za-z]+|[0-9]+|[!-/:-@\[-`{-~]')} AS token_count,
  {count_matches('text', '[0-9]+')} AS numbers
FROM documents""",
    "tag_counts_map": rf"""
SELECT 'WORD' AS tag, sum({count_matches('text', r'\p{L}+')})::BIGINT AS n FROM documents
UNION ALL SELECT 'NUM', sum({count_matches('text', r'\p{Nd}+')})::BIGINT FROM documents
UNION ALL SELECT 'PUNCT', sum({count_matches('text', f'[^{WORD}{SPACE}]')})::BIGINT FROM documents""",
    "label_counts_array": f"""
SELECT 'NAME' AS label, sum({count_matches('text', '[A-Z][a-z]+')})::BIGINT AS n FROM documents
UNION ALL SELECT 'NUMBER', sum({count_matches('text', '[0-9]+')})::BIGINT FROM documents""",
    "content_tokens_df": f"WITH {BAGS} SELECT token, docs FROM vocabulary",
    "bag_of_words": f"""
WITH {BAGS} SELECT id, token, count(*)::BIGINT AS n FROM content
WHERE token IN (SELECT token FROM vocabulary) GROUP BY id, token""",
    "topk_ip": f"WITH {neighbours(5)} {VECTOR_HITS}",
    "topk_l2": f"WITH {neighbours(5, 'L2')} {VECTOR_HITS}",
    "topk_blocked": f"WITH {neighbours(5)} {VECTOR_HITS}",
    "topk_bounded": f"WITH {neighbours(5)} {VECTOR_HITS}",
    "ivf_full_probe": f"WITH {neighbours(5)} {VECTOR_HITS}",
    "ivf_exact": f"WITH {neighbours(5)} {VECTOR_HITS}",
    "l2_normalized": f"""
SELECT vec_id AS id, {r6('1.0', 'squared_length')},
  {r6('embedding[1]::DOUBLE * 3 / sqrt(list_dot_product(e3, e3))', 'head')}
FROM (SELECT vec_id, embedding, list_transform(embedding, lambda x: x::DOUBLE * 3) AS e3 FROM embeddings)""",
    "embed_words": f"""
WITH {BUCKETS} SELECT pid AS id, b::BIGINT AS bucket, {r6('c / norm', 'weight')}
FROM doc_bucket JOIN doc_norm USING (pid)""",
    "batch_embed": """
SELECT doc_id AS id, length(text)::BIGINT AS chars,
  (length(text) - length(replace(text, ' ', '')) + 1)::BIGINT AS spaced,
  (length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS lines
FROM documents""",
    "vector_table_stats": """
SELECT 2 * count(vec_id)::BIGINT AS row_count, 64::BIGINT AS min_dim, 64::BIGINT AS max_dim,
  3 * (count(*) - count(vec_id))::BIGINT AS rejected
FROM documents LEFT JOIN embeddings ON vec_id = doc_id""",
    "vector_rejects": f"""
SELECT doc_id AS id,
  CASE WHEN length(text) > {MAX_CHARS} THEN 'passage too long' ELSE 'no vector' END AS problem
FROM documents LEFT JOIN embeddings ON vec_id = doc_id
WHERE length(text) > {MAX_CHARS} OR vec_id IS NULL""",
    "context_join_left": f"""
WITH {neighbours(2)}, lists AS (SELECT qid, list(pid ORDER BY rank) AS ids FROM hits GROUP BY qid)
SELECT qid, {listed('ids')} AS context_ids, ids[1] AS top1_pid, text AS context_text
FROM lists LEFT JOIN documents ON doc_id = ids[1]""",
    "context_lookup": f"""
WITH {neighbours(5)},
texts AS (
  SELECT qid, text, min(rank) AS pos FROM hits JOIN documents ON doc_id = pid
  WHERE text <> '' GROUP BY qid, text),
lists AS (SELECT qid, list(text ORDER BY pos)[1:3] AS texts FROM texts GROUP BY qid)
SELECT e.vec_id AS qid, coalesce(len(texts), 0)::BIGINT AS n,
  coalesce({listed('list_transform(texts, lambda t: substr(t, 1, 200))')}, '') AS contexts
FROM embeddings e LEFT JOIN lists ON lists.qid = e.vec_id""",
    "retrieve_text": f"""
WITH {found(fixed.BASELINE_TOP_K)}
SELECT qid, rank::BIGINT AS rank, pid, {r6('score', 'score')} FROM hits""",
    "rerank_topk": f"""
WITH {RERANKED} SELECT qid, rerank_rank::BIGINT AS rerank_rank, rank::BIGINT AS rank, pid,
  {r6('rerank_score', 'rerank_score')}
FROM reranked WHERE rerank_rank <= {fixed.RERANK_TOP_K}""",
    "confidence_margin": f"""
WITH {RERANKED} SELECT qid, {r6('conf', 'conf')}, {r6('margin', 'margin')} FROM sure""",
    "abstain": f"""
WITH {RERANKED} SELECT qid, {LOW}::INT::BIGINT AS low_conf,
  CASE WHEN {LOW} THEN {quoted(fixed.ABSTAIN_ANSWER)} ELSE prediction END AS prediction
FROM sure JOIN records USING (qid)""",
    "prompt_texts": f"""
WITH {found(fixed.BASELINE_TOP_K)},
blocks AS (
  SELECT h.qid, string_agg('[' || h.pid || '] ' || d.text, chr(10) || chr(10) ORDER BY h.rank) AS block
  FROM hits h JOIN documents d ON d.doc_id = h.pid GROUP BY h.qid)
SELECT qid, {quoted(fixed.SYSTEM_PROMPT)} || chr(10) || chr(10) || 'Context:' || chr(10)
  || coalesce(block, '') || chr(10) || chr(10) || 'Question: ' || question || chr(10) || 'Answer:' AS prompt
FROM records LEFT JOIN blocks USING (qid)""",
    "qa_baseline": f"""
WITH {found(fixed.BASELINE_TOP_K)}
SELECT qid, question, {leading_words('texts', '128')} AS prediction, gold,
  {listed('ids')} AS context_ids
FROM records JOIN context_lists USING (qid)""",
    "qa_reranked": f"""
WITH {RERANKED}, {TOP_RERANKED}
SELECT qid, question,
  CASE WHEN {LOW} THEN {quoted(fixed.ABSTAIN_ANSWER)} ELSE {leading_words('texts', '128')} END AS prediction,
  gold, {listed('ids')} AS context_ids, {r6('conf', 'conf')}, {r6('margin', 'margin')},
  {LOW}::INT::BIGINT AS low_conf
FROM records JOIN sure USING (qid) JOIN top_reranked USING (qid)""",
    "batch_generate": f"""
WITH {found(fixed.BASELINE_TOP_K)}
SELECT qid, 'You ask: ' || question AS prediction, {listed('ids')} AS context_ids
FROM records JOIN context_lists USING (qid)""",
    "batch_rerank": f"""
WITH {found(fixed.RERANK_CANDIDATES)},
scored AS (
  SELECT h.qid, h.rank, h.pid,
    least(length(question), length(text))::DOUBLE / greatest(length(question), length(text), 1) AS s
  FROM hits h JOIN records USING (qid) JOIN documents ON doc_id = pid),
reranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s DESC, rank) AS rr FROM scored)
SELECT qid, {listed(f'list(pid ORDER BY rr) FILTER (rr <= {fixed.RERANK_TOP_K})')} AS context_ids,
  {r6('max(s) FILTER (rr = 1)', 'conf')},
  {r6('max(s) FILTER (rr = 1) - max(s) FILTER (rr = 2)', 'margin')}
FROM reranked GROUP BY qid""",
    "answer_norm": f"""
WITH {RECORDS} SELECT qid, array_to_string({answer_tokens('gold')}, ' ') AS gold,
  len({answer_tokens('gold')})::BIGINT AS tokens FROM records""",
    "token_f1": f"WITH {RECORDS}, {token_f1('records')} SELECT qid, {r6('f1', 'f1')} FROM scores",
    "unknown_flag": f"WITH {RECORDS}, {token_f1('records')} SELECT qid, unknown::BIGINT AS unknown FROM scores",
    "squad_scores": f"""
WITH {RECORDS}, {token_f1('records')}
SELECT qid, {r6('em', 'em')}, {r6('squad_f1', 'squad_f1')} FROM scores""",
    "squad_last_prediction": f"""
WITH {RECORDS},
turns AS (
  SELECT qid AS turn, split_part(qid, '-', 1) AS conv, split_part(qid, '-', 2)::INT AS pos, gold,
    coalesce(prediction, '') AS own FROM records),
latest AS (SELECT conv, arg_max(own, pos) AS prediction FROM turns GROUP BY conv),
paired AS (SELECT turn, gold, prediction FROM turns JOIN latest USING (conv)),
{token_f1('paired')}
SELECT turn, {r6('em', 'em')}, {r6('squad_f1', 'squad_f1')} FROM scores""",
    "macro_scores_ci": f"WITH {RECORDS}, {token_f1('records')} SELECT 'run' AS tag, {comparison(False)} FROM scores",
    "comparison_row": f"WITH {RECORDS}, {token_f1('records')} SELECT 'run' AS tag, {comparison(True)} FROM scores",
    "first_questions": f"""
WITH {RECORDS} SELECT qid, question, gold AS answer FROM records ORDER BY qid LIMIT 200""",
    "prompt_grid_scores": f"""
WITH {found(max(fixed.GRID_TOP_K))},
variants AS (
  SELECT 'top_' || k || '_new_' || m || '_' || s AS tag, qid, gold,
    {leading_words('texts[1:k]', 'm')} AS prediction
  FROM records JOIN context_lists USING (qid),
    (VALUES {', '.join(f'({k})' for k in fixed.GRID_TOP_K)}) AS ks(k),
    (VALUES {', '.join(f'({m})' for m in fixed.GRID_MAX_NEW_TOKENS)}) AS ms(m),
    (VALUES {', '.join(f"('{s}')" for s in fixed.PROMPT_STRATEGIES)}) AS ss(s)),
{token_f1('variants')}
SELECT tag, {comparison(True)} FROM scores GROUP BY tag""",
    "judge_dataset": f"""
WITH {JUDGE_BASE}
SELECT qid, question, answer, answer AS response,
  {listed('list_transform(texts[1:5], lambda t: substr(t, 1, 1800))')} AS contexts,
  gold AS reference, gold AS "references", gold AS ground_truth, gold AS ground_truths
FROM valid""",
    "judge_sample": f"""
WITH {JUDGE_BASE} SELECT qid, answer, len(texts)::BIGINT AS contexts FROM valid ORDER BY qid LIMIT 50""",
    "judge_shards": f"""
WITH {JUDGE_SCORES}, {shards(fixed.JUDGE_BATCH)}
SELECT tag, shard::BIGINT AS shard, size::BIGINT AS size, {METRICS6} FROM shard_means""",
    "judge_weighted_mean": f"""
WITH {JUDGE_SCORES}, {shards(fixed.JUDGE_BATCH)} SELECT tag, n, {METRICS6} FROM summary""",
    "judge_summary": f"""
WITH {JUDGE_SCORES}, {shards(10)}
SELECT tag, n, {METRICS6}, {fixed.CONTEXT_CAP}::BIGINT AS ctx_cap, 0::BIGINT AS ctx_char_cap, batch,
  4::BIGINT AS workers, 'overlap' AS judge FROM summary""",
    "batch_judge": f"""
WITH {JUDGE_BASE}, {CAPPED},
sharded AS (
  SELECT *, (row_number() OVER (PARTITION BY tag ORDER BY qid) - 1) // 5 AS shard,
    list_filter(regexp_split_to_array(question, '[{SPACE}]+'), lambda t: t <> '') AS qt,
    list_filter(regexp_split_to_array(answer, '[{SPACE}]+'), lambda t: t <> '') AS ans
  FROM capped),
judged AS (
  SELECT *, max(length(answer)) OVER (PARTITION BY tag, shard) > {ANSWER_LIMIT} AS failed,
    len(list_intersect(list_distinct(qt), list_distinct(ans)))::DOUBLE AS shared
  FROM sharded),
rows AS (
  SELECT tag, shard, failed,
    CASE WHEN NOT failed THEN shared / nullif(len(list_distinct(qt)), 0) END AS relevancy,
    CASE WHEN NOT failed THEN (shared > 0)::INT::DOUBLE END AS faith
  FROM judged),
means AS (
  SELECT tag, shard, count(*) AS size, count(*) FILTER (failed) AS failed, avg(relevancy) AS r,
    avg(faith) AS f FROM rows GROUP BY tag, shard)
SELECT tag, sum(size)::BIGINT AS n, sum(failed)::BIGINT AS failed,
  {r6('sum(r * size) / sum(CASE WHEN r IS NOT NULL THEN size END)', 'answer_relevancy')},
  {r6('sum(f * size) / sum(CASE WHEN f IS NOT NULL THEN size END)', 'faithfulness')}
FROM means GROUP BY tag""",
    "report_union": f"""
WITH {JUDGE_SCORES}, {shards(25)}, {token_f1('records')}
SELECT 'run' AS tag, count(*)::BIGINT AS n, {r6('avg(f1)', 'f1_mean')}, {r6('avg(unknown)', 'unknown_rate')},
  NULL::DOUBLE AS faithfulness, NULL::DOUBLE AS answer_relevancy, NULL::BIGINT AS batch FROM scores
UNION ALL
SELECT tag, n, NULL, NULL, {r6('faithfulness')}, {r6('answer_relevancy')}, batch FROM summary""",
    "report_best_per_tag": f"""
WITH {JUDGE_SCORES}, {shards(10, '_a')}, {shards(25, '_b')}, {shards(50, '_c')},
runs AS (
  SELECT tag, n, {METRICS6}, batch FROM (
    SELECT * FROM summary_a UNION ALL SELECT * FROM summary_b UNION ALL SELECT * FROM summary_c)),
best AS (
  SELECT *, row_number() OVER (PARTITION BY tag ORDER BY
    {', '.join(f'{m} DESC NULLS LAST' for m in METRICS)}) AS place
  FROM runs WHERE n > {fixed.MIN_REPORTED_ROWS})
SELECT tag, n, {', '.join(METRICS)}, batch FROM best WHERE place = 1""",
    "report_append": f"""
WITH {JUDGE_SCORES}, {shards(25)}, {token_f1('records')}
SELECT 'run' AS tag, count(*)::BIGINT AS n, {r6('avg(f1)', 'f1_mean')}, NULL::DOUBLE AS faithfulness FROM scores
UNION ALL SELECT tag, n, NULL, {r6('faithfulness')} FROM summary""",
    "row_positions": """
SELECT row_number() OVER (ORDER BY doc_id DESC) - 1 AS id, length(text)::BIGINT AS char_len
FROM documents""",
    "shard_positions": """
SELECT doc_id, lang, (row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) - 1)::BIGINT AS pos
FROM documents""",
    "scan_roundtrip": f"""
WITH {RECORDS}, {token_f1('records')}
SELECT 'passages csv' AS source, doc_id::VARCHAR AS key, md5(text) AS text FROM documents
UNION ALL SELECT 'passages parquet', doc_id::VARCHAR, md5(text) FROM documents
UNION ALL SELECT 'queries csv',
  (split_part(qid, '-', 1)::BIGINT * 1000 + split_part(qid, '-', 2)::BIGINT)::VARCHAR, md5(question) FROM records
UNION ALL SELECT 'answers json', qid, md5(coalesce(gold, '')) FROM records
UNION ALL SELECT 'scores parquet', qid, md5(unknown::VARCHAR) FROM scores""",
    "leading_topic": f"""
WITH squares AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * x::DOUBLE * 1e6) / 1e6::DOUBLE) AS s FROM embeddings),
best AS (SELECT vec_id, list_max(s) AS m, list_position(s, list_max(s)) - 1 AS place FROM squares)
SELECT vec_id AS id, CASE WHEN m >= {fixed.MIN_TOPIC_SHARE} THEN place END::BIGINT AS topic,
  {r6(f'CASE WHEN m >= {fixed.MIN_TOPIC_SHARE} THEN m ELSE 0 END::DOUBLE', 'share')} FROM best""",
    "ivf_recall": "SELECT 5 * count(*)::BIGINT AS expected, 1::BIGINT AS enough FROM embeddings",
    "index_reuse": f"WITH {neighbours(5)} {VECTOR_HITS}",
    "evaluate_run": f"""
WITH {RECORDS}, {token_f1('records')}
SELECT 'run' AS tag, count(*) FILTER (length(question) % 3 = 1)::BIGINT AS by_id,
  count(*) FILTER (length(question) % 3 = 2)::BIGINT AS by_position, {comparison(True)} FROM scores""",
}
ORACLE["qa_indexed"] = ORACLE["qa_baseline"]
ORACLE["judge_run"] = f"""
SELECT *, 5::BIGINT AS batch, {fixed.CONTEXT_CAP}::BIGINT AS ctx_cap FROM ({ORACLE['batch_judge']}) WHERE tag = 'cap_5'"""
