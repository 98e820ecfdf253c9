"""Texts and numbers that results depend on, stated once.

Changing any of them changes prompts, flags or scores.
"""

# Prompt texts.
SYSTEM_PROMPT = (
    "You are a helpful assistant. Answer using only the provided context. "
    "If the answer is not in the context, say you don't know. Be concise. "
    "Cite the passage IDs you used."
)

INSTRUCTION_PROMPT = """\
Role: Grounded QA assistant.
Policy:
  • Use ONLY the text in <context> — do not infer or add outside facts.
  • If the answer is not in <context>, reply exactly: I don't know.
  • Prefer verbatim entity names, numbers, and dates from <context>.
  • Keep answers concise (≤ 35 words) and neutral.
Output format:
  Answer: <your answer>
  Citations: [<passage_ids>]
"""

COT_PROMPT = """\
Role: Grounded QA assistant.
Policy:
  • Use ONLY the text in <context>. If insufficient, say: I don't know.
  • First extract 1–2 short evidence snippets with their [id].
  • Then give a FINAL answer in ≤ 30 words; no hedging.
Output format:
  Evidence:
    - [<id>] "<≤12-word quote>"
    - [<id>] "<≤12-word quote>" (optional)
  Final: <your answer>
  Citations: [<passage_ids>]
"""

PERSONA_PROMPT = """\
You are a senior Wikipedia fact-checker.
Style: precise, encyclopedic, and terse; no speculation or filler.
Grounding rules:
  • Answer strictly from <context>; otherwise say: I don't know.
  • Preserve canonical names/labels; include units and dates as written.
  • Prefer a single definitive sentence; lists only when the question asks for them.
Output format:
  Answer: <your answer>
  Citations: [<passage_ids>]
"""

PROMPT_STRATEGIES = {
    "instruction": INSTRUCTION_PROMPT,
    "cot": COT_PROMPT,
    "persona": PERSONA_PROMPT,
}

# Answer given when the confidence gate closes.
ABSTAIN_ANSWER = "I don't know."

# Phrases that mark an answer as unknown.
UNKNOWN_PHRASES = ("don't know", "do not know", "unknown")

# Articles dropped before answers are compared.
ARTICLES = ("a", "an", "the")

# F1 denominator guard, and the score of a missing runner-up.
F1_EPSILON = 1e-12
NO_RUNNER_UP = -1e9

# Gate, candidate and context settings of a re-ranked run.
MIN_CONF = 0.25
MIN_MARGIN = 0.05
RERANK_CANDIDATES = 50
RERANK_TOP_K = 5
BASELINE_TOP_K = 3

# Cell search settings.
NLIST = 1024
NPROBE = 16

# Judge settings and metric names.
JUDGE_METRICS = ("faithfulness", "context_precision", "context_recall", "answer_relevancy")
JUDGE_BATCH = 25
CONTEXT_CAP = 5

# Columns of a corpus profile.
PROFILE_COLUMNS = (
    "char_len", "word_len", "token_count", "non_ascii_pct", "punct_pct", "digits_pct",
)

# Vocabulary limits (documents, share of documents) and topics.
MIN_DOCS = 2
MAX_DOC_SHARE = 0.8
TOPICS = 5
TOPIC_SEED = 42
TOPIC_PASSES = 10
TOPIC_BATCH_SHARE = 0.25
TOPIC_WORDS = 20
MIN_TOPIC_SHARE = 0.1

# Fewest tokens a passage may have, and smallest judged run reported.
MIN_PASSAGE_TOKENS = 3
MIN_REPORTED_ROWS = 100

# Parameter grid of the sweep.
GRID_TOP_K = (3, 5, 10)
GRID_MAX_NEW_TOKENS = (256, 384, 512)
