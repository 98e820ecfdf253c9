"""Column expressions over text. All stay in the JVM; none needs a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed

# What counts as white space and as a word character is spelt out, because the
# shorthand classes of Java cover ASCII only.
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
WORD = r"\p{L}\p{N}_"


def normalize_text(text: Column) -> Column:
    """Lower case; newlines and tabs become single spaces, nothing else changes."""
    return F.translate(F.lower(text), "\n\t", "  ")


def corpus_key(text: Column) -> Column:
    """Key under which passages count as copies: squeezed, ASCII letters and digits only."""
    squeezed = F.regexp_replace(F.lower(text), f"[{SPACE}]+", " ")
    return F.regexp_replace(squeezed, "[^a-z0-9 ]", "")


def char_len(text: Column) -> Column:
    return F.length(text)


def word_len(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+"))


def approx_token_count(text: Column) -> Column:
    """A quarter of the characters, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4).cast("int"))


def token_count(text: Column) -> Column:
    """Words and single symbols; stands in for a language-model tokenizer."""
    return F.regexp_count(text, F.lit(f"[{WORD}]+|[^{WORD}{SPACE}]"))


def _share(text: Column, pattern: str) -> Column:
    return F.try_divide(F.regexp_count(text, F.lit(pattern)).cast("double"), F.length(text))


def non_ascii_share(text: Column) -> Column:
    return _share(text, r"[^\x00-\x7f]")


def punctuation_share(text: Column) -> Column:
    return _share(text, f"[^{WORD}{SPACE}]")


def digit_share(text: Column) -> Column:
    return _share(text, r"\p{Nd}")


def normalize_answer(text: Column) -> Column:
    """Lower case without ASCII punctuation, articles and extra white space."""
    bare = F.regexp_replace(F.lower(text), r"\p{Punct}", "")
    articles = "|".join(fixed.ARTICLES)
    without = F.regexp_replace(bare, f"(?<![{WORD}])(?:{articles})(?![{WORD}])", " ")
    return F.trim(F.regexp_replace(without, f"[{SPACE}]+", " "))


def split_answer(normalized: Column) -> Column:
    """Tokens of a text that :func:`normalize_answer` has made."""
    return F.array_remove(F.split(normalized, " "), "")


def answer_tokens(text: Column) -> Column:
    return split_answer(normalize_answer(text))


def words(text: Column) -> Column:
    """Lower-case words, in order; the unit of the default encoder and re-ranker."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]+"), F.lit(0))


def token_f1(predicted: Column, expected: Column) -> Column:
    """F1 of two token arrays: shared *distinct* tokens over full lengths."""
    shared = F.size(F.array_intersect(predicted, expected))
    n_predicted, n_expected = F.size(predicted), F.size(expected)
    precision = F.try_divide(shared, n_predicted)
    recall = F.try_divide(shared, n_expected)
    harmonic = F.try_divide(2 * precision * recall, precision + recall + fixed.F1_EPSILON)
    return (
        F.when((n_predicted == 0) | (n_expected == 0), (n_predicted == n_expected).cast("double"))
        .when(shared == 0, F.lit(0.0))
        .otherwise(harmonic)
    )


def multiset_overlap(left: Column, right: Column) -> Column:
    """Tokens two arrays share, repeats included.

    The tokens of both are sorted together, left ones first among equals, and folded
    once: a right token counts while the left side has one to pair it with.
    """

    def sided(tokens, side):
        return F.transform(
            tokens, lambda t: F.struct(t.alias("token"), F.lit(side).alias("side"))
        )

    def fold(seen, x):
        open_lefts = F.when(seen["token"] == x["token"], seen["open"]).otherwise(0)
        is_left = x["side"] == 0
        return F.struct(
            x["token"].alias("token"),
            F.when(is_left, open_lefts + 1).otherwise(open_lefts - 1).alias("open"),
            (seen["shared"] + F.when(is_left | (open_lefts <= 0), 0).otherwise(1)).alias("shared"),
        )

    start = F.struct(
        F.lit("").alias("token"), F.lit(0).alias("open"), F.lit(0).alias("shared")
    )
    tokens = F.sort_array(F.concat(sided(left, 0), sided(right, 1)))
    return F.aggregate(tokens, start, fold, lambda seen: seen["shared"])


def multiset_f1(predicted: Column, expected: Column) -> Column:
    """F1 of two token arrays with repeats counted; 0 when they share nothing.

    Twice the shared tokens over all tokens is the harmonic mean of both shares.
    """
    size = F.size(predicted) + F.size(expected)
    shared = multiset_overlap(predicted, expected)
    return F.coalesce(F.try_divide(2.0 * shared, size), F.lit(0.0))


def unknown_flag(prediction: Column) -> Column:
    """1 when the answer admits not knowing, else 0."""
    lowered = F.lower(F.coalesce(prediction, F.lit("")))
    said = F.lit(False)
    for phrase in fixed.UNKNOWN_PHRASES:
        said = said | F.contains(lowered, F.lit(phrase))
    return said.cast("int")


def first_gold(gold: Column, is_array: bool) -> Column:
    """The answer that counts: the first of several, and '' when there is none."""
    chosen = F.try_element_at(gold, F.lit(1)) if is_array else gold
    return F.coalesce(chosen, F.lit(""))


def record_id(*candidates: Column) -> Column:
    """First id that is present, as text-safe coalesce over qid, id and position."""
    return F.coalesce(*candidates)


def overlap_score(question_words: Column, passage_words: Column) -> Column:
    """Share of the distinct question words that occur in the passage."""
    shared = F.size(F.array_intersect(question_words, passage_words))
    return F.coalesce(F.try_divide(shared, F.size(F.array_distinct(question_words))), F.lit(0.0))
