"""URL filters: rules indexed by their rarest literal token, so that a URL meets few of them.

A rule has a place (``host/path``, optional), a pattern (optional) and a verdict. Its literal
tokens are the runs of letters and digits that must stand in every URL it fits. The index
files each rule under the one of its tokens that is least common among the URLs at hand; a
URL fetches the rules filed under its own tokens, and only those are tried in full, their
regular expressions included.

Defined cases: a null URL and one without ``://`` have an empty host and path; they fit no
place, and get the default verdict. Rows with the same URL each get their own result. No
rules, or no rows, give the default verdict for all rows and no rows. Other columns of the
input are carried along; one that has the name of a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[A-Za-z0-9]+"
RESULTS = ("host", "path", "rule", "rule_pattern", "verdict")


@dataclass(frozen=True)
class Rule:
    """``place`` is a host, a slash and the start of a path; ``pattern`` a Java expression that
    some part of the lower-cased URL has to match, with ``literals`` that every match holds as
    whole tokens. Without a place a rule counts as weaker than any rule with one."""

    verdict: str
    place: str | None = None
    pattern: str | None = None
    literals: tuple[str, ...] = ()

    @property
    def host(self) -> str | None:
        return None if self.place is None else self.place.split("/", 1)[0]

    @property
    def path(self) -> str | None:
        return None if self.place is None else "/" + self.place.split("/", 1)[1]


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1)))


def rule_table(spark, rules: Sequence[Rule]) -> DataFrame:
    """The rules as rows, each with the literal tokens that the URLs it fits must hold.

    The last piece of a path may go on in the URL, so it counts only when a slash or another
    mark ends it.
    """
    rows = [
        (i, r.verdict, r.place, r.host, r.path, r.pattern, list(r.literals)) for i, r in enumerate(rules)
    ]
    table = spark.createDataFrame(
        rows,
        "rule_id long, verdict string, place string, host string, path string, pattern string, literals array<string>",
    )
    whole = F.regexp_replace(F.col("path"), f"{TOKEN}$", "")
    return table.withColumn(
        "must",
        F.array_union(
            F.transform("literals", F.lower),
            F.array_union(
                F.coalesce(_tokens("host"), F.array().cast("array<string>")),
                F.coalesce(F.transform(_tokens(whole), F.lower), F.array().cast("array<string>")),
            ),
        ),
    )


def rarest_token_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule under its least common token; a rule without literals under the empty token.

    ``urls`` has (token, seen). Tokens that no URL holds count as seen 0 times.
    """
    listed = rules.select("rule_id", F.explode_outer("must").alias("token"))
    counted = listed.join(urls, "token", "left").groupBy("rule_id")
    rarest = counted.agg(
        F.min_by("token", F.struct(F.coalesce("seen", F.lit(0)), "token")).alias("token")
    )
    return rules.drop("must").join(rarest, "rule_id").withColumn("token", F.coalesce("token", F.lit("")))


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``rule_pattern`` and ``verdict``.

    The fitting rule with the longest place wins, then the longest pattern, then the earliest
    rule. ``rule`` is the winner's place, null if it has none or no rule fits.

    The rules fit a plan of three joins with them alone: the token counts (for tokens that
    rules hold), the index, and the fetched candidates. How each is joined is left to Spark,
    which sends the rules to the tasks if they are few, and shuffles else. Winners are found
    once for each different URL, so that a page fetched a million times is judged once.
    """
    spark = pages.sparkSession
    table = rule_table(spark, rules)
    wanted = table.select(F.explode("must").alias("token")).distinct()
    different = pages.select(F.col(url).alias("__url_text")).groupBy("__url_text").count()
    lowered = F.lower("__url_text")
    tokens = F.array_union(F.coalesce(_tokens(lowered), F.array().cast("array<string>")), F.array(F.lit("")))
    parts = different.select("__url_text", "count", F.explode(tokens).alias("token"))
    seen = parts.join(wanted, "token").groupBy("token").agg(F.sum("count").alias("seen"))
    index = rarest_token_index(table, seen)
    candidates = parts.join(index, "token").select(
        "__url_text", "rule_id", "verdict", "place", "host", "path", "pattern",
        host_of(F.col("__url_text")).alias("__url_host"), path_of(F.col("__url_text")).alias("__url_path"),
    )
    fits = (
        F.col("place").isNull()
        | (
            ((F.col("__url_host") == F.col("host")) | F.endswith("__url_host", F.concat(F.lit("."), "host")))
            & F.startswith("__url_path", "path")
        )
    ) & (F.col("pattern").isNull() | F.expr("lower(__url_text) rlike pattern"))
    strength = F.struct(
        F.length(F.coalesce("place", F.lit(""))), F.length(F.coalesce("pattern", F.lit(""))), -F.col("rule_id")
    )
    winners = candidates.filter(fits).groupBy("__url_text").agg(
        F.max_by(F.struct("place", "pattern", "verdict"), strength).alias("__url_won")
    )
    # Columns are taken from their own frame, so that input columns of any name do not clash.
    won = winners.withColumnRenamed("__url_text", "__url_known")
    judged = pages.join(won, pages[url] == won["__url_known"], "left")
    kept = [pages[c] for c in pages.columns if c.lower() not in RESULTS]
    best = won["__url_won"]
    return judged.select(
        *kept,
        host_of(pages[url]).alias("host"),
        path_of(pages[url]).alias("path"),
        best["place"].alias("rule"),
        best["pattern"].alias("rule_pattern"),
        F.coalesce(best["verdict"], F.lit(default)).alias("verdict"),
    )
