"""Secret scans over every version of every path, through a ledger of contents.

The ledger is a folder of three tables. ``paths`` holds each path with the address (SHA-256)
of each content it has had, ``scanned`` the pairs of content and rule version that are done,
``findings`` what they gave. A new batch of versions is addressed first; one text per address
is then fetched, and only for the rules, in their present version, that have not seen it.
Findings are joined back to all paths with that content.

A batch writes its findings before it marks them as scanned, so a batch that broke off is
scanned again and its doubled findings count once.

Defined cases: null text is empty text; it has an address and no findings. Null ids are
paths like others. Rows repeated in a batch each get their result; their content is scanned
once. Empty batches add nothing. Positions count code points, ends are exclusive. Other
columns of the input are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"  # marks; no rule may match these characters


@dataclass(frozen=True)
class SecretRule:
    """Leftmost matches of ``pattern`` that do not overlap; those whose ``group`` is shorter
    than ``least`` characters are dropped after matching."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# Kinds, patterns and least lengths, in the order in which kinds are listed. A
# run of the last two kinds that is too short holds no long one, so the length is in the pattern.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
RULES = (
    SecretRule("assign", ASSIGN, group=2, least=6),
    SecretRule("access", "AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", "[0-9a-f]{24,}"),
)

SCANNED = "blob string, kind string, version int, batch string"
FINDINGS = "blob string, kind string, version int, start long, end long, batch string"


def blob_of(text: Column) -> Column:
    """Address of a content: hex SHA-256 of its UTF-8 bytes."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _pieces(text: Column, rule: SecretRule) -> Column:
    """For each match its text and the length up to the next match; first what stands before all."""
    clean = F.translate(text, OPEN + CLOSE, OTHER + OTHER)
    marked = F.regexp_replace(clean, rule.pattern, f"{OPEN}$0{CLOSE}")
    return F.transform(
        F.split(marked, OPEN),
        lambda part, i: F.struct(
            i.alias("i"),
            (F.length(part) - F.when(i > 0, 1).otherwise(0)).alias("size"),
            F.when(i > 0, F.substring_index(part, CLOSE, 1)).alias("found"),
        ),
    )


def scan_texts(texts: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """Findings (blob, kind, version, start, end) in ``texts`` (blob, text, done).

    ``done`` lists the (kind, version) pairs that are left out for that blob. A text is gone
    over once for each rule it needs; only texts with a match are cut at their matches.
    """
    per_rule = F.array(
        *[
            F.when(
                ~F.array_contains(F.col("done"), f"{r.kind}:{r.version}") & F.rlike(F.col("text"), F.lit(r.pattern)),
                F.struct(
                    F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _pieces(F.col("text"), r).alias("pieces")
                ),
            )
            for r in rules
        ]
    )
    matched = texts.select("blob", F.explode(F.array_compact(per_rule)).alias("m"))
    cut = matched.select("blob", "m.kind", "m.version", F.explode("m.pieces").alias("p"))
    rows = cut.select("blob", "kind", "version", "p.*").distinct()
    before = Window.partitionBy("blob", "kind", "version").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    long_enough = F.lit(False)
    for r in rules:
        size = F.length(F.regexp_extract("found", r.pattern, r.group))
        long_enough = long_enough | ((F.col("kind") == r.kind) & (size >= r.least))
    return placed.filter((F.col("i") > 0) & long_enough).select(
        "blob", "kind", "version", "start", (F.col("start") + F.length("found")).alias("end")
    )


@dataclass
class BlobLedger:
    """A ledger in ``folder``, which all executors share."""

    spark: SparkSession
    folder: str
    rules: Sequence[SecretRule] = field(default=RULES)

    def _read(self, name: str, schema: str) -> DataFrame:
        """The table of all batches; made empty first if there is none."""
        path = f"{self.folder}/{name}"
        self.spark.createDataFrame([], schema).write.mode("append").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _add(self, rows: DataFrame, name: str, batch: str) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{self.folder}/{name}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED)

    def findings(self) -> DataFrame:
        """Findings of the present rule versions, each once."""
        now = [f"{r.kind}:{r.version}" for r in self.rules]
        found = self._read("findings", FINDINGS)
        current = found.filter(F.concat_ws(":", "kind", "version").isin(now))
        return current.select("blob", "kind", "start", "end").distinct()

    def ingest(self, versions: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
        """Take in a batch of versions, one row each, and return its rows (path, blob).

        Addresses are counted down to one row a content before texts move. Of each content
        that some rule has not seen, the text of one row is fetched by a join on the path.
        """
        batch = uuid4().hex
        rows = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        addressed = rows.withColumn("blob", blob_of(F.col("text")))
        place = f"{self.folder}/paths/batch={batch}"
        addressed.select("path", "blob").write.parquet(place)
        paths = self.spark.read.parquet(place)
        done = self.scanned().groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("done"))
        every = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in self.rules])
        unseen = (
            paths.groupBy("blob").agg(F.min("path").alias("path"))
            .join(done, "blob", "left")
            .withColumn("done", F.coalesce("done", F.array().cast("array<string>")))
            .filter(F.size(F.array_except(every, "done")) > 0)
        )
        wanted = unseen.select(F.col("path").alias("rep"), F.col("blob").alias("rep_blob"), "done")
        texts = addressed.join(
            wanted.hint("shuffle_hash"), F.col("path").eqNullSafe(F.col("rep")) & (F.col("blob") == F.col("rep_blob"))
        ).select("blob", "text", "done")
        self._add(scan_texts(texts, self.rules), "findings", batch)
        pairs = unseen.select("blob", F.explode(F.array_except(every, "done")).alias("pair"))
        cut = F.split("pair", ":")
        self._add(pairs.select("blob", cut[0].alias("kind"), cut[1].cast("int").alias("version")), "scanned", batch)
        return paths

    def report(self, paths: DataFrame) -> DataFrame:
        """``paths`` with the findings of their contents: one count a kind, and all spans in order.

        Findings are put together once a content; contents with many paths are only joined.
        """
        order = F.lit(0)
        for i, r in enumerate(self.rules):
            order = F.when(F.col("kind") == r.kind, i).otherwise(order)
        span = F.concat_ws(":", "kind", "start", "end")
        found = self.findings().groupBy("blob").agg(
            *[F.count_if(F.col("kind") == r.kind).alias(f"n_{r.kind}") for r in self.rules],
            F.array_sort(F.collect_list(F.struct("start", order.alias("o"), span.alias("span")))).alias("all"),
        )
        joined = paths.join(found, "blob", "left")
        return joined.select(
            "path",
            "blob",
            *[F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in self.rules],
            F.coalesce(F.concat_ws(",", F.col("all.span")), F.lit("")).alias("spans"),
        )
