"""A Merkle manifest of a table: one leaf a row, a tree a group, a root over the groups, and
proofs that a row belongs.

Every row is a leaf, the SHA-256 of its fields. The leaves of each group (by default the
language) are numbered in order of id; each level pairs consecutive nodes and hashes each pair
(a last node without partner is hashed alone) until one node, the group's subroot, remains.
The subroots, in order of group, build the root in the same way.

Levels are built by Spark, one grouped step for every ``BLOCK_BITS`` levels, and stored as block
rows: up to 16 consecutive nodes and what lies above them in these levels. A block's parent is
found from its place (a 16th of it, or, above a group's top, the group's place among the
subroots). Digests travel as 32 bytes and are written as hex only where they are hashed or
returned. Proofs come from one recursive query: each leaf starts in its own block and climbs a
block a step, appending the siblings it meets and folding its hash with them, until it reaches
the root. Given a changed leaf, the same climb folds the changed hash; the result equals the root
only where nothing changed.

Defined cases: a null field is written ``-``; a null id sorts before all ids and a null group
before all groups (groups bytewise in UTF-8); rows with the same id sort by their leaf, so that
repeated rows give the same tree in any order. A group of one row has that leaf as subroot,
and one group has its subroot as root. A leaf without siblings at all has the hash of the empty
text as proof. An empty table gives an empty result. Other columns are not read. The climb
returns a row a leaf and block, so the session's row limit for recursive queries is lifted.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..shared import write_through

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = "tier int, grp long, level int, block long, up_levels int, rows array<array<binary>>, lift boolean"
BLOCK_BITS = 4  # levels of a block: a climb of many levels takes few steps, each of which moves all leaves
PLACE_BITS = 40  # a row's key is its group's number and its place there, in one long


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digest(text: Column) -> Column:
    return F.unhex(sha(text))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def _above(row: Column) -> Column:
    """The nodes above a row of consecutive nodes: one for each pair, and for a last one without partner."""
    first = F.sequence(F.lit(0), F.size(row) - 1, F.lit(2))
    return F.transform(first, lambda i: digest(F.concat(hexed(F.get(row, i)), F.coalesce(hexed(F.get(row, i + 1)), F.lit("")))))


def _levels(base: DataFrame, tier: int) -> tuple[DataFrame, DataFrame]:
    """Block rows of all levels below the top of each group, and the tops (grp, hash, level).

    ``base`` has (grp, pos, hash, n): the nodes of level 0 and the size of their group.
    """
    spark = base.sparkSession
    most = base.agg(F.max("n")).first()[0] or 1
    blocks = spark.createDataFrame([], BLOCK)
    tops = base.filter(F.col("n") <= 1).select("grp", "hash", F.lit(0).alias("level"))
    nodes = base.filter(F.col("n") > 1)
    level = 0
    while -(-most // 2**level) > 1:
        width = F.ceil(F.col("n") / F.lit(2**level))  # nodes of the group at this level
        run = F.array_sort(F.collect_list(F.struct("pos", "hash")))
        built = nodes.groupBy("grp", F.shiftright("pos", BLOCK_BITS).alias("block"), "n").agg(run["hash"].alias("r0"))
        for j in range(BLOCK_BITS):
            built = built.withColumn(f"r{j + 1}", _above(F.col(f"r{j}")))
        ups = sum(((width > 2**j).cast("int") for j in range(1, BLOCK_BITS)), F.lit(1))  # levels up to the top, or of the block
        built = built.select(
            "grp", "block", "n", ups.alias("up_levels"), (width <= 2**BLOCK_BITS).alias("whole"),
            F.array(*[F.col(f"r{j}") for j in range(BLOCK_BITS)]).alias("rows"),
            F.get(F.array(*[F.get(f"r{j + 1}", F.lit(0)) for j in range(BLOCK_BITS)]), ups - 1).alias("hash"),
        )
        built = write_through(built, f"merkle-{tier}-{level}")
        blocks = blocks.unionByName(built.select(
            F.lit(tier).alias("tier"), "grp", F.lit(level).alias("level"), "block", "up_levels", "rows",
            (F.col("whole") & F.lit(tier == 0)).alias("lift"),
        ))
        tops = tops.unionByName(built.filter("whole").select("grp", "hash", (F.col("up_levels") + level).alias("level")))
        nodes = built.filter(~F.col("whole")).select("grp", F.col("block").alias("pos"), "hash", "n")
        level += BLOCK_BITS
    return blocks, tops


def manifest(rows: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
             changed: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, digests in
    lowercase hex.

    ``changed`` may give new values of some fields, as columns of ``rows``: the fold then starts
    from the leaf of the changed row and climbs with the original siblings, as a check of a
    stored proof against a row read again. Without it every row is verified.
    """
    spark = rows.sparkSession
    leaves = write_through(with_leaves(rows, fields, key, group, changed), "merkle-leaves")

    inner, subroots = _levels(leaves.select("grp", "pos", F.col("leaf").alias("hash"), "n"), 0)
    subroots = write_through(subroots.select("grp", F.col("hash").alias("subroot")), "merkle-subroots")
    groups = subroots.agg(F.count(F.lit(1))).first()[0]
    upper = subroots.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"), F.col("subroot").alias("hash"), F.lit(groups).alias("n"))
    outer, root_row = _levels(upper, 1)
    found = root_row.select(hexed(F.col("hash")), "level").first()  # the one node left at the top, if any rows
    root, root_level = found or (None, 0)

    names = {n: f"merkle_{n}_{uuid4().hex}" for n in ("leaves", "blocks")}
    leaves.createOrReplaceTempView(names["leaves"])
    inner.unionByName(outer).createOrReplaceTempView(names["blocks"])
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    inside = f"CAST(c.pos & {2**BLOCK_BITS - 1} AS INT)"
    sibling = f"lower(hex(get(get(b.rows, j), shiftright({inside}, j) ^ 1)))"
    on_left = f"shiftright({inside}, j) & 1 = 1"
    climb = spark.sql(f"""
        WITH RECURSIVE climb AS (
          SELECT row_key, 0 AS step, IF(n = 1, 1, 0) AS tier, IF(n = 1, 0L, grp) AS grp, 0 AS level, IF(n = 1, grp, pos) AS pos,
                 start AS cur, CAST(NULL AS ARRAY<BINARY>) AS sibs
          FROM {names['leaves']}
          UNION ALL
          SELECT c.row_key, c.step + 1,
                 IF(b.lift, 1, c.tier), IF(b.lift, 0L, c.grp), IF(b.lift, 0, c.level + b.up_levels),
                 IF(b.lift, c.grp, shiftright(c.pos, b.up_levels)),
                 aggregate(sequence(0, b.up_levels - 1), c.cur, (h, j) -> unhex(sha2(CAST(concat(
                     IF({on_left}, {sibling}, ''), lower(hex(h)), IF({on_left}, '', coalesce({sibling}, ''))) AS BINARY), 256))),
                 filter(transform(sequence(0, b.up_levels - 1), j -> get(get(b.rows, j), shiftright({inside}, j) ^ 1)), s -> s IS NOT NULL)
          FROM climb c JOIN {names['blocks']} b
            ON b.tier = c.tier AND b.grp = c.grp AND b.level = c.level AND b.block = shiftright(c.pos, {BLOCK_BITS}))
        SELECT row_key, step, sibs, IF(tier = 1 AND level = {root_level}, cur, NULL) AS top FROM climb
    """)
    # Each step gave the siblings of a block's levels; they are joined in order of step per leaf.
    steps = F.array_sort(F.collect_list(F.struct("step", "sibs")))
    ordered = F.transform(F.flatten(F.transform(steps, lambda x: x["sibs"])), hexed)
    climbed = climb.filter(F.col("sibs").isNotNull()).groupBy("row_key").agg(
        F.max("top").alias("folded"), sha(F.array_join(ordered, "")).alias("proof_sha256")
    )
    folded = hexed(F.coalesce("folded", "start"))
    return (
        leaves.join(climbed, "row_key", "left")
        .join(subroots.select("grp", "subroot"), "grp")
        .select(
            F.col("key").alias(key), hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
            F.lit(root).cast("string").alias("root"), F.coalesce("proof_sha256", sha(F.lit(""))).alias("proof_sha256"),
            folded.alias("folded_root"), (folded == F.lit(root)).alias("verified"),
        )
    )


def with_leaves(rows: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
                changed: dict[str, Column] | None = None) -> DataFrame:
    """(row_key, key, grp, pos, n, leaf, start) of every row: its group's number, its place there,
    the group's size, its leaf and the leaf of its changed fields. ``row_key`` is group number
    and place in one long."""
    changed = changed or {}
    leafy = rows.select(
        F.col(key).alias("key"),
        F.col(group).alias("gval"),
        leaf_of(*[F.col(f) for f in fields]).alias("leaf"),
        leaf_of(*[changed.get(f, F.col(f)) for f in fields]).alias("start"),
    )
    groups = leafy.select("gval").distinct()
    numbered_groups = number_rows(groups, [F.col("gval").asc_nulls_first()], "grp")
    tagged = leafy.join(numbered_groups, leafy["gval"].eqNullSafe(numbered_groups["gval"])).select("key", "leaf", "start", "grp")
    placed = number_rows(tagged, [F.col("key").asc_nulls_first(), F.col("leaf")], "pos", within="grp")
    sizes = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    row_key = F.shiftleft(F.col("grp"), PLACE_BITS).bitwiseOR(F.col("pos"))
    return placed.join(sizes, "grp").select(row_key.alias("row_key"), "key", "grp", "pos", "n", "leaf", "start")
