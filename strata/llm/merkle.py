"""Merkle manifest of a dataset by nested-struct rollup (operator 11).

Every row's hash is a leaf.  Within a group (``lang`` for documents) the
leaves get their rank, whose base-8 digits become columns.  Inside blocks of
BLOCK leaves the digit columns are grouped away one after the other; each
grouping nests the child structs (hash and grandchildren) into their parent.
Block roots are the leaves of the next round, until one node a group is left;
the groups' roots form one more tree of the same kind.  On the way down a
block meets its own path in a grouping by (group, block), and one transform
and explode of the nested children emits every child's path: no join of
leaves with nodes, and no row wider than a block.

Ranks come from one written range partitioning and a table with a row for
each partition and group, so a group that holds most of the rows is never
sorted in one task.

Defined results: a null field counts as ``-``; null groups and ids come
first; rows with equal ids are ordered by their leaf; an empty table has no
rows; a lone leaf is its group's root; further columns are left out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_width
from .textscan import crc_class

#: Children of a node, and groupings inside one block (BLOCK leaves).
FANOUT_BITS, DIGITS = 3, 3
FANOUT, BLOCK = 1 << FANOUT_BITS, 1 << (FANOUT_BITS * DIGITS)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(**changed: Column) -> Column:
    """Hash of the FIELDS of a row; ``changed`` replaces some of them."""
    def part(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(changed.get(f, F.col(f))) for f in FIELDS]), 256)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows(key, ...)`` with ``idx``, the rank (from 0) within ``key``, and ``n``, the key's rows."""
    wide = shuffle_width(rows.sparkSession)
    dealt = cut_lineage(
        rows.repartitionByRange(wide, "key", *order).sortWithinPartitions("key", *order)
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "merkle-ranked")
    runs = dealt.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    of_key = Window.partitionBy("key")
    before = of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("key").alias("run_key"), F.col("part").alias("run_part"),
                       (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("size").over(of_key).alias("n"))
    same = F.col("key").eqNullSafe(F.col("run_key")) & (F.col("part") == F.col("run_part"))
    return (dealt.join(runs, same).withColumn("idx", F.col("at") + F.col("shift"))
            .drop("part", "at", "run_key", "run_part", "shift"))


def _nodes(n: Column, level: int) -> Column:
    """Nodes of a group of ``n`` after ``level`` groupings."""
    return F.shiftright(n + F.lit((1 << (FANOUT_BITS * level)) - 1), FANOUT_BITS * level)


def _nest(items: DataFrame) -> DataFrame:
    """``items(key, idx, n, h, load)`` to one row a block: its number, hash and nested children."""
    digit = {f"d{i}": F.shiftright("idx", FANOUT_BITS * i).bitwiseAND(F.lit(FANOUT - 1)) for i in range(DIGITS)}
    now = items.withColumns({**digit, "block": F.shiftright("idx", FANOUT_BITS * DIGITS)})
    now = now.repartition("key", "block")  # all groupings below stay inside their partition
    inner = "load"
    for level in range(DIGITS):
        rest = [f"d{i}" for i in range(level + 1, DIGITS)]
        now = (now.groupBy("key", "block", "n", *rest)
               .agg(F.sort_array(F.collect_list(F.struct(f"d{level}", "h", inner))).alias("kids"))
               .withColumn("h", F.when(_nodes(F.col("n"), level) > 1, F.sha2(F.array_join("kids.h", ""), 256))
                           .otherwise(F.col("kids")[0]["h"])))
        inner = "kids"
    return now.select("key", F.col("block").alias("idx"), _nodes(F.col("n"), DIGITS).alias("n"), "h", "kids",
                      F.col("n").alias("n_below"))


def _step(hashes: Column, i: Column) -> Column:
    """The siblings left and right of child ``i``."""
    return F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
                    F.array_join(F.slice(hashes, i + F.lit(2), F.size(hashes)), "").alias("right"))


def _children(kids: Column, n: Column, level: int = DIGITS - 1) -> Column:
    """All items below ``kids`` (children of grouping ``level``) with their paths up to the block root."""
    none = F.array().cast("array<struct<left:string,right:string>>")

    def path(i: Column) -> Column:
        return F.when(_nodes(n, level) > 1, F.array(_step(kids["h"], i))).otherwise(none)

    if level == 0:
        return F.transform(kids, lambda c, i: F.struct(c["load"].alias("load"), c["h"].alias("h"),
                                                       path(i).alias("path")))

    def below(c: Column, i: Column) -> Column:
        return F.transform(_children(c["kids"], n, level - 1), lambda x: F.struct(
            x["load"].alias("load"), x["h"].alias("h"), F.concat(x["path"], path(i)).alias("path")))

    return F.flatten(F.transform(kids, below))


def _up(items: DataFrame, name: str) -> list[DataFrame]:
    """Block tables of all rounds; the last has one row for each key."""
    rounds = []
    while True:
        rounds.append(cut_lineage(_nest(items), name))
        if (rounds[-1].agg(F.max("n")).first()[0] or 0) <= 1:
            return rounds
        # a block is known by its number: the load is empty above the first round
        items = rounds[-1].select("key", "idx", "n", "h", F.struct("idx").alias("load"))


def _down(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """Every item of the first round with its whole path; ``top(key, path, *names)`` starts at the last."""
    names = [c for c in top.columns if c not in ("key", "path")]
    above = top.withColumn("idx", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        carried = [F.first(c, ignorenulls=True).alias(c) for c in ("n_below", "kids", "path", *names)]
        met = (blocks.select("key", "idx", "n_below", "kids")
               .unionByName(above, allowMissingColumns=True).groupBy("key", "idx").agg(*carried))
        child = F.explode(_children(F.col("kids"), F.col("n_below"))).alias("child")
        out = met.select("key", "path", *names, child).select(
            "key", "child.load", "child.h", F.concat("child.path", "path").alias("path"), *names)
        above = out.select("key", F.col("load.idx"), "path", *names) if blocks is not rounds[0] else out
    return above


def manifest(rows: DataFrame, by: str, order: str, keep: list[str]) -> DataFrame:
    """Merkle proofs of ``rows`` (with a column ``leaf``), grouped by ``by``, ascending by ``order``.

    Returns (by, order, leaf, subroot, root, path, *keep); ``path`` holds, level by
    level, the hashes left and right of the node, joined.
    """
    load = F.struct(F.col(order).alias("id"), *[F.col(c) for c in keep])
    items = cut_lineage(rows.select(F.col(by).alias("key"), F.col(order).alias("id"), F.col("leaf").alias("h"),
                                    load.alias("load")), "merkle-leaves")
    rounds = _up(_ranked(items, ["id", "h"]), "merkle-blocks")
    roots = rounds[-1].select(F.lit(0).alias("key"), "h", F.struct(F.col("key").alias("group")).alias("load"))
    group_rounds = _up(_ranked(roots.withColumn("group", F.col("load.group")), ["group"]), "merkle-groups")
    none = F.array().cast("array<struct<left:string,right:string>>")
    top = group_rounds[-1].select("key", none.alias("path"), F.col("h").alias("root"))
    groups = _down(group_rounds, top).select(F.col("load.group").alias("key"), "path", "root",
                                             F.col("h").alias("subroot"))
    done = _down(rounds, groups)
    return done.select(F.col("key").alias(by), F.col("load.id").alias(order), F.col("h").alias("leaf"),
                       "subroot", "root", "path", *[F.col(f"load.{c}").alias(c) for c in keep])


def folded(path: Column, start: Column) -> Column:
    """The root that follows from the leaf ``start`` and the siblings of ``path``."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def tamper_check(documents: DataFrame) -> DataFrame:
    """``documents`` to (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    Where crc32(doc_id as text) is divisible by 3, the check meets a text whose
    A-Z were lower-cased after the manifest was made; rows without an id are
    left as they are.
    """
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    met = F.when(crc_class(F.col("doc_id"), 3) == 0, leaf(text=lower)).otherwise(leaf())
    rows = documents.select(*FIELDS).select("lang", "doc_id", leaf().alias("leaf"), met.alias("met"))
    made = manifest(rows, "lang", "doc_id", ["met"])
    out = made.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                      folded(F.col("path"), F.col("met")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
