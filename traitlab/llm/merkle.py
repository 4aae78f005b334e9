"""Merkle manifest of a table: a digest tree per group, one tree over the groups.

A leaf is the SHA-256 of a row's fields. Leaves are numbered within their group
by a range sort of the digests alone; each aligned block of ``ARITY ** HEIGHT``
of them is one row, which keeps every level as one hex string: fixed-width
substrings of a level hash to the level above it, and the substrings on both
sides of a node in its run are the siblings that its proof needs. The tops of
a group's blocks are the nodes of the next round, so a group of any size takes
``log(rows) / log(729)`` rounds and no task holds more than a block. The roots
of the groups are the leaves of one more tree, built the same way.

Every round's blocks are written to the shared folder, so a lost executor costs
its own tasks only and all readers see the same numbering.

Defined results: a null field counts as ``-`` and differs from an empty one; a
null group is a group and comes first; equal order keys are ordered by leaf,
rows equal in both are alike; a group of one row has its leaf as root; no rows
give no rows; columns are carried as named by the caller, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpoint_dir
from .common import broadcast_if_small, scratch_table

ARITY = 3
HEIGHT = 6
BLOCK = ARITY ** HEIGHT
HEX = 64
PATH = "array<struct<left:string,right:string>>"


def digest(*fields: Column) -> Column:
    """Hex SHA-256 of fields, each ``-`` when null, else its bytes, ``:``, value."""
    def framed(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*map(framed, fields)), 256)


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (with ``grp``) and, per group, ``pos`` by ``order`` and the size ``n``."""
    checkpoint_dir(rows.sparkSession)
    # rows equal in the whole order are alike, the last key only spreads them
    order = [F.col("grp"), *order, F.col("near")]
    rows = rows.withColumn("near", F.monotonically_increasing_id())
    ranged = scratch_table(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("near")
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()),
        "merkle-order")
    held = ranged.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("part", "grp", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("held").over(whole).alias("n")).checkpoint()
    return (ranged.join(broadcast_if_small(starts, "grp.name"), ["part", "grp"])
            .withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def _piece(level: Column, first: Column, nodes: Column) -> Column:
    """``nodes`` digests of a level from number ``first`` on, as far as it goes."""
    return level.substr((first * HEX + 1).cast("int"), (nodes * HEX).cast("int"))


def _parents(level: Column) -> Column:
    """The level above a level: the digests of its runs."""
    runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / (ARITY * HEX)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda run: F.sha2(_piece(level, run * ARITY, F.lit(ARITY)), 256)),
                        "").cast("binary")


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """One row per aligned block of (grp, n, pos, digest, carried columns): its
    ``members``, its ``levels`` from the digests up, and its ``top``."""
    member = F.struct("pos", "digest", *carried)
    rows = (nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block"))
            .agg(F.sort_array(F.collect_list(member)).alias("members"), F.first("n").alias("n")))
    # as bytes, a substring is found without walking over what is before it
    rows = rows.withColumn("levels", F.array(F.array_join("members.digest", "").cast("binary")))
    rows = rows.withColumn("members", F.transform("members", lambda m: m.dropFields("digest")))
    for height in range(HEIGHT):
        above = _parents(F.element_at("levels", -1))
        # a group that ends below this height already has its root
        grows = F.col("n") > ARITY ** height
        rows = rows.withColumn("levels", F.when(grows, F.concat("levels", F.array(above))).otherwise(F.col("levels")))
    return rows.withColumn("top", F.element_at("levels", -1).cast("string"))


def _climb(nodes: DataFrame, carried: list[str]) -> list[DataFrame]:
    """Blocks of every round, lowest first; ``n`` is the round's node count of the group."""
    rounds = [scratch_table(_blocks(nodes, carried), "merkle-blocks")]
    while not (more := rounds[-1].where(F.col("n") > BLOCK)).isEmpty():
        nodes = more.select("grp", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("pos"),
                            F.col("top").alias("digest"))
        rounds.append(scratch_table(_blocks(nodes, []), "merkle-blocks"))
    return rounds


def _roots(rounds: list[DataFrame]) -> DataFrame:
    ended = [r.where(F.col("n") <= BLOCK).select("grp", "top") for r in rounds]
    out = ended[0]
    for r in ended[1:]:
        out = out.union(r)
    return out


def _steps() -> Column:
    """The siblings of member ``m.pos`` on each of its block's levels."""
    at = F.col("m.pos") % BLOCK

    def step(level: Column, height: Column) -> Column:
        own = F.floor(at / F.pow(F.lit(ARITY), height))
        run = own - own % ARITY
        return F.struct(_piece(level, run, own - run).cast("string").alias("left"),
                        _piece(level, own + 1, run + ARITY - 1 - own).cast("string").alias("right"))

    return F.transform(F.slice("levels", 1, F.size("levels") - 1), step)


def _descend(rounds: list[DataFrame], base: DataFrame, carried: list[str]) -> DataFrame:
    """Members of the lowest round with the ``path`` of siblings to the root.

    ``base`` has, per group, the columns that its members take over and the
    ``path`` above the group.
    """
    taken = [c for c in base.columns if c not in ("grp", "path")]
    above = None
    for number, blocks in reversed(list(enumerate(rounds))):
        ended = blocks.where(F.col("n") <= BLOCK).join(base, "grp")
        if above is not None:
            ended = ended.unionByName(blocks.where(F.col("n") > BLOCK).join(above, ["grp", "block"]))
        members = ended.withColumn("m", F.explode("members")).withColumn(
            "path", F.concat(_steps(), F.col("path")))
        if number:
            above = members.select("grp", F.col("m.pos").alias("block"), "path", *taken)
    first = F.element_at("levels", 1)
    return members.select(*[F.col("m")[c].alias(c) for c in carried],
                          _piece(first, F.col("m.pos") % BLOCK, F.lit(1)).cast("string").alias("leaf"), "path", *taken)


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along a path of siblings."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(rows: DataFrame, leaf: Column, group: str, order: str, carried: list[str]) -> DataFrame:
    """Per row the ``carried`` columns, ``leaf``, ``subroot`` (its group's),
    ``root`` and ``path``.

    ``leaf`` is the digest of a row; ``path`` has one (left, right) pair of
    sibling strings per level, for :func:`fold`.
    """
    name = F.col(group).cast("string")
    grp = F.struct(name.isNotNull().alias("set"), F.coalesce(name, F.lit("")).alias("name"))
    row = F.struct(*[F.col(c) for c in carried]) if carried else F.lit(None)
    nodes = _numbered(rows.select(F.col(order).alias("ord"), row.alias("row"), grp.alias("grp"), leaf.alias("digest")),
                      [F.col("ord"), F.col("digest")]).drop("ord")
    lower = _climb(nodes, ["row"])
    subroots = _roots(lower).select(F.col("grp").alias("key"), F.col("top").alias("digest"))
    nodes = _numbered(subroots.withColumn("grp", F.struct(F.lit(True).alias("set"), F.lit("").alias("name"))),
                      [F.col("key")])
    upper = _climb(nodes, ["key"])
    base = _roots(upper).select("grp", F.col("top").alias("root"), F.array().cast(PATH).alias("path"))
    groups = _descend(upper, base, ["key"]).select(F.col("key").alias("grp"), F.col("leaf").alias("subroot"),
                                                   "root", "path")
    out = _descend(lower, scratch_table(groups, "merkle-groups"), ["row"])
    return out.select(*[F.col("row")[c].alias(c) for c in carried], "leaf", "subroot", "root", "path")
