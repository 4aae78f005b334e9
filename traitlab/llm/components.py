"""Connected components of an edge list by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import release_scratch, scratch_paths, scratch_table, small_enough


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (columns ``a``, ``b``).

    Each round hooks every node to the neighbour (or itself) of least hash and
    contracts the edges; hashes change with the round, so every round leaves
    about half of a component's nodes or fewer, whatever its shape. Edges and
    labels stay distributed; a hub's neighbours are combined on the map side.
    What a round leaves is written and reread: a checkpoint would also hand on
    the plan's constraints, which double with every round.
    """
    spark, before = edges.sparkSession, scratch_paths()
    edges = scratch_table(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels, turn = None, 0
    while labels is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        rank = lambda c, k=turn: F.struct(F.xxhash64(F.lit(k), c).alias("h"), F.col(c).alias("v"))
        hooks = scratch_table(
            both.groupBy("a").agg(F.min(rank("b")).alias("m"))
            .select(F.col("a").alias("node"), F.least("m", rank("a"))["v"].alias("up")), "hooks")
        side = F.broadcast(hooks) if small_enough(hooks) else hooks
        to = lambda c, side=side: side.select(F.col("node").alias(c), F.col("up").alias("up_" + c))
        labels = hooks.toDF("node", "root") if labels is None else scratch_table(
            labels.join(to("root"), "root", "left")
            .select("node", F.coalesce("up_root", "root").alias("root")), "labels")
        edges = scratch_table(
            edges.join(to("a"), "a").join(to("b"), "b")
            .select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b"))
            .where("a <> b").distinct(), "edges")
        turn += 1
    used = scratch_paths() - before
    labels = scratch_table(labels, "components")
    release_scratch(spark, used)
    return labels
