"""Connected components of very large link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import discard, scope, stored


def connected_components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node can reach: node, component.

    ``links`` has the columns ``a`` and ``b``, in either direction; a link of a node with
    itself, or without one of its ends, links nothing, and without links there are no rows.
    Every round gives each node the smallest parent it sees through its links, hooks its old
    parent below that one, and halves the way up. Rounds grow with the logarithm of the
    longest chain. Each round is a stored table, which the next one replaces. Small values
    meet in the map tasks, and the joins are between a node and its links or its parent: a
    node with very many children is split by the planner.
    """
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "links")
    lowest = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("parent"))
    with scope() as made:
        parents = stored(lowest, "parents")
        before, made[:] = made[:], []
    while True:
        with scope() as made:
            parents = _next_parents(both, parents)
            done = parents.filter("parent < old").isEmpty()
            # Of the rounds, only the result of this one is still read.
            before += made[:-1]
            del made[:-1]
            discard(before)
            if not done:
                before, made[:] = made[:], []
        if done:
            return parents.select("node", F.col("parent").alias("component"))
        parents = parents.drop("old")


def _next_parents(both: DataFrame, parents: DataFrame) -> DataFrame:
    """One round, stored: node, parent, and the parent before it (old)."""
    above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("upper"))
    raised = stored(parents.join(above, "parent").select("node", "parent", "upper"), "raised")
    seen = (
        both.join(raised.select(F.col("node").alias("b"), "upper"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.min("upper").alias("seen"))
    )
    lowest = F.least("upper", "seen")
    offers = F.array(
        F.struct("node", lowest.alias("offer"), F.col("parent").alias("old")),
        F.struct(
            F.col("parent").alias("node"),
            lowest.alias("offer"),
            F.lit(None).cast("long").alias("old"),
        ),
    )
    return stored(
        raised.join(seen, "node")
        .select(F.inline(offers))
        .groupBy("node")
        .agg(F.min("offer").alias("parent"), F.max("old").alias("old")),
        "parents",
    )
