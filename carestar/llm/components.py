"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import stored, stored_and_any


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    In each round a node moves to the smallest among itself and its neighbours, and edges move
    with their ends; those inside one node vanish. Nodes that are hashes lose a constant share
    in each round, so there are few. All steps are joins and aggregates on narrow rows that
    combine before the shuffle; each round is written, so that none is computed twice. Where a
    node ends is read from the rounds at the end, last round first, as the last are the smallest.
    """
    a, b = F.col("a"), F.col("b")
    left, more = stored_and_any(edges.where(a != b).select("a", "b"), "edges")
    if not more:
        return left.select(a.alias("node"), a.alias("component"))
    steps = []
    while more:
        both = left.unionAll(left.select(b.alias("a"), a.alias("b")))
        step = both.groupBy(a.alias("v")).agg(F.min("b").alias("n"))
        step = stored(step.select("v", F.least("v", "n").alias("to")), "steps")
        steps.append(step)
        at_a = left.join(step.select(F.col("v").alias("a"), F.col("to").alias("a2")), "a")
        at_b = at_a.join(step.select(F.col("v").alias("b"), F.col("to").alias("b2")), "b")
        ends = at_b.where(F.col("a2") != F.col("b2"))
        left, more = stored_and_any(ends.select(F.col("a2").alias("a"), F.col("b2").alias("b")), "edges")
    # Nodes of a round are among those that the round before moved to.
    moves = steps[-1]
    for step in reversed(steps[:-1]):
        later = moves.select(F.col("v").alias("to"), F.col("to").alias("end"))
        moves = step.join(later, "to", "left").select("v", F.coalesce("end", "to").alias("to"))
    labels = moves.select(F.col("v").alias("node"), F.col("to").alias("component"))
    return stored(labels, "labels") if len(steps) > 1 else labels
