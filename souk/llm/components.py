"""Connected components of an edge table, by hooking and contraction.

Every round each component hooks onto its smallest neighbour, chains of hooks are
followed to their ends by pointer jumping, and the edges are renamed and deduplicated.
At least half of the components that still have an edge vanish each round. All joins
are by a component's name; smallest neighbours are partial aggregates, so a component
with a third of all edges is no single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.plans.tables import materialize


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for each node of ``edges`` (a, b): its smallest reachable node.

    Loops and repeated edges are allowed; a node with a loop only is its own component.
    An edge with a NULL end is ignored. No edges give no rows. Runs jobs.
    """
    edges = edges.select("a", "b").dropna()
    labels = None
    current = materialize(_both_ways(edges))
    while not current.isEmpty():
        # The smallest of oneself and one's neighbours; roots point at themselves.
        hooks = materialize(current.groupBy("a").agg(
            F.least(F.col("a"), F.min("b")).alias("to")
        ).withColumnRenamed("a", "from"))
        hooks = _jump(hooks)
        if labels is None:
            labels = hooks.select(F.col("from").alias("node"), F.col("to").alias("component"))
        else:
            labels = labels.join(hooks, F.col("component") == F.col("from"), "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
        labels = materialize(labels)
        left = hooks.select(F.col("from").alias("a"), F.col("to").alias("new_a"))
        right = hooks.select(F.col("from").alias("b"), F.col("to").alias("new_b"))
        renamed = current.join(left, "a").join(right, "b").filter("new_a != new_b").select(
            F.col("new_a").alias("a"), F.col("new_b").alias("b")
        )
        current = materialize(renamed.distinct())
    loops = edges.filter("a = b").select(F.col("a").alias("node")).distinct()
    if labels is None:
        return loops.select("node", F.col("node").alias("component"))
    alone = loops.join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    return labels.unionByName(alone)


def _both_ways(edges: DataFrame) -> DataFrame:
    edges = edges.filter("a != b")
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _jump(hooks: DataFrame) -> DataFrame:
    """``hooks`` (from, to) with each ``to`` replaced by the end of its chain."""
    while True:
        onward = hooks.filter("from != to").select(
            F.col("from").alias("via"), F.col("to").alias("end")
        )
        moved = hooks.join(onward, F.col("to") == F.col("via"), "left")
        if moved.filter("via IS NOT NULL").isEmpty():
            return hooks
        hooks = materialize(moved.select("from", F.coalesce("end", "to").alias("to")))
