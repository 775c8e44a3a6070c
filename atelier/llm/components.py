"""Connected components of an edge table, by least labels and pointer jumping.

Every round is a written table; nothing of the graph reaches the driver but the number of labels that changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label: the least node of its component."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.table(both.filter("a is not null and b is not null and a <> b").distinct(), f"{name}-edges")
    labels = scratch.table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m")).select("node", F.least("node", "_m").alias("label")), f"{name}-0")
    done = 0
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_m"))
        low = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_m").alias("_low"))
        over = labels.select(F.col("node").alias("_low"), F.col("label").alias("_up"))
        done += 1
        labels = scratch.table(low.join(over, "_low", "left").select("node", "_old", F.least("_low", F.coalesce("_up", "_low")).alias("label")), f"{name}-{done}")
        changed = labels.filter("label <> _old").limit(1).count()
        labels = labels.select("node", "label")
        if not changed:
            return labels


def extended(scratch: Scratch, labels: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``labels`` after further edges: the edges are drawn between components, so only what they join is walked again."""
    of = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"l{x}"))
    drawn = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
    drawn = scratch.table(drawn, f"{name}-drawn")
    up = components(scratch, drawn.filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")), name)
    fresh = drawn.select(F.col("a").alias("node"), F.col("la").alias("label")).union(drawn.select("b", "lb")).distinct()
    every = labels.unionByName(fresh.join(labels.select("node"), "node", "left_anti"))
    moved = every.join(up.select(F.col("node").alias("label"), F.col("label").alias("_up")), "label", "left")
    return scratch.table(moved.select("node", F.coalesce("_up", "label").alias("label")), f"{name}-labels")
