"""Connected components of an edge table by repeated minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, component)`` for every node that has an edge; the
    component is its smallest node.

    Each round looks up the label's own label of every neighbour. The smallest goes to
    the node and also to the node's current label, so that whole groups hook at once,
    whatever the order of the ids along a chain; then labels follow their own label
    (pointer jumping). Labels only get smaller, and rounds go on until none does. Labels
    live in written tables; only whether one changed reaches the driver. Null ends and
    loops are ignored; repeated edges are harmless; without edges the result is empty.
    """
    e = edges.select("a", "b").filter("a is not null and b is not null and a <> b")
    both = written(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    # far: the label's own label
    labels = _with_far(both.groupBy("a").agg(F.min("b").alias("m"))
                       .select(F.col("a").alias("node"), F.least("a", "m").alias("component"), F.lit(True).alias("moved")))
    while labels.filter("moved").head(1):
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("far").alias("near"))
        met = labels.join(near, labels.node == near.a).select("node", "component", "far", "near")
        hooks = met.groupBy(F.col("component").alias("root")).agg(F.min("near").alias("hook"))
        low = F.least("component", "far", "near", "hook")  # least skips nulls
        old, labels = labels, _with_far(met.join(hooks, met.node == hooks.root, "left").select(
            "node", low.alias("component"), (low < F.col("component")).alias("moved")))
        forget(old)
    forget(both)
    return labels.select("node", "component")


def _with_far(labels: DataFrame) -> DataFrame:
    jump = labels.select(F.col("node").alias("root"), F.col("component").alias("far"))
    return written(labels.join(jump, labels.component == jump.root).select("node", "component", "far", "moved"), "labels")
