"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.llm.common import discard, materialize


def _ends(step: DataFrame) -> DataFrame:
    """Follows (u, to), where every ``to`` is some row's u and not above its own, to the last: each round doubles the way, so a chain of n takes log n."""
    while True:
        far = step.select(F.col("u").alias("to"), F.col("to").alias("far"))
        jumped = materialize(step.join(far, "to").select("u", F.col("far").alias("to"), (F.col("far") < F.col("to")).alias("moved")), "jump")
        discard(step)
        step = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return step


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (u, v): root is the least node of its component.

    Each round points a node to the least of itself and its neighbours, follows these pointers to their ends, and contracts the edges to
    those. At most half of the nodes are ends, so the rounds are logarithmic in the number of nodes, as are the steps of one. It ends when no
    edge is left. Grouped minima combine before the shuffle."""
    left = materialize(edges.where("u <> v").select("u", "v").distinct(), "edges")
    roots = materialize(left.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = _ends(materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("to")), "step"))
        to = step.withColumnRenamed("u", "root")
        new_roots = materialize(roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
        a, b = step.select("u", F.col("to").alias("a")), step.select(F.col("u").alias("v"), F.col("to").alias("b"))
        new_left = materialize(left.join(a, "u").join(b, "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        for old in (left, roots, step):
            discard(old)
        left, roots = new_left, new_roots
    return roots
