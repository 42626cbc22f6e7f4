"""Connected components of a link table, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm.store import discard, materialize


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``: root is the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours, then the label's own label (so a chain's length
    halves), and is written to the shared folder; it ends when no label changes. No rows for no links.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "edges")
    label = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "labels")
    for _ in range(most_rounds):
        seen = both.join(label, both.b == label.node).select(F.col("a").alias("node"), "root")
        near = label.select("node", "root").union(seen).groupBy("node").agg(F.min("root").alias("root"))
        jump = label.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = near.join(jump, "root").select("node", F.least("root", "next").alias("root"))
        new = materialize(new, "labels")
        changed = new.join(label.withColumnRenamed("root", "was"), "node").where("root <> was").limit(1).count()
        discard(label)
        label = new
        if not changed:
            discard(both)
            return label
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
