"""Connected components as joins and grouped minima, without collecting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchpulse.llm.tables import done_with, written


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)``; the component
    is its smallest node.

    Each round every node takes the smallest label among its neighbours' and
    its own (grouped minima are combined before the shuffle, so a node with
    many neighbours costs one row for each task), then the label of its
    label, until nothing changes.  The result is a written table, which
    ``done_with`` removes.
    """
    edges = edges.where(F.col("a") != F.col("b"))
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        stepped = labels.select("node", "label").join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = written(
            stepped.join(jump, "label", "left").select("node", F.coalesce(F.least("label", "next"), "label").alias("label"), "was"), "labels"
        )
        changed = new.where(F.col("label") != F.col("was")).limit(1).count()
        done_with(labels)
        if not changed:
            done_with(both)
            out = new.select("node", F.col("label").alias("component"))
            out.written_to = new.written_to
            return out
        labels = new
