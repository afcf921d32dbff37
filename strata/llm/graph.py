"""Connected components as tables, for operators that link documents.

Labels are rows (node, label); a component's label is one of its nodes.  New links
never touch the old ones again: they are mapped to labels first, so only the graph of the labels that
they join is searched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize


def settle(parent: DataFrame, name: str = "labels") -> DataFrame:
    """Labels of a forest, from (node, label) rows in which a label may be a node with a label of its
    own: every round each node takes its label's label, until none moves."""
    label = parent
    while True:
        far = label.select(F.col("node").alias("_n"), F.col("label").alias("_far"))
        new = materialize(label.join(far, F.col("label") == F.col("_n"), "left").select(
            "node", F.coalesce("_far", "label").alias("label"), (F.col("_far") != F.col("label")).alias("_moved")), name)
        label = new.select("node", "label")
        if new.filter("_moved").isEmpty():
            return label


def smallest(links: DataFrame, name: str = "labels") -> DataFrame:
    """(node, label) of all nodes of the links (a, b): the smallest node of the component.  Every
    round hands each node the smallest label around it, then that label's label."""
    edges = materialize(links.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("near")), F.struct(F.col("b").alias("node"), F.col("a").alias("near"))))), name)
    label = materialize(edges.groupBy("node").agg(F.min("near").alias("_m")).select("node", F.least("node", "_m").alias("label")), name)
    while True:
        around = (edges.join(label.select(F.col("node").alias("near"), "label"), "near")
                  .groupBy("node").agg(F.min("label").alias("_m")))
        step = label.join(around, "node").select("node", F.col("label").alias("_old"), F.least("label", "_m").alias("_mid"))
        far = label.select(F.col("node").alias("_mid"), F.col("label").alias("_far"))
        new = materialize(step.join(far, "_mid").select("node", "_old", F.least("_mid", "_far").alias("label")), name)
        label = new.select("node", "label")
        if new.filter("label != _old").isEmpty():
            return label


def joined(label: DataFrame, links: DataFrame, name: str = "labels") -> DataFrame:
    """The labels after links (a, b) between nodes that have one."""
    ends = links.join(label.select(F.col("node").alias("a"), F.col("label").alias("_a")), "a").join(
        label.select(F.col("node").alias("b"), F.col("label").alias("_b")), "b")
    between = ends.filter("_a != _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
    root = smallest(between, name).select(F.col("node").alias("label"), F.col("label").alias("_root"))
    return materialize(label.join(root, "label", "left").select("node", F.coalesce("_root", "label").alias("label")), name)
