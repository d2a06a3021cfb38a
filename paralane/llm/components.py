"""Connected components of a table of links, by alternating large and small stars."""

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paralane.session import materialize


def forest(left: np.ndarray, right: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest node that each of ``nodes`` nodes is linked with, over any number of links."""
    label = np.arange(nodes)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label = shorter
        if np.array_equal(before, label):
            break
    return label


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node it is linked with, ``root``, for nodes that are not their own root.

    ``links`` has two columns, ``a`` and ``b``, of one orderable type. Each round hangs every
    node's larger neighbours, and then its smaller ones, on the smallest it knows; rounds are few
    (they grow with the logarithm of the longest path). A round is two sums with partial sums and
    two joins, whose hot keys adaptive execution splits; each is written to the shared folder, so
    that no lineage grows and lost executors cost one step. No links: an empty result.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(large.filter("a != b").distinct())
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = materialize(small.filter("a != b").distinct())
        now = edges.agg(F.count("*"), F.count_distinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
