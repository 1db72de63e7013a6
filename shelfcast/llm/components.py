"""Connected components of links between numbered nodes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.tables import Put


def components(links: DataFrame, put: Put) -> DataFrame:
    """``node, label`` of all nodes in ``links`` (``a, b``); the label is the smallest node reachable.

    Every round takes the smallest label among neighbours, then the label of that label.
    """
    both = put(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both-ways")
    labels = put(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        heard = both.join(labels, both["a"] == labels["node"]).groupBy("b").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, labels["node"] == heard["b"]).select("node", "label", F.least("label", "heard").alias("lower"))
        lower = put(lower, "lower-labels")
        onward = lower.select(F.col("node").alias("lower"), F.col("lower").alias("onward"))
        jumped = put(lower.join(onward, "lower").select("node", F.least("lower", "onward").alias("new"), "label"), "labels")
        labels = jumped.select("node", F.col("new").alias("label"))
        if jumped.filter("new < label").isEmpty():
            return labels


def merge(labels: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Labels after the links ``one[i] - two[i]``; a label is the smallest number of its component."""
    while True:
        low, high = np.minimum(labels[one], labels[two]), np.maximum(labels[one], labels[two])
        apart = low < high
        if not apart.any():
            return labels
        one, two = one[apart], two[apart]
        parent = np.arange(len(labels))
        np.minimum.at(parent, high[apart], low[apart])
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        labels = parent[labels]
