"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longspan.session import pin


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place reachable from each of ``n`` places over the links ``a[i]``-``b[i]``."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every linked node, root the smallest node it can reach.

    Alternating stars: each round hangs all neighbours of a node on the smallest one, first the larger neighbours, then the
    smaller ones, until nothing moves. The links stay a distributed table, written once a round to the shared folder. Links
    with a null end and links of a node to itself join nothing.
    """
    edges = links.select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")).where(
        F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))).distinct()
    edges = pin(edges)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("u")).agg(F.least(F.min("lo"), F.min("hi")).alias("m"))
        large = both.where("lo > hi").join(least, F.col("hi") == F.col("u")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = large.where("hi != lo").distinct()
        least = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        joined = large.join(least, F.col("hi") == F.col("u"))
        small = joined.where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
        edges = pin(small.where("hi != lo").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
