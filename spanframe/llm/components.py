"""Connected components of a graph whose edges are a DataFrame.

Alternates large-star and small-star rounds (Kiveris et al., 2014) until the
edges no longer change; each round is written to the shared folder. Nothing is
gathered per component: a star of any size is only ever an aggregate of its
minimum and a join back.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import written


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """edges: (a, b) bigint. Returns (node, component): every node of an edge, with the smallest node reachable.

    Loops and repeated edges do no harm; no edges give no rows.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(ordered, label)
    state = _print(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # aggregates are written first: in the stage of a join they would keep Spark from splitting the edges of a big star
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), label)
        # large star: neighbours above a node go to the least of its neighbourhood
        large = written(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), label)
        # small star: a node and its neighbours below it go to the least of them
        below = written(large.groupBy("a").agg(F.min("b").alias("m")), label)
        moved = large.join(below, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = written(moved.unionByName(below.withColumnRenamed("m", "b")).distinct(), label)
        after = _print(new)
        now, before, state = new, state, after
        if after == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what the edges (a, b) between 0 and n - 1 connect: below n of them, however many came."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        left = low != high
        if not left.any():
            break
        a, b = low[left], high[left]
        np.minimum.at(root, b, a)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    node = np.flatnonzero(root != np.arange(n))
    return node, root[node]
