"""Connected components of an edge table, and of the few edges inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Edges per file that a round writes.
FILE_EDGES = 100_000


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long): the smallest node it reaches.

    Alternates the two star contractions (neighbours to the smallest one,
    larger ones first) until nothing changes; each round is written to shared
    storage.  Smallest neighbours are aggregated before they are joined, so no
    node's neighbours are gathered.  Loops and null ends are left out.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = staged(e, name)
    before = None
    # Rounds write as many files as the edges ask for, so that small graphs don't spend their time on tasks.
    parts = 1 + e.count() // FILE_EDGES
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
        before = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct().coalesce(parts), name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        e = staged(small.where("u <> v").distinct().coalesce(parts), name)


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0 .. n - 1 with edges i - j: the smallest node each one reaches."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[root]
        open_ = new[i] != new[j]
        root, i, j = new, i[open_], j[open_]
    return root
