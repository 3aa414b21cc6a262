"""Connected components of a graph of links.

Links are first contracted where they lie: every partition of at most about ``LINKS`` links is
reduced by union-find to a star for each of its components. While there are several partitions
their stars are joined: labels start as the star's centre; each round takes the smallest
label among a node's neighbours and then the label of that label (pointer jumping), so the
number of rounds grows with the logarithm of the longest path. Every round is cut in the
shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut, ship

#: Links that one task contracts, about.
LINKS = 200_000


def _stars(links: DataFrame) -> DataFrame:
    """``(a, b)``: every node of a partition's links with the smallest node of its component
    within the partition."""
    ship(links.sparkSession)

    def run(batches):
        up: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while up.setdefault(root, root) != root:
                root = up[root]
            while up[x] != root:
                up[x], x = root, up[x]
            return root

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                p, q = find(a), find(b)
                if p != q:
                    up[max(p, q)] = min(p, q)
        if up:
            nodes = np.fromiter(up, np.int64, len(up))
            roots = np.fromiter((find(x) for x in list(up)), np.int64, len(up))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])

    return links.mapInArrow(run, "a long, b long")


def components(links: DataFrame, links_per_task: int = LINKS) -> DataFrame:
    """``links(a, b)`` -> ``(node, label)`` for every node with a link to another; two nodes have
    the same label (the smallest node of their component) exactly if they are connected. Links
    may repeat, point either way or from a node to itself. No link gives no row. Neighbours are
    combined before the shuffle, so a node with very many links gathers nowhere."""
    real = cut(links.select("a", "b").where("a <> b"))
    tasks = -(-real.count() // links_per_task)
    stars = _stars(real.coalesce(max(tasks, 1)))
    if tasks <= 1:
        return cut(stars.select(F.col("a").alias("node"), F.col("b").alias("label")))
    both = cut(stars.where("a <> b")
               .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                       .alias("e")).select("e.a", "e.b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        near = (both.join(labels, both["b"] == labels["node"])
                .groupBy("a").agg(F.min("label").alias("near")))
        step = (labels.join(near, labels["node"] == near["a"])
                .select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")))
        up = labels.select(F.col("node").alias("_node"), F.col("label").alias("_up"))
        new = cut(step.join(up, step["label"] == up["_node"])
                  .select("node", "was", F.least("label", "_up").alias("label")))
        changed = new.where("was <> label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
