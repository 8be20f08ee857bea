"""Connected components by hooking, pointer doubling and contraction, one written table a step."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, tabled

#: Links, of 16 bytes, that one task may join; it is their count that says so.
FEW = 1 << 19


def _joined(batches):
    """(a, p): for each end of a link the smallest node that it reaches."""
    parts = [np.stack([x.column(i).to_numpy() for i in range(2)]) for x in batches]
    if not parts:
        return
    ends = np.concatenate(parts, 1)
    nodes, at = np.unique(ends, return_inverse=True)
    a, b = at.reshape(ends.shape)
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (root != root[root]).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["a", "p"])


def components(links: DataFrame, few: int = FEW) -> DataFrame:
    """(node, label) for each end of a link (a, b); ends that reach each other share the label.

    Each turn hooks a node to its smallest neighbour, follows the hooks twice, and contracts the links; the links
    that remain shrink, and once they are few one task joins them. Hubs are aggregated map-side, and no component of
    more links than that is ever gathered in one place. The result is a table of its own, which the caller may discard.
    """
    pair = F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = materialise(links.where("a <> b").select(pair.alias("x")).select("x.*").distinct(), "links")
    labels = None
    while n := left.count():
        if n <= few:
            hook, moved = left.repartition(1).mapInArrow(_joined, "a bigint, p bigint"), left.limit(0)
            hook = materialise(hook, "hooks")
        else:
            both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
            hook = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p"))
            for _ in range(2):
                onto = hook.select(F.col("a").alias("p"), F.col("p").alias("pp"))
                hook = hook.join(onto, "p").select("a", F.col("pp").alias("p"))
            hook = materialise(hook, "hooks")
            to_a, to_b = hook.select("a", F.col("p").alias("pa")), hook.select(F.col("a").alias("b"), F.col("p").alias("pb"))
            moved = left.join(to_a, "a").join(to_b, "b").where("pa <> pb")
            moved = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        old, left = left, materialise(moved, "links")
        discard(old)
        if labels is None:  # the first hooks are the first labels
            labels = tabled(hook.select(F.col("a").alias("node"), F.col("p").alias("label")), hook._strandloom_path)
        else:
            onto = hook.select(F.col("a").alias("label"), "p")
            old, labels = labels, materialise(labels.join(onto, "label", "left").select("node", F.coalesce("p", "label").alias("label")), "labels")
            discard(old, hook)
    return tabled(left.select(F.col("a").alias("node"), F.col("b").alias("label")), left._strandloom_path) if labels is None else labels
