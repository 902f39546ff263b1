"""Connected components of a distributed link table, without gathering links anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Links up to this count (16 bytes each) fit into one task of any executor; more take distributed rounds.
ONE_TASK = 500_000


def least_labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the nodes that aren't the least: labels sink along links, then jump."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (label[a], label[b], a, b):
            np.minimum.at(new, side, low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """One large-star or small-star step over links (u, v)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not larger_only:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if larger_only:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(u, v): for each node of links (u, v; longs) but the least of its component, that least node.

    Up to ``one_task`` links, counted first, are labelled in one task on an executor. More alternate
    large-star and small-star steps until the links are stars; each round is written to the shared
    folder, so lineage stays short and a lost executor costs one round.
    """
    links = written(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def label(batches):
        tables = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        if tables:
            u, v = (np.concatenate([t[i] for t in tables]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in least_labels(u, v)], names=["u", "v"])

    if links.count() <= one_task:
        return written(links.coalesce(1).mapInArrow(label, "u long, v long"))
    mark = None
    while True:
        links = written(_star(_star(links, True), False))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            return links
        mark = now
