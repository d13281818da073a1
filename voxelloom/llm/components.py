"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, materialize


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same components as all pairs (a, b), at most one for each node."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right, label = where[: len(a)], where[len(a) :], np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of `links`; component is the smallest node that links reach.

    Nulls and self-links are ignored; repeated links count once; without links the
    result is empty. Each round is two aggregations and two joins over the links
    (Kiveris et al., 2014), written to the shared folder; rounds grow with the
    logarithm of the longest chain. Minima are pre-aggregated, and a hub's joined
    rows can be split by adaptive execution, so a hub needs no task of its own.
    """
    pairs = (
        links.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .distinct()
    )
    current = materialize(pairs, "links")
    before = _fingerprint(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        after_table = materialize(small, "links")
        after = _fingerprint(after_table)
        drop(current)
        current = after_table
        if after == before:
            break
        before = after
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
