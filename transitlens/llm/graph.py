"""Connected components of an edge table by alternating large and small stars.

Each step replaces the edges of a vertex by edges to its smallest neighbour, so
long chains shrink fast and a hub's edges stay a plain column of rows (joins
have one row per vertex on one side; nothing is gathered per vertex).
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation, functions as F

from transitlens.llm.common import Scratch


def _star(pairs: DataFrame, least: DataFrame) -> DataFrame:
    return pairs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _star(both.filter("v > u"), least).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _star(down, least).filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, tmp: Scratch, name: str, most_rounds: int = 60) -> DataFrame:
    """(id, component): smallest reachable id for every vertex but the smallest
    of its component.  ``edges`` has long columns a and b."""
    now, state = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tmp, f"{name}-0")
    for r in range(1, most_rounds + 1):
        was = state
        now, state = _written(_small(_large(now)), tmp, f"{name}-{r}")
        tmp.drop(f"{name}-{r - 1}")
        if state == was:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _written(edges: DataFrame, tmp: Scratch, step: str) -> tuple[DataFrame, tuple]:
    """The written edges, and their number and digest, counted while they are written."""
    seen = Observation(step)
    out = tmp.write(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), step)
    return out, (seen.get["n"], seen.get["h"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges (vertex, smallest id of its component) that span the links a[i] - b[i] of one task."""
    ids, inv = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = inv[:len(a)], inv[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(len(ids)))
    return ids[at].tolist(), ids[label[at]].tolist()
