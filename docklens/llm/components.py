"""Connected components of an undirected graph given by its edges.

Union-find runs inside each task first, so that at most one edge for each vertex of the
task goes on. The forests of the tasks are joined by alternating large-star and small-star
steps (every vertex hands its neighbours to the smallest vertex it knows), which need a
few rounds for any number of tasks. Each round is written to the shared folder. A vertex
with very many neighbours is one row on one side of each join; Spark splits the other side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.llm.storage import dropped, stored


def forest(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, smallest vertex reached) of the edges, by union-find."""
    names, at = np.unique(np.concatenate([low, high]), return_inverse=True)
    parent = list(range(len(names)))

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    n = len(low)
    for a, b in zip(at[:n].tolist(), at[n:].tolist()):
        a, b = find(a), find(b)
        if a != b:  # names are in order: the smaller place is the smaller vertex
            parent[max(a, b)] = min(a, b)
    root = np.array([find(v) for v in range(len(parent))], dtype=np.int64)
    return names, names[root] if len(names) else names


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        names, root = forest(
            np.concatenate([low, batch.column(0).to_numpy(zero_copy_only=False)]),
            np.concatenate([high, batch.column(1).to_numpy(zero_copy_only=False)]),
        )
        high, low = names[names != root], root[names != root]
    for first in range(0, len(low), 100_000):
        part = slice(first, first + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(high[part]), pa.array(low[part])], ["u", "v"])


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) of every vertex of ``edges``; the id is the smallest vertex.

    Edges with a null end and loops count for nothing: a vertex that has no other edge is
    not in the result. Repeated edges and either direction count once.
    """
    pairs = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(
            F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")
        )
    )
    star = stored(pairs.mapInArrow(_local, "u long, v long"), "forest")
    seen = _mark(star)
    while seen[0]:
        both = star.union(star.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = stored(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .union(least)
            .distinct()
        )
        after = stored(small, "small")
        dropped(star)
        dropped(large)
        star, before = after, seen
        seen = _mark(star)
        if seen == before:
            break
    return star.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        star.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    )
