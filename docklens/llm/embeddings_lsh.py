"""Near-duplicate vectors by p-stable hashing.

Normalised vectors within a distance c of each other fall into the same cell of a random
projection cut into widths w with a known chance, so vectors that agree in all
``projections`` of one of several ``tables`` are compared by exact cosine in double
precision. At cosine 0.98 (distance 0.2) and width 2 one projection agrees with a chance
of 0.92, a table of 16 with 0.26, and 32 tables miss a pair with 6e-5.

Equal vectors of one label are one class with a count, so copies never meet. A pair of
classes that shares several tables counts in the first of them only: every row carries
its cells of all tables. Buckets are compared inside a task by shifting the sorted rows
against themselves; a bucket larger than ``chunk`` is dealt in pairs of chunks to many
tasks. A task returns one row for each vector: its links and the smallest vector it
reaches there; no pair leaves it.

Cases: vectors that are null, empty or zero, that hold null or non-finite components, or
that have no label link with nothing; vectors of different lengths are not compared; rows
that repeat an id, or have none, are rows of their own, with their own vector; null ids are
larger than others, and a component of such rows alone has none; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.llm.components import connected, forest
from docklens.llm.storage import stored
from docklens.llm.words import mix


@dataclass(frozen=True)
class Search:
    cosine: float = 0.98
    tables: int = 32
    projections: int = 16
    width: float = 2.0
    seed: int = 11
    chunk: int = 1024


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector in double precision; None for one that cannot be compared."""
    out: list[np.ndarray | None] = []
    for one in column:
        if not one.is_valid or one.values is None or one.values.null_count or not len(one.values):
            out.append(None)
            continue
        x = one.values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(x if np.isfinite(x).all() and x.any() else None)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=-1, keepdims=True)  # squares of extreme components stay finite
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


def _cells(units: np.ndarray, search: Search) -> np.ndarray:
    """(vectors, tables): a 32-bit key of the cell in each table."""
    random = np.random.default_rng([search.seed, units.shape[1]])
    total = search.tables * search.projections
    along = random.standard_normal((units.shape[1], total))
    shift = random.uniform(0, search.width, total)
    cell = np.floor((units @ along + shift) / search.width).astype(np.int64).view(np.uint64)
    cell = cell.reshape(len(units), search.tables, search.projections)
    key = np.zeros(cell.shape[:2], np.uint64)
    for k in range(search.projections):
        key = mix(key + cell[:, :, k] + np.uint64(k + 1))
    return (key >> np.uint64(32)).astype(np.uint32)


def _hashed(search: Search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("vector"))
            units: list[bytes | None] = [None] * len(vectors)
            cells: list[bytes | None] = [None] * len(vectors)
            sizes = {len(v) for v in vectors if v is not None}
            for size in sizes:
                at = [k for k, v in enumerate(vectors) if v is not None and len(v) == size]
                unit = _unit(np.stack([vectors[k] for k in at]))
                for k, u, c in zip(at, unit, _cells(unit, search)):
                    units[k], cells[k] = u.tobytes(), c.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([0 if v is None else len(v) for v in vectors], pa.int32()),
                    pa.array(units, pa.binary()),
                    pa.array(cells, pa.binary()),
                ],
                ["id", "label", "size", "unit", "cells"],
            )

    return run


_KEYS = ["label", "size", "bucket", "lo", "hi"]


def _groups(rows: pa.RecordBatch) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    for c in _KEYS:
        x = rows.column(c)
        text = pa.types.is_string(x.type)
        x = np.array(x.to_pylist(), object) if text else x.to_numpy(zero_copy_only=False)
        new[1:] |= x[1:] != x[:-1]
    return np.cumsum(new)


def _links(search: Search):
    """(id, links, root): links of each vector found in the task's buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            group = _groups(rows)
            done = int(np.searchsorted(group, group[-1])) if len(group) else 0
            yield from compare(rows.slice(0, done), group[:done])
            held = rows.slice(done)
        if held is not None:
            yield from compare(held, _groups(held))

    def compare(rows: pa.RecordBatch, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = rows.num_rows
        if n < 2:
            return
        ids, copies, table, side, lo, hi, size = (
            rows.column(c).to_numpy(zero_copy_only=False)
            for c in ("id", "copies", "table", "side", "lo", "hi", "size")
        )
        own = lo == hi
        cells = np.frombuffer(b"".join(rows.column("cells").to_pylist()), np.uint32)
        cells = cells.reshape(n, search.tables)
        units = rows.column("unit").to_pylist()
        flat = np.frombuffer(b"".join(units), np.float64)
        begin = np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)])
        links = np.zeros(n, np.int64)
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        names, root = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for apart in range(1, int(np.bincount(group).max())):
            i = np.flatnonzero(group[:-apart] == group[apart:])
            j = i + apart
            keep = own[i] | (side[i] != side[j])
            i, j = i[keep], j[keep]
            for part in range(0, len(i), 16384):
                p, q = i[part : part + 16384], j[part : part + 16384]
                # of the tables in which both share a cell the first counts
                first = (cells[p] == cells[q]).argmax(axis=1) == table[p]
                p, q = p[first], q[first]
                cosine = np.empty(len(p))
                for d in np.unique(size[p]).tolist():
                    of = np.flatnonzero(size[p] == d)
                    x = flat[begin[p[of]][:, None] + np.arange(d)]
                    y = flat[begin[q[of]][:, None] + np.arange(d)]
                    cosine[of] = np.einsum("ij,ij->i", x, y)
                near = cosine >= search.cosine
                p, q = p[near], q[near]
                if len(p):
                    np.add.at(links, p, copies[q])
                    np.add.at(links, q, copies[p])
                    ends.append((ids[p], ids[q]))
            if sum(len(a) for a, _ in ends) > 200_000:
                names, root = forest(
                    np.concatenate([names, *(a for a, _ in ends)]),
                    np.concatenate([root, *(b for _, b in ends)]),
                )
                ends = []
        if ends:
            names, root = forest(
                np.concatenate([names, *(a for a, _ in ends)]),
                np.concatenate([root, *(b for _, b in ends)]),
            )
        if not len(names):
            return
        vectors, at = np.unique(ids, return_inverse=True)
        total = np.zeros(len(vectors), np.int64)
        np.add.at(total, at, links)
        reached = vectors.copy()
        reached[np.searchsorted(vectors, names)] = root
        some = (total > 0) | (reached != vectors)
        yield pa.RecordBatch.from_arrays(
            [pa.array(vectors[some]), pa.array(total[some]), pa.array(reached[some])],
            ["id", "links", "root"],
        )

    return run


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    search: Search = Search(),
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors are compared only within equal labels. ``n_links`` counts the other rows
    linked directly, copies included; ``component_id`` is the smallest id reachable;
    ``kept`` marks one row of each component, one with that id.
    """
    read = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    hashed = read.mapInArrow(
        _hashed(search), "id long, label string, size int, unit binary, cells binary"
    ).withColumnRenamed("id", "own_id")
    hashed = hashed.withColumns(
        {"digest": F.sha2("unit", 256), "row": F.monotonically_increasing_id()}
    )
    hashed = stored(hashed, "hashed")  # from here on ``row`` names a row, and is fixed
    able = hashed.where("unit is not null and label is not null")
    # a class is named by the row that would be kept of it: the smallest id, null ones last
    first_row = F.struct(F.col("own_id").isNull().alias("none"), "own_id", "row")
    classes = stored(
        able.groupBy("label", "size", "digest")
        .agg(F.min(first_row).alias("least"), F.count("*").alias("copies"))
        .withColumn("rep", F.col("least.row")),
        "vector-classes",
    )
    reps = able.select(F.col("row").alias("id"), "label", "size", "unit", "cells").join(
        classes.select(F.col("rep").alias("id"), "copies"), "id"
    )
    reps = stored(reps, "vector-reps")

    tables = F.explode(F.sequence(F.lit(0), F.lit(search.tables - 1)))
    members = reps.select("id", "label", "size", "cells", tables.alias("table")).select(
        "id", "label", "size", "table",
        F.conv(F.hex(F.substring(F.col("cells"), F.col("table") * 4 + 1, F.lit(4))), 16, 10)
        .cast("long").alias("cell"),
    ).withColumn("bucket", F.shiftleft(F.col("table").cast("long"), 32) + F.col("cell"))
    crowds = (
        members.groupBy("label", "size", "bucket")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("label", "size", "bucket", F.ceil(F.col("n") / search.chunk).cast("int").alias("chunks"))
    )
    rows = (
        members.join(crowds, ["label", "size", "bucket"])
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "id", "bucket", "table", "side",
            F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"),
        )
        .join(reps, "id")
    )
    found = stored(
        rows.repartition(*_KEYS)
        .sortWithinPartitions(*_KEYS)
        .mapInArrow(_links(search), "id long, links long, root long"),
        "vector-links",
    )
    parts = stored(connected(found, "id", "root"), "vector-parts")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    of_class = stored(
        classes.join(links.withColumnRenamed("id", "rep"), "rep", "left")
        .join(parts.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "label", "size", "digest", "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "rep").alias("part"),
        ),
        "vector-of-class",
    )
    keeper = of_class.groupBy("part").agg(F.min("least").alias("keeper"))
    of_class = of_class.join(keeper, "part").select(
        "label", "size", "digest", "n_links", "keeper"
    )
    alone = F.col("keeper").isNull()
    return (
        hashed.select("own_id", "row", "label", "size", "digest")
        .join(of_class, ["label", "size", "digest"], "left")
        .select(
            F.col("own_id").alias("vec_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(alone, F.col("own_id")).otherwise(F.col("keeper.own_id")).alias("component_id"),
            (alone | (F.col("keeper.row") == F.col("row"))).alias("kept"),
        )
    )
