"""Merkle manifest of a dataset: a hash tree for each group of rows, one over the groups, and
for every row the siblings that prove it.

Rows of a group are numbered in order; every ``FAN`` consecutive nodes become the hash of their
joined digests, until one is left (a lone node is not hashed again). Per level, lag and lead
at the fixed offsets of that level, masked by the slot of a node in its run and by the end of
the group, give the digests of its siblings; the rows of first children hash the parents.

The windows run within spans of ``FAN ** LEVELS`` rows, which hold whole runs of so many levels:
one shuffle serves all of them, and no task holds a group. The roots of the spans are the rows
of the next layer, smaller by that factor, and the paths of the layers are joined from the top
down by (group, span). Places come from a sort by ranges of (group, order), so a group with most
rows lies in many tasks, too.

Cases: a null value counts as ``-``, a null group is a group of its own and comes first; rows of
a group stand in the order of the id (null first), then of the digest, and repeated rows are
leaves of their own; an empty table gives an empty result; columns that are not asked for are
not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docklens.llm.storage import stored

FAN = 3
#: levels that one span of a group holds
LEVELS = 7
SPAN = FAN**LEVELS


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the joined texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of the values, each as byte count, ``:`` and text, or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return digest(
        *(
            F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
            for t in texts
        )
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored ``rows`` with ``place`` (0, 1, ... in its ``key``) and ``size`` (rows of the key)."""
    by = [F.col(c).asc_nulls_first() for c in ("key", *order, "_tie")]
    sorted_rows = stored(
        rows.withColumn("_tie", F.monotonically_increasing_id())  # parts equal rows, too
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()),
        "sorted",
    ).withColumn("_part", F.shiftright("_at", 33))
    of_key = Window.partitionBy("key")
    runs = (
        sorted_rows.groupBy("key", "_part")
        .agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_before", F.sum("_n").over(of_key.orderBy("_part")) - F.col("_n"))
        .withColumn("size", F.sum("_n").over(of_key))
        .drop("_n")
    )
    return (
        sorted_rows.join(runs, ["key", "_part"])
        .withColumn("place", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_at", "_part", "_first", "_before")
    )


def _levels(rows: DataFrame) -> DataFrame:
    """``rows`` with ``span``, ``path`` (siblings within the span) and, on its first row, ``top``."""
    place, size = F.col("place"), F.col("size")
    rows = rows.withColumn("span", F.floor(place / SPAN)).withColumn("_h", F.col("hash"))
    window = Window.partitionBy("key", "span").orderBy("place")
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(LEVELS):
        step = FAN**level
        slot = F.floor(place / step) % FAN
        before = [
            F.when(slot >= k, F.lag("_h", k * step).over(window)) for k in range(FAN - 1, 0, -1)
        ]
        after = [F.when(slot + k < FAN, F.lead("_h", k * step).over(window)) for k in range(1, FAN)]
        goes_on = size > step
        rows = (
            rows.withColumn("_l", F.concat_ws("", *before))
            .withColumn("_r", F.concat_ws("", *after))
            .withColumn(
                "_s",
                F.when(
                    goes_on & (place % step == 0),
                    F.struct(F.col("_l").alias("left"), F.col("_r").alias("right")),
                ),
            )
            # the descendants of a node follow its first row
            .withColumn(f"_p{level}", F.last("_s", ignorenulls=True).over(so_far))
            .withColumn(
                "_h",
                F.when(
                    place % (step * FAN) == 0,
                    F.when(goes_on, digest(F.col("_h"), F.col("_r"))).otherwise(F.col("_h")),
                ),
            )
        )
    siblings = F.array(*(f"_p{level}" for level in range(LEVELS)))
    return (
        rows.withColumn("path", F.filter(siblings, lambda s: s.isNotNull()))
        .withColumnRenamed("_h", "top")
        .drop("_l", "_r", "_s", *(f"_p{level}" for level in range(LEVELS)))
    )


def _climb(rows: DataFrame) -> list[DataFrame]:
    """Layers (key, place, size, hash) from ``rows`` to one row for each key."""
    layers = [rows]
    while len(layers) == 1 or (layers[-1].agg(F.max("size")).first()[0] or 0) > 1:
        up = _levels(layers[-1]).where(F.col("place") % SPAN == 0)
        up = up.select(
            "key", F.col("span").alias("place"), F.ceil(F.col("size") / SPAN).alias("size"),
            F.col("top").alias("hash"),
        )
        layers.append(stored(up, "layer"))
    return layers


def _descend(layers: list[DataFrame], top: DataFrame) -> DataFrame:
    """The first layer with ``path`` and the columns of ``top`` (key, path, ...)."""
    given = [c for c in top.columns if c not in ("key", "path")]
    upper = top.withColumn("place", F.lit(0).cast("long"))
    for layer in reversed(layers[:-1]):
        if layer is not layers[-2]:
            upper = stored(upper, "paths")
        above = upper.select(
            "key", F.col("place").alias("span"), F.col("path").alias("_upper"), *given
        )
        upper = (
            _levels(layer)
            .join(above, ["key", "span"])
            .withColumn("path", F.concat("path", "_upper"))
            .drop("_upper", "span", "top")
        )
    return upper


def manifest(
    docs: DataFrame,
    fields: list[str],
    id_col: str = "doc_id",
    group_col: str = "source",
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """(id, leaf, subroot, root, path) of every row, with the columns of ``keep``.

    A leaf is the digest of ``fields``. ``path`` lists the siblings from the leaf's level to the
    root, as (left, right) texts of joined digests. Groups are ordered by their bytes.
    """
    own = {name: f"_keep{n}" for n, name in enumerate(keep or {})}
    group = F.col(f"`{group_col}`").cast("string")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("key"),
        leaf_digest(*(F.col(f"`{c}`") for c in fields)).alias("hash"),
        *(value.alias(own[name]) for name, value in (keep or {}).items()),
    )
    rows = _placed(stored(rows, "leaves"), ["_id", "hash"])
    layers = _climb(rows)
    groups = layers[-1].select(
        F.lit("").alias("key"), F.col("key").alias("group"), F.col("hash").alias("hash")
    )
    groups = stored(_placed(groups, ["group"]), "groups")
    over = _climb(groups)
    root = over[-1].select(
        "key", F.col("hash").alias("root"), _no_siblings().alias("path")
    )
    tops = _descend(over, root).select(
        F.col("group").alias("key"), F.col("hash").alias("subroot"), "root", "path"
    )
    proved = _descend(layers, stored(tops, "subroots"))
    return proved.select(
        F.col("_id").alias(id_col), F.col("hash").alias("leaf"), "subroot", "root", "path",
        *(F.col(own[name]).alias(name) for name in own),
    )


def _no_siblings() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")
