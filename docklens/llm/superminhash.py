"""Near-duplicate texts by SuperMinHash signatures, banding, verification and union-find.

Every distinct shingle of a text walks through a random permutation of the signature's
places: at step j it offers the rank j + r (r random in [0, 1)) to the j-th place of its
permutation. A place keeps the smallest rank. Ranks of one shingle are therefore all
different, which gives less variance than independent hashes, and no later step can lower
a place once all hold ranks below that step: most texts stop after one or two steps.

Texts with equal shingle sets are one class. Classes that share a band of their signatures
are compared on their full sets in three turns, each only between classes that are not yet
in one component:

1. with a few pivots of each band's bucket;
2. along the best forest of a bucket: of the pairs that sizes and signatures leave, the
   likeliest that join its components (copies of one text are far closer to that text than
   to each other, and it is rarely a pivot);
3. all pairs of a family (classes that such pairs connect) that is still in parts, counted
   exactly in blocks inside tasks.

A block returns a forest of what it found. So the rows that move grow with the texts, not
with the pairs of a group.

Cases:

* a null, empty or blank text has no shingles: size 0, linked with nothing;
* fewer words than a shingle: the whole word sequence is its one shingle;
* equal texts are linked with each other; the smallest id names the component;
* every row counts: rows that repeat an id, or have none, are rows of their own, with their
  own text; null ids are larger than others, and a component of such rows alone has none;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklens.llm import words
from docklens.llm.components import connected, forest
from docklens.llm.storage import dropped, stored
from docklens.llm.words import LOWER, WHITE, mix, spans


@dataclass(frozen=True)
class Near:
    """What counts as near, and the signature that finds it.

    A pair at the similarity itself is missed with a chance of (1 - s**rows)**bands:
    5e-8 for 0.8 with 32 bands of 4. ``slack`` is how far below the similarity a signature
    may estimate a pair that the blocks still confirm: 5 standard deviations of 128 places.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    slack: float = 0.18
    pivots: int = 4
    block: int = 1024
    block_shingles: int = 500_000

    @property
    def places(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    for _, values, offsets in words.slices(texts):
        run = spans(values, offsets, WHITE)
        keys = words.hashes(LOWER[values], run)[0]
        n = len(keys)
        gram = np.zeros(max(0, n - size + 1), np.uint64)
        for k in range(size):
            gram = mix(gram + keys[k : k + len(gram)] + np.uint64(k + 1))
        for first, last in zip(run.of[:-1].tolist(), run.of[1:].tolist()):
            if last - first >= size:
                yield np.unique(gram[first : last - size + 1])
            elif last > first:
                whole = np.uint64(last - first)
                for key in keys[first:last]:
                    whole = mix(np.array([whole + key + np.uint64(size)], np.uint64))[0]
                yield np.array([whole], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


_ONE = np.uint64(1) << np.uint64(32)


def _draw(elements: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Two random 32-bit numbers of every element for a step."""
    x = mix(elements + np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return x & np.uint64(0xFFFFFFFF), x >> np.uint64(32)


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """SuperMinHash of each set: (sets, places) ranks, step in the upper 32 bits.

    An empty set has the rank ``places << 32`` everywhere.
    """
    out = np.full((len(sets), places), np.uint64(places) << np.uint64(32), np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return out
    flat = out.reshape(-1)
    x = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), sizes)
    order = None  # the permutations of the elements that go on, from step 1
    for step in range(places):
        rank, pick = _draw(x, step)
        swap = step + ((pick * np.uint64(places - step)) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            place = swap
        else:
            here = np.arange(len(x))
            place = order[here, swap].astype(np.int64)
            order[here, swap] = order[here, step]
        np.minimum.at(flat, of * places + place, rank + np.uint64(step) * _ONE)
        # ranks of the next step are at least step + 1
        open_ = out.max(axis=1) >= np.uint64(step + 1) * _ONE
        go = open_[of]
        if not go.any():
            break
        if step == 0:
            x, of, place = x[go], of[go], place[go]
            order = np.tile(np.arange(places, dtype=np.uint16), (len(x), 1))
            here = np.arange(len(x))
            order[here, place] = 0
        else:
            x, of, order = x[go], of[go], order[go]
    return out


def _bands(signature: np.ndarray, near: Near) -> np.ndarray:
    parts = signature.reshape(len(signature), near.bands, near.rows)
    key = np.zeros(parts.shape[:2], np.uint64)
    for k in range(near.rows):
        key = mix(key + parts[:, :, k] + np.uint64(k + 1))
    return key.view(np.int64)


_SIGNED = (
    "own_id long, mark binary, n_shingles long, digest binary, bands array<long>, brief binary"
)


def signed(docs: DataFrame, near: Near) -> DataFrame:
    """Size, digest of the whole set, band keys and a 16-bit-a-place signature of each row.

    ``docs`` has (doc_id, mark, text).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _groups(shingle_sets(batch.column(2), near.shingle)):
                signature = signatures(sets, near.places)
                keys = _bands(signature, near)
                brief = mix(signature).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        batch.column(1).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) for s in sets]),
                        pa.array(list(keys), pa.list_(pa.int64())),
                        pa.array([b.tobytes() for b in brief]),
                    ],
                    ["own_id", "mark", "n_shingles", "digest", "bands", "brief"],
                )

    return docs.mapInArrow(run, _SIGNED)


def _digest(shingles: np.ndarray) -> bytes:
    return blake2b(shingles, digest_size=16).digest()


def _groups(
    sets: Iterator[np.ndarray], most: int = 200_000
) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets) of runs of rows with about ``most`` shingles."""
    first, held, size = 0, [], 0
    for one in sets:
        held.append(one)
        size += len(one)
        if size >= most:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """(digest, shingles): the full set of each text as little-endian 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _groups(shingle_sets(batch.column(0), size)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["digest", "shingles"],
                )

    return texts.mapInArrow(run, "digest binary, shingles binary")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                a = np.frombuffer(x.as_buffer(), np.uint64)
                b = np.frombuffer(y.as_buffer(), np.uint64)
                both = _common(a, b)
                yes.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(yes, pa.bool_())],
                ["a", "b", "near"],
            )

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """(a, b, near) for the pairs, by the full shingle sets of both texts.

    In each pair ``b`` is the pivot, which may be in very many pairs: its set is joined
    first, to pair rows that are still short, and Spark splits such a pivot's pairs.
    """
    joined = pairs.join(
        sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b"
    ).join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    return stored(
        joined.select("a", "b", "set_a", "set_b").mapInArrow(
            _confirm(near.percent), "a long, b long, near boolean"
        ),
        "confirmed",
    )


def _whole_groups(keys: list[str], compare):
    """Hand the rows of each task, sorted by ``keys``, on in whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            group = _group_of(rows, keys)
            done = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if done:
                yield from compare(rows.slice(0, done), group[:done])
            held = rows.slice(done)
        if held is not None and held.num_rows:
            yield from compare(held, _group_of(held, keys))

    return run


def _portions(key: np.ndarray, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of whole groups with at most so many pairs, or of one group."""
    edge = np.append(np.flatnonzero(np.diff(key, prepend=-1)), len(key))
    total = np.concatenate([[0], np.cumsum(np.diff(edge) ** 2)])
    first = 0
    while first < len(edge) - 1:
        last = int(np.searchsorted(total, total[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(edge) - 1)
        yield int(edge[first]), int(edge[last])
        first = last


_BUCKET = ["band", "key", "lo", "hi"]
_FAMILY = ["family", "lo", "hi"]


def _numbers(rows: pa.RecordBatch, *columns: str) -> list[np.ndarray]:
    return [rows.column(c).to_numpy(zero_copy_only=False) for c in columns]


def _best_forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Edges of a spanning forest of the largest weights between the labels."""
    taken = []
    order = np.argsort(-weight, kind="stable")
    i, j, at = i[order], j[order], order
    while True:
        open_ = label[i] != label[j]
        i, j, at = i[open_], j[open_], at[open_]
        if not len(i):
            return np.concatenate(taken) if taken else np.zeros(0, np.int64)
        # the first edge of each label is its best
        both = np.concatenate([label[i], label[j]])
        spot = np.concatenate([np.arange(len(i))] * 2)
        first = np.full(int(label.max()) + 1, len(i))
        np.minimum.at(first, both, spot)
        best = np.unique(first[first < len(i)])
        names, root = forest(label[i[best]], label[j[best]])
        # of edges in a cycle of equal weights one is too many; it does no harm
        taken.append(at[best])
        to = np.arange(int(label.max()) + 1)
        to[names] = root
        label = to[label]


def _blocks(near: Near):
    """(kind, a, b): pairs to compare (0), and the family of each class in a pair (1)."""
    least = int((near.percent / 100 - near.slack) * near.places)

    def compare(rows: pa.RecordBatch, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a, b in _portions(key):
            yield from pairs(rows.slice(a, b - a), key[a:b] - key[a])

    def pairs(rows: pa.RecordBatch, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, of, size, side, lo, hi = _numbers(
            rows, "doc_id", "component_id", "n_shingles", "side", "lo", "hi"
        )
        own = lo == hi
        brief = np.frombuffer(b"".join(rows.column("brief").to_pylist()), np.uint16)
        brief = brief.reshape(len(ids), near.places)
        first, second, alike = [], [], []
        for apart in range(1, int(np.bincount(key).max())):
            i = np.flatnonzero(key[:-apart] == key[apart:])
            j = i + apart
            keep = (of[i] != of[j]) & (own[i] | (side[i] != side[j]))
            keep &= 100 * np.minimum(size[i], size[j]) >= near.percent * np.maximum(size[i], size[j])
            i, j = i[keep], j[keep]
            for part in range(0, len(i), 65536):
                p, q = i[part : part + 65536], j[part : part + 65536]
                same = (brief[p] == brief[q]).sum(axis=1)
                yes = same >= least
                first.append(p[yes])
                second.append(q[yes])
                alike.append(same[yes])
        if not first:
            return
        i, j, weight = (np.concatenate(x) for x in (first, second, alike))
        if not len(i):
            return
        # one label for each component of a bucket
        _, label = np.unique(np.stack([key, of]), axis=1, return_inverse=True)
        best = _best_forest(i, j, weight, label.reshape(-1))
        a, b = ids[i[best]], ids[j[best]]
        names, root = forest(ids[i], ids[j])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array([0, 1], np.int32), [len(a), len(names)])),
                pa.array(np.concatenate([np.maximum(a, b), names])),
                pa.array(np.concatenate([np.minimum(a, b), root])),
            ],
            ["kind", "a", "b"],
        )

    return _whole_groups(_BUCKET, compare)


def _shared(sets: list[np.ndarray], dense: int = 32) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    n = len(sets)
    x = np.concatenate(sets)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    _, at, count = np.unique(x, return_inverse=True, return_counts=True)
    out = np.zeros((n, n))
    many = np.flatnonzero(count >= dense)
    spot = np.full(len(count), -1)
    spot[many] = np.arange(len(many))
    own = spot[at]
    order = np.argsort(own, kind="stable")
    sorted_own, sorted_of = own[order], of[order]
    for first in range(0, len(many), 4096):
        a, b = np.searchsorted(sorted_own, [first, first + 4096])
        part = np.zeros((n, min(4096, len(many) - first)), np.float32)
        part[sorted_of[a:b], sorted_own[a:b] - first] = 1
        out += part @ part.T
    few = np.flatnonzero((count >= 2) & (count < dense))
    spot[:] = -1
    spot[few] = np.arange(len(few))
    own = spot[at]
    keep = np.flatnonzero(own >= 0)
    keep = keep[np.argsort(own[keep], kind="stable")]
    group, member = own[keep], of[keep]
    for apart in range(1, dense):
        if apart >= len(group):
            break
        i = np.flatnonzero(group[:-apart] == group[apart:])
        if not len(i):
            break
        np.add.at(out, (member[i], member[i + apart]), 1)
        np.add.at(out, (member[i + apart], member[i]), 1)
    return np.rint(out).astype(np.int64)


def _families(near: Near):
    """(a, b): a forest of the links between classes of each block of a family."""

    def compare(rows: pa.RecordBatch, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = _numbers(rows, "doc_id")[0]
        edge = np.searchsorted(key, np.arange(int(key[-1]) + 2))
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("shingles")]
        size = np.array([len(s) for s in sets])
        for first, last in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if last - first < 2:
                continue
            both = _shared(sets[first:last])
            n = size[first:last]
            i, j = np.nonzero(np.triu(both, 1))
            near_ = 100 * both[i, j] >= near.percent * (n[i] + n[j] - both[i, j])
            names, root = forest(ids[first:last][i[near_]], ids[first:last][j[near_]])
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(root)], ["a", "b"])

    return _whole_groups(_FAMILY, compare)


def _group_of(rows: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    for x in _numbers(rows, *keys):
        new[1:] |= x[1:] != x[:-1]
    return np.cumsum(new)


def _dealt(rows: DataFrame, chunks: str = "chunks") -> DataFrame:
    """Rows of a group in every pair of its chunks that holds theirs: lo, hi and side."""
    side = F.pmod(F.xxhash64("doc_id"), F.col(chunks)).cast("int")
    return (
        rows.withColumn("side", side)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(chunks) - 1)))
        .withColumn("lo", F.least("side", "other"))
        .withColumn("hi", F.greatest("side", "other"))
        .drop("other", chunks)
    )


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with the component of each class so far: itself, if not linked."""
    return rows.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id")
    )


def _signed_rows(docs: DataFrame, id_col: str, text_col: str, near: Near) -> tuple:
    """(rows (own_id, mark, text), stored signed rows): ``mark`` is the digest of a text,
    ``row`` names a signed row."""
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("own_id"),
        _mark(text_col).alias("mark"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    marks = signed(texts, near).withColumn("row", F.monotonically_increasing_id())
    return texts, stored(marks, "signed")


def _mark(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: Near = Near()
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingle
    sets. ``component_id`` is the smallest id reachable by links; ``kept`` marks one row of
    each component, which has that id.
    """
    texts, marks = _signed_rows(docs, id_col, text_col, near)
    return _grouped(texts, marks, near).select(
        F.col("own_id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


def _grouped(texts: DataFrame, marks: DataFrame, near: Near) -> DataFrame:
    """Signed rows with ``component_id`` and ``kept``. Within, ``doc_id`` names a class of
    rows with equal sets, by one of its rows."""
    full = marks.where("n_shingles > 0")
    # the class is named by the row that would be kept of it: the smallest id, null ones last
    first_row = F.struct(F.col("own_id").isNull().alias("none"), "own_id", "row")
    classes = stored(
        full.groupBy("digest")
        .agg(F.min(first_row).alias("least"))
        .select("digest", "least", F.col("least.row").alias("rep")),
        "classes",
    )
    reps = stored(
        full.join(classes.select(F.col("rep").alias("row")), "row", "left_semi").select(
            F.col("row").alias("doc_id"), "n_shingles", "bands", "brief", "digest", "mark"
        ),
        "reps",
    )
    members = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))

    # buckets of several classes, each with a pivot: the smallest id in one of several fixed
    # random orders. All that follows needs only their members, and those members' sets
    order = F.xxhash64("doc_id", F.pmod("band", F.lit(near.pivots)))
    buckets = members.groupBy("band", "key").agg(
        F.min(F.struct(order.alias("o"), "doc_id")).alias("p"), F.count("*").alias("n")
    ).where("n > 1").select("band", "key", "n", F.col("p.doc_id").alias("b"))
    members = stored(members.join(buckets, ["band", "key"]), "members")
    some = members.select("doc_id").distinct()
    wanted = reps.join(some, "doc_id").select("doc_id", "digest", "mark")
    # equal texts once, then one text of each class: the one that its name stands for
    once = texts.join(wanted.select("mark").distinct(), "mark", "left_semi").dropDuplicates(["mark"])
    sets = stored(
        _sets(once.select("text"), near.shingle)
        .join(wanted.select("doc_id", "digest"), "digest")
        .select("doc_id", "shingles"),
        "sets",
    )
    first = stored(
        members.where("doc_id != b").select(F.col("doc_id").alias("a"), "b").distinct(), "pairs"
    )
    links = confirmed(first, sets, near).where("near").select("a", "b")
    parts = stored(connected(links), "parts")

    # buckets that still hold several components, except those of two compared classes
    placed = _placed(members.where("n > 2").drop("b", "n"), parts)
    mixed = (
        placed.groupBy("band", "key")
        .agg(
            F.count("*").alias("n"),
            F.min("component_id").alias("low"),
            F.max("component_id").alias("high"),
        )
        .where("low < high")
        .select("band", "key", F.ceil(F.col("n") / near.block).cast("int").alias("chunks"))
    )
    rows = _dealt(placed.join(mixed, ["band", "key"])).join(
        reps.select("doc_id", "n_shingles", "brief"), "doc_id"
    )
    likely = stored(
        rows.repartition(*_BUCKET)
        .sortWithinPartitions(*_BUCKET)
        .mapInArrow(_blocks(near), "kind int, a long, b long")
        .distinct(),
        "likely",
    )
    second = likely.where("kind = 0").select("a", "b").join(first, ["a", "b"], "left_anti")
    second = stored(second, "more-pairs")
    links = links.union(confirmed(second, sets, near).where("near").select("a", "b"))
    parts = stored(connected(links), "parts")

    # families that are still in parts
    family = stored(connected(likely.where("kind = 1")), "families")
    family = _placed(
        family.select(F.col("id").alias("doc_id"), F.col("component_id").alias("family")), parts
    ).join(reps.select("doc_id", "n_shingles"), "doc_id")
    apart = (
        family.groupBy("family")
        .agg(
            F.count("*").alias("n"),
            F.sum("n_shingles").alias("size"),
            F.min("component_id").alias("low"),
            F.max("component_id").alias("high"),
        )
        .where("low < high")
        .select(
            "family",
            F.greatest(F.ceil(F.col("n") / near.block), F.ceil(F.col("size") / near.block_shingles))
            .cast("int").alias("chunks"),
        )
    )
    family = stored(family.join(apart, "family").select("doc_id", "family", "chunks"), "family")
    third = (
        _dealt(family)
        .join(sets, "doc_id")
        .repartition(*_FAMILY)
        .sortWithinPartitions(*_FAMILY)
        .mapInArrow(_families(near), "a long, b long")
    )
    third = stored(third, "family-links")
    dropped(sets)
    parts = stored(connected(links.union(third)), "parts")

    parts = parts.withColumnRenamed("id", "rep").withColumnRenamed("component_id", "part")
    of_class = classes.join(parts, "rep", "left").select(
        "digest", "least", F.coalesce("part", "rep").alias("part")
    )
    keeper = of_class.groupBy("part").agg(F.min("least").alias("keeper"))
    of_class = of_class.join(keeper, "part").select("digest", "keeper")
    alone = F.col("n_shingles") == 0
    return (
        marks.select("own_id", "mark", "row", "n_shingles", "digest")
        .join(of_class, "digest", "left")
        .withColumn("component_id", F.when(alone, F.col("own_id")).otherwise(F.col("keeper.own_id")))
        .withColumn("kept", alone | (F.col("keeper.row") == F.col("row")))
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: Near = Near()
) -> DataFrame:
    """One document of each component, in the columns of ``docs``.

    Of rows with the same id and text one stays, whatever else they hold; rows without words
    stay all.
    """
    texts, marks = _signed_rows(docs, id_col, text_col, near)
    kept = _grouped(texts, marks, near).where("kept AND n_shingles > 0")
    kept = kept.select(
        F.coalesce("own_id", F.lit(0)).alias("_i"), F.col("own_id").isNull().alias("_n"),
        F.col("mark").alias("_m"),
    )
    plain = {c: f"_c{n}" for n, c in enumerate(docs.columns)}
    renamed = docs.toDF(*plain.values())
    own, text = plain[id_col], plain[text_col]
    with_word = F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    number = F.col(own).cast("long")
    named = renamed.where(with_word).withColumns(
        {
            "_i": F.coalesce(number, F.lit(0)),
            "_n": number.isNull(),
            "_m": _mark(text),
        }
    )
    keys = ["_i", "_n", "_m"]
    once = named.join(kept, keys, "left_semi").dropDuplicates(keys).drop(*keys)
    return once.union(renamed.where(~with_word)).toDF(*docs.columns)
