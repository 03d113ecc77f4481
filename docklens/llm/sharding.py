"""Balanced label propagation: documents move to the shards of the documents they are
linked with, under quotas that keep every shard's number of rows even.

Links are hubs: documents with the same hub are linked, without a row for each pair. Each
round joins the documents' shards to their hubs, counts them for each hub and shard, joins
the counts back and lets each document prefer the shard that holds most of its neighbours,
less a penalty for fuller shards. Moves into a shard are let through, whole hubs together
and large ones first, while its quota lasts. A hub with more rows than a shard can take is
first divided into as few parts as shards allow, each a hub of its own. What is left over
(documents without links, hubs that found no room, the smallest hubs of shards that are
too full) then fills the shards hub by hub, so that row counts differ by one at most and
only a hub at the edge of a shard is cut.

Only DataFrame functions are used. Positions are numbers within small hash buckets plus
the counts of the buckets before, so no task holds a shard.

Cases: a null text has size 1 and the checksum of an empty text, and is linked with empty
texts; equal texts are linked; repeated rows are rows of their own; rows with a null id
are placed like others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docklens.llm.storage import dropped, stored

ROUNDS = 8
#: rows that one bucket of the numbering should hold
BUCKET_ROWS = 20_000
#: share of a shard that one part of a divided hub may fill
PART = 0.9


def _case(values: list[int], at: Column) -> Column:
    """The value at a position, from a short list."""
    return F.element_at(F.array(*(F.lit(int(v)).cast("long") for v in values)), at + 1)


def _share(*columns: str | Column) -> Column:
    """A number in [0, 1) that follows from the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def numbered(df: DataFrame, groups: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... in each group, in the order of bucket and ``order``."""
    rows = df.withColumn("_bucket", bucket)
    keys = [*groups, "_bucket"]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    running = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_bucket"))
    before = sizes.select(*keys, (running - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (
        rows.withColumn("_own", own)
        .join(before, keys)
        .withColumn(name, F.col("_before") + F.col("_own"))
        .drop("_bucket", "_own", "_before")
    )


def _counts(df: DataFrame, shards: int, column: str = "shard") -> list[int]:
    """Rows of each shard: one small row for each."""
    found = {r[0]: r[1] for r in df.groupBy(column).count().collect()}
    return [found.get(k, 0) for k in range(shards)]


def _buckets(rows: int) -> int:
    return max(1, -(-rows // BUCKET_ROWS))


def propagate(members: DataFrame, rows: int, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(row, shard) of the rows that have links.

    ``members`` is a stored table (row, hub) with hubs of two rows at least; ``rows`` is
    the number of all rows, linked or not.
    """
    room = max(1, rows // shards)
    crowded = (
        members.groupBy("hub")
        .agg(F.count("*").alias("n"))
        .withColumn("parts", F.ceil(F.col("n") / (room * PART)).cast("int"))
    )
    parted = members.join(crowded.where("parts > 1").select("hub", "parts"), "hub", "left")
    part = F.floor(_share("row", F.lit(7)) * F.coalesce("parts", F.lit(1))).cast("int")
    members = stored(parted.select("row", "hub", part.alias("part")), "members")
    hub = ["hub", "part"]
    sizes = members.groupBy(*hub).agg(F.floor(F.log2(F.count("*"))).cast("int").alias("class"))
    main = members.groupBy("row").agg(F.min(F.struct(*hub)).alias("main"))
    shard = F.floor(_share("row") * shards).cast("int").alias("shard")
    state = stored(
        main.select("row", "main", "main.*", shard).join(sizes, hub).drop(*hub), "shards"
    )
    load = _counts(state, shards)
    for turn in range(rounds):
        votes = (
            members.join(state.select("row", "shard"), "row")
            .groupBy(*hub)
            .agg(*(F.count(F.when(F.col("shard") == k, 1)).alias(f"n{k}") for k in range(shards)))
        )
        wishes = (
            members.join(votes, hub)
            .groupBy("row")
            .agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(shards)))
        )
        total = reduce(lambda a, b: a + b, (F.col(f"n{k}") for k in range(shards)))
        free = [max(0.0, 1 - n / room) for n in load]
        # all rows of a hub that see the same votes break a tie alike
        score = F.array_max(
            F.array(
                *(
                    F.struct(
                        (F.col(f"n{k}") / total + F.lit(0.5 * free[k])).alias("s"),
                        F.xxhash64("main", F.lit(k)).alias("h"),
                        F.lit(k).alias("k"),
                    )
                    for k in range(shards)
                )
            )
        )
        wanted = stored(
            state.join(wishes, "row").select(
                "row", "main", "class", "shard", score.getField("k").alias("to")
            ),
            "wishes",
        )
        # at most shards * shards * 64 small rows
        flow = wanted.groupBy("shard", "to", "class").agg(F.count("*").alias("n")).collect()
        if all(r["shard"] == r["to"] for r in flow):
            dropped(wanted)
            break
        least, part = zip(*(_quota(flow, k, room) for k in range(shards)))
        of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("to") + 1)
        passes = (F.col("class") > of(least)) | (
            (F.col("class") == of(least)) & (_share("main", F.lit(1000 + turn)) < of(part))
        )
        after = stored(
            wanted.select(
                "row", "main", "class",
                F.when(passes, F.col("to")).otherwise(F.col("shard")).alias("shard"),
            ),
            "shards",
        )
        dropped(wanted)
        dropped(state)
        state = after
        load = _counts(state, shards)
    return state


def _quota(flow: list, shard: int, room: int) -> tuple[int, float]:
    """(size class, share of its hubs) down to which moves into a shard are let through."""
    left = room - sum(r["n"] for r in flow if r["shard"] == r["to"] == shard)
    by_class: dict[int, int] = {}
    for r in flow:
        if r["to"] == shard != r["shard"]:
            by_class[r["class"]] = by_class.get(r["class"], 0) + r["n"]
    for size in sorted(by_class, reverse=True):
        if by_class[size] > left:
            return size, max(0.0, left / by_class[size])
        left -= by_class[size]
    return -1, 0.0


def shard_documents(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    Equal texts are linked. The law is ``rows``: counts of the shards differ by one at
    most. ``slot`` numbers the rows of a shard from 0; ``grown_shard`` is null.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("hub"),
    )
    # a row is named by its id, or, where ids repeat, by its place among them
    again = Window.partitionBy("doc_id", "hub").orderBy("size")
    rows = rows.withColumn("nth", F.row_number().over(again))
    rows = stored(rows.withColumn("row", F.struct("doc_id", "hub", "nth")), "rows")
    n = rows.count()
    linked = rows.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1").select("hub")
    members = stored(rows.join(linked, "hub").select("row", "hub"), "links")
    state = propagate(members, n, shards, rounds)

    most = [n // shards + (k < n % shards) for k in range(shards)]
    buckets = _buckets(n)
    whole = state.groupBy("main").agg(F.min("shard").alias("low"), F.max("shard").alias("high"))
    state = state.join(whole.where("low = high").select("main"), "main")
    # large hubs first, a hub's rows beside each other; those of a bucket are spread in it
    near = (
        (63 - F.col("class")) * buckets + F.floor(_share("main", F.lit(3)) * buckets)
    ) * 32 + F.pmod(F.xxhash64("row"), F.lit(32))
    placed = numbered(
        state, ["shard"], near, [F.xxhash64("main"), F.xxhash64("row"), F.col("row")], "slot"
    )
    held = stored(
        placed.where(F.col("slot") < _case(most, F.col("shard"))).select("row", "shard", "slot"), "held"
    )
    stay = _counts(held, shards)
    rest = rows.join(linked.withColumn("linked", F.lit(True)), "hub", "left").select(
        "row", F.when(F.col("linked"), F.xxhash64("hub")).otherwise(F.xxhash64("row")).alias("key")
    )
    rest = rest.join(held.select("row"), "row", "left_anti")
    rest = numbered(
        rest,
        [],
        F.floor(_share("key") * buckets) * 32 + F.pmod(F.xxhash64("row"), F.lit(32)),
        [F.col("key"), F.xxhash64("row"), F.col("row")],
        "place",
    )
    first = [sum(most[i] - stay[i] for i in range(k)) for k in range(shards)]
    to = reduce(
        lambda a, b: a + b,
        ((F.col("place") >= first[k]).cast("int") for k in range(1, shards)),
        F.lit(0),
    )
    gap = [stay[k] - first[k] for k in range(shards)]
    rest = rest.withColumn("shard", to).select(
        "row", "shard", (F.col("place") + _case(gap, F.col("shard"))).alias("slot")
    )
    return (
        rows.join(held.select("row", "shard", "slot").union(rest), "row")
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
