"""Token ids in files of patched frame-of-reference blocks.

The ids of all documents, in ascending order of doc_id, form one stream. The stream is cut
into segments (some hundred thousand ids, whole documents) and each segment into blocks of
128 ids. A block stores its minimum, the differences to it in as many bits as 90 % of them
need, bit plane by bit plane, and the upper bits of the others in an exception list. A
segment also has the byte at which each of its blocks starts, its document ids and their
numbers of ids, so any document or block can be read alone.

Segments are rows of a Parquet table: Spark's writer commits them, on any file system and
after lost executors. ``part`` and ``first`` place a segment in the stream: segments are
ordered by part, and ``first`` counts the ids of the part before it.

Cases: a null or empty text has only the end id; repeated rows are written each; rows with
equal doc_id are in an order of their own, rows with a null doc_id come first; an empty
table gives an empty file; other columns are not read; a text longer than a segment is a
segment of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docklens.llm import vocab, words

BLOCK = 128
SEGMENT_IDS = 1 << 18
PERCENTILE = 90

_SEGMENT = (
    "part int, first long, n_ids long, doc_ids array<long>, doc_tokens array<int>, "
    "starts binary, blocks binary"
)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def write_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(first byte of each block and the end, blocks) of a stream of 32-bit ids."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(1, np.uint32), b""
    full = np.full(n * BLOCK, ids[-1], np.uint32)  # the last block is filled up
    full[: len(ids)] = ids
    full = full.reshape(n, BLOCK)
    least = full.min(axis=1)
    rest = full - least[:, None]
    bits = _widths(rest)
    at = (BLOCK * PERCENTILE + 99) // 100 - 1
    width = np.partition(bits, at, axis=1)[:, at]
    large = bits > width[:, None]
    n_large = large.sum(axis=1)
    # header 6, planes 16 a bit, exceptions 1 + 4 each
    starts = np.concatenate([[0], np.cumsum(6 + 16 * width.astype(np.int64) + 5 * n_large)])
    out = np.zeros(starts[-1], np.uint8)
    begin = starts[:-1]
    out[begin[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(n, 4)
    out[begin + 4] = width
    out[begin + 5] = n_large
    for bit in range(int(width.max())):
        own = np.flatnonzero(width > bit)
        plane = np.packbits((rest[own] >> np.uint32(bit)).astype(np.uint8) & 1, axis=1)
        out[(begin[own] + 6 + 16 * bit)[:, None] + np.arange(16)] = plane
    row, column = np.nonzero(large)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_large) - n_large, n_large)
    tail = begin[row] + 6 + 16 * width[row].astype(np.int64)
    out[tail + nth] = column
    upper = (rest[row, column] >> width[row].astype(np.uint32)).astype("<u4")
    spot = tail + n_large[row] + 4 * nth
    out[spot[:, None] + np.arange(4)] = upper.view(np.uint8).reshape(-1, 4)
    return starts.astype("<u4"), out.tobytes()


def read_blocks(starts: np.ndarray, data: bytes) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` (the end is the last of them)."""
    raw = np.frombuffer(data, np.uint8)
    begin = starts[:-1].astype(np.int64)
    n = len(begin)
    if not n:
        return np.zeros(0, np.uint32)
    least = np.ascontiguousarray(raw[begin[:, None] + np.arange(4)]).view("<u4")
    width, n_large = raw[begin + 4], raw[begin + 5].astype(np.int64)
    rest = np.zeros((n, BLOCK), np.uint32)
    for bit in range(int(width.max())):
        own = np.flatnonzero(width > bit)
        plane = raw[(begin[own] + 6 + 16 * bit)[:, None] + np.arange(16)]
        rest[own] |= np.unpackbits(plane, axis=1).astype(np.uint32) << np.uint32(bit)
    row = np.repeat(np.arange(n), n_large)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_large) - n_large, n_large)
    tail = begin[row] + 6 + 16 * width[row].astype(np.int64)
    column = raw[tail + nth]
    spot = tail + n_large[row] + 4 * nth
    upper = np.ascontiguousarray(raw[spot[:, None] + np.arange(4)]).view("<u4").reshape(-1)
    rest[row, column] |= upper.astype(np.uint32) << width[row].astype(np.uint32)
    return (rest + least.astype(np.uint32)).reshape(-1)


def _segments(path: str, end_id: int, most: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.word_encoder(path, added)
        part, first = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        total = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held)
            starts, blocks = write_blocks(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([starts.tobytes()], pa.binary()),
                    pa.array([blocks], pa.binary()),
                ],
                ["part", "first", "n_ids", "doc_ids", "doc_tokens", "starts", "blocks"],
            )

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for row, values, offsets in words.slices(batch.column(1)):
                ids, edge = encoder.encode(values, offsets)
                n = len(edge) - 1
                # the end id after each document
                stream = np.insert(ids, edge[1:], np.uint32(end_id))
                edge = edge + np.arange(n + 1)
                at = 0
                while at < n:
                    room = max(most - total, 0)
                    to = int(np.searchsorted(edge, edge[at] + room, "right")) - 1
                    if to > at:
                        names += doc_ids[row + at : row + to]
                        sizes += np.diff(edge[at : to + 1]).tolist()
                        held.append(stream[edge[at] : edge[to]])
                        total += int(edge[to] - edge[at])
                        at = to
                    elif not total:  # longer than a segment
                        names.append(doc_ids[row + at])
                        sizes.append(int(edge[at + 1] - edge[at]))
                        held.append(stream[edge[at] : edge[at + 1]])
                        total = sizes[-1]
                        at += 1
                    if at < n or total >= most:
                        yield close()
                        first += total
                        names, sizes, held, total = [], [], [], 0
        if total:
            yield close()

    return run


def write_tokens(
    docs: DataFrame,
    target: str,
    path: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_ids: int = SEGMENT_IDS,
    added: bool = False,
) -> None:
    """Write the token files of ``docs`` to the folder ``target``.

    ``path`` is a tokenizer file whose tokens never span white space. With ``added``,
    strings of the file's added tokens in a text get their ids.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).withColumn("spread", F.xxhash64("text"))  # rows of one id lie in several tasks
    rows.repartitionByRange("doc_id", "spread").sortWithinPartitions(
        "doc_id", "spread", "text"
    ).select("doc_id", "text").mapInArrow(
        _segments(path, end_id, segment_ids, added), _SEGMENT
    ).write.parquet(target)


def _documents(columns: str, compute: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                names = row.column("doc_ids").flatten()
                sizes = row.column("doc_tokens").flatten().to_numpy(zero_copy_only=False)
                starts = np.frombuffer(row.column("starts")[0].as_buffer(), "<u4")
                ids = read_blocks(starts, row.column("blocks")[0].as_buffer())
                edge = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                first = row.column("first")[0].as_py()
                made = [compute(ids[a:b].astype("<u4")) for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), row.column("part")[0].as_py(), np.int32)),
                        pa.array(first + edge[:-1]),
                        names,
                        pa.array(sizes.astype(np.int64)),
                        pa.array(made),
                    ],
                    ["part", "first", "doc_id", "n_tokens", columns],
                )

    return run


def read_tokens(
    spark: SparkSession,
    target: str,
    column: str = "ids",
    kind: str = "binary",
    compute: Callable[[np.ndarray], object] = np.ndarray.tobytes,
) -> DataFrame:
    """(doc_id, start, n_tokens, ``column``) of every document in the files.

    ``start`` counts the ids of all documents before it. ``compute`` makes the value of
    ``column`` from a document's ids, by default their little-endian bytes.
    """
    files = spark.read.parquet(target)
    rows = files.mapInArrow(
        _documents(column, compute),
        f"part int, first long, doc_id long, n_tokens long, {column} {kind}",
    )
    # one row for each task that wrote
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = sums.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    return rows.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", column
    )


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.tobytes())
