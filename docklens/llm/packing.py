"""Cost-balanced packing of documents into training sequences.

A piece of n ids costs ``linear * n + quadratic * n * n`` (feed-forward and attention
work). Pieces of a block are taken by descending cost, and each goes to the sequence of
the lowest cost that still has room for it. A block has just as many sequences as its ids
need; a piece that fits nowhere whole is cut over the cheapest sequences with room. So a
block has less than one sequence of padding.

Documents longer than a sequence are first cut into full pieces and a rest. Pieces are
dealt to blocks by the hash of document, start, content, task and a running number among
equal pieces of the task, about ``block_docs`` documents a block, so blocks are even, also
where many rows share an id, none holds more than one long document's share by chance, and
each is packed in one task. Equal pieces are alike, so a task that runs again with its rows
in another order deals the same pieces to the same blocks.

Cases: a null or empty text is its end id alone; repeated rows are packed each; rows with
a null id keep it; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.llm import vocab, words

SEQUENCE = 2048
BLOCK_DOCS = 1024
#: cost of a token's own work, in units of one pair of attending tokens: with a model
#: width d, a layer does about 12 d * d work a token and 2 d work a pair, so 6 d
LINEAR = 6 * 1024.0
QUADRATIC = 1.0

_PIECE = "doc_id long, start long, doc_tokens long, ids binary, salt long"
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)


def _pieces(path: str, end_id: int, most: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocab.byte_ids(path, added)
        part = TaskContext.get().partitionId()
        equal: Counter[int] = Counter()
        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, values, offsets in words.slices(batch.column(1)):
                doc_id, start, size, data, salt = [], [], [], [], []
                for k in range(len(offsets) - 1):
                    text = values[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8")
                    ids = np.array(encode(text) + [end_id], "<u4")
                    for first in range(0, len(ids), most):
                        doc_id.append(names[row + k])
                        start.append(first)
                        size.append(len(ids))
                        piece = ids[first : first + most].tobytes()
                        data.append(piece)
                        key = hash((names[row + k], first, piece))
                        salt.append(zlib.crc32(b"%d %d" % (part, equal[key]), zlib.crc32(piece)))
                        equal[key] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_id, pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(data, pa.binary()),
                        pa.array(salt, pa.int64()),
                    ],
                    ["doc_id", "start", "doc_tokens", "ids", "salt"],
                )

    return run


def assign(
    sizes: np.ndarray, most: int, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> list[tuple[int, int, int, int, int]]:
    """(piece, first id in it, length, sequence, offset) for pieces of at most ``most`` ids."""
    n = -(-int(sizes.sum()) // most)
    cost = np.zeros(n)
    room = np.full(n, most, np.int64)
    placed = []

    def put(piece: int, first: int, length: int, to: int) -> None:
        placed.append((piece, first, length, to, most - int(room[to])))
        room[to] -= length
        cost[to] += linear * length + quadratic * length * length

    order = np.lexsort((np.arange(len(sizes)), -sizes))
    left = []
    for piece in order.tolist():
        length = int(sizes[piece])
        fits = np.where(room >= length, cost, np.inf)
        to = int(fits.argmin())
        if np.isfinite(fits[to]):
            put(piece, 0, length, to)
        else:
            left.append(piece)
    for piece in left:
        first, length = 0, int(sizes[piece])
        while first < length:
            to = int(np.where(room > 0, cost, np.inf).argmin())
            part = min(length - first, int(room[to]))
            put(piece, first, part, to)
            first += part
    return placed


def _pack(most: int, linear: float, quadratic: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids"], na_position="first", kind="stable")
        sizes = rows["ids"].str.len().to_numpy(np.int64) // 4
        piece, first, length, to, offset = (
            np.array(x, np.int64) for x in zip(*assign(sizes, most, linear, quadratic))
        )
        data = rows["ids"].to_numpy()
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].array[piece],
                "start": rows["start"].to_numpy()[piece] + first,
                "length": length,
                "ids": [
                    data[p][4 * a : 4 * (a + n)]
                    for p, a, n in zip(piece.tolist(), first.tolist(), length.tolist())
                ],
                "doc_tokens": rows["doc_tokens"].to_numpy()[piece],
                "sequence_id": (int(rows["block"].iloc[0]) << 32) + to,
                "offset": offset,
            }
        )

    return run


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    block_docs: int = BLOCK_DOCS,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    added: bool = False,
) -> DataFrame:
    """One row for each piece of a document in a sequence, with its ids (little-endian).

    With ``added``, strings of the file's added tokens in a text get their ids.
    """
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    blocks = max(1, -(-docs.count() // block_docs))
    block = F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(blocks)).alias("block")
    return (
        read.mapInArrow(_pieces(path, end_id, sequence, added), _PIECE)
        .select("doc_id", "start", "doc_tokens", "ids", block)
        .groupBy("block")
        .applyInPandas(_pack(sequence, linear, quadratic), SCHEMA)
    )
