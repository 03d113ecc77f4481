"""Byte-level BPE encoding and decoding with one encoding of each distinct word.

Encoding has three steps. Texts are exploded into pre-tokens with positions, in blocks of
a few megabytes of text: a block holds its distinct words and, for each text, the places
of its words in that list. The words of all blocks meet by their hash, and each distinct
word is encoded once. The ids go back to their blocks, where the texts are put together
by position. Words and positions travel packed, many in one compressed value, because one
row for each pre-token takes several times the input in shuffles. The texts of a task are
sorted before they are cut into blocks, so a task that is run again makes the same blocks.

Decoding joins the ids with the table of token bytes (as many rows as the vocabulary has,
read by each task).

Cases: a null text counts as empty and gives no ids; repeated rows are encoded each on
their own; a null id value passes; an empty table gives an empty result; other columns are
not read. A very long text is one block of its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docklens.llm import vocab

BLOCK_BYTES = 8 << 20
KEPT_WORDS = 1_000_000

_ZSTD = pa.Codec("zstd", 3)


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """Byte planes of integer arrays, and byte strings, compressed."""
    parts = []
    for one in arrays:
        if isinstance(one, bytes):
            size, raw = 0, one
        else:
            one = one.astype(np.uint32)
            size, raw = 4, one.view(np.uint8).reshape(-1, 4).T.tobytes()
        squeezed = _ZSTD.compress(raw, asbytes=True) if raw else b""
        parts.append(np.array([size, len(raw), len(squeezed)], np.int64).tobytes() + squeezed)
    return b"".join(parts)


def _unpack(data: bytes) -> list:
    out, at = [], 0
    while at < len(data):
        size, raw, squeezed = np.frombuffer(data, np.int64, 3, at).tolist()
        at += 24
        value = (
            _ZSTD.decompress(data[at : at + squeezed], decompressed_size=raw, asbytes=True)
            if raw
            else b""
        )
        at += squeezed
        if size:
            value = np.frombuffer(value, np.uint8).reshape(4, -1).T
            value = np.ascontiguousarray(value).view(np.uint32).reshape(-1)
        out.append(value)
    return out


_COLUMNS = ["key", "block", "kind", "part", "data"]
_SCHEMA = "key long, block long, kind int, part int, data binary"

#: A space beside other white space: such texts are split by the pattern as a whole.
_WIDE = re.compile(r" \s|\s ")


class _Block:
    """Texts of one block, split into pre-tokens."""

    def __init__(self, pattern):
        self._pattern = pattern
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.bytes = 0
        self._words: dict[str, int] = {}
        self._units: dict[str, int | tuple[int, ...]] = {}
        self._places: list[np.ndarray] = []

    def _split(self, text: str) -> tuple[int, ...]:
        words = self._words
        return tuple(words.setdefault(w, len(words)) for w in self._pattern.findall(text))

    def add(self, id_: int | None, text: str) -> None:
        if _WIDE.search(text):
            places = np.array(self._split(text), np.uint32)
        else:
            # matches never span a single space from its left: parts may be split alone
            units, flat = self._units, []
            head, *parts = text.split(" ")
            flat.extend(self._split(head))
            for part in parts:
                known = units.get(part)
                if known is None:
                    known = self._split(" " + part)
                    units[part] = known = known[0] if len(known) == 1 else known
                if type(known) is int:
                    flat.append(known)
                else:
                    flat.extend(known)
            places = np.array(flat, np.uint32)
        self.ids.append(id_)
        self.sizes.append(len(places))
        self._places.append(places)
        self.bytes += len(text)

    def rows(self, name: int, parts: int) -> Iterator[tuple[int, int, int, int, bytes]]:
        """(key, block, kind, part, data): the words by the part of their hash, then the texts.

        Rows of one ``key`` are to meet in one task: those of a part of the words.
        """
        texts = list(self._words)
        places = np.concatenate(self._places) if self._places else np.zeros(0, np.uint32)
        counts = np.bincount(places, minlength=len(texts))
        coded = [w.encode("utf-8", "surrogatepass") for w in texts]
        part = np.array([zlib.crc32(w) % parts for w in coded], np.int64)
        # frequent words get small numbers; the numbers of a part are part, part + parts, ...
        order = np.lexsort((np.arange(len(texts)), -counts, part))
        edge = np.searchsorted(part[order], np.arange(parts + 1))
        number = np.empty(len(texts), np.uint32)
        for p in range(parts):
            own = order[edge[p] : edge[p + 1]]
            if len(own):
                number[own] = p + parts * np.arange(len(own), dtype=np.uint32)
                mine = [coded[k] for k in own.tolist()]
                sizes = np.array([len(w) for w in mine], np.uint32)
                yield p, name, 0, p, _pack(sizes, b"".join(mine))
        ids = np.array([-1 if i is None else i for i in self.ids], np.int64)
        null = np.array([i is None for i in self.ids], np.uint32)
        sizes = np.array(self.sizes, np.uint32)
        places = number[places] if len(places) else places
        yield name, name, 1, 0, _pack(null, ids.tobytes(), sizes, places)


def _blocks(parts: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern = regex.compile(vocab.PATTERN)
        first = TaskContext.get().partitionId() << 24
        block = _Block(pattern)

        def close() -> pa.RecordBatch:
            columns = list(zip(*block.rows(first, parts)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], _COLUMNS
            )

        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1)):
                block.add(id_.as_py(), text.as_py() or "")
                if block.bytes >= most:
                    yield close()
                    first += 1
                    block = _Block(pattern)
        if block.ids:
            yield close()

    return run


def _encode_words(path: str):
    """Ids of the words of each row, a word of a part encoded once; texts pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.byte_encoder(path)
        known: dict[bytes, bytes] = {}
        part = None
        for batch in batches:
            out = []
            for kind, p, data in zip(
                batch.column("kind").to_pylist(), batch.column("part").to_pylist(), batch.column("data")
            ):
                if kind:
                    out.append(data.as_py())
                    continue
                if p != part or len(known) > KEPT_WORDS:
                    part, known = p, {}
                sizes, text = _unpack(data.as_py())
                ids, at = [], 0
                for size in sizes.tolist():
                    word = text[at : at + size]
                    at += size
                    one = known.get(word)
                    if one is None:
                        one = np.array(
                            encoder.encode_ordinary(word.decode("utf-8")), np.uint32
                        ).tobytes()
                        known[word] = one
                    ids.append(one)
                counts = np.array([len(i) // 4 for i in ids], np.uint32)
                out.append(_pack(counts, np.frombuffer(b"".join(ids), np.uint32)))
            kept = [batch.column(c) for c in _COLUMNS[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.binary())], _COLUMNS)

    return run


def _assemble(parts: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        words = rows[rows["kind"] == 0]
        loaded = [(p, *_unpack(d)) for p, d in zip(words["part"], words["data"])]
        top = max((p + parts * (len(c) - 1) for p, c, _ in loaded), default=-1) + 1
        count, start = np.zeros(top, np.int64), np.zeros(top, np.int64)
        flat, used = [], 0
        for p, counts, ids in loaded:
            at = p + parts * np.arange(len(counts))
            count[at] = counts
            start[at] = used + np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int64)])
            flat.append(ids)
            used += len(ids)
        flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        out_id, out_ids = [], []
        for data in rows.loc[rows["kind"] == 1, "data"]:
            null, ids, sizes, places = _unpack(data)
            edge = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            ids = np.frombuffer(ids, np.int64)
            for k in range(len(ids)):
                own = places[edge[k] : edge[k + 1]]
                n = count[own]
                to = np.cumsum(n)
                spot = np.arange(to[-1] if len(to) else 0) + np.repeat(start[own] - to + n, n)
                out_id.append(None if null[k] else int(ids[k]))
                out_ids.append(flat[spot].astype("<u4").tobytes())
        return pd.DataFrame(
            {"doc_id": pd.array(out_id, dtype="Int64"), "ids": pd.Series(out_ids, dtype=object)}
        )

    return run


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, ids): the ids of every text as little-endian unsigned 32-bit integers."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    blocks = read.sortWithinPartitions("doc_id", "text").mapInArrow(
        _blocks(parts, block_bytes), _SCHEMA
    )
    coded = (
        blocks.repartition(parts, "key")
        .sortWithinPartitions("kind", "part")
        .mapInArrow(_encode_words(path), _SCHEMA)
    )
    return coded.groupBy("block").applyInPandas(_assemble(parts), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids. Null ids decode to null."""
    kept = [f for f in encoded.schema if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocab.token_bytes(path)
        small = (b.slice(k, 512) for b in batches for k in range(0, b.num_rows, 512))
        for batch in small:
            out = []
            for one in batch.column(ids_col):
                if not one.is_valid:
                    out.append(None)
                    continue
                text = table.take(pa.array(np.frombuffer(one.as_buffer(), "<u4")))
                out.append(b"" if not len(text) else _joined(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(out, pa.binary())],
                [f.name for f in kept] + ["decoded"],
            )

    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])
    return encoded.select(*(f.name for f in kept)).mapInArrow(run, schema)


def _joined(values: pa.Array) -> bytes:
    """All values of a binary array, one after the other."""
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    return data[int(offsets[0]) : int(offsets[-1])].to_pybytes() if data is not None else b""
