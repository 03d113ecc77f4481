"""Words, lines and their 64-bit hashes, found in the bytes of many texts at once.

Texts are taken in slices of a few megabytes, so memory follows the slice (or one
longer text), not the batch. Hashes are multilinear over the bytes (a random odd
factor for each place) and mixed with the length; the chance that two different words
of a text meet is about 2^-57.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_PLACES = 1 << 12
_FACTORS = np.random.Generator(np.random.PCG64(20240607)).integers(
    1, 1 << 63, _PLACES, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

NOT_ALNUM = np.ones(256, bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    NOT_ALNUM[_low:_high] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with at most ``most`` bytes, or one row.

    A null text counts as an empty one.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    values = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, values[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Spans:
    """Runs of bytes: ``start`` and ``end`` of each, and ``of``: the first run of each text."""

    start: np.ndarray
    end: np.ndarray
    of: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), self.counts)


def spans(values: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> Spans:
    """The longest runs of bytes that are no separators, within each text."""
    if not len(values):
        none = np.zeros(0, np.int64)
        return Spans(none, none, np.zeros(len(offsets), np.int64))
    inside = ~separator[values]
    filled = offsets[:-1] < offsets[1:]
    first = np.empty(len(values), bool)
    first[0], first[1:] = True, ~inside[:-1]
    first[offsets[:-1][filled]] = True
    last = np.empty(len(values), bool)
    last[-1], last[:-1] = True, ~inside[1:]
    last[offsets[1:][filled] - 1] = True
    start = np.flatnonzero(inside & first)
    return Spans(start, np.flatnonzero(inside & last) + 1, np.searchsorted(start, offsets))


def lines(values: np.ndarray, offsets: np.ndarray) -> Spans:
    """The parts between line feeds, empty ones too; an empty text has none."""
    feeds = np.flatnonzero(values == 0x0A)
    filled = np.flatnonzero(offsets[:-1] < offsets[1:])
    start = np.sort(np.concatenate([offsets[filled], feeds + 1]), kind="stable")
    end = np.sort(np.concatenate([feeds, offsets[filled + 1]]), kind="stable")
    row = np.sort(
        np.concatenate([filled, np.searchsorted(offsets, feeds, "right") - 1]), kind="stable"
    )
    return Spans(start, end, np.searchsorted(row, np.arange(len(offsets))))


def hashes(values: np.ndarray, runs: Spans, heads: tuple[int, ...] = ()) -> list[np.ndarray]:
    """A hash of each run, then of its first h bytes (all, if shorter) for h in ``heads``.

    Runs are taken in parts of about SLICE_BYTES, so a very long text needs no more.
    """
    edge = np.concatenate([[0], np.cumsum(runs.end - runs.start)])
    parts, first = [], 0
    while first < len(runs.start):
        last = int(np.searchsorted(edge, edge[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(runs.start))
        parts.append(_hashes(values, runs.start[first:last], edge[first : last + 1] - edge[first], heads))
        first = last
    if len(parts) == 1:
        return parts[0]
    none = [np.zeros(0, np.uint64)]
    return [np.concatenate([p[k] for p in parts] or none) for k in range(1 + len(heads))]


def _hashes(
    values: np.ndarray, start: np.ndarray, edge: np.ndarray, heads: tuple[int, ...]
) -> list[np.ndarray]:
    length = np.diff(edge)
    place = np.arange(edge[-1], dtype=np.int64) - np.repeat(edge[:-1], length)
    each = values[place + np.repeat(start, length)].astype(np.uint64) + np.uint64(1)
    each *= _FACTORS[place & (_PLACES - 1)]
    if edge[-1] and length.max() > _PLACES:
        each *= (place >> 12).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C16) + np.uint64(1)
    out = []
    for head in (None, *heads):
        own = each if head is None else np.where(place < head, each, np.uint64(0))
        total = np.concatenate([[np.uint64(0)], np.cumsum(own, dtype=np.uint64)])
        n = length if head is None else np.minimum(length, head)
        out.append(mix(total[edge[1:]] - total[edge[:-1]] + mix(n.astype(np.uint64))))
    return out


def per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marks are set in each text; ``offsets`` in the places of ``marks``."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys are found twice or more."""
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys
