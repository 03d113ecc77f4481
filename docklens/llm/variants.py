"""Spelling variants: words that differ by one code point, found by pivotal bigrams.

Words are counted in tasks first and then over all. Of the bigrams of a word, ordered by how
many words hold them (rarest first) and by place, the first three are its prefix. Two of them
that do not overlap are its pivots, chosen by dynamic programming for the least sum of words that
hold them. One edit destroys at most one of two disjoint pivots, so of two near words the one
whose prefix ends earlier in the order of bigrams (either, if both end alike) has a pivot in the
prefix of the other. A bigram that ends the prefix may come again later in the word: an edit
makes at most two new bigrams, so its first five places count as the prefix when others look
their pivots up.

Position limits: the edit lies to one side of a pivot that survived, so the word is unchanged
from the pivot to its other end. The first pivot is looked up with all that is left of it, the
second with all that is right of it, and these two cover every place of the edit. What lies on
the edited side is halved: an edit in one half leaves the other. A look-up key is the hash of
the pivot's position, the unchanged side, the pivot, and one unchanged half; the length that
the halves are taken from is that of the shorter word. A word has 8 keys as a pivot holder and
24 to 56 as a prefix holder, however many words there are; equal keys are an equi-join that
Spark splits if a key is hot, and candidates are verified on the words.

The table of bigrams is bounded by the alphabet (26 + 64 letters, 8,100 bigrams); it is the only
thing that goes to the driver and back.

Cases: a null text has no words; in a row without an id no code point is deleted; ``×`` and
``÷`` lie in the range of letters and count as such; rows that are repeated count each time; an empty table gives an empty result; other
columns are not read. Words have at least ``least_length`` (4 or more, so that two disjoint
bigrams exist in every prefix) code points.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.llm import words
from docklens.llm.batches import strings
from docklens.llm.storage import stored

#: bytes of text that are counted together
_SLICE = 8 << 20
#: code points are kept in one byte: Latin-1
_LETTERS = np.zeros(256, bool)
for _low, _high in ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x100)):
    _LETTERS[_low:_high] = True

#: bigrams of a prefix: edits * bigram length + 1
_PREFIX = 3
#: places of the bigram that ends a prefix: those and what one edit can add
_PLACES = _PREFIX + 2
#: code points that one table of words holds at most, or one word
_CELLS = 1 << 20

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))


def latin(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with one byte for each code point below 256 (other bytes become 0), and offsets.

    A code point from U+00C0 to U+00FF is ``C3`` and one byte in UTF-8.
    """
    after = np.zeros(len(values), bool)
    after[1:] = values[:-1] == 0xC3
    out = np.where(after, values | 0x40, np.where(values < 0x80, values, 0)).astype(np.uint8)
    keep = values != 0xC3
    place = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], place[offsets]


def _crc(values: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of Latin-1 code points as UTF-8, going on from a state."""
    state = state ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(start - end, kind="stable")  # longest first: those still running lead
    at, length = start[order], (end - start)[order]
    run = state[order]
    for k in range(int(length[0]) if len(length) else 0):
        n = int(np.searchsorted(-length, -k, "left"))
        byte = values[at[:n] + k]
        wide = byte >= 0x80
        if wide.any():
            lead = run[:n][wide]
            run[:n][wide] = _CRC[(lead ^ np.uint32(0xC3)) & np.uint32(255)] ^ (lead >> np.uint32(8))
            byte = np.where(wide, byte & 0xBF, byte)
        own = run[:n]
        run[:n] = _CRC[(own ^ byte) & np.uint32(255)] ^ (own >> np.uint32(8))
    out = np.empty_like(run)
    out[order] = run
    return out ^ np.uint32(0xFFFFFFFF)


def _crcs(values: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The same, with runs of over 64 code points one by one."""
    out = np.zeros(len(start), np.uint32)
    short = end - start <= 64
    out[short] = _crc(values, start[short], end[short], state[short])
    for k in np.flatnonzero(~short):
        text = values[start[k] : end[k]].tobytes().decode("latin-1")
        out[k] = zlib.crc32(text.encode(), int(state[k]))
    return out


def _utf8(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The runs as an array of texts."""
    length = end - start
    edge = np.concatenate([[0], np.cumsum(length)])
    each = values[np.arange(edge[-1]) + np.repeat(start - edge[:-1], length)]
    wide = each >= 0x80
    if not wide.any():
        return strings(each, edge)
    place = np.concatenate([[0], np.cumsum(1 + wide)])
    out = np.empty(place[-1], np.uint8)
    out[place[:-1]] = np.where(wide, 0xC3, each)
    out[place[:-1][wide] + 1] = each[wide] & 0xBF
    return strings(out, place[edge])


def count_runs(ids: list, texts: pa.Array, least_length: int, every: int) -> Iterator[pa.Array]:
    """Counts (a struct array of ``values`` and ``counts``) of the words of slices of the texts."""
    for first, values, offsets in words.slices(texts, _SLICE):
        values, offsets = latin(values, offsets)
        values = words.LOWER[values]
        runs = words.spans(values, offsets, ~_LETTERS)
        long = runs.end - runs.start >= least_length
        start, end, row = runs.start[long], runs.end[long], runs.row[long]
        of = ids[first : first + len(offsets) - 1]
        begin = np.array([zlib.crc32(f"{i}:".encode()) for i in of], np.uint32)
        known = np.array([i is not None for i in of], bool)
        crc = _crcs(values, start, end, begin[row])
        cut = known[row] & (crc % every == 0)
        found = [_utf8(values, start[~cut], end[~cut])]
        shorter = []
        for k in np.flatnonzero(cut & (end - start > least_length)):
            text = values[start[k] : end[k]].tobytes().decode("latin-1")
            at = int(crc[k]) % len(text)
            shorter.append(text[:at] + text[at + 1 :])
        found.append(pa.array(shorter, pa.string()))
        yield pc.value_counts(pa.chunked_array(found))


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    every: int = 97,
) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences.

    Words are runs of letters up to U+00FF with A-Z lowered. Where ``every`` divides the
    unsigned CRC-32 of ``<id>:<word>``, the code point at that number modulo the length is
    deleted from the word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in count_runs(batch.column(0).to_pylist(), batch.column(1), least_length, every):
                yield pa.RecordBatch.from_arrays(
                    [counts.field("values"), counts.field("counts")], ["word", "n"]
                )

    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def bigram_counts(texts: pa.Array) -> np.ndarray:
    """For each bigram (first * 256 + second) the number of the words that hold it."""
    out = np.zeros(1 << 16, np.int64)
    for length, _, table in _by_length(texts):
        grams = np.sort(_grams(table), axis=1)
        new = np.ones(grams.shape, bool)
        new[:, 1:] = grams[:, 1:] != grams[:, :-1]
        out += np.bincount(grams[new], minlength=1 << 16)
    return out


def _by_length(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, code points by row) of the words of each length."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, values, offsets = next(words.slices(texts, 1 << 62), (0, np.zeros(0, np.uint8), np.zeros(1, np.int64)))
    values, offsets = latin(values, offsets)
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        every = np.flatnonzero(lengths == length)
        for at in np.array_split(every, -(-len(every) * int(length) // _CELLS)):
            if len(at):
                yield int(length), at, values[offsets[at][:, None] + np.arange(length)]


def _grams(table: np.ndarray) -> np.ndarray:
    return table[:, :-1].astype(np.int64) << 8 | table[:, 1:]


def pivots(grams: np.ndarray, rank: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(places where others find it, rank of the prefix's last, first and second pivot) by word.

    ``rank`` is the place of each bigram in the global order, ``counts`` its words.
    """
    places = np.arange(grams.shape[1])
    rows = np.arange(len(grams))
    order = rank[grams].astype(np.int64)
    by_place = order * len(places) + places
    third = np.partition(by_place, _PREFIX - 1, axis=1)[:, _PREFIX - 1]
    last = third // len(places)
    cost = np.where(by_place <= third[:, None], counts[grams].astype(np.float64), np.inf)
    # the cheapest pivot that ends before a place, then the cheapest pair
    best = np.minimum.accumulate(cost, axis=1)
    newest = np.ones(cost.shape, bool)
    newest[:, 1:] = best[:, 1:] < best[:, :-1]
    best_at = np.maximum.accumulate(np.where(newest, places, 0), axis=1)
    second = np.argmin(cost[:, 2:] + best[:, :-2], axis=1) + 2
    ends = order == last[:, None]
    held = (order < last[:, None]) | (ends & (np.cumsum(ends, axis=1) <= _PLACES))
    return held, last.astype(np.int32), best_at[rows, second - 2], second


_SEED = np.random.Generator(np.random.PCG64(11))
_WIDE = 1 << 10
_HEAD, _TAIL = _SEED.integers(1, 1 << 63, (2, _WIDE), dtype=np.uint64) | np.uint64(1)


def _sums(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first k code points, and of the last k, for each k."""
    n, length = table.shape
    places = np.arange(length)
    turn = (places // _WIDE).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    each = table.astype(np.uint64) + np.uint64(1)
    out = []
    for factors, own in ((_HEAD, each), (_TAIL, each[:, ::-1])):
        part = np.zeros((n, length + 1), np.uint64)
        np.cumsum(own * (factors[places % _WIDE] * turn), axis=1, out=part[:, 1:])
        out.append(part)
    return out[0], out[1]


def _keys(
    head: np.ndarray, tail: np.ndarray, rows: np.ndarray, at: np.ndarray, side: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which, keys) for bigrams at ``at`` in ``rows``; all before a bigram's end is unchanged.

    ``head`` and ``tail`` are hashes of the first and of the last k code points.
    """
    length = head.shape[1] - 1
    left = head[rows, at + 2]
    rest = length - at - 2
    for shorter in (0, 1):  # the other word is as long or longer, or shorter
        size = rest - shorter
        ok = size >= 0
        size = np.maximum(size, 0)
        half = size // 2
        for kind in (0, 1):
            if kind == 0:
                own = head[rows, at + 2 + half] + left
                use = ok
            else:
                own = tail[rows, size - half] + words.mix(left)
                use = ok & (half > 0)  # without a first half the other key always holds
            name = ((at * 4096 + size) * 4 + kind * 2 + side).astype(np.uint64)
            yield np.flatnonzero(use), words.mix(own[use] + words.mix(name[use]))


def index_keys(
    texts: pa.Array, rank: np.ndarray, counts: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places of words, keys, is a pivot's, rank of the prefix's last) of the words."""
    for length, at, table in _by_length(texts):
        held, last, first, second = pivots(_grams(table), rank, counts)
        head, tail = _sums(table)
        every = np.arange(len(at))
        holder, place = np.nonzero(held)
        for side, ahead, behind in ((0, head, tail), (1, tail, head)):
            turn = (lambda p: p) if side == 0 else (lambda p: length - 2 - p)
            pivot = turn(first if side == 0 else second)
            for rows, where, own in ((every, pivot, True), (holder, turn(place), False)):
                for use, keys in _keys(ahead, behind, rows, where, side):
                    of = rows[use]
                    yield at[of], keys, np.full(len(of), own), last[of]


_ENTRY = "key long, pivot boolean, last int, word string, n long"


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b), a < b, of the words of ``vocab`` (word, n; stored) that are near."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << 16, np.int64)
        for batch in batches:
            out += bigram_counts(batch.column(0))
        held = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(out[held])], ["gram", "n"])

    # at most 8,100 rows
    grams = (
        vocab.select("word")
        .mapInArrow(count, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(1 << 16, np.int64)
    counts[[r["gram"] for r in grams]] = [r["n"] for r in grams]
    rank = np.empty(1 << 16, np.int32)
    rank[np.lexsort((np.arange(1 << 16), counts))] = np.arange(1 << 16, dtype=np.int32)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n = batch.column(0), batch.column(1)
            for at, keys, pivot, last in index_keys(texts, rank, counts):
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)), pa.array(pivot), pa.array(last),
                        texts.take(at), n.take(at),
                    ],
                    ["key", "pivot", "last", "word", "n"],
                )

    entries = vocab.select("word", "n").mapInArrow(index, _ENTRY)
    own = entries.where("pivot").select(
        "key", F.col("last").alias("end"), F.col("word").alias("s"), F.col("n").alias("n_s")
    )
    others = entries.where("NOT pivot").select(
        "key", "last", F.col("word").alias("r"), F.col("n").alias("n_r")
    )
    length = F.length("s") - F.length("r")
    found = (
        own.join(others, "key")
        .where((F.col("end") <= F.col("last")) & (F.col("s") != F.col("r")))
        .where((F.abs(length) <= 1) & (F.levenshtein("s", "r", 1) == 1))
    )
    ordered = F.col("s") < F.col("r")
    pick = lambda x, y: F.when(ordered, F.col(x)).otherwise(F.col(y))
    return found.select(
        pick("s", "r").alias("a"), pick("n_s", "n_r").alias("n_a"),
        pick("r", "s").alias("b"), pick("n_r", "n_s").alias("n_b"),
    ).distinct()


def forms(vocab: DataFrame) -> DataFrame:
    """(word, n, form, n_near, form_n) of the words of a stored table (word, n).

    The form is the near word with the most occurrences (of equal ones the first in the order
    of code points), if it has at least twice those of the word.
    """
    pairs = near_pairs(vocab)
    side = lambda w, x, n: F.struct(
        F.col(w).alias("word"), (-F.col(n)).alias("less"), F.col(x).alias("form")
    )
    sides = pairs.select(F.inline(F.array(side("a", "b", "n_b"), side("b", "a", "n_a"))))
    best = sides.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct("less", "form")).alias("best")
    )
    enough = -F.col("best.less") >= 2 * F.col("n")
    return vocab.join(best, "word", "left").select(
        "word", "n",
        F.when(enough, F.col("best.form")).alias("form"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def group_variants(docs: DataFrame, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``docs``.

    The root is reached by following forms; each form has twice the occurrences of its word,
    so a chain is short, and following two steps at once needs a handful of rounds.
    """
    table = stored(forms(stored(vocabulary(docs, **options), "words")), "forms")
    way = table.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    while True:
        further = way.select(F.col("word").alias("to"), F.col("to").alias("next"))
        way = stored(
            way.join(further, "to", "left").select(
                "word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if not way.where("moved").limit(1).count():
            break
        way = way.drop("moved")
    roots = way.select("word", F.col("to").alias("root"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
