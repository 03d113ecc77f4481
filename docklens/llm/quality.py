"""Quality rules, line first.

Every line is judged (punctuation, symbols, shouting, repetition, navigation, boilerplate);
failing lines go; a document that loses too many of its words goes. The punctuation rule looks
at the paragraph: prose that was wrapped has its sentence marks on some of its lines only.
Before that, base rules judge the whole document: too few words, or too many words in
repeated eight-word windows.

Words are runs of bytes other than ASCII white space. Cases:

* a null text counts as empty: no words, so the base rules fail it; its cleaned text is
  null, that of an empty text is empty;
* lines without a word are never removed and lose nothing;
* of equal lines with a word in one document the first stays;
* repeated rows are judged alike, each on its own; an empty table gives an empty result;
* other columns pass through; one that is named like a result is replaced.

Rows never meet: there is no shuffle. Memory follows a slice of texts or one longer text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklens.llm import words
from docklens.llm.batches import Result, add_columns, by_slice, set_aside, strings
from docklens.llm.words import LOWER, WHITE, Spans, mix, per_text, repeated, spans

WINDOW = 8

#: Phrases of page furniture, in lower case; they count in lines of few words.
BOILERPLATE = (
    "accept cookies", "accept all cookies", "all rights reserved", "back to top",
    "click here", "cookie policy", "enable javascript", "follow us on", "log in",
    "privacy policy", "read more", "share this", "sign in", "sign up", "skip to content",
    "subscribe to", "terms of service", "terms of use", "uses cookies",
)

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_lines_removed long, words_removed long, kept boolean"
)


@dataclass(frozen=True)
class Rules:
    """Limits of the rules. Shares are of the words of a line or document."""

    min_words: int = 20
    max_repeat_percent: int = 30
    #: symbols for each word of a line
    max_symbols: float = 0.5
    #: separators of a menu for each word, and how many make a menu
    max_separators: float = 0.25
    min_separators: int = 3
    #: share of capital ASCII letters, in lines of at least so many letters
    max_capitals: float = 0.6
    min_letters: int = 20
    #: share of words equal to the word before, in lines of at least so many words
    max_stutter: float = 0.5
    min_stutter_words: int = 8
    #: lines of at least so many words need a sentence mark, or must be wrapped: followed by
    #: lines of their paragraph up to one with a mark, and at least so many bytes long
    min_sentence_words: int = 3
    min_wrapped_bytes: int = 40
    #: phrases of page furniture count in lines of at most so many words
    max_boilerplate_words: int = 12
    #: share of words that a document may lose with its lines
    max_lost: float = 0.5


def _table(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_SYMBOLS = _table("#*$%&|<>")
_MENU = _table("|>")
_MARKS = _table(".!?;:\"")
_WIDE_MARKS = tuple(c.encode() for c in "。！？।؟")
_CAPITALS, _SMALL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("abcdefghijklmnopqrstuvwxyz")
_CONTINUED = np.zeros(256, bool)
_CONTINUED[0x80:0xC0] = True


def _within(marks: np.ndarray, runs: Spans) -> np.ndarray:
    """How many marks are set in each run."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[runs.end] - total[runs.start]


def _places(values: np.ndarray, phrase: bytes) -> np.ndarray:
    found = np.zeros(len(values), bool)
    n = len(phrase)
    if len(values) >= n:
        at = np.flatnonzero(values[: len(values) - n + 1] == phrase[0])
        for k in range(1, n):
            at = at[values[at + k] == phrase[k]]
        found[at] = True
    return found


def _phrase_lines(values: np.ndarray, runs: Spans, at: np.ndarray) -> np.ndarray:
    """Which of the lines ``at`` hold a phrase of page furniture."""
    out = np.zeros(len(runs.start), bool)
    for k in at:
        line = LOWER[values[runs.start[k] : runs.end[k]]].tobytes().decode("utf-8", "replace")
        out[k] = any(p in line for p in BOILERPLATE)
    return out


def _repeat_words(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which words lie in a window of WINDOW words found twice or more in their text."""
    n = len(keys)
    if n < WINDOW:
        return np.zeros(n, bool)
    window = np.zeros(n - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        window = mix(window + keys[k : n - WINDOW + 1 + k] + np.uint64(k))
    row = np.repeat(np.arange(len(of) - 1), np.diff(of))
    whole = row[: n - WINDOW + 1] == row[WINDOW - 1 :]
    at = np.flatnonzero(whole)
    again = at[repeated(mix(window[at] ^ mix(row[at].astype(np.uint64))))]
    step = np.zeros(n + 1, np.int32)
    step[again] += 1
    step[again + WINDOW] -= 1
    return np.cumsum(step[:-1]) > 0


def _judge(values: np.ndarray, offsets: np.ndarray, rules: Rules, text: bool) -> Result:
    run = spans(values, offsets, WHITE)
    n_words = run.counts
    keys = words.hashes(values, run)[0]
    line = words.lines(values, offsets)
    first_word = np.searchsorted(run.start, line.start)
    line_words = np.searchsorted(run.start, line.end) - first_word
    with_word = line_words > 0

    line_key = mix(words.hashes(values, line)[0] ^ mix(line.row.astype(np.uint64)))
    order = np.flatnonzero(with_word)
    _, firsts = np.unique(line_key[order], return_index=True)
    copy = with_word.copy()
    copy[order[firsts]] = False

    n_repeat = per_text(_repeat_words(keys, run.of), run.of)
    base_failed = (n_words < rules.min_words) | (
        100 * n_repeat > rules.max_repeat_percent * n_words
    )

    marks = _MARKS[values]
    for wide in _WIDE_MARKS:
        marks |= _places(values, wide)
    symbols = _SYMBOLS[values]
    menu = _within(_MENU[values], line)
    capitals = _within(_CAPITALS[values], line)
    letters = capitals + _within(_SMALL[values], line)
    same = np.zeros(len(keys), bool)
    if len(keys):
        same[1:] = keys[1:] == keys[:-1]
    total = np.concatenate([[0], np.cumsum(same)])
    # the first word of a line does not count
    after = first_word + line_words
    stutter = total[after] - total[np.minimum(first_word + 1, after)]
    unmarked = with_word & (line_words >= rules.min_sentence_words) & (_within(marks, line) == 0)
    bad = copy.copy()
    bad |= unmarked & ~_wrapped(line, with_word, unmarked, _within(marks, line) > 0, rules)
    bad |= with_word & (_within(symbols, line) > rules.max_symbols * line_words)
    bad |= with_word & (menu >= rules.min_separators) & (menu > rules.max_separators * line_words)
    bad |= with_word & (letters >= rules.min_letters) & (capitals > rules.max_capitals * letters)
    bad |= (line_words >= rules.min_stutter_words) & (stutter > rules.max_stutter * line_words)
    short = np.flatnonzero(with_word & ~bad & (line_words <= rules.max_boilerplate_words))
    bad |= _phrase_lines(values, line, short)

    gone = np.concatenate([[0], np.cumsum(np.where(bad, line_words, 0))])
    lost = gone[line.of[1:]] - gone[line.of[:-1]]
    out: Result = {
        "n_words": n_words,
        "word_chars": per_text(~WHITE[values] & ~_CONTINUED[values], offsets),
        "n_symbols": per_text(symbols, offsets),
        "n_dup_lines": per_text(copy, line.of),
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "n_lines_removed": per_text(bad, line.of),
        "words_removed": lost,
        "kept": ~base_failed & (lost <= rules.max_lost * n_words),
    }
    if text:
        out["cleaned"] = _without(values, offsets, line, bad)
    return out


def _wrapped(
    line: Spans, with_word: np.ndarray, unmarked: np.ndarray, marked: np.ndarray, rules: Rules
) -> np.ndarray:
    """Which lines go on: wide lines without a mark, one below the other, above one with a mark."""
    out = np.zeros(len(line.start), bool)
    at = np.flatnonzero(with_word)
    if not len(at):
        return out
    goes_on = (unmarked & (line.end - line.start >= rules.min_wrapped_bytes))[at]
    n = len(at)
    place = np.where(goes_on, n, np.arange(n))  # the next line that does not go on
    stop = np.minimum.accumulate(place[::-1])[::-1]
    found = stop < n
    last = at[np.minimum(stop, n - 1)]
    # no line without words lies between, and none of another text
    near = last - at == stop - np.arange(n)
    out[at] = goes_on & found & near & (line.row[last] == line.row[at]) & marked[last]
    return out


def _without(values: np.ndarray, offsets: np.ndarray, line: Spans, bad: np.ndarray) -> pa.Array:
    """The texts without their bad lines; a line feed stands between the lines left."""
    good = np.flatnonzero(~bad)
    row = line.row[good]
    follows = np.zeros(len(good), bool)
    if len(good):
        follows[1:] = row[1:] == row[:-1]
    step = np.zeros(len(values) + 1, np.int32)
    np.add.at(step, line.start[good] - follows, 1)
    np.add.at(step, line.end[good], -1)
    stay = np.cumsum(step[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(stay, dtype=np.int64)])
    return strings(values[stay], total[offsets])


def judge(
    docs: DataFrame,
    text_col: str = "text",
    rules: Rules = Rules(),
    keep: list[str] | None = None,
    cleaned: bool = False,
) -> DataFrame:
    """``docs`` (columns ``keep``) with the counts and verdict of every document.

    ``cleaned=True`` adds the text without its failing lines.
    """

    def compute(texts: pa.Array) -> Result:
        empty = _judge(np.zeros(0, np.uint8), np.zeros(1, np.int64), rules, cleaned)
        out = by_slice(texts, lambda v, o: _judge(v, o, rules, cleaned), empty)
        if cleaned:
            out["cleaned"] = pc.if_else(pc.is_valid(texts), out["cleaned"], None)
        return out

    schema = SCHEMA + ", cleaned string" * cleaned
    return add_columns(docs, [text_col], schema, compute, keep)


def clean(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The kept documents with their cleaned texts, in the columns of ``docs``.

    A column ``n_chars`` is counted again; all others stay as they are.
    """
    aside, own = set_aside(docs, SCHEMA + ", cleaned string")
    judged = judge(aside, own[text_col], rules, cleaned=True).where("kept")
    return judged.select(
        *(
            F.col("cleaned" if c == text_col else f"`{own[c]}`").alias(c)
            if c != "n_chars"
            else F.length("cleaned").cast(docs.schema[c].dataType).alias(c)
            for c in docs.columns
        )
    )
