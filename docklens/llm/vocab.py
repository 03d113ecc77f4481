"""Public tokenizer files, and encoders with their ids.

Paths are parameters; executors read the file at the same path, or one that the caller
distributes. Encoders are made once in each Python worker.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

from docklens.llm import words

#: Splits text before the merges of byte-level BPE. A fixed value of these vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def public(name: str) -> str:
    """The place of a file of the ``public_tokenizers`` package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes in order for the
    characters from 256.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


def _model(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)["model"]


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file or of a byte-level BPE in JSON.

    An encoder by ranks joins two neighbours whenever their bytes together are a token; a
    JSON file names the two parts of each token. Both agree if the ids follow the merges
    and if every token is what its own bytes are joined to: then two neighbours that
    together are a token can only be its named parts. Tokens that the merges never reach
    are left out, for the same reason. (``tests`` check files against the library.)
    """
    if not path.endswith(".json"):
        with open(path, "rb") as file:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    letters = byte_letters()
    return {bytes(letters[c] for c in token): n for token, n in _reached(path, "").items()}


def _reached(path: str, end: str) -> dict[str, int]:
    """The tokens that the merges of a file reach, with their ids in the order of merges."""
    from tokenizers import models

    model = _model(path)
    vocabulary = model["vocab"]
    pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocabulary[a + b] for a, b in pairs]
    if ids != sorted(ids):
        raise ValueError(f"{path}: ids do not follow the merges")
    inner = models.BPE(vocab=vocabulary, merges=pairs)
    last = models.BPE(vocab=vocabulary, merges=pairs, end_of_word_suffix=end) if end else None
    out = {}
    for token, n in vocabulary.items():
        ends = bool(end) and token.endswith(end) and token != end
        found = (last if ends else inner).tokenize(token.removesuffix(end) if ends else token)
        if [t.id for t in found] == [n]:
            out[token] = n
    return out


@lru_cache(maxsize=4)
def byte_encoder(path: str):
    """A byte-level encoder; strings of special tokens in a text are ordinary text."""
    import tiktoken

    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def added_tokens(path: str) -> dict[str, int]:
    """The strings that the library cuts out of a text before anything else, with their ids."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens") or []
    for token in tokens:
        if any(token.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: {token['content']} is not matched as it stands")
        if not token["content"] or any(c.isspace() for c in token["content"]):
            raise ValueError(f"{path}: an added token holds white space or nothing")
    return {token["content"]: token["id"] for token in tokens}


@lru_cache(maxsize=4)
def byte_ids(path: str, added: bool = False) -> Callable[[str], list[int]]:
    """A function from a text to its byte-level ids.

    With ``added``, strings of added tokens get their ids, as from the library itself;
    otherwise they are ordinary text.
    """
    plain = byte_encoder(path).encode_ordinary
    tokens = added_tokens(path) if added else {}
    if not tokens:
        return plain
    cut = re.compile("|".join(map(re.escape, sorted(tokens, key=len, reverse=True))))

    def ids(text: str) -> list[int]:
        out, at = [], 0
        for found in cut.finditer(text):
            out += [*plain(text[at : found.start()]), tokens[found.group()]]
            at = found.end()
        return out + plain(text[at:]) if at else plain(text)

    return ids


@lru_cache(maxsize=4)
def token_bytes(path: str) -> pa.Array:
    """The bytes of each id, in order."""
    table = {n: b for b, n in ranks(path).items()}
    return pa.array([table.get(n, b"") for n in range(max(table) + 1)], pa.large_binary())


@lru_cache(maxsize=4)
def library_encoder(path: str, added: bool = False):
    """The tokenizer of a JSON file; strings of special tokens are ordinary text without ``added``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not added
    return tokenizer


#: Stands for the end of a word in the ranks below. Words that hold it go to the library.
_END = "\x7f"
#: Words that the library's normal form only puts in lower case: visible ASCII and Latin
#: letters, without the capital I with a dot, whose lower case is two characters.
_PLAIN = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")


class WordEncoder:
    """Ids of texts from a BPE with word ends that drops white space.

    Texts are cut at ASCII white space. Each different word of a slice is looked up by its
    64-bit hash and encoded once; ids of up to ``most`` words are kept. Plain words are cut
    by the file's own pattern and encoded by ranks, all in one call; the others are given
    to the library. With ``added``, words that hold a string of an added token are given to
    it too, and get that token's id.
    """

    def __init__(self, path: str, most: int = 1_000_000, added: bool = False):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        kinds = [n["type"] for n in whole["normalizer"]["normalizers"]]
        cut, *others = whole["pre_tokenizer"]["pretokenizers"]
        suffix = whole["model"]["end_of_word_suffix"]
        if kinds != ["NFC", "Replace", "Lowercase"] or len(others) != 1 or not suffix:
            raise ValueError(f"{path}: not a lower-case BPE with word ends")
        self._pieces = regex.compile(cut["pattern"]["Regex"]).findall
        letters = byte_letters()
        by_rank = {
            bytes(letters[c] for c in token.removesuffix(suffix))
            + (_END.encode() if token.endswith(suffix) else b""): n
            for token, n in _reached(path, suffix).items()
        }
        # the end alone is no token, but every byte must have a rank
        by_rank[_END.encode()] = top = max(by_rank.values()) + 1
        self._ranks = tiktoken.Encoding(
            path, pat_str=f"[^{_END}]+{_END}", mergeable_ranks=by_rank, special_tokens={}
        )
        self._last = np.zeros(top + 1, bool)
        self._last[[n for b, n in by_rank.items() if len(b) > 1 and b.endswith(_END.encode())]] = True
        self._library = library_encoder(path, added)
        self._added = tuple(added_tokens(path)) if added else ()
        self._most = most
        self._clear()

    def _clear(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._start = np.zeros(0, np.int64)
        self._count = np.zeros(0, np.int64)
        self._ids = np.zeros(1 << 20, np.uint32)
        self._used = 0

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        if not texts:  # a slice may have no new plain word
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        pieces = [self._pieces(t.lower()) for t in texts]
        joined = "".join(p + _END for own in pieces for p in own)
        ids = self._ranks.encode_to_numpy(joined, disallowed_special=())
        edge = np.concatenate([[0], np.flatnonzero(self._last[ids]) + 1])
        last = np.cumsum([len(own) for own in pieces], dtype=np.int64)
        return ids, np.diff(edge[last], prepend=0)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        plain = np.array(
            [
                _PLAIN.fullmatch(t) is not None and not any(a in t for a in self._added)
                for t in texts
            ]
        )
        own = np.flatnonzero(plain)
        rest = np.flatnonzero(~plain)
        ids, count = self._plain([texts[k] for k in own])
        if len(rest):
            made = self._library.encode_batch_fast(
                [texts[k] for k in rest], add_special_tokens=False
            )
            more = [e.ids for e in made]
            ids = np.concatenate([ids, np.array([n for e in more for n in e], np.uint32)])
            count = np.concatenate([count, np.array([len(e) for e in more], np.int64)])
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        self._ids[self._used : self._used + len(ids)] = ids
        start = self._used + np.cumsum(count) - count
        self._used += len(ids)
        order = np.argsort(np.concatenate([own, rest]), kind="stable")  # as keys are
        at = np.searchsorted(self._keys, keys)
        self._keys = np.insert(self._keys, at, keys)
        self._start = np.insert(self._start, at, start[order])
        self._count = np.insert(self._count, at, count[order])

    def encode(self, values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and the end)."""
        run = words.spans(values, offsets, words.WHITE)
        keys = words.hashes(values, run)[0]
        if not len(keys):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        unique, first, at = np.unique(keys, return_index=True, return_inverse=True)
        if len(self._keys) > self._most:
            self._clear()
        known = np.searchsorted(self._keys, unique)
        known[known == len(self._keys)] = 0
        new = np.flatnonzero(self._keys[known] != unique) if len(self._keys) else np.arange(len(unique))
        if len(new):
            spots = first[new]
            data = values.tobytes()
            self._learn(
                unique[new],
                [
                    data[a:b].decode("utf-8")
                    for a, b in zip(run.start[spots].tolist(), run.end[spots].tolist())
                ],
            )
            known = np.searchsorted(self._keys, unique)
        entry = known[at]
        count = self._count[entry]
        edge = np.concatenate([[0], np.cumsum(count)])
        place = np.arange(edge[-1]) + np.repeat(self._start[entry] - edge[:-1], count)
        return self._ids[place], edge[run.of]


@lru_cache(maxsize=2)
def word_encoder(path: str, added: bool = False) -> WordEncoder:
    return WordEncoder(path, added=added)
