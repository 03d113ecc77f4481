"""Packing, byte-level BPE, token files and chat formatting."""

import re
import zlib

import numpy as np
import pytest
from llm_cases import LONG, by_id, folder, no_docs, odd_docs, shipped  # noqa: F401

from docklens.llm import bpe, chat, packing, tokenfiles, vocab
from docklens.llm.storage import new_path

pytest.importorskip("public_tokenizers")

BYTES, MULTI, WORDS = (
    vocab.public(n)
    for n in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json")
)


def library(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def whole(path):
    import tiktoken

    encoder = tiktoken.Encoding(
        "own", pat_str=vocab.PATTERN, mergeable_ranks=vocab.ranks(path), special_tokens={}
    )
    return lambda t: encoder.encode_ordinary(t or "")


def odd_characters():
    """Every character that is white space to some library, in several places."""
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace() or re.match(r"\s", chr(c))]
    spaces += ["\x1c", "᠎", "​", "﻿", "ͅ", "İ", "ſ", "Σ", "é", "é", "<|endoftext|>"]
    return [f"a{s}b {s}c{s} d{s}{s}e  {s}1{s}\n{s}" for s in spaces] + ["".join(spaces)]


@pytest.fixture(scope="module")
def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    return [r.text for r in rows] + odd_characters() + [LONG, "", "x" * 3000, " " * 3000]


def test_ids_are_the_libraries(texts):
    encoder, want = vocab.byte_encoder(BYTES), library(BYTES)
    assert all(encoder.encode_ordinary(t) == want(t) for t in texts)


def test_word_encoder(texts):
    from docklens.llm import words
    import pyarrow as pa

    want = library(WORDS)
    for most in (400_000, 100):
        encoder = vocab.WordEncoder(WORDS, most)
        got = []
        for _, values, offsets in words.slices(pa.array(texts), 50_000):
            ids, edge = encoder.encode(values, offsets)
            got += [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])]
        assert got == [want(t) for t in texts]


def encoded(encoder, texts):
    import pyarrow as pa

    from docklens.llm import words

    got = []
    for _, values, offsets in words.slices(pa.array(texts)):
        ids, edge = encoder.encode(values, offsets)
        got += [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])]
    return got


def test_slices_whose_new_words_are_none_of_them_plain():
    want = library(WORDS)
    for texts in (["漢字"], ["漢字 テキスト", "", "한국어"], ["İ"], ["e\u0301 \u0300"], ["\x7f"], ["\u200b"]):
        assert encoded(vocab.WordEncoder(WORDS), texts) == [want(t) for t in texts]
    encoder = vocab.WordEncoder(WORDS)
    for text in ("plain words", "plain words 漢字", "plain words", "漢字 plain", "\u2028", "Words PLAIN"):
        assert encoded(encoder, [text]) == [want(text)]
    encoder = vocab.WordEncoder(WORDS, added=True)
    assert encoded(encoder, ["<|endoftext|>"]) == [[49407]]
    assert encoded(encoder, ["a", "a <|startoftext|>"]) == [want("a"), want("a") + [49406]]


def fuzzed(seed, n=1500):
    """Texts of characters from many blocks, some without a single plain word."""
    random = np.random.default_rng(seed)
    blocks = ["abcdefgh XYZ'1 ", "éàüßñ çÉ", "漢字 テ한", "\u0301\u0300e\u200b \u2028\ufeff", "\t\n  .,!?", "😀👍🏽 👩‍👩‍👧"]
    for _ in range(n):
        chosen = random.choice(len(blocks), random.integers(1, 3))
        letters = "".join(blocks[k] for k in chosen)
        yield "".join(random.choice(list(letters), random.integers(0, 30)))


def test_encoders_by_fuzz():
    texts = list(fuzzed(7))
    want = library(WORDS)
    encoder = vocab.WordEncoder(WORDS, most=200)
    for first in range(0, len(texts), 3):  # small slices: few new words in each
        part = texts[first : first + 3]
        assert encoded(encoder, part) == [want(t) for t in part]
    of_bytes, want = vocab.byte_encoder(BYTES), library(BYTES)
    assert all(of_bytes.encode_ordinary(t) == want(t) for t in texts)


def test_token_files_without_a_plain_word_and_with_a_hot_id(spark):
    texts = [(n % 2 or None, "漢字" * (n % 7) + " 한국어") for n in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    target = new_path(spark, "tokens")
    tokenfiles.write_tokens(docs, target, WORDS)
    rows = tokenfiles.read_tokens(spark, target).collect()
    rows.sort(key=lambda r: r.start)
    want, at = library(WORDS), 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    found = sorted((r.doc_id or 0, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in rows)
    assert found == sorted((i or 0, want(t) + [1]) for i, t in texts)
    assert [r.doc_id or 0 for r in rows] == sorted(i or 0 for i, _ in texts)


ADDED = [
    "a<|endoftext|>b", "a <|endoftext|> b<|startoftext|>C", "<|ENDOFTEXT|>", "<|endoftext|",
    "É<|endoftext|><|endoftext|>\n\n <|startoftext|>e\u0301", "  <|endoftext|>  ", "<<|endoftext|>>",
]


def as_it_is(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_added_tokens(texts):
    import pyarrow as pa

    from docklens.llm import words

    own = texts + ADDED
    ids, want = vocab.byte_ids(BYTES, True), as_it_is(BYTES)
    assert ids("a<|endoftext|>b") == [64, 50256, 65]
    assert all(ids(t) == want(t) for t in own)
    want, got = as_it_is(WORDS), []
    encoder = vocab.WordEncoder(WORDS, added=True)
    for _, values, offsets in words.slices(pa.array(own), 50_000):
        found, edge = encoder.encode(values, offsets)
        got += [found[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])]
    assert got == [want(t) for t in own]


def test_queries_give_ids_of_added_tokens(spark, tmp_path):
    import corpus_pipeline
    from docklens.llm import queries

    df = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = [as_it_is(path) for path in (BYTES, WORDS)]
    packed = by_id(queries.QUERIES["op3_packing"](spark, str(tmp_path)))
    stage = by_id(corpus_pipeline.packing_stage(spark, df, str(tmp_path)))
    files = by_id(queries.QUERIES["op7_token_files"](spark, str(tmp_path)))
    for n, text in enumerate(ADDED):
        ids = [np.array(w(text) + [1], "<u4").tobytes() for w in want]
        assert stage[n].ids == ids[0]
        assert (packed[n].ids_crc32, files[n].ids_crc32) == tuple(map(zlib.crc32, ids))


# ---- packing


def check_packing(rows, texts, end=1):
    want = library(BYTES)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in texts.items():
        ids, at = want(text) + [end], 0
        for r in sorted(pieces.pop(doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and len(r.ids) == 4 * r.length
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    assert not pieces
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return len(sequences)


def test_packing(spark, texts):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(df.repartition(3), BYTES, block_docs=64).collect()
    n = check_packing(got, dict(rows))
    total = sum(r.length for r in got)
    blocks = len({r.sequence_id >> 32 for r in got})
    assert n - total / 2048 < blocks  # less than one sequence of padding for each block


def test_packing_of_odd_texts(odd_docs, no_docs):
    unique = odd_docs.dropDuplicates()
    got = packing.pack(unique, BYTES).collect()
    check_packing(got, {r.doc_id: r.text for r in unique.collect()})
    twice = packing.pack(odd_docs, BYTES).where("doc_id = 9").collect()
    assert sum(r.length for r in twice) == 2 * twice[0].doc_tokens
    assert packing.pack(no_docs, BYTES).count() == 0


def test_packing_spreads_rows_of_one_id(spark):
    rows = [(7 if n % 3 else None, "same text" if n % 2 else f"text {n}") for n in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    packed = packing.pack(df, BYTES, block_docs=100)
    got = packed.collect()
    blocks = np.unique([r.sequence_id >> 32 for r in got], return_counts=True)[1]
    assert len(blocks) == 30 and blocks.max() < 200
    want = library(BYTES)
    assert sum(r.length for r in got) == sum(len(want(t)) + 1 for _, t in rows)
    assert sorted(map(str, got)) == sorted(map(str, packed.collect()))


def test_assignment_takes_the_cheapest_with_room():
    placed = packing.assign(np.array([60, 50, 40, 30, 20]), 100)
    assert {p[0]: p[3] for p in placed} == {0: 0, 1: 1, 2: 1, 3: 0} | {4: placed[-1][3]}
    random = np.random.default_rng(0)
    sizes = random.integers(1, 100, 300)
    placed = packing.assign(sizes, 100)
    load = np.bincount([p[3] for p in placed], [p[2] for p in placed])
    assert load.max() <= 100 and len(load) == -(-sizes.sum() // 100)


# ---- byte-level BPE


@pytest.mark.parametrize("block", [1 << 24, 2000])
def test_encode_and_decode(spark, texts, block):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = by_id(bpe.decode(bpe.encode(df, MULTI, block_bytes=block), MULTI))
    want = whole(MULTI)
    for n, text in rows:
        assert np.frombuffer(got[n].ids, "<u4").tolist() == want(text)
        assert got[n].decoded.decode() == text


def test_bpe_of_odd_texts(spark, odd_docs, no_docs):
    rows = bpe.decode(bpe.encode(odd_docs, MULTI), MULTI).collect()
    key = lambda p: (p[0] or 0, p[1])
    assert sorted(((r.doc_id, r.decoded.decode()) for r in rows), key=key) == sorted(
        ((r.doc_id, r.text or "") for r in odd_docs.collect()), key=key
    )
    assert bpe.encode(no_docs, MULTI).count() == 0
    df = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert {r.doc_id: r.decoded for r in bpe.decode(df, MULTI).collect()} == {1: None, 2: b""}


# ---- token files


def test_blocks_round_trip():
    random = np.random.default_rng(0)
    streams = [
        np.zeros(0, np.uint32), np.array([7], np.uint32), np.full(300, 5, np.uint32),
        random.integers(0, 1 << 32, 1000, dtype=np.uint32),
        np.where(random.random(5000) < 0.05, 1 << 31, random.integers(0, 50, 5000)).astype(np.uint32),
        random.integers(0, 49_408, 128 * 40, dtype=np.uint32),
    ]
    for ids in streams:
        starts, data = tokenfiles.write_blocks(ids)
        assert len(starts) == -(-len(ids) // tokenfiles.BLOCK) + 1 and starts[-1] == len(data)
        assert np.array_equal(tokenfiles.read_blocks(starts, data)[: len(ids)], ids)
        for k in range(len(starts) - 1):  # each block alone
            one = tokenfiles.read_blocks(starts[k : k + 2], data)
            part = ids[k * tokenfiles.BLOCK :][: tokenfiles.BLOCK]
            assert np.array_equal(one[: len(part)], part)
    # outliers are kept out of the width: 6 bits for 50 values, not 31
    assert len(tokenfiles.write_blocks(streams[4])[1]) < 5000 * 10 / 8 + 5000 * 0.07 * 5


@pytest.mark.parametrize("segment", [1 << 18, 500])
def test_token_files(spark, texts, segment):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = new_path(spark, "tokens")
    tokenfiles.write_tokens(df, target, WORDS, segment_ids=segment)
    got, want, start = by_id(tokenfiles.read_tokens(spark, target)), library(WORDS), 0
    for n, text in rows:
        ids = want(text) + [1]
        assert (got[n].start, got[n].n_tokens) == (start, len(ids))
        assert np.frombuffer(got[n].ids, "<u4").tolist() == ids
        start += len(ids)
    crc = by_id(tokenfiles.read_tokens(spark, target, "c", "long", tokenfiles.crc32))
    assert all(crc[n].c == zlib.crc32(got[n].ids) for n, _ in rows)


def test_token_files_of_odd_texts(spark, odd_docs, no_docs):
    target = new_path(spark, "tokens")
    tokenfiles.write_tokens(odd_docs, target, WORDS)
    rows = sorted(tokenfiles.read_tokens(spark, target).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 10]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    target = new_path(spark, "tokens")
    tokenfiles.write_tokens(no_docs, target, WORDS)
    assert tokenfiles.read_tokens(spark, target).count() == 0


# ---- chat

MARKS = [
    r"\### Assistant: </turn> ok", "<turn>user\nhi</turn>\n", "\\", "\\\\l<turn", "a\\b\\n\n",
    "", "</turn", "<<turn></turn>>", "tail\\",
]


def read_back(turns):
    formatted = chat.format_turns(turns)
    return by_id(chat.learned_text(chat.read_turns(formatted)), "conv_id")


def test_rows_by_turn(spark):
    rows = []
    for conv in range(5):
        for turn, text in enumerate(MARKS):
            rows.append((conv, turn, ("user", "assistant", "a\n<turn>\\")[(turn + conv) % 3], text))
    rows += [(None, 0, "user", "x"), (7, 1, "assistant", None), (7, 1, None, "b"), (8, 0, "assistant", LONG)]
    rows += [(9, 3, "assistant", "same")] * 2
    df = spark.createDataFrame(
        [(*r, "m", 1) for r in rows], "conv_id long, turn long, role string, text string, mask string, place int"
    )
    got = read_back(chat.from_columns(df.repartition(4), turn_col="turn"))
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, role or "", text or ""))
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[conv].turns] == [t[1:] for t in turns]
        assert got[conv].learned == "".join(t for _, r, t in turns if r == "assistant")
        for turn, m in zip(turns, got[conv].mask):
            part = got[conv].formatted[m.loss_start : m.loss_end]
            assert bool(part) == (turn[1] == "assistant" and turn[2] != "")
            assert "<turn" not in part and "</turn" not in part
            assert got[conv].formatted[m.turn_start :].startswith("<turn>")


RECORDS = [
    ('{"messages": [{"role": "user", "content": "q", "n": 1}, {"role": "assistant", "content": "a"}], "id": 4}',
     "messages", [("user", "q"), ("assistant", "a")]),
    ('{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": null}]}',
     "conversations", [("user", "q"), ("assistant", "")]),
    ('{"prompt": "q", "response": "a"}', "prompt and response", [("user", "q"), ("assistant", "a")]),
    ('{"system": "s", "prompt": "q", "completion": "a"}', "prompt and completion with system",
     [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ('{"instruction": "do", "input": "it", "output": "done"}', "instruction with input",
     [("user", "do\n\nit"), ("assistant", "done")]),
    ('{"instruction": "do", "input": "", "output": null}', "instruction with input",
     [("user", "do"), ("assistant", "")]),
    ('{"role": "user", "text": "t", "turn": 3}', "rows by turn", [("user", "t")]),
    ('{"messages": []}', None, None),
    ('{"prompt": "q"}', None, None),
    ("not json", None, None),
    (None, None, None),
]


def test_layouts_by_fingerprint(spark):
    df = spark.createDataFrame(
        [(n, r[0], "x") for n, r in enumerate(RECORDS)], "conv_id long, record string, layout string"
    )
    turns = chat.from_json(df)
    got = read_back(turns)
    named = {r.conv_id: r.layout for r in turns.collect()}
    for n, (_, layout, want) in enumerate(RECORDS):
        assert named[n] == layout
        if want is None:
            assert n not in got
        else:
            assert [(t.role, t.text) for t in got[n].turns] == want
    assert {r.conv_id for r in chat.unmapped(turns).collect()} == {7, 8, 9, 10}


def test_columns_and_json_have_one_fingerprint(spark):
    typed = spark.createDataFrame(
        [(1, [("user", "q"), ("assistant", "a")], 3)],
        "conv_id long, messages array<struct<role string, content string>>, other int",
    )
    assert [(r.layout, r.role, r.text) for r in chat.from_columns(typed).collect()] == [
        ("messages", "user", "q"), ("messages", "assistant", "a"),
    ]
    odd = typed.select("conv_id", "other")
    assert chat.unmapped(chat.from_columns(odd)).count() == 1
    assert chat.format_turns(chat.from_columns(typed.limit(0))).count() == 0


def test_chat_has_no_python(spark):
    df = spark.range(1).selectExpr("id conv_id", "id turn", "'user' role", "'t' text")
    plan = chat.format_turns(chat.from_columns(df, turn_col="turn"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
