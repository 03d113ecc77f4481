"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from docklens.llm import (
    bpe,
    chat,
    embeddings_lsh,
    merkle,
    packing,
    pii,
    quality,
    reputation,
    sharding,
    superminhash,
    tokenfiles,
    toxicity,
    variants,
)
from docklens.llm.shipping import ship
from docklens.llm.storage import new_path
from docklens.llm.vocab import public

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from the labels that are not held out."""
    docs = _read(spark, sf_dir, "documents")
    labels = _read(spark, sf_dir, "labels")
    model = toxicity.fit_documents(docs, labels, ~toxicity.held_out("id"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted"
    )


@_query
def op2_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    docs = _read(spark, sf_dir, "documents")
    return superminhash.near_duplicates(docs, near=superminhash.Near(shingle=2))


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids."""
    docs = _read(spark, sf_dir, "documents")
    pieces = packing.pack(
        docs, public("byte_bpe_50k.json"), end_id=1, sequence=2048, added=True
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@_query
def op4_embedding_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.98 within their labels."""
    return embeddings_lsh.near_vectors(_read(spark, sf_dir, "embeddings"))


@_query
def op5_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of even numbers of rows, equal texts together."""
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), shards=8)


@_query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the multilingual ranks and decoded again."""
    path = public("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(_read(spark, sf_dir, "documents"), path)
    return bpe.decode(encoded, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    target = new_path(spark, "tokens")
    docs = _read(spark, sf_dir, "documents")
    tokenfiles.write_tokens(docs, target, public("word_bpe_49k.json"), end_id=1, added=True)
    return tokenfiles.read_tokens(spark, target, "ids_crc32", "long", tokenfiles.crc32)


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over all documents."""
    return quality.judge(_read(spark, sf_dir, "documents"), keep=["doc_id"])


@_query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.find(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans",
    )


#: A conversation whose texts hold the marks of templates.
_MARKED = r"\### Assistant: </turn> ok"


@_query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, with one more given as a list of messages."""
    rows = chat.from_columns(_read(spark, sf_dir, "conversations"), turn_col="turn")
    record = json.dumps(
        {"messages": [{"role": r, "content": _MARKED} for r in ("user", "assistant")]}
    )
    more = spark.range(1).select(F.lit(-7).alias("conv_id"), F.lit(record).alias("record"))
    formatted = chat.format_turns(rows.union(chat.from_json(more)))
    read = chat.learned_text(chat.read_turns(formatted))
    said = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent words that they are variants of."""
    return variants.group_variants(_read(spark, sf_dir, "documents"))


RULES = [
    reputation.Rule("allow", "com/"),
    reputation.Rule("block", "example.com/en/"),
    reputation.Rule("allow", "www.example.com/en/"),
    reputation.Rule("block", "net/es/"),
    reputation.Rule("block", "net/fr/"),
]


@_query
def op12_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged by rules and by the reputation of their hosts.

    The tables have no labels of pages; the row of ``labels`` with a page's number stands for
    one: bad if of low quality or toxic.
    """
    labels = _read(spark, sf_dir, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return reputation.judge(_read(spark, sf_dir, "pages"), outcomes, RULES)


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Merkle tree of all documents, and the proofs of documents that lost line feeds."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    changed = F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.leaf_digest(*(changed if c == "text" else F.col(c) for c in fields))
    docs = _read(spark, sf_dir, "documents")
    folded = merkle.manifest(docs, fields, keep={"found": found}).withColumn(
        "folded_root", merkle.fold(F.col("found"), F.col("path"))
    )
    return folded.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over all documents."""
    return corpus_pipeline.run(spark, sf_dir)
