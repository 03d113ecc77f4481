"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, written as Parquet and read
again, and works on all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docklens.llm import packing, pii, quality, superminhash, toxicity
from docklens.llm.shipping import ship
from docklens.llm.storage import stored
from docklens.llm.vocab import public

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the rules go, and documents that fail or lose too much."""
    ship(spark)
    return quality.clean(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier of the labelled ones finds toxic go."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_documents(docs, labels, ~toxicity.held_out("id"))
    return toxicity.clean(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles one stays."""
    ship(spark)
    return superminhash.deduplicate(docs, near=superminhash.Near(shingle=5, percent=80))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind."""
    ship(spark)
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 2048."""
    ship(spark)
    return packing.pack(
        docs, public("byte_bpe_50k.json"), end_id=1, sequence=2048, added=True
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", pii_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a trained field decide in it: SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
