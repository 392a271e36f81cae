"""The pipeline over documents: stages that each apply one operator to all that the stage before kept.

All stages but the last return the columns of documents. A rejected document is gone from then on, a copy gives way to
the document with the smallest id of its group, secrets are replaced in the text, and the mix holds a document as often
as it is taken. The last stage returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.line_crf import fit, held_out, keep_good, training_texts
from tally.llm.mixing import mixed_rows
from tally.llm.packing import best_fit_packing
from tally.llm.scratch import written
from tally.llm.secrets import redact_secrets
from tally.llm.shingle_join import keep_one


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the field finds good enough. It learns from the labels of this stage's documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    return keep_good(docs, fit(*training_texts(docs, labels)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their five-word shingles."""
    return keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars counted anew."""
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of 2048 tokens."""
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mix", mix),
    ("pack", pack),
]

ORACLE_SQL = None  # SQL can express none of the stages; tests/llm/ holds them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
