"""A training-data pipeline over the documents table, stage by stage.

Each stage reads what the one before has written. Texts without a known language go, one
document of each group of near copies stays, secrets are masked, sources are mixed to their
target weights, and what is left is packed into sequences.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.settle import checkpoint_dir
from faultline.llm import langid, mixing, neardup, packing, secretscan

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: With fewer letters, even a clean text may be no more like its language than noise.
LETTERS = 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts without a letter, or unlike every language that the labels show.

    Texts with a letter, but fewer than LETTERS, cannot be told apart by their score and stay.
    """
    model = langid.train(docs, sample_key="doc_id")
    found = langid.predict(docs, model, whole_rows=True)
    short = F.length(F.regexp_replace("row.text", r"\P{L}", "")) < LETTERS
    known = (found["lang_pred"] != langid.UNKNOWN) & (short | (found["score"] > langid.NOISE))
    return found.where(known).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return neardup.one_of_each_group(docs, width=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret found in a text; documents without one stay as they are."""
    model = secretscan.train(secretscan.labelled_samples(docs))
    found = secretscan.scan_secrets(docs, model, keep=tuple(docs.columns))
    return secretscan.with_masks(found, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents up to its budget of words, repeated where it has too few."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every piece of every document in a sequence of at most 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language prototypes, odd sketches and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and read again."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
