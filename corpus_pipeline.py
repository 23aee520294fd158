"""From raw documents to packed training sequences.

Every stage takes the documents that its predecessor kept and returns documents,
the last one the places of their pieces in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.llm.language import identify
from assayloom.llm.mixing import mix_documents, mixed_texts
from assayloom.llm.packing import pack_documents
from assayloom.llm.secrets import redacted, scan_secrets
from assayloom.llm.simhash import drop_near_duplicates
from assayloom.llm.tables import Saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages."""
    return identify(docs, keep=COLUMNS).filter("accepted").select(*COLUMNS)


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of the SimHash operator, with its shingles and bit distance."""
    return drop_near_duplicates(docs, keep=COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, their secrets replaced by a mark."""
    found = scan_secrets(docs, keep=COLUMNS)
    secret = F.size("spans") > 0
    found = found.withColumn("text", F.when(secret, redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text")))
    return found.withColumn("n_chars", F.when(secret, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take the words that the mix wants: a document up to two times, whole or in parts."""
    mixed = mixed_texts(mix_documents(docs, keep=["text", "lang", "source", "n_chars"]))
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the tokens of all documents in sequences."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can not express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each one to the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = Saved(stage(spark, docs, sf_dir), name).df
    return STAGES[-1][1](spark, docs, sf_dir)
