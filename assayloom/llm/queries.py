"""Registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clusters import cluster_vectors
from .embeddings import embedding_components
from .language import identify
from .middle import fill_in_middle, restored
from .mixing import mix_documents
from .neighbours import nearest_neighbours
from .packing import pack_documents
from .scoring import cross_entropy_difference
from .secrets import count_of, scan_secrets
from .secrets import written as written_spans
from .simhash import simhash_components
from .substrings import remove_repeated_windows
from .syncmers import edit_fingerprints
from .url_filters import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Vocabulary file of op10.
TOKENIZER = "word_bpe_49k.json"

#: The rules of op1.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_url_redirect_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_secret_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    base = F.sha2(written_spans(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, written_spans(F.col("spans")).alias("spans"))


def op3_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_embedding_hyperplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))


def op7_fingerprints_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))


def op8_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_mixing_splitting_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents")).drop("pieces")


def op10_packing_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_centroids_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle_fenwick(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    output = F.col("output")
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(output, 256).alias("output_sha256"),
        F.sha2(restored(output, F.col("form")), 256).alias("restored_sha256"))


def op13_neighbours_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    named = [
        op1_url_redirect_classes,
        op2_secret_credential_links,
        op3_simhash_bk_trees,
        op4_cross_entropy_difference,
        op5_substring_super_kmers,
        op6_embedding_hyperplanes,
        op7_fingerprints_closed_syncmers,
        op8_language_evidence,
        op9_mixing_splitting_tree,
        op10_packing_minimum_bin_slack,
        op11_centroids_ns_bounds,
        op12_fill_in_middle_fenwick,
        op13_neighbours_nn_descent,
    ]
    return {f.__name__: f for f in named}
