"""The corpus pipeline: quality, near duplicates, benchmark passages, personal
data, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``; the last returns the packed pieces of the documents that
are left. Null texts and ids, empty tables and repeated rows pass through as the
operators define it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketgrain.llm import common
from marketgrain.llm import op3_prob_minhash as near
from marketgrain.llm import op4_co_training as quality
from marketgrain.llm import op6_pseudonyms as privacy
from marketgrain.llm import op8_linear_grouping as packing
from marketgrain.llm import op9_latent_semantic as benchmark

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject as low or toxic."""
    labels = common.table(spark, sf_dir, "labels")
    return quality.kept(docs.select(*COLUMNS), labels)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least id."""
    return near.deduplicated(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return benchmark.without_leaks(docs.select(*COLUMNS), common.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses as pseudonyms."""
    return privacy.with_pseudonyms(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the sequences."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        common.ship(spark)
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs


# tokens, registers, trained models: SQL can't express these; tests/llm has brute force
ORACLE_SQL = None
