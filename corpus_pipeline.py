"""Documents to packed training sequences, in stages that are each stored as Parquet."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loadwarden.llm.minhash import drop_near_duplicates
from loadwarden.llm.mixing import mix_documents
from loadwarden.llm.packing import pack_documents
from loadwarden.llm.quality import fit_quality, keep_good
from loadwarden.llm.rows import stored
from loadwarden.llm.secrets import redact_secrets
from loadwarden.sources import read_parquet

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are likelier good than bad, learned from all labels.

    Null and empty texts are scored like others; null and repeated doc_ids are rows like any; a label
    without a document, or with two qualities, teaches nothing.
    """
    labels = read_parquet(spark, f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit_quality(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id, null last.

    Null, empty and blank texts are in no group and stay; of rows that are alike the first stays.
    """
    return drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; null texts stay null."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of documents as the mix of sources takes them; one that it repeats is a row each time.

    A null source is one of its own. Texts without a word have no block, so their rows end here.
    """
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all packed sequences, with their token ids; no documents give no pieces.

    The workers come from earlier stages, and what is left of an executor's memory is little.
    """
    return pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), words_kept=100_000, piece_bytes=1 << 20
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("mix", mix),
    ("pack", pack),
]

#: A classifier fitted on compressed sizes and a tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last one's rows."""
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
