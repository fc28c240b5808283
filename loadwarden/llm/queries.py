"""The operators of this package as queries over the test tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwarden.llm import (
    chat_format,
    collocations,
    fingerprints,
    language,
    minhash,
    mixing,
    packing,
    prefix_trie,
    quality,
    secrets,
    substring_dedup,
    token_files,
    vectors,
)
from loadwarden.llm.splits import held_out
from loadwarden.llm.sql import CHAT_SQL, COLLOCATIONS_SQL, MIXING_SQL, SECRETS_SQL, TRIE_SQL, VECTORS_SQL
from loadwarden.llm.tokens import loaded
from loadwarden.scratch import scratch_path
from loadwarden.sources import read_parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


@_query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages and whole lines of all documents that repeat earlier ones, unit by unit."""
    return substring_dedup.find_repeats(_table(spark, sf_dir, "documents"), whole_lines=True)


@_query(SECRETS_SQL)
def op2_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in all documents."""
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = [rule.kind for rule in secrets.BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(secrets.joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias(
            "base_sha256"
        ),
        secrets.joined(F.col("spans")).alias("spans"),
    )


@_query()
def op3_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    docs = _table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@_query(VECTORS_SQL)
def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with their links and the smallest vector that links lead to."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


@_query()
def op5_score_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents, learned from the labels outside the held-out third."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels.where(~held_out(F.col("doc_id"))))
    return quality.score_quality(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query()
def op6_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those outside the held-out third."""
    docs = _table(spark, sf_dir, "documents")
    model = language.fit_language(docs.where(~held_out(F.col("doc_id"))))
    return language.identify_language(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@_query()
def op7_fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprint_neighbours(_table(spark, sf_dir, "documents"))


@_query(MIXING_SQL)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed at weights 5, 2, 1 in turn; what the mix takes of each."""
    sizes = mixing.measured(_table(spark, sf_dir, "documents"))
    targets = mixing.source_targets(sizes)
    return mixing.taken_words(sizes, targets, mixing.mix_blocks(sizes, targets))


@_query()
def op9_write_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of all documents, written as coded blocks and read back."""
    tokenizer, folder = public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), tokenizer, folder, end_id=2)
    read = token_files.read_tokens(spark, folder, loaded(tokenizer).vocabulary)
    return read.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@_query()
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the smallest document that near-duplicate links lead to."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query(TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all conversations, each with the first turns of the one its hundred begins with."""
    return prefix_trie.rebuilt_trie(_table(spark, sf_dir, "conversations"))


@_query(CHAT_SQL)
def op12_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, as token ids; what the ids say when read back."""
    said = r"\### Assistant: </turn> ok"
    tricky = spark.range(0, 2, 1, 1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(tricky)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return chat_format.read_digests(chat_format.format_conversations(conversations, tokenizer), tokenizer)


@_query(COLLOCATIONS_SQL)
def op13_mine_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of all documents whose words belong together, the best of each language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))
