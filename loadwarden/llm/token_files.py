"""Token ids in files of coded blocks.

A token folder holds three tables. ``frequencies`` has how often each id occurs
in all documents. ``blocks`` has the documents in ascending order of doc_id,
cut at documents into blocks of about a million ids, each coded by the shared
frequencies with a range asymmetric numeral system: the stream, the decoder's
checkpoints (states and words per segment), the documents' ids and lengths, and
a checksum of the token ids. ``parts`` has where each part of the order begins.
Any block is decoded without another one, and inside a block all segments at once.

Tokenizing is done once; ids go through one range shuffle in compressed form.
The frequencies are bounded by the vocabulary, the parts by their parameter.

Cases: a null or empty text is its end id alone; null doc_ids come first and
repeated ones lie side by side; without documents the tables are empty; columns
besides doc_id and text are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadwarden.llm.rans import Coder, scaled
from loadwarden.llm.rows import ROW_ID, arrow_map, pieces, row_id, stored
from loadwarden.llm.tokens import loaded, with_end

BLOCK_IDS = 1 << 20
PART_IDS = 1 << 23
MOST_PARTS = 20_000


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, number of ids and the ids, compressed, in the order of ``docs``."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, pack = loaded(tokenizer_path), zstandard.ZstdCompressor(level=1)
        for batch in pieces(batches, 4 << 20):
            ids, bounds = with_end(*tokenizer.encode(batch.column("text")), end_id)
            ids = ids.astype("<u4") if tokenizer.vocabulary > 1 << 16 else ids.astype("<u2")
            data = [pack.compress(ids[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
            columns = [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), encode, f"doc_id {kind}, n_tokens bigint, ids binary")


def _unpacked(batch: pa.RecordBatch, wide: bool) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    data = b"".join(unpack.decompress(x) for x in batch.column("ids").to_pylist())
    return np.frombuffer(data, "<u4" if wide else "<u2")


def id_counts(ids: DataFrame, vocabulary: int) -> DataFrame:
    """How often each id occurs, counted in every task before they are added up."""
    wide = vocabulary > 1 << 16

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in pieces(batches, 1 << 20):
            counts += np.bincount(_unpacked(batch, wide), minlength=vocabulary)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    counted = arrow_map(ids.select("ids"), count, "id bigint, n bigint")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def in_order(ids: DataFrame, parts: int) -> DataFrame:
    """Ids of documents in ascending order of doc_id, in parts of about as many rows each.

    Documents with equal or null ids are ordered by their number of ids, by a hash of them and by row, so
    that a third of all rows with one id, or with one text, is more than one part.
    """
    order = ["doc_id", "n_tokens", "hash", ROW_ID]
    return (
        ids.select("doc_id", "n_tokens", "ids", F.xxhash64("ids").alias("hash"), row_id().alias(ROW_ID))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "n_tokens", "ids")
    )


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    *,
    end_id: int,
    block_ids: int = BLOCK_IDS,
    part_ids: int = PART_IDS,
) -> None:
    """Write the token folder of all documents."""
    vocabulary = max(loaded(tokenizer_path).vocabulary, end_id + 1)
    ids = stored(tokenized(docs, tokenizer_path, end_id), "token-ids")
    id_counts(ids, vocabulary).coalesce(1).write.parquet(f"{folder}/frequencies")
    total = ids.agg(F.sum("n_tokens")).first()[0] or 0
    coder_of = _coder(docs.sparkSession, folder, vocabulary)
    names = ["part", "block", "doc_ids", "lengths", "n_ids", "stream", "states", "words", "checksum"]

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, block = coder_of(), TaskContext.get().partitionId(), 0
        keys, lengths, parts, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            data = np.concatenate(parts).astype("<u4")
            stream, states, words = coder.encode(data)
            of_docs = pa.concat_arrays(keys)
            values = [[part], [block], None, [np.concatenate(lengths)], [len(data)], [stream], [states], [words]]
            columns = [pa.array(v) for v in values if v is not None] + [pa.array([zlib.crc32(data)], pa.int64())]
            columns.insert(2, pa.ListArray.from_arrays(pa.array([0, len(of_docs)], pa.int32()), of_docs))
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in pieces(batches, 1 << 18):
            keys.append(batch.column("doc_id"))
            lengths.append(batch.column("n_tokens").to_numpy())
            parts.append(_unpacked(batch, vocabulary > 1 << 16))
            held += len(parts[-1])
            if held >= block_ids:
                yield row()
                block += 1
                keys, lengths, parts, held = [], [], [], 0
        if held:
            yield row()

    kind = docs.schema["doc_id"].dataType.simpleString()
    n_parts = min(max(total // part_ids, docs.sparkSession.sparkContext.defaultParallelism), MOST_PARTS)
    blocks = arrow_map(
        in_order(ids, int(n_parts)),
        code,
        f"part bigint, block bigint, doc_ids array<{kind}>, lengths array<bigint>, n_ids bigint,"
        " stream binary, states binary, words binary, checksum bigint",
    )
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    order = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    (
        docs.sparkSession.read.parquet(f"{folder}/blocks")
        .groupBy("part", "block")
        .agg(F.sum("n_ids").alias("n_ids"))
        .groupBy("part")
        .agg(
            F.sum("n_ids").alias("n_ids"),
            F.transform(F.sort_array(F.collect_list(F.struct("block", "n_ids"))), lambda x: x["n_ids"]).alias("sizes"),
        )
        .select("part", "sizes", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("start"))
        .write.parquet(f"{folder}/parts")
    )


def _coder(spark: SparkSession, folder: str, vocabulary: int):
    """A function that gives a task its coder; the table it carries is bounded by the vocabulary."""
    counts = np.zeros(vocabulary, np.int64)
    for row in spark.read.parquet(f"{folder}/frequencies").collect():
        counts[row["id"]] = row["n"]
    frequencies = spark.sparkContext.broadcast(scaled(counts))
    return lambda: Coder(frequencies.value)


def read_tokens(spark: SparkSession, folder: str, vocabulary: int) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before), n_tokens, and the ids
    as little-endian unsigned 32-bit integers. A block whose checksum is wrong is an error."""
    coder_of = _coder(spark, folder, vocabulary)
    names = ["doc_id", "start", "n_tokens", "ids"]

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of()
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i].as_py()
                ids = coder.decode(get("stream"), get("states"), get("words"), get("n_ids")).astype("<u4")
                if zlib.crc32(ids) != get("checksum"):
                    raise ValueError(f"block {get('part')}/{get('block')} is damaged")
                lengths = batch.column("lengths")[i].values.to_numpy()
                ends = np.cumsum(lengths)
                data = [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [
                    batch.column("doc_ids")[i].values,
                    pa.array(get("start") + ends - lengths),
                    pa.array(lengths),
                    pa.array(data, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    parts = spark.read.parquet(f"{folder}/parts")
    blocks = spark.read.parquet(f"{folder}/blocks").join(parts, "part")
    before = F.aggregate(F.slice("sizes", F.lit(1), F.col("block").cast("int")), F.col("start"), lambda a, x: a + x)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return arrow_map(
        blocks.withColumn("start", before).drop("sizes"),
        decode,
        f"doc_id {kind}, start bigint, n_tokens bigint, ids binary",
    )
