"""A quality classifier out of two compression dictionaries.

One zstandard dictionary is trained on texts labelled good, one on texts
labelled bad. A text is compressed with both, in pieces of a few kilobytes so
that the dictionaries count in long texts as well. The difference of the two
sizes over their sum, how far the text shrinks, and its length go through a
logistic calibration fitted on labelled texts that are in neither dictionary.

The model is fitted on a bounded sample of the labelled rows: at most
``most_texts`` of each label, evenly spread by a hash of doc_id, of at most
``most_chars`` characters each. Scoring reads every text in full and moves none.

Cases: null and empty texts get the score of an empty text; null and repeated
doc_ids are scored like others and never learned from if null; a document with
contradicting labels is not learned from. Without texts of both labels, the score
is the share of label 1 among what there is, or 0.5. Labels of documents that are
not there play no part, nor do other columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwarden.llm.rows import arrow_map, pieces

MOST_TEXTS = 3000
MOST_CHARS = 50_000
DICTIONARY_BYTES = 112_640
PIECE_BYTES = 2048
LEVEL = 3
SEED = 29


@dataclass(frozen=True)
class QualityModel:
    """``dictionaries`` of good and bad texts, and the calibration; without them ``share`` is the score."""

    share: float
    dictionaries: tuple[tuple[bytes, int], ...] = ()
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    weights: np.ndarray | None = None


class Scorer:
    def __init__(self, model: QualityModel):
        self.model = model
        self.compressors = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=_ready(data, kind),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for data, kind in model.dictionaries
        ]

    def features(self, texts: list[str | None]) -> np.ndarray:
        sizes = np.empty((len(texts), 3))
        for i, text in enumerate(texts):
            data = (text or "").encode()
            parts = [data[a : a + PIECE_BYTES] for a in range(0, max(1, len(data)), PIECE_BYTES)]
            sizes[i] = [*(sum(len(c.compress(p)) for p in parts) for c in self.compressors), len(data)]
        good, bad, length = sizes.T
        difference = (bad - good) / (bad + good)
        shrunk = np.log((bad + good) / 2 / np.maximum(1, length))
        size = np.log(length + 50)
        return np.stack(
            [difference, shrunk, shrunk * shrunk, size, shrunk * size, difference * size], axis=1
        )

    def scores(self, texts: list[str | None]) -> np.ndarray:
        model = self.model
        if not model.dictionaries:
            return np.full(len(texts), model.share)
        x = _scaled(np.clip(self.features(texts), model.low, model.high), model.low, model.high)
        return 1 / (1 + np.exp(-np.clip(x @ model.weights, -40, 40)))


def _ready(data: bytes, kind: int) -> zstandard.ZstdCompressionDict:
    dictionary = zstandard.ZstdCompressionDict(data, dict_type=kind)
    dictionary.precompute_compress(level=LEVEL)
    return dictionary


def _scaled(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    span = np.where(high > low, high - low, 1)
    return np.concatenate([np.ones((len(x), 1)), (x - low) / span * 4 - 2], axis=1)


def _dictionary(texts: list[str]) -> tuple[bytes, int]:
    samples = [
        data[a : a + PIECE_BYTES]
        for data in (text.encode() for text in texts)
        for a in range(0, len(data), PIECE_BYTES)
    ]
    try:
        return (
            zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes(),
            zstandard.DICT_TYPE_FULLDICT,
        )
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"\n".join(samples)[-DICTIONARY_BYTES:] or b"\n", zstandard.DICT_TYPE_RAWCONTENT


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, most_texts: int = MOST_TEXTS, most_chars: int = MOST_CHARS
) -> QualityModel:
    """Learn from the documents that have a label; ``labels`` holds those that may be learned from."""
    agreed = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .where("quality = _most")
        .select("doc_id", "quality")
    )
    totals = {r["quality"]: r["count"] for r in agreed.groupBy("quality").count().collect()}
    if not totals:
        return QualityModel(0.5)
    share = F.when(
        F.col("quality") == 1, F.lit(most_texts / max(1, totals.get(1, 0)))
    ).otherwise(F.lit(most_texts / max(1, totals.get(0, 0))))
    place = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Some more than asked for, since texts may be missing or too long; at most a few thousand ids.
    chosen = agreed.where(place < share * 1.2).withColumn("_place", place)
    rows = (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull() & (F.length("text") <= most_chars))
        .join(F.broadcast(chosen), "doc_id")
        # One text for each doc_id, however many rows have it, so that the chosen ids bound what is collected.
        .groupBy("quality", "_place", "doc_id")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: (r["_place"], r["doc_id"], r["text"]))
    texts = {q: [r["text"] for r in rows if r["quality"] == q][:most_texts] for q in (1, 0)}
    if min(map(len, texts.values())) < 4:
        return QualityModel(totals.get(1, 0) / sum(totals.values()))
    dictionaries = tuple(_dictionary(texts[q][::2]) for q in (1, 0))
    scorer = Scorer(QualityModel(0.5, dictionaries))
    x = np.concatenate([scorer.features(texts[q][1::2]) for q in (1, 0)])
    y = np.concatenate([np.full(len(texts[q][1::2]), float(q)) for q in (1, 0)])
    # Weights undo that both labels are sampled up to the same number.
    weight = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
    low, high = x.min(axis=0), x.max(axis=0)
    weights = _logistic(_scaled(x, low, high), y, weight / weight.mean())
    return QualityModel(0.5, dictionaries, low, high, weights)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weighted logistic regression by Newton steps, halved while they do not help."""

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * b @ b)

    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge * b)
        while np.abs(step).max() > 1e-9 and loss(b + step) > loss(b):
            step /= 2
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id`` and the score of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in pieces(batches, 2 << 20):
            scores = scorer.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), score, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: QualityModel, least: float = 0.5) -> DataFrame:
    """The documents with at least this score, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in pieces(batches, 2 << 20):
            yield batch.filter(pa.array(scorer.scores(batch.column(at).to_pylist()) >= least))

    return arrow_map(docs, keep, docs.schema)
