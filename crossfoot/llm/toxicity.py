"""Toxicity score: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A document's features are the hashed n-grams that occur in it, each scaled by the logarithm of how much likelier it is in
toxic than in other training documents; a logistic model on the scaled features gives the score. Only the model is
fitted on a sample: at most ``max_labelled`` labelled rows, those first in order of a hash of their id. Every document
is scored, on its whole text.

Defined results: NULL and empty texts get the score of a document without features. With no labelled rows, or rows of
one label only, every score is that label's share (0.0 without any row). Repeated rows stay repeated, further columns
are ignored. A label row without a document, or with a NULL label, is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.llm.grams import gram_buckets
from crossfoot.llm.storage import stored

SIZES, BITS = (4, 5), 18


@dataclass(frozen=True)
class ToxicityModel:
    """Weight of each n-gram bucket, with its log-count ratio multiplied in, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        grams = gram_buckets(text or "", SIZES, BITS)
        found = np.unique(grams[self.weights[grams] != 0])
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[found].sum(), -500, 500))))


def labelled_sample(docs: DataFrame, labels: DataFrame, trains: Column, max_labelled: int, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """Texts and labels of at most ``max_labelled`` rows; their ids alone are broadcast, as that number bounds them."""
    key = labels[id_column]
    rows = labels.filter(trains & key.isNotNull() & labels[label_column].isin(0, 1)).select(key.alias("labelled_id"), labels[label_column].cast("int").alias("label"))
    first = rows.orderBy(F.xxhash64("labelled_id"), "labelled_id", "label").limit(max_labelled)
    texts = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    return texts.join(F.broadcast(first), F.col("id") == F.col("labelled_id")).select("id", "text", "label")


def features_per_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of documents with each n-gram, apart for the two labels; bucket -1 counts the documents."""
    seen = np.zeros((2, 1 << BITS), np.int64)
    documents = np.zeros(2, np.int64)
    for batch in batches:
        for text, label in zip(batch.column(1), batch.column(2), strict=True):
            seen[label.as_py(), np.unique(gram_buckets(text.as_py() or "", SIZES, BITS))] += 1
            documents[label.as_py()] += 1
    found = np.flatnonzero(seen.any(axis=0))
    counts = np.concatenate([documents[:, None], seen[:, found]], axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, found]), pa.array(counts[1]), pa.array(counts[0])], names=["bucket", "toxic", "other"])


def fit_logistic(rows: list[np.ndarray], labels: np.ndarray, width: int, scale: np.ndarray, rounds: int, penalty: float, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression on scaled presence features, by full-batch Adam steps."""
    at = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights, moment, spread = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    values = scale[at]
    for step in range(1, rounds + 1):
        margin = weights[-1] + np.bincount(owner, weights[at] * values, len(rows))
        miss = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels
        slope = np.r_[np.bincount(at, miss[owner] * values, width) / len(rows) + penalty * weights[:-1], miss.mean()]
        moment, spread = 0.9 * moment + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
        weights -= rate * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    trains: Column,
    max_labelled: int = 16384,
    max_features: int = 4096,
    min_documents: int = 4,
    rounds: int = 150,
    penalty: float = 1e-3,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> ToxicityModel:
    """Log-count ratios over the sample, the ``max_features`` most telling n-grams of at least ``min_documents``, and the logistic fit on the driver.

    What reaches the driver is bounded by the number of buckets, and by ``max_labelled`` rows of selected features.
    """
    sample = stored(labelled_sample(docs, labels, trains, max_labelled, id_column, text_column, label_column))
    counted = sample.mapInArrow(features_per_label, "bucket long, toxic long, other long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()
    bucket, toxic, other = (counted[c].to_numpy() for c in ("bucket", "toxic", "other"))
    totals = {1: int(toxic[bucket == -1].sum()), 0: int(other[bucket == -1].sum())}
    weights = np.zeros(1 << BITS)
    if not totals[1] or not totals[0]:
        return ToxicityModel(weights, 500.0 if totals[1] else -500.0)
    bucket, toxic, other = bucket[bucket >= 0], toxic[bucket >= 0], other[bucket >= 0]
    ratio = np.log((toxic + 1) / (totals[1] + 2)) - np.log((other + 1) / (totals[0] + 2))
    common = toxic + other >= min_documents
    bucket, ratio, telling = bucket[common], ratio[common], (np.abs(ratio) * np.sqrt(toxic + other))[common]
    chosen = np.lexsort((bucket, -telling))[:max_features]
    slot = np.full(1 << BITS, -1)
    slot[bucket[chosen]] = np.arange(len(chosen))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slot[np.unique(gram_buckets(text.as_py() or "", SIZES, BITS))] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([f[f >= 0].tolist() for f in found], pa.list_(pa.int32()))], names=["id", "label", "found"])

    schema = T.StructType([sample.schema["id"], sample.schema["label"], T.StructField("found", T.ArrayType(T.IntegerType()))])
    rows = sample.mapInArrow(select, schema).toArrow().sort_by([("id", "ascending"), ("label", "ascending")])
    features = [np.array(f, np.int64) for f in rows["found"].to_pylist()]
    fitted, bias = fit_logistic(features, rows["label"].to_numpy().astype(float), len(chosen), ratio[chosen], rounds, penalty)
    weights[bucket[chosen]] = fitted * ratio[chosen]
    return ToxicityModel(weights, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id and score from 0 to 1. No shuffle."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(docs[id_column], docs[text_column]).mapInArrow(score, schema)
