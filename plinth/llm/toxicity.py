"""Toxicity: a linear classifier on hashed character n-grams scaled by naive Bayes log-count ratios.

The features of a text are the buckets its lower-cased n-grams fall into, present or not. A bucket
counts if its log-count ratio between toxic and other training texts is clear; the ratio is the
feature's value and a logistic regression learns the weights.

Defined cases: null and empty texts get the score of a text without any feature; a null id is held
out or not by the empty text's checksum; equal texts get equal scores. Without a training row of
each class every score is the share of toxic rows, 0 if there are none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.batches import documents, joined, pieces, remainder, utf8
from plinth.llm.features import char_grams, fit_logistic, sigmoid
from plinth.llm.sampling import collected, labelled_ids, stored_features

#: The fit uses at most so many labelled documents; scoring covers all.
TRAIN_ROWS = 6000
SIZES = (3, 4, 5, 6)
BITS = 18
#: A bucket is a feature if its log-count ratio is at least this far from 0, in so many texts.
MIN_RATIO, MIN_TEXTS = 1.0, 3
PENALTY = 1e-3
HELD_OUT = 5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per bucket, ratio included
    bias: float


def _prepared(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return joined([b" " + t.lower() + b" " for t in texts])


def present(texts: list[bytes], wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For pieces of the batch: first row, and the distinct (row, bucket) pairs, if ``wanted[bucket]``."""
    for lo, hi in pieces(texts):
        buf, starts, ends = _prepared(texts[lo:hi])
        owner = np.repeat(np.arange(hi - lo, dtype=np.int64), ends - starts + 1)
        keys = []
        for _, buckets, inside in char_grams(buf, ends, SIZES, BITS):
            kept = inside if wanted is None else inside & wanted[buckets]
            at = np.flatnonzero(kept)
            keys.append(np.unique((owner[at] << BITS) | buckets[at]))
        pairs = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        yield lo, pairs >> BITS, pairs & ((1 << BITS) - 1)


def _features(texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    for lo, rows, buckets in present(texts):
        cuts = np.searchsorted(rows, np.arange(rows[-1] + 2 if len(rows) else 1))
        for i in range(len(cuts) - 1):
            out[lo + i] = buckets[cuts[i]:cuts[i + 1]]
    return out, [np.zeros(0)] * len(texts)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", *, rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample of the labelled rows given, of both classes alike as far as there are rows."""
    chosen, shift = labelled_ids(docs, labels, doc_id, label, rows)
    sample = stored_features(docs, chosen, doc_id, text, _features)
    n, n_toxic, texts, toxic = _counts(sample)
    if not 0 < n_toxic < n:
        return Model(np.zeros(1 << BITS, np.float32), 500.0 if n_toxic else -500.0)
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((texts - toxic + 1) / (n - n_toxic + 2))
    wanted = (np.abs(ratio) >= MIN_RATIO) & (texts >= MIN_TEXTS)
    # only the features come to the driver
    y, buckets, _ = collected(_only(sample, wanted))
    y = np.array([1.0 if v else 0.0 for v in y])
    owner = np.repeat(np.arange(len(y)), [len(b) for b in buckets])
    cols = np.concatenate(buckets)
    place = np.cumsum(wanted) - 1
    w, b = fit_logistic(owner, place[cols], ratio[cols], y, int(wanted.sum()), PENALTY)
    weights = np.zeros(1 << BITS, np.float32)
    weights[wanted] = w * ratio[wanted]
    return Model(weights, b + shift)


def _counts(sample: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Sampled texts, toxic ones, and how many of each have each bucket; summed in a few tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for label, buckets in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n[int(bool(label))] += 1
                seen[int(bool(label)), np.frombuffer(buckets, "<i4")] += 1
        yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary()), pa.array([seen.tobytes()], pa.binary())], ["n", "seen"])

    n, seen = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.int64)
    for row in sample.coalesce(8).mapInArrow(run, "n binary, seen binary").collect():
        n += np.frombuffer(row["n"], np.int64)
        seen += np.frombuffer(row["seen"], np.int32).reshape(2, -1)
    return int(n.sum()), int(n[1]), seen.sum(0), seen[1]


def _only(sample: DataFrame, wanted: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = [np.frombuffer(b, "<i4") for b in batch.column(2).to_pylist()]
            kept = pa.array([b[wanted[b]].tobytes() for b in buckets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), kept, batch.column(3)], batch.schema.names)

    return sample.mapInArrow(run, sample.schema)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    weights, bias, wanted = model.weights, model.bias, model.weights != 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(2))
            total = np.zeros(len(texts))
            for lo, rows, buckets in present(texts, wanted):
                sums = np.bincount(rows, weights[buckets].astype(np.float64))
                total[lo:lo + len(sums)] += sums
            p = sigmoid(total + bias)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), (remainder(doc_id, HELD_OUT) == 0).alias("held_out"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fit(docs, labels.where(remainder("doc_id", HELD_OUT) != 0)))
