"""Bounded samples of labelled rows, to fit classifiers on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.batches import pieces, utf8
from plinth.session import new_dir

SEED = 20240229
#: Parts of a class that are ranked apart before they meet.
PARTS = 64


def labelled_ids(docs: DataFrame, labels: DataFrame, doc_id: str, label: str, rows: int) -> tuple[DataFrame, float]:
    """_id, _label (0 or 1) of at most ``rows`` labelled documents, and what the sample does to log odds.

    Labels other than 0 are 1; a document labelled twice takes its largest label; rows without an id
    or label, and ids that ``docs`` does not have, are left out. A rare class comes in whole as far as
    it fits into half of the rows. The number returned is to be added to the log odds of a
    classifier fitted on the sample, so that they are those of all labelled documents.
    """
    once = _largest_label(labels, doc_id, label).select("_id", (F.col("_label").cast("double") != 0).cast("int").alias("_label"))
    known = once.join(docs.select(F.col(doc_id).alias("_known")), F.col("_id") == F.col("_known"), "left_semi")
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}  # two rows
    few = min(counts.get(k, 0) for k in (0, 1))
    per_class = max(rows // 2, rows - few)
    shift = 0.0
    if few:
        taken = {k: min(n, per_class) for k, n in counts.items()}
        shift = float(np.log(counts[1] / counts[0]) - np.log(taken[1] / taken[0]))
    return _by_class(known, per_class), shift


def ids_by_class(docs: DataFrame, doc_id: str, label: str, per_class: int) -> DataFrame:
    """_id, _label of at most ``per_class`` documents of each class, chosen by a hash of the id."""
    return _by_class(_largest_label(docs, doc_id, label), per_class)


def _largest_label(docs: DataFrame, doc_id: str, label: str) -> DataFrame:
    known = docs.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))


def _by_class(once: DataFrame, per_class: int) -> DataFrame:
    # planned as group limits on both sides of the shuffles: first per class and part, so that a
    # hot class is ranked in many tasks, then per class over the few rows that are left
    hashed = once.withColumn("_hash", F.xxhash64("_id", F.lit(SEED))).withColumn("_part", F.pmod("_hash", F.lit(PARTS)))
    for keys in (["_label", "_part"], ["_label"]):
        order = Window.partitionBy(*keys).orderBy("_hash", "_id")
        hashed = hashed.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_class)
    return hashed.select("_id", "_label")


Extract = Callable[[list[bytes]], tuple[list[np.ndarray], list[np.ndarray]]]


def stored_features(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str, extract: Extract) -> DataFrame:
    """_id, _label, _buckets, _values of the chosen documents, written to the shared folder.

    ``chosen`` is bounded by the caller's sample size, hence also what is broadcast and collected:
    a document brings at most one entry per bucket. Of repeated rows of a document one counts.
    """
    label_type = chosen.schema["_label"].dataType.simpleString()
    id_type = chosen.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(2))
            for lo, hi in pieces(texts):
                buckets, values = extract(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array([b.astype("<i4").tobytes() for b in buckets], pa.binary()),
                     pa.array([v.astype("<f4").tobytes() for v in values], pa.binary())],
                    ["_id", "_label", "_buckets", "_values"],
                )

    rows = docs.select(F.col(doc_id).alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), F.col("_key") == F.col("_id")
    ).select("_id", "_label", "_text").groupBy("_id").agg(F.max("_label").alias("_label"), F.max("_text").alias("_text"))
    schema = f"_id {id_type}, _label {label_type}, _buckets binary, _values binary"
    path = new_dir(docs.sparkSession, "sample")
    rows.mapInArrow(run, schema).write.parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def collected(features: DataFrame) -> tuple[list, list[np.ndarray], list[np.ndarray]]:
    """Labels, buckets and values on the driver, in the order of ids."""
    found = features.toArrow()
    order = np.argsort(np.array(found.column("_id").to_pylist()), kind="stable") if len(found) else []
    labels = found.column("_label").to_pylist()
    buckets, values = found.column("_buckets"), found.column("_values")
    return (
        [labels[i] for i in order], [np.frombuffer(buckets[i].as_buffer(), "<i4") for i in order],
        [np.frombuffer(values[i].as_buffer(), "<f4") for i in order],
    )
