"""Quality rules: exact counts per text, and a calibrated classifier on hashed n-grams.

The features of a text are the shares its character and word n-grams have in hashed buckets. A
logistic regression learns their weights on labelled rows; a second one, on rows kept apart, maps
its margin to a probability. A text is kept if it passes the base rules and its probability
reaches the fixed threshold.

Defined cases: a null or empty text has no words and fails the base rules; equal texts get equal
results; ids may be null or repeat. Without labelled rows of both kinds the base rules decide.
Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.batches import SPACE, U64, documents, group_sums, joined, mix, pieces, runs, span_hashes, table, utf8
from plinth.llm.features import char_grams, fit_logistic, sigmoid
from plinth.llm.sampling import collected, labelled_ids, stored_features

#: The fit uses at most so many labelled documents; every fourth of them calibrates.
TRAIN_ROWS = 2000
CALIBRATES = 4
CHAR_SIZES, WORD_SIZES = (2, 3, 4), (1, 2)
BITS = 17
MIN_TEXTS = 3
SCALE, PENALTY, STEPS = 10.0, 1e-5, 100
#: Kept from this probability on.
KEEP_FROM = 0.5

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
SYMBOLS = table(b"#*$%&|<>")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


class Piece:
    """The words of some texts in one byte array."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.buf, self.starts, self.ends = joined(texts, b"\n")
        self.word_starts, self.word_ends = runs(~SPACE[self.buf])
        self.first = np.searchsorted(self.word_starts, self.starts)
        self.last = np.searchsorted(self.word_starts, self.ends)
        self.owner = np.repeat(np.arange(len(texts)), self.last - self.first)
        self.hashes = span_hashes(self.buf, self.word_starts, self.word_ends)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per kind of n-gram: buckets in text order, and each text's first and last place in them."""
        for n, buckets, inside in char_grams(self.buf, self.ends, CHAR_SIZES, BITS):
            yield buckets, np.minimum(self.starts, len(buckets)), np.minimum(np.maximum(self.ends - n + 1, self.starts), len(buckets))
        for n in WORD_SIZES:
            h = self.hashes[:max(len(self.hashes) - n + 1, 0)]
            for k in range(1, n):
                h = mix(h * U64(31) + self.hashes[k:len(h) + k])
            place = np.minimum(self.first, len(h))
            yield (h >> U64(64 - BITS)).astype(np.int32), place, np.minimum(np.maximum(self.last - n + 1, place), len(h))

    def repeat_words(self) -> np.ndarray:
        """Per text, words inside 8-word windows that the text has twice or more."""
        n = len(self.hashes) - WINDOW + 1
        if n <= 0:
            return np.zeros(len(self.texts), np.int64)
        # the text's number goes into the hash, so only windows of one text meet
        h = mix(self.owner[:n].astype(U64) + U64(0x9E37))
        for k in range(WINDOW):
            h = mix(h * U64(0x100000001B3) + self.hashes[k:k + n])
        whole = self.owner[:n] == self.owner[WINDOW - 1:]
        ordered = np.sort(h[whole])
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        step = np.zeros(len(self.hashes) + 1, np.int32)
        if len(twice):
            at = np.searchsorted(twice, h)
            hit = np.flatnonzero(whole & (twice[np.minimum(at, len(twice) - 1)] == h))
            step[hit] += 1
            step[hit + WINDOW] -= 1
        covered = (np.cumsum(step[:-1]) > 0).astype(np.int64)
        return group_sums(covered, self.first, self.last)


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def base_counts(piece: Piece) -> dict[str, np.ndarray]:
    characters = (~SPACE[piece.buf] & ((piece.buf & 0xC0) != 0x80)).astype(np.int64)
    symbols = SYMBOLS[piece.buf].astype(np.int64)
    return {
        "n_words": piece.last - piece.first,
        "word_chars": group_sums(characters, piece.starts, piece.ends),
        "n_symbols": group_sums(symbols, piece.starts, piece.ends),
        "n_dup_lines": np.fromiter(map(duplicate_lines, piece.texts), np.int64, len(piece.texts)),
        "n_repeat_words": piece.repeat_words(),
    }


def _features(texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    buckets, values = [], []
    for text in texts:
        total = np.zeros(1 << BITS)
        for found, first, last in Piece([text]).grams():
            own = found[first[0]:last[0]]
            total += np.bincount(own, minlength=1 << BITS) / max(len(own), 1)
        at = np.flatnonzero(total)
        buckets.append(at)
        values.append(total[at] * SCALE)
    return buckets, values


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", *, rows: int = TRAIN_ROWS) -> Model | None:
    """Fit and calibrate on a bounded sample of labelled rows; None without both kinds of rows."""
    chosen, shift = labelled_ids(docs, labels, doc_id, label, rows)
    y, buckets, values = collected(stored_features(docs, chosen, doc_id, text, _features))
    y = np.array([1.0 if v else 0.0 for v in y])
    apart = np.arange(len(y)) % CALIBRATES == CALIBRATES - 1
    if not len(y) or len(set(y[~apart])) < 2:
        return None
    texts = np.zeros(1 << BITS, np.int32)
    for i in np.flatnonzero(~apart):
        texts[buckets[i]] += 1
    wanted = texts >= MIN_TEXTS
    kept = [wanted[b] for b in buckets]
    cols = np.concatenate([b[k] for b, k in zip(buckets, kept)])
    shares = np.concatenate([v[k] for v, k in zip(values, kept)])
    owner = np.repeat(np.arange(len(y), dtype=np.int32), [int(k.sum()) for k in kept])
    place, row = np.cumsum(wanted, dtype=np.int32) - 1, np.cumsum(~apart, dtype=np.int32) - 1
    at = ~apart[owner]
    w, bias = fit_logistic(row[owner[at]], place[cols[at]], shares[at], y[~apart], int(wanted.sum()), PENALTY, STEPS)
    weights = np.zeros(1 << BITS)
    weights[wanted] = w
    margin = bias + np.bincount(owner, shares * weights[cols], len(y))[apart]
    if len(set(y[apart])) < 2:
        return Model(weights.astype(np.float32), bias, 1.0, shift)
    n = int(apart.sum())
    slope, offset = fit_logistic(np.arange(n), np.zeros(n, int), margin, y[apart], 1, 1e-3, 300)
    return Model(weights.astype(np.float32), bias, float(slope[0]), offset + shift)


def probabilities(piece: Piece, model: Model) -> np.ndarray:
    margin = np.full(len(piece.texts), model.bias)
    for buckets, first, last in piece.grams():
        sums = group_sums(model.weights[buckets].astype(np.float64), first, last)
        margin += SCALE * sums / np.maximum(last - first, 1)
    return sigmoid(model.slope * margin + model.offset)


def judge(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed, kept and probability for each row."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            columns = {n: np.zeros(len(texts), np.int64) for n in names}
            p = np.ones(len(texts))
            for lo, hi in pieces(texts):
                piece = Piece(texts[lo:hi])
                for name, values in base_counts(piece).items():
                    columns[name][lo:hi] = values
                if model is not None:
                    p[lo:hi] = probabilities(piece, model)
            failed = (columns["n_words"] < MIN_WORDS) | (100 * columns["n_repeat_words"] > MAX_REPEATED_PERCENT * columns["n_words"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(columns[n]) for n in names], pa.array(failed), pa.array(~failed & (p >= KEEP_FROM)), pa.array(p)],
                ["doc_id", *names, "base_failed", "kept", "probability"],
            )

    counts = ", ".join(f"{n} long" for n in names)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, {counts}, base_failed boolean, kept boolean, probability double")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
