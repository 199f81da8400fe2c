"""Language identification by error-correcting output codes.

Every language has a codeword; a binary classifier per bit, linear on hashed byte n-grams of the
letters, predicts it. Decoding sums each bit's loss against every codeword, weighted by how
reliable the bit is, and takes the nearest one; a small lead over the next marks the text as
ambiguous.

Defined cases: a null text, or one without any letter, is ``und`` with score 0; so is every text
if no language was learned. A null id is held out or not by the empty text's checksum. With one
language learned, every text with a letter is in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.batches import documents, joined, let_go, parts, pieces, remainder, ship, utf8
from plinth.llm.features import char_grams, sigmoid
from plinth.llm.sampling import SEED, collected, ids_by_class, stored_features

#: The fit uses at most so many documents of a language, and so many in all; where languages are
#: many, each is left its share of the latter, but never fewer than the last.
ROWS_PER_LANGUAGE, ROWS, FEWEST = 300, 4000, 5
SIZES = (1, 2, 3)
BITS = 13
#: Up to this many languages every split of them is a bit; beyond, bits are drawn.
EXHAUSTIVE = 5
STEPS, RATE, PENALTY, SCALE = 150, 0.1, 1e-5, 30.0
#: A text whose lead over the next codeword is below this share of the bits' total weight is ambiguous.
LEAD = 0.02
UNKNOWN = "und"
HELD_OUT, HELD_OUT_AT = 4, 2


def codewords(k: int) -> np.ndarray:
    """k codewords of +1 and -1, no two bits alike or opposite, none constant."""
    if k < 2:
        return np.ones((k, 0))
    if k <= EXHAUSTIVE:
        bits = [[1 - 2 * ((n >> (k - 1 - c)) & 1) for c in range(k)] for n in range(1, 1 << (k - 1))]
        return np.array(bits, float).T
    # a bit and its opposite are one split, of which there are enough from six languages on
    rng, width = np.random.default_rng(SEED), min(int(np.ceil(12 * np.log2(k))), (1 << (k - 1)) - 1)
    best, best_gap = np.ones((k, 0)), -1.0
    for _ in range(50):
        bits: dict[bytes, np.ndarray] = {}
        while len(bits) < width:
            bit = rng.choice([-1.0, 1.0], k)
            bit *= bit[0]
            if (bit < 0).any():
                bits[bit.tobytes()] = bit
        code = np.stack(list(bits.values()), 1)
        distance = (width - code @ code.T) / 2 + np.eye(k) * width
        if distance.min() > best_gap:
            best, best_gap = code, distance.min()
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit's loss


# letters of ASCII in lower case; everything else of ASCII is a space
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)


def _folded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buf, starts, ends = joined([b" " + t + b" " for t in texts])
    return _FOLD[buf], starts, ends


def _features(texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Share of each bucket among the n-grams of a text."""
    buckets, values = [], []
    for text in texts:
        buf, _, ends = _folded([text])
        total = np.zeros(1 << BITS)
        for _, found, inside in char_grams(buf, ends, SIZES, BITS):
            total += np.bincount(found[inside], minlength=1 << BITS)
        at = np.flatnonzero(total)
        buckets.append(at)
        values.append(total[at] / max(total.sum(), 1))
    return buckets, values


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    """Fit on a bounded sample of ``docs`` for each of their languages."""
    named = docs.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).select(label).distinct().count()
    share = min(ROWS_PER_LANGUAGE, max(ROWS // max(named, 1), FEWEST))
    chosen = ids_by_class(docs, doc_id, label, share)
    labels, buckets, values = collected(stored_features(docs, chosen, doc_id, text, _features))
    languages = sorted(set(labels))
    code = codewords(len(languages))
    bits = code.shape[1]
    if not bits:
        return Model(languages, code, np.zeros((1 << BITS, 0), np.float32), np.zeros(0), np.zeros(0))
    x = np.zeros((len(labels), 1 << BITS), np.float32)
    for i, (b, v) in enumerate(zip(buckets, values)):
        x[i, b] = v * SCALE
    y = code[[languages.index(c) for c in labels]]
    w, bias = np.zeros((1 << BITS, bits), np.float32), np.zeros(bits)
    m1 = m2 = np.zeros_like(w)
    for k in range(1, STEPS + 1):
        slope = -y * sigmoid(-y * (x @ w + bias)) / len(labels)
        g = x.T @ slope.astype(np.float32) + np.float32(PENALTY) * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w -= (RATE * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.999**k)) + 1e-8)).astype(np.float32)
        bias -= RATE * slope.sum(0)
    right = (np.sign(x @ w + bias) == y).mean(0)
    return Model(languages, code, w * np.float32(SCALE), bias, right / right.sum())


def margins(texts: list[bytes], model: Model) -> np.ndarray:
    """Each bit's classifier value, texts x bits."""
    out = np.zeros((len(texts), len(model.bias)))
    for lo, hi in pieces(texts, 1 << 20):
        buf, starts, ends = _folded(texts[lo:hi])
        sums, count = np.zeros((hi - lo, len(model.bias))), np.zeros(hi - lo)
        for n, buckets, inside in char_grams(buf, ends, SIZES, BITS):
            last = np.maximum(ends - n + 1, starts)
            count += last - starts
            for bit in range(len(model.bias)):
                values = np.append(model.weights[:, bit][buckets], np.float32(0)).astype(np.float64)
                part = np.add.reduceat(values, np.stack([np.minimum(starts, len(values) - 1), np.minimum(last, len(values) - 1)], 1).ravel())[::2]
                sums[:, bit] += np.where(last > starts, part, 0)
        out[lo:hi] = sums / np.maximum(count, 1)[:, None] + model.bias
    return out


def decode(values: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword, its probability, and whether its lead is too small."""
    if len(model.languages) == 1:
        n = len(values)
        return np.zeros(n, int), np.ones(n), np.zeros(n, bool)
    # logistic loss of each bit against each codeword, weighted by the bit's reliability
    loss = np.stack([np.logaddexp(0, -values * word) @ model.trust for word in model.code], 1)
    order = np.sort(loss, 1)
    share = np.exp(-(loss - order[:, :1]) * len(model.trust))
    best = loss.argmin(1)
    return best, 1 / share.sum(1), order[:, 1] - order[:, 0] < LEAD


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "_language") -> DataFrame:
    """All columns of ``docs`` and a struct ``out`` of lang_pred, score, ambiguous."""
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("*", has_letter.alias(f"{out}_letter"))
    at_text = docs.columns.index(text)
    found = T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType()),
    ])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, found)])
    languages = np.array([*model.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in parts(batch, at_text):
                n = part.num_columns - 1
                letter = part.column(n).to_numpy(zero_copy_only=False).astype(bool)
                pred = np.full(part.num_rows, len(languages) - 1)
                score, doubt = np.zeros(part.num_rows), np.ones(part.num_rows, bool)
                at = np.flatnonzero(letter)
                if len(at) and model.languages:
                    texts = utf8(part.column(at_text).take(pa.array(at)))
                    pred[at], score[at], doubt[at] = decode(margins(texts, model), model)
                struct = pa.StructArray.from_arrays(
                    [pa.array(languages[pred], pa.string()), pa.array(score), pa.array(doubt)], names=found.names
                )
                yield pa.RecordBatch.from_arrays([*part.columns[:n], struct], [*part.schema.names[:n], out])

    return rows.mapInArrow(run, schema)


def _learned(docs: DataFrame) -> Model:
    return fit(docs.where(remainder("doc_id", HELD_OUT) != HELD_OUT_AT))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = predict(docs.select("doc_id", "text"), _learned(docs))
    return rows.select(
        "doc_id", (remainder("doc_id", HELD_OUT) == HELD_OUT_AT).alias("held_out"), "_language.lang_pred",
        "_language.score", "_language.ambiguous",
    )


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; ``und`` and ambiguous ones go."""
    ship(spark)
    out = "_language"
    while any(c.startswith(out) for c in docs.columns):
        out = "_" + out
    rows = predict(docs, _learned(docs), out=out)
    return rows.where((F.col(f"{out}.lang_pred") != UNKNOWN) & ~F.col(f"{out}.ambiguous")).drop(out)
