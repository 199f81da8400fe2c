"""Interpolated modified Kneser-Ney language model of word pairs, counted in Spark.

The model lies in the shared folder as sorted arrays of 64-bit hashes with their counts, cut by the
highest bits of the hash; workers map the files into memory and search them. It is made in two
passes over the training texts:

1. Pairs of neighbouring tokens are counted. Only their hashes travel, already summed per task, so
   a pair or word that is everywhere is one entry per task, and hashes spread evenly.
2. With the pairs' counts c known, the texts are read again and each place adds 1/c to its word:
   over all c places that makes 1 per different pair, which is the continuation count. Contexts
   collect in the same way how many pairs of theirs were seen once, twice, or more often.

The folder must be mounted on all workers (a ``file:`` path); other stores can't be mapped.

Defined cases: a null text is empty and consists of its end token; unknown words get the unknown
share of the unigram distribution; without training texts every probability is 1 and all scores
are 0; ids may be null or repeat. Only the two named columns are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.batches import SPACE, U64, documents, group_sums, joined, mix, pieces, remainder, runs, span_hashes, utf8
from plinth.session import new_dir

HELD_OUT, HELD_OUT_AT = 7, 2
#: Hashes are cut by their highest bits into shards: this many bits, or more for large inputs.
SHARD_BITS = 6
#: Tokens a task sums before it passes them on.
GATHERED = 1_500_000
START, END = U64(0x5354415254), U64(0x454E44)
#: Discounts stay at or above this, so that unknown words keep a share.
LEAST_DISCOUNT = 0.05


class Tokens:
    """Token hashes of some texts: each text's words, then its end; and the token before each."""

    def __init__(self, texts: list[bytes]):
        buf, starts, ends = joined([t.lower() for t in texts], b"\n")
        a, b = runs(~SPACE[buf]) if len(buf) else (np.zeros(0, int), np.zeros(0, int))
        words = span_hashes(buf, a, b) if len(buf) else np.zeros(0, U64)
        size = np.searchsorted(a, ends) - np.searchsorted(a, starts)
        self.stop = np.cumsum(size + 1)
        self.start = self.stop - size - 1
        self.token = np.full(int((size + 1).sum()), END, U64)
        is_word = np.ones(len(self.token), bool)
        is_word[self.stop - 1] = False
        self.token[is_word] = words
        self.before = np.empty_like(self.token)
        self.before[1:] = self.token[:-1]
        self.before[self.start] = START
        self.pair = mix(self.before * U64(0x9FB21C651E98DF25) + self.token)


def shard_bits(texts: DataFrame) -> int:
    """As many shards as the input has splits, so what one task merges does not grow with the input."""
    return max(SHARD_BITS, (texts.rdd.getNumPartitions() - 1).bit_length())


def _shards(ordered: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards that sorted hashes fall into, and where each of them begins and the last one ends."""
    shard = ordered >> U64(64 - bits)
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, int)
    return shard[first].astype(np.int64), np.append(first, len(shard))


def local_path(uri: str) -> str:
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model is mapped into memory, so {uri} must be a mounted folder")
    return unquote(parts.path)


def _store(path: str, values: np.ndarray) -> None:
    """Whole or not at all: a task that runs again replaces the file by an equal one."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{os.getpid()}.{os.urandom(6).hex()}"
    values.tofile(own)
    os.replace(own, path)


def _load(path: str, kind: str) -> np.ndarray:
    """Every shard has its files, so one that is not there is an error, not an empty shard."""
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


def _complete(tables: list[Mapped], written: set[int], bits: int) -> None:
    """Give the shards that no row fell into their empty files, once the others are written."""
    for shard in set(range(1 << bits)) - written:
        for table in tables:
            for column in ("hash", *table.kinds):
                _store(table.path(shard, column), np.zeros(0, np.uint8))


class Mapped:
    """Sorted hashes with values, in files per shard, mapped when first used."""

    def __init__(self, place: str, name: str, kinds: dict[str, str], bits: int):
        self.place, self.name, self.kinds, self.bits, self.open = place, name, kinds, bits, {}

    def path(self, shard: int, column: str) -> str:
        return f"{self.place}/{self.name}/{shard}.{column}"

    def _shard(self, shard: int) -> dict[str, np.ndarray]:
        if shard not in self.open:
            self.open[shard] = {c: _load(self.path(shard, c), k) for c, k in ({"hash": "<u8"} | self.kinds).items()}
        return self.open[shard]

    def get(self, hashes: np.ndarray) -> dict[str, np.ndarray]:
        """Values of each hash; 0 where it is not stored."""
        distinct, back = np.unique(hashes, return_inverse=True)
        out = {c: np.zeros(len(distinct), k) for c, k in self.kinds.items()}
        shards, cuts = _shards(distinct, self.bits)
        for shard, a, b in zip(shards.tolist(), cuts, cuts[1:]):
            data = self._shard(shard)
            if not len(data["hash"]):
                continue
            own = distinct[a:b]
            # neighbours in order, so the search stays in the cache
            at = np.minimum(np.searchsorted(data["hash"], own), len(data["hash"]) - 1)
            hit = data["hash"][at] == own
            for c in self.kinds:
                out[c][a:b] = np.where(hit, data[c][at], 0)
        return {c: v[back] for c, v in out.items()}


class PairCounts:
    """Counts of pairs in one byte each; those that need more lie in arrays of their own."""

    def __init__(self, place: str, bits: int):
        self.small = Mapped(place, "pairs", {"count": "<u1"}, bits)
        self.large = Mapped(place, "frequent", {"count": "<i8"}, bits)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        count = self.small.get(hashes)["count"].astype(np.int64)
        more = np.flatnonzero(count == 255)
        if len(more):
            count[more] = self.large.get(hashes[more])["count"]
        return count


WORD_KINDS = {"count": "<i8", "kinds_before": "<u4", "once": "<u4", "twice": "<u4", "more": "<u4"}


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and 3 or more, from counts of counts."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = [0.0]
    for k in range(1, 4):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * y
        out.append(min(max(d, LEAST_DISCOUNT), k))
    return np.array(out)


@dataclass
class Model:
    place: str
    bits: int
    tokens: int  # all training tokens, ends included
    words: int  # different ones
    pairs: int  # different pairs
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    unknown_share: float  # what the unigram distribution passes on to the uniform one
    _open: tuple | None = field(default=None, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_open": None}

    def arrays(self) -> tuple[PairCounts, Mapped]:
        if self._open is None:
            self._open = PairCounts(self.place, self.bits), Mapped(self.place, "words", WORD_KINDS, self.bits)
        return self._open

    def log10(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token by the model, and each token's training count."""
        pairs, words = self.arrays()
        # every token follows one of the same array or a start, so one search serves both
        both = words.get(np.append(tokens.token, START))
        of_start = {c: v[-1] for c, v in both.items()}
        now = {c: v[:-1] for c, v in both.items()}
        before = {c: np.concatenate([v[:1], v[:-1]]) for c, v in now.items()}
        for c, v in before.items():
            v[tokens.start] = of_start[c]
        uniform = 1.0 / (self.words + 1)
        kinds = now["kinds_before"].astype(np.float64)
        if self.pairs:
            kept = np.maximum(kinds - self.word_discounts[np.minimum(now["kinds_before"], 3)], 0)
            unigram = kept / self.pairs + self.unknown_share * uniform
        else:
            unigram = np.full(len(kinds), uniform)
        total = before["count"].astype(np.float64)
        seen = total > 0
        total = np.where(seen, total, 1)
        count = pairs.get(tokens.pair)
        d = self.pair_discounts
        passed_on = (d[1] * before["once"] + d[2] * before["twice"] + d[3] * before["more"]) / total
        p = np.maximum(count - d[np.minimum(count, 3)], 0) / total + passed_on * unigram
        return np.log10(np.where(seen, p, unigram)), now["count"]


def count_pairs(texts: DataFrame, place: str, bits: int) -> list[int]:
    """Write the pair counts; returns how many pairs were seen 1, 2, 3 and 4 times, and how many there are."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed(held: list[np.ndarray]) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            shards, cuts = _shards(found, bits)
            return pa.RecordBatch.from_arrays([
                pa.array(shards.astype(np.int32)),
                pa.array([found[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([n[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ], ["shard", "hashes", "counts"])

        held, size = [], 0
        for batch in batches:
            column = utf8(batch.column(0))
            for lo, hi in pieces(column):
                held.append(Tokens(column[lo:hi]).pair)
                size += len(held[-1])
                if size >= GATHERED:
                    yield passed(held)
                    held, size = [], 0
        if size:
            yield passed(held)

    pairs = PairCounts(place, bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, columns in _by_shard(batches, ("<u8", "<u4")):
            found, n = _summed(columns[0], columns[1:])
            n = n[0]
            frequent = n >= 255
            _store(pairs.small.path(shard, "hash"), found)
            _store(pairs.small.path(shard, "count"), np.minimum(n, 255).astype("<u1"))
            _store(pairs.large.path(shard, "hash"), found[frequent])
            _store(pairs.large.path(shard, "count"), n[frequent].astype("<i8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([len(found)]), *[pa.array([int((n == k).sum())]) for k in range(1, 5)]],
                ["shard", "n", "n1", "n2", "n3", "n4"],
            )

    placed = _placed(texts.mapInArrow(gather, "shard int, hashes binary, counts binary"), bits)
    rows = placed.mapInArrow(merge, "shard long, n long, n1 long, n2 long, n3 long, n4 long").collect()  # a row per shard
    _complete([pairs.small, pairs.large], {r["shard"] for r in rows}, bits)
    return [sum(r[k] for r in rows) for k in ("n1", "n2", "n3", "n4", "n")]


def _placed(rows: DataFrame, bits: int) -> DataFrame:
    return rows.repartition(1 << bits, "shard").sortWithinPartitions("shard")


def _by_shard(batches: Iterator[pa.RecordBatch], kinds: tuple[str, ...]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The arrays of each shard, which come in the order of shards; summed whenever they double."""
    most = 8 * GATHERED // len(kinds)
    now, held, size, limit = None, [[] for _ in kinds], 0, most
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if now is not None and row[0] != now:
                yield now, [np.concatenate(h) for h in held]
                held, size, limit = [[] for _ in kinds], 0, most
            now = row[0]
            for h, raw, kind in zip(held, row[1:], kinds):
                h.append(np.frombuffer(raw, kind))
            size += len(held[0][-1])
            if size > limit:
                keys, sums = _summed(np.concatenate(held[0]), [np.concatenate(h) for h in held[1:]])
                held = [[keys], *[[s.astype(np.float64) if k.startswith("<f") else s] for s, k in zip(sums, kinds[1:])]]
                size, limit = len(keys), max(limit, 2 * len(keys))
    if now is not None:
        yield now, [np.concatenate(h) for h in held]


def _summed(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    sums = [np.add.reduceat(v[order].astype(np.float64 if v.dtype.kind == "f" else np.int64), first) if len(keys) else v for v in values]
    return keys[first], sums


_STATS = ("<i8", "<f8", "<i8", "<f8", "<f8")


def count_words(texts: DataFrame, place: str, bits: int) -> list[dict]:
    """Write the word statistics; returns sums per shard."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = PairCounts(place, bits)

        def passed(held: list[tuple[np.ndarray, list[np.ndarray]]]) -> pa.RecordBatch:
            keys, sums = _summed(np.concatenate([h[0] for h in held]), [np.concatenate([h[1][k] for h in held]) for k in range(5)])
            shards, cuts = _shards(keys, bits)
            return pa.RecordBatch.from_arrays([
                pa.array(shards.astype(np.int32)),
                *[pa.array([v[a:b].astype(kind).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
                  for v, kind in zip([keys, *sums], ("<u8", *_STATS))],
            ], ["shard", "hashes", *WORD_KINDS])

        held, size = [], 0
        for batch in batches:
            column = utf8(batch.column(0))
            for lo, hi in pieces(column):
                tokens = Tokens(column[lo:hi])
                held.append(_statistics(tokens, pairs.get(tokens.pair)))
                size += len(tokens.token)
                if size >= GATHERED:
                    yield passed(held)
                    held, size = [], 0
        if size:
            yield passed(held)

    words = Mapped(place, "words", WORD_KINDS, bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, columns in _by_shard(batches, ("<u8", *_STATS)):
            keys, sums = _summed(columns[0], columns[1:])
            _store(words.path(shard, "hash"), keys)
            for (c, kind), v in zip(WORD_KINDS.items(), sums):
                _store(words.path(shard, c), np.rint(v).astype(kind))
            token = keys != START
            before = np.rint(sums[1]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([int(sums[0][token].sum())]), pa.array([int(token.sum())]),
                 *[pa.array([int((before == k).sum())]) for k in range(1, 5)]],
                ["shard", "tokens", "words", "n1", "n2", "n3", "n4"],
            )

    columns = ", ".join(f"{c} binary" for c in WORD_KINDS)
    placed = _placed(texts.mapInArrow(gather, f"shard int, hashes binary, {columns}"), bits)
    rows = placed.mapInArrow(merge, "shard long, tokens long, words long, n1 long, n2 long, n3 long, n4 long").collect()  # a row per shard
    _complete([words], {r["shard"] for r in rows}, bits)
    return [r.asDict() for r in rows]


def _statistics(tokens: Tokens, count: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per different token of some texts: its count, and shares of the statistics of WORD_KINDS."""
    keys, back = np.unique(np.concatenate([tokens.token, tokens.before]), return_inverse=True)
    n = len(tokens.token)
    now, before, share = back[:n], back[n:], 1.0 / np.maximum(count, 1)
    add = lambda at, weights=None: np.bincount(at, weights, len(keys))
    times = add(now)
    # the start is a context once per text, and no token
    times += np.where(keys == START, add(before), 0)
    return keys, [
        times, add(now, share), add(before[count == 1]).astype(np.int64),
        add(before[count == 2], share[count == 2]), add(before[count > 2], share[count > 2]),
    ]


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count the model over all texts given."""
    place = local_path(new_dir(docs.sparkSession, "kneser-ney"))
    texts = docs.select(F.col(text).alias("text"))
    bits = shard_bits(texts)
    *pair_counts, pairs = count_pairs(texts, place, bits)
    rows = count_words(texts, place, bits)
    n = [sum(r[f"n{k}"] for r in rows) for k in range(1, 5)]
    words = sum(r["words"] for r in rows)
    d = discounts(n)
    # different words after 1, 2, and 3 or more different ones pass on their discounts
    share = (d[1] * n[0] + d[2] * n[1] + d[3] * (words - n[0] - n[1])) / pairs if pairs else 1.0
    return Model(place, bits, sum(r["tokens"] for r in rows), words, pairs, discounts(pair_counts), d, share)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity for each row."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(2))
            n, known = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            base, total = np.zeros(len(texts)), np.zeros(len(texts))
            for lo, hi in pieces(texts):
                tokens = Tokens(texts[lo:hi])
                log, count = model.log10(tokens)
                add_one = np.log10((count + 1) / (model.tokens + 1.0 * (model.words + 1)))
                n[lo:hi] = tokens.stop - tokens.start
                known[lo:hi] = group_sums((count > 0).astype(np.int64), tokens.start, tokens.stop)
                base[lo:hi] = group_sums(add_one, tokens.start, tokens.stop)
                total[lo:hi] = group_sums(log, tokens.start, tokens.stop)
            perplexity = 10 ** np.minimum(-total / np.maximum(n, 1), 300)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens)),
                 pa.array(base), pa.array(total), pa.array(perplexity)], names,
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), (remainder(doc_id, HELD_OUT) == HELD_OUT_AT).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    )


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs.where(remainder("doc_id", HELD_OUT) != HELD_OUT_AT)))
