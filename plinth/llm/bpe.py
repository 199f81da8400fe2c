"""Byte-level BPE by ranked merges, and its decoding.

A text is cut by the splitting pattern; each match is a byte array in which the adjacent pair of
lowest rank is joined until no pair has a rank. The words that are new to a worker are folded together in
NumPy, each distinct one once; the others are looked up. Decoding concatenates the ids' bytes.

:func:`fold_merges` does the merges of a column of words by Spark's higher-order functions alone. It
gives the same ids, but costs about 0.7 ms a word, so the queries use the Arrow form (see README).

Defined cases: a null text is empty and has no ids; ids of documents may be null or repeat; only
the two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.batches import documents, keep, parts, pieces, ship, utf8
from plinth.llm.words import SAFE_CUT

RANKS = "byte_bpe_50k.tiktoken"
#: Distinct pieces a worker meets before it forgets those it has not met since as many before.
KEPT_PIECES = 200_000
#: Stands for pairs that are no token; larger than every rank.
NO_RANK = 1 << 62
#: Longer byte arrays keep their pairs in a heap.
SHORT = 64


def load_ranks(name: str = RANKS) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Folds the ranked merges over the byte arrays of many words at once.

    All words lie in one array of ids. Each round joins, in every word that still has a pair with a
    rank, the leftmost pair of lowest rank; only the pairs beside a join are looked up again.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        order = np.argsort(np.fromiter(pairs, np.int64, len(pairs)))
        self.pairs = np.append(np.fromiter(pairs, np.int64, len(pairs))[order], NO_RANK)
        self.joined = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], NO_RANK)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.joined[at], NO_RANK)

    def fold(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word, which are matches of the pattern."""
        out: list[list[int]] = [[]] * len(words)
        short = []
        for k, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[k] = [whole]
            elif len(word) > SHORT:
                out[k] = _merge_long(word, self.ranks)
            elif word:
                short.append(k)
        if not short:
            return out
        ids = self.bytes[np.frombuffer(b"".join(words[k] for k in short), np.uint8)]
        size = np.array([len(words[k]) for k in short])
        owner = np.array(short)
        first = np.cumsum(size) - size
        last = np.zeros(len(ids), bool)
        last[first + size - 1] = True
        rank = np.where(last, NO_RANK, self._rank(ids, np.append(ids[1:], 0)))
        while True:
            best = np.minimum.reduceat(rank, first)
            done = best == NO_RANK
            if done.any():
                for k, a, b in zip(owner[done].tolist(), first[done].tolist(), (first + size)[done].tolist()):
                    out[k] = ids[a:b].tolist()
                keep = np.repeat(~done, size)
                ids, rank, last = ids[keep], rank[keep], last[keep]
                owner, size, best = owner[~done], size[~done], best[~done]
                if not len(owner):
                    return out
                first = np.cumsum(size) - size
            hit = np.flatnonzero(rank == np.repeat(best, size))
            word = np.searchsorted(first, hit, "right") - 1
            hit = hit[np.append(True, word[1:] != word[:-1])]  # the leftmost of each word; every word has one
            ids[hit] = best
            last[hit] = last[hit + 1]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            hit -= np.arange(len(hit))  # one place before each was taken out
            ids, rank, last = ids[keep], rank[keep], last[keep]
            size -= 1
            first = np.cumsum(size) - size
            right = np.append(ids[1:], 0)
            rank[hit] = np.where(last[hit], NO_RANK, self._rank(ids[hit], right[hit]))
            before = hit[hit > first] - 1
            rank[before] = self._rank(ids[before], ids[before + 1])


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs over a linked list: n log n for a word of n bytes."""
    n = len(word)
    end, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        if 0 <= at and end[at] < n:
            middle, last = end[at], end[end[at]]
            rank = ranks.get(word[at:last])
            if rank is not None:
                heapq.heappush(heap, (rank, at, middle, last))

    for i in range(n):
        offer(i)
    gone = bytearray(n)
    while heap:
        _, at, middle, last = heapq.heappop(heap)
        if gone[at] or end[at] != middle or end[middle] != last:
            continue  # a part of this pair has grown since
        gone[middle] = 1
        end[at] = last
        if last < n:
            previous[last] = at
        offer(at)
        offer(previous[at])
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at:end[at]]])
        at = end[at]
    return out


#: The literal rank map is cut into so many small maps by a checksum, as Spark looks through a map key by key.
MAPS = 1 << 16


def fold_merges(word: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of a binary column of matches: higher-order functions fold the ranked merges over its bytes."""
    maps: list[dict[str, int]] = [{} for _ in range(MAPS)]
    for token, rank in ranks.items():
        maps[zlib.crc32(token) % MAPS][token.hex().upper()] = rank
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")

    def rank_of(token: Column) -> Column:
        return F.element_at(F.get(literal, (F.crc32(F.unhex(token)) % MAPS).cast("int")), token)

    def bound(value: Column, use) -> Column:
        """``use(value)`` with ``value`` computed once."""
        return F.get(F.transform(F.array(value), use), 0)

    def merge(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(parts) - 2), lambda i: rank_of(F.concat(F.get(parts, i), F.get(parts, i + 1))))
        # rank and place in one number; nulls are no candidates
        best = F.array_min(F.transform(pairs, lambda r, i: r.cast("bigint") * (1 << 31) + i))

        def joined(at: Column) -> Column:
            pair = F.array(F.concat(F.get(parts, at), F.get(parts, at + 1)))
            return F.concat(F.slice(parts, 1, at), pair, F.slice(parts, at + 3, F.size(parts)))

        merged = bound(best, lambda b: F.when(b.isNull(), parts).otherwise(bound((b % (1 << 31)).cast("int"), joined)))
        return F.when(F.size(parts) > 1, merged).otherwise(parts)

    digits, n = F.hex(word), F.octet_length(word)
    single = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(digits, 2 * i + 1, F.lit(2)))
    rounds = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    ids = F.transform(F.aggregate(rounds, single, merge), rank_of)
    whole = rank_of(digits)
    return F.when(n == 0, F.array().cast("array<int>")).when(whole.isNotNull(), F.array(whole)).otherwise(ids)


def join_pieces(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that ids stand for, by concatenating binary pieces."""
    names = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        names[rank] = token.hex()
    pieces = F.from_json(F.lit(json.dumps(names)), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))


class Encoder:
    """Encodes texts, each distinct piece once; a worker process keeps it from task to task."""

    def __init__(self, vocabulary: str, pattern: str):
        import regex

        ranks = load_ranks(vocabulary)
        self.merges, self.split = Merges(ranks), regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.names = list(map(str, range(len(self.tokens))))
        # the cuts are safe for this pattern; for another one a text stays whole
        self.cuts = pattern == public_tokenizers.PATTERN
        # pieces met lately, and those met before them: rare ones leave after a while
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if not text:
            return []
        return SAFE_CUT.split(text) if self.cuts else [text]

    def learn(self, pieces: Iterable[str]) -> None:
        """Fold the merges of the pieces that are not known, all at once."""
        if len(self.known) > KEPT_PIECES:
            self.before, self.known = self.known, {}
        new = []
        for piece in set(pieces).difference(self.known):
            found = self.before.get(piece)
            if found is None:
                new.append(piece)
            else:
                self.known[piece] = found
        matches = list(map(self.split, new))
        words = list(set(chain.from_iterable(matches)))
        ids_of = dict(zip(words, self.merges.fold([w.encode() for w in words])))
        for piece, found in zip(new, matches):
            ids = ids_of[found[0]] if len(found) == 1 else [i for w in found for i in ids_of[w]]
            # as text, which takes little memory and is what the ids are hashed as
            self.known[piece] = " ".join(map(self.names.__getitem__, ids)).encode()

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text in decimal, one space apart; many texts are learned together."""
        for lo, hi in pieces(texts):
            cut = [self.pieces(t.decode()) for t in texts[lo:hi]]
            self.learn(chain.from_iterable(cut))
            known = self.known.__getitem__
            yield from (b" ".join(filter(None, map(known, found))) for found in cut)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encoder(vocabulary: str, pattern: str) -> Encoder:
    return keep(("bpe", vocabulary, pattern), lambda: Encoder(vocabulary, pattern))


def encode(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, vocabulary: str = RANKS,
    pattern: str = public_tokenizers.PATTERN, keep_ids: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``keep_ids``, ids and decoded."""
    fields = [
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ]
    if keep_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, pattern)
        for batch in (part for whole in batches for part in parts(whole, 1)):
            counts, ids_sha, decoded_sha, all_ids, all_bytes = [], [], [], [], []
            for written in coder.encode(utf8(batch.column(1))):
                ids = list(map(int, written.split()))
                decoded = coder.decode(ids)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(written).hexdigest())
                decoded_sha.append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    all_ids.append(np.array(ids, np.int32))
                    all_bytes.append(decoded)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            if keep_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_bytes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select(doc_id, text).mapInArrow(run, T.StructType(fields))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir))


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: one row per document with its ids and what they decode to."""
    ship(spark)
    return encode(docs, keep_ids=True)
