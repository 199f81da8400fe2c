"""Benchmark decontamination with suffix arrays of the training texts.

Each task turns its documents into shards of bounded size and builds a shard's suffix array over
words. Every benchmark suffix that begins a window is binary-searched in it; the range it ends in
is every place of the shard where the window stands. Windows that follow one another on both sides
make the longest verbatim matches. The benchmark comes in blocks of bounded size, one pass over
the documents for each, so a benchmark of any size is searched whole.

Defined cases: a null text has no words; an item without words has no window; equal items count as
often as they have different ids, and a null id counts as the id ``null``; a document without
words is not contaminated. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.batches import U64, documents, joined, pieces, runs, ship, span_hashes, table, utf8

WINDOW = 13
#: Contaminated if at least this percentage of the words is hit.
MIN_PERCENT = 5
#: Bytes of benchmark text in a block, which is what one broadcast holds.
BLOCK_BYTES = 8 << 20
#: Bytes of training text in a shard; a longer document is a shard of its own.
SHARD_BYTES = 2 << 20
#: Word places marked at once.
PLACES = 1 << 21

WORD = table(bytes(b for b in range(256) if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and each text's first and last place among them."""
    buf, starts, ends = joined([t.lower() for t in texts])
    if not len(buf):
        return np.zeros(0, U64), starts, ends
    a, b = runs(WORD[buf])
    return span_hashes(buf, a, b), np.searchsorted(a, starts), np.searchsorted(a, ends)


@dataclass(frozen=True)
class Block:
    """Benchmark items as word hashes: item k has ``words[first[k]:first[k + 1]]``."""

    ids: list[str]
    words: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(ids: list[str], texts: list[bytes]) -> "Block":
        words, first, last = words_of(texts)
        return Block(ids, words, np.append(first, len(words)).astype(np.int64))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and item of every window."""
        size = np.diff(self.first)
        count = np.where(size >= WINDOW, size - WINDOW + 1, np.minimum(size, 1))
        item = np.repeat(np.arange(len(size)), count)
        start = self.first[item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        return start, np.minimum(size, WINDOW)[item], item


class SuffixArray:
    """Suffixes of a sequence of ranks, ordered by their first ``depth`` words at least.

    Rank 0 ends a document; no benchmark word has it, so no match goes beyond.
    """

    def __init__(self, ranks: np.ndarray, n_ranks: int, depth: int):
        n = len(ranks)
        self.n = n
        self.ranks = np.concatenate([ranks, np.zeros(2 * depth + 64, ranks.dtype)])
        bits = max(1, int(n_ranks).bit_length())
        known = max(1, min(62 // bits, depth))
        key = np.zeros(n, np.int64)
        for k in range(known):
            key = (key << bits) | self.ranks[k:n + k]
        self.order = np.argsort(key)
        ordered = key[self.order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        slots = np.arange(n)
        rank = np.zeros(n + 2 * depth + 64, np.int64)
        group = np.maximum.accumulate(np.where(new, slots, 0)) if n else slots
        rank[self.order] = group + 1
        while known < depth:
            # only suffixes that still share their beginning are ordered further
            tied = np.flatnonzero(~(new & np.append(new[1:], True)))
            if not len(tied):
                break
            at = self.order[tied]
            key = (group[tied] << 32) | rank[at + known]
            by = np.argsort(key)
            key, at = key[by], at[by]
            self.order[tied] = at
            new[tied] = np.append(True, key[1:] != key[:-1])
            group = np.maximum.accumulate(np.where(new, slots, 0))
            rank[at] = group[tied] + 1
            known *= 2

    def _bound(self, lo: np.ndarray, hi: np.ndarray, depth: int, want: np.ndarray, after: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) >> 1
            value = self.ranks[self.order[np.minimum(mid, self.n - 1)] + depth]
            right = open_ & ((value <= want) if after else (value < want))
            lo = np.where(right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)

    def find(self, query: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of ``order`` whose suffixes begin with ``query[start:start + length]``."""
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), self.n)
        for depth in range(int(length.max(initial=0))):
            at = np.flatnonzero((lo < hi) & (depth < length))
            if not len(at):
                break
            want = query[start[at] + depth]
            left = self._bound(lo[at], hi[at], depth, want, False)
            hi[at] = self._bound(left, hi[at], depth, want, True)
            lo[at] = left
        return lo, hi


def occurrences(words: np.ndarray, first: np.ndarray, last: np.ndarray, block: Block) -> Iterator[tuple[np.ndarray, ...]]:
    """doc, place, length, item, item_place of every window of the block that stands in the shard.

    Places count words from 0 within the document and within the item.
    """
    start, length, item = block.windows()
    if not len(words) or not len(start):
        return
    vocabulary, rank = np.unique(words, return_inverse=True)
    doc = np.repeat(np.arange(len(first)), last - first)
    ranks = np.zeros(len(words) + len(first), np.int64)
    ranks[np.arange(len(words)) + doc] = rank + 1
    base = first + np.arange(len(first))
    known = np.minimum(np.searchsorted(vocabulary, block.words), len(vocabulary) - 1)
    query = np.where(vocabulary[known] == block.words, known + 1, -1)
    array = SuffixArray(ranks, len(vocabulary) + 1, WINDOW)
    lo, hi = array.find(query, start, length)
    count = np.where(hi > lo, hi - lo, 0)
    found = np.flatnonzero(count)
    cuts = np.searchsorted(np.cumsum(count[found]), np.arange(PLACES, int(count.sum()) + PLACES, PLACES))
    for part in np.split(found, np.unique(cuts[cuts < len(found)])):
        if not len(part):
            continue
        n = count[part]
        w = np.repeat(part, n)
        slot = np.repeat(lo[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        place = array.order[slot]
        d = np.searchsorted(base, place, "right") - 1
        yield d, place - base[d], length[w], item[w], start[w] - block.first[item[w]]


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    """The benchmark in blocks, brought to the driver one at a time; each is of bounded size."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).distinct()
    size = items.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    placed = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    for k in range(blocks):
        found = (placed if blocks == 1 else placed.where(F.col("block") == k)).toArrow()
        yield Block.of(found.column("id").to_pylist(), utf8(found.column("text").combine_chunks()))


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, word, item_id, item_word, n_words: the longest verbatim matches of a window or more."""
    spark, parts = docs.sparkSession, []
    kind = docs.schema[doc_id].dataType.simpleString()
    for block in _blocks(benchmark, item_id, item_text):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = utf8(batch.column(1))
                for lo, hi in pieces(texts, SHARD_BYTES):
                    rows = [np.stack(x) for x in occurrences(*words_of(texts[lo:hi]), sent.value)]
                    if not rows:
                        continue
                    d, place, length, item, item_place = np.concatenate(rows, 1)
                    # a window continues the one before on both sides
                    by = np.lexsort((place, place - item_place, item, d))
                    d, place, length, item, item_place = (x[by] for x in (d, place, length, item, item_place))
                    new = np.ones(len(d), bool)
                    new[1:] = (np.diff(d) != 0) | (np.diff(item) != 0) | (np.diff(place) != 1) | (np.diff(item_place) != 1)
                    at = np.flatnonzero(new)
                    end = np.append(at[1:], len(d)) - 1
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(lo + d[at])), pa.array(place[at]),
                         pa.array([sent.value.ids[i] for i in item[at]], pa.string()), pa.array(item_place[at]),
                         pa.array(place[end] - place[at] + length[end])],
                        ["doc_id", "word", "item_id", "item_word", "n_words"],
                    )

        parts.append(docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, word long, item_id string, item_word long, n_words long"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "_hits", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``out`` of n_words, n_hit, n_items, items_sha256, contaminated."""
    at = docs.columns.index(text)
    found = T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("spans", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType())),
    ])
    width = len(docs.columns)
    rows = docs
    for k, block in enumerate(_blocks(benchmark, item_id, item_text)):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, k=k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = utf8(batch.column(at))
                before = batch.column(width).to_pylist() if k else [None] * len(texts)
                states = []
                for lo, hi in pieces(texts, SHARD_BYTES):
                    states += _searched(texts[lo:hi], sent.value, before[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:width], pa.array(states, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.binary()), ("items", pa.list_(pa.string()))]))],
                    [*batch.schema.names[:width], out],
                )

        # each pass sees the documents' columns and what earlier blocks have hit
        rows = rows.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, found)]))
    items, words, n_hit = (F.col(f"{out}.{c}") for c in ("items", "n_words", "n_hit"))
    return rows.withColumn(out, F.struct(
        words.alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        ((n_hit > 0) & (100 * n_hit >= MIN_PERCENT * words)).alias("contaminated"),
    ))


def _searched(texts: list[bytes], block: Block, before: list[dict | None]) -> list[dict]:
    """Per text: its words, the hit spans as packed pairs of word places, and the items found."""
    words, first, last = words_of(texts)
    sizes = (last - first).astype(np.int64)
    base = np.cumsum(sizes + 1) - sizes - 1
    step = np.zeros(int((sizes + 1).sum()) + 1, np.int64)
    for d, state in enumerate(before):
        if state and state["spans"]:
            a, b = np.frombuffer(state["spans"], ">u4").astype(np.int64).reshape(-1, 2).T
            np.add.at(step, base[d] + a, 1)
            np.add.at(step, base[d] + b, -1)
    pairs = [np.zeros(0, np.int64)]
    for d, place, length, item, _ in occurrences(words, first, last, block):
        step += np.bincount(base[d] + place, minlength=len(step)) - np.bincount(base[d] + place + length, minlength=len(step))
        pairs.append(np.unique(d * len(block.ids) + item))
    hit = np.cumsum(step) > 0
    total = np.append(0, np.cumsum(hit))
    a, b = runs(hit)
    owner = np.searchsorted(base, a, "right") - 1
    items: list[set] = [set(s["items"]) if s else set() for s in before]
    for pair in np.unique(np.concatenate(pairs)):
        items[pair // len(block.ids)].add(block.ids[pair % len(block.ids)])
    packed = np.stack([a - base[owner], b - base[owner]], 1).astype(">u4")
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [
        {"n_words": int(sizes[i]), "n_hit": int(total[base[i] + sizes[i]] - total[base[i]]), "spans": packed[cuts[i]:cuts[i + 1]].tobytes(), "items": sorted(items[i])}
        for i in range(len(texts))
    ]


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "_hits.*")


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark of ``sf_dir``."""
    ship(spark)
    out = "_hits"
    while any(c.startswith(out) for c in docs.columns):
        out = "_" + out
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=out)
    return found.where(~F.col(f"{out}.contaminated")).drop(out)


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP8_SQL = f"""
WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
    SELECT item, w, least(len(w), {WINDOW}) AS n, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i
    FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
    SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
    FROM docs JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n)),
found AS (SELECT r, i, n, item FROM places JOIN windows USING (n, win)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (
    SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
named AS (
  SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256
  FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit > 0 AND 100 * n_hit >= {MIN_PERCENT} * len(w), false) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
