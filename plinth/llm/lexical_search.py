"""Ranked lexical search of many items at once, with the work that items share done once.

Every item is a bag of terms, and a document's score for it is a sum over these terms. What items
have in common is mined first: terms found in the same items make a set, and sets that stand side
by side in two or more items are joined, round by round. This gives a graph whose leaves are terms,
whose inner nodes are shared sets and whose roots are items. Each task fills, for a block of
documents, one accumulator per leaf, adds them up along the graph, every shared set once, and keeps
the best documents of each item; the tasks' lists meet in a window.

The items come in blocks of bounded size, two passes over the documents for each: one for the
statistics of the terms, one for the scores.

Defined cases: a null text has no terms, and a document without terms counts nowhere; every row of
the items is an item of its own, whatever its id; repeated rows are documents of their own; a null
doc_id comes after all others of the same score. Items without a hit have no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.batches import documents, table, utf8
from plinth.llm.words import groups, placed

TOP = 20
#: Bytes of item text in a block, which is what one broadcast holds.
BLOCK_BYTES = 1 << 20
#: Accumulators (nodes times documents) a task holds at once.
CELLS = 4 << 20
#: Lists of one item are merged in so many parts first.
PARTS = 64

#: Bytes between terms: all of ASCII but digits and letters.
GAPS = table(bytes(b for b in range(128) if not (chr(b).isdigit() or chr(b).isalpha())))


# --- what items share ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Graph:
    """Nodes 0 … leaves - 1 are terms. Each level adds nodes: ``(children, first child of each)``."""

    leaves: int
    levels: list[tuple[np.ndarray, np.ndarray]]
    children: np.ndarray
    first: np.ndarray

    @property
    def nodes(self) -> int:
        return self.leaves + sum(len(first) for _, first in self.levels)

    def fill(self, cells: np.ndarray) -> np.ndarray:
        """Add up the accumulators of the leaves; returns one row per item."""
        at = self.leaves
        for children, first in self.levels:
            cells[at:at + len(first)] = np.add.reduceat(cells[children], first, axis=0)
            at += len(first)
        return np.add.reduceat(cells[self.children], self.first, axis=0)


def _level(sets: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in sets])
    return np.array([c for s in sets for c in s], np.int64), np.cumsum(sizes) - sizes


def share(items: list[list[int]], leaves: int) -> Graph:
    """The graph of some items, which are lists of terms with repeats; none is empty."""
    # the k-th occurrence of a term in an item is an element of its own, so bags are sets
    holders: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, terms in enumerate(items):
        for term, count in Counter(terms).items():
            for k in range(count):
                holders[term, k].append(i)
    alike: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for (term, _), found in holders.items():
        alike[tuple(found)].append(term)
    levels, nodes, held = [], leaves, [[] for _ in items]
    sets = []
    for found, terms in alike.items():
        if len(found) > 1 and len(terms) > 1:
            sets.append(tuple(terms))
            terms = [nodes + len(sets) - 1]
        for i in found:
            held[i] += terms
    while sets:
        levels.append(_level(sets))
        nodes += len(sets)
        # neighbours in the order of how many items hold them; a line of neighbours, not all pairs
        uses = Counter(n for nodes_of in held for n in set(nodes_of))
        for nodes_of in held:
            nodes_of.sort(key=lambda n: (-uses[n], n))
        pairs = Counter(p for nodes_of in held for p in set(zip(nodes_of, nodes_of[1:])))
        new: dict[tuple[int, int], int] = {}
        for i, nodes_of in enumerate(held):
            out, k = [], 0
            while k < len(nodes_of):
                pair = tuple(nodes_of[k:k + 2])
                if pairs[pair] > 1:
                    out.append(new.setdefault(pair, nodes + len(new)))
                    k += 2
                else:
                    out.append(nodes_of[k])
                    k += 1
            held[i] = out
        sets = list(new)
    return Graph(leaves, levels, *_level([tuple(h) for h in held]))


# --- terms of documents --------------------------------------------------------------------------


@dataclass(frozen=True)
class Items:
    """A block: ids of its items, the hashes of its terms in order, and the graph over them."""

    ids: list
    terms: np.ndarray
    graph: Graph

    @staticmethod
    def of(ids: list, texts: list[bytes]) -> Items | None:
        _, words, _, _, first, last = placed([t.lower() for t in texts], GAPS)
        terms, leaf = np.unique(words, return_inverse=True)
        some = [k for k in range(len(ids)) if last[k] > first[k]]
        if not some:
            return None
        return Items([ids[k] for k in some], terms, share([leaf[first[k]:last[k]].tolist() for k in some], len(terms)))


def counted(texts: list[bytes], terms: np.ndarray, most: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Blocks of rows, with the number of terms of each row and a table rows x ``terms`` of occurrences.

    Only the parts of a long text are ever in memory together with their hashes.
    """
    for lo in range(0, len(texts), most):
        block = texts[lo:lo + most]
        size, found = np.zeros(len(block), np.int64), np.zeros(len(block) * len(terms), np.int64)
        for rows, parts in groups(block):
            _, words, _, _, first, last = placed([p.lower() for p in parts], GAPS)
            rows = np.array(rows)
            np.add.at(size, rows, last - first)
            at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
            known = np.flatnonzero(terms[at] == words)
            row = np.repeat(rows, last - first)[known]
            if len(known):
                base = rows[0]
                n = np.bincount((row - base) * len(terms) + at[known])
                found[base * len(terms):base * len(terms) + len(n)] += n
        yield slice(lo, lo + len(block)), size, found.reshape(len(block), len(terms))


def statistics(docs: DataFrame, text: str, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and for each of ``terms`` the documents that hold it."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value
        held, total = np.zeros(len(terms), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for _, size, found in counted(utf8(batch.column(0)), terms, max(16, CELLS // len(terms))):
                held += np.count_nonzero(found, axis=0)
                total += (np.count_nonzero(size), size.sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([total, held[some]]))], ["term", "n"]
        )

    rows = docs.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(len(terms) + 2, np.int64)  # as many rows as the block has terms, and two
    n[rows.column("term").to_numpy() + 2] = rows.column("n").to_numpy()
    return int(n[0]), int(n[1]), n[2:]


# --- ranking -------------------------------------------------------------------------------------


def weight(n_docs: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1)))


def scores(found: np.ndarray, size: np.ndarray, n_docs: int, n_terms: int, weights: np.ndarray, graph: Graph) -> np.ndarray:
    """Items x documents."""
    m = 75 + (25 * size * n_docs) // max(n_terms, 1)
    doc, term = np.nonzero(found)
    tf = found[doc, term]
    cells = np.zeros((graph.nodes, len(size)), np.int64)
    cells[term, doc] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
    return graph.fill(cells)


class Best:
    """The ``top`` highest scores of each item, ties by id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)
        self.rows = np.zeros((4, 0), np.int64)  # item, score, no id, id

    def add(self, ids: np.ndarray, unknown: np.ndarray, score: np.ndarray) -> None:
        item, doc = np.nonzero(score >= self.least[:, None])
        if not len(item):
            return
        new = np.stack([item, score[item, doc], unknown[doc], ids[doc]])
        rows = np.concatenate([self.rows, new], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], np.arange(len(self.least)))
        place = np.arange(rows.shape[1]) - first[rows[0]]
        self.rows = rows[:, place < self.top]
        full = self.rows[:, np.flatnonzero(place[place < self.top] == self.top - 1)]
        self.least[full[0]] = full[1]


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    """The items in blocks, brought to the driver one at a time; each is of bounded size."""
    rows = items.select(F.col(item_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    placed_rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    for k in range(blocks):
        found = (placed_rows if blocks == 1 else placed_rows.where(F.col("block") == k)).toArrow()
        block = Items.of(found.column("id").to_pylist(), utf8(found.column("text").combine_chunks()))
        if block:
            yield block


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents with a score above 0."""
    spark, lists = docs.sparkSession, []
    kind = items.schema[item_id].dataType
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("_block", T.IntegerType()), T.StructField("_item", T.LongType()), T.StructField("item_id", kind),
        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType()),
    ])
    for k, block in enumerate(_blocks(items, item_id, item_text)):
        n_docs, n_terms, held = statistics(rows, "text", block.terms)
        weights = np.array([weight(n_docs, h) for h in held.tolist()], np.int64)
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], k=k, sent=sent, weights=weights, n_docs=n_docs, n_terms=n_terms) -> Iterator[pa.RecordBatch]:
            block, best = sent.value, Best(len(sent.value.ids), top)
            for batch in batches:
                texts = utf8(batch.column(1))
                ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                unknown = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                for rows, size, found in counted(texts, block.terms, max(16, CELLS // block.graph.nodes)):
                    best.add(ids[rows], unknown[rows], scores(found, size, n_docs, n_terms, weights, block.graph))
            item, score, no_id, ids = best.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(item), k, np.int32)), pa.array(item), pa.array([block.ids[i] for i in item], _arrow(kind)),
                 pa.array(ids, mask=no_id.astype(bool)), pa.array(score)],
                ["_block", "_item", "item_id", "doc_id", "score"],
            )

        lists.append(rows.mapInArrow(run, schema))
    if not lists:
        found = spark.createDataFrame([], schema)
    else:
        found = lists[0]
        for other in lists[1:]:
            found = found.unionByName(other)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # a task's list has ``top`` rows an item; many tasks' lists are merged in parts before they meet
    part = found.withColumn("_part", F.spark_partition_id() % PARTS)
    part = part.withColumn("_n", F.row_number().over(Window.partitionBy("_block", "_item", "_part").orderBy(*order))).where(F.col("_n") <= top)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("_block", "_item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP12_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0),
items AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark),
asked AS (SELECT q, t, count(*) AS k FROM (SELECT q, unnest(w) AS t FROM items) GROUP BY q, t),
found AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs)
  WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * held + 1))) AS BIGINT) AS weight
  FROM (SELECT t, count(*) AS held FROM found GROUP BY t), size),
lengths AS (SELECT r, doc_id, 75 + (25 * len(w) * n_docs) // n_terms AS m FROM docs, size WHERE len(w) > 0),
scored AS (
  SELECT q, r, doc_id, CAST(sum(k * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN found USING (t) JOIN weights USING (t) JOIN lengths USING (r) GROUP BY q, r, doc_id),
ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM ranked JOIN items USING (q) WHERE rank <= {TOP}
"""
