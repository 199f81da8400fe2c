"""SimHash near-duplicates by anchor points.

64 bits are seen as two blocks of 31 (two bits stay unused in the search). Fingerprints that differ
in at most 3 bits differ in at most 1 bit of one block. The anchors of a block are the words of the
perfect Hamming code of length 31, whose covering radius is 1: a fingerprint's home is the anchor
within that radius, and it is copied to every anchor within radius + 1 = 2, at most 16. Whatever
lies within 1 bit of a fingerprint in that block therefore meets it at its home. Per anchor, links
are compared on all 64 bits and leave as a star per linked group, never as pairs.

Fingerprints at an anchor with more than ``CROWD`` of them meet by whole 64-bit words instead: two
of them differ in at most 3 bits if some word is within 1 bit of one and 2 bits of the other. No
word has more than 2,081 fingerprints that near, so these groups are bounded whatever the input.

Defined cases: a null text has no words and the fingerprint 0, like an empty one; equal rows link
to each other; a component whose ids are all null has a null id. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.llm.batches import U64, documents, let_go, parts, pieces, ship, utf8
from plinth.llm.components import stars
from plinth.llm.skew import dealt_anew
from plinth.session import new_dir, stored

SEED = 42
SHINGLE = 3
THRESHOLD = 3
#: Two blocks, so one of them has at most THRESHOLD // 2 differing bits.
BLOCK_SHIFTS = (0, 32)
BLOCK_BITS = 31

#: Fingerprints that a task copies to their anchors, up to 32 for each.
PLACED = 1 << 15
#: Fingerprints of one anchor that a task compares.
CROWD = 100_000
#: Anchors in a broadcast list of crowded ones at most (8 MB).
BROADCAST_ROWS = 1_000_000
#: Names of repeated documents in a broadcast list at most (some 10 MB).
BROADCAST_NAMES = 100_000

#: Eight lanes of one byte, a lane for each bit of the index, the highest bit in the highest lane.
_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], U64)


def _hashes(text: bytes) -> tuple[list[int], int]:
    """XXH64 of each shingle of a text, and how many there are."""
    import xxhash

    words = text.lower().split()  # both know ASCII only, as the contract does
    if not words:
        return [], 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(line, SEED)], 1
    start = [0]
    for w in words:
        start.append(start[-1] + len(w) + 1)
    digest = xxhash.xxh64_intdigest
    out = [digest(line[a:b - 1], SEED) for a, b in zip(start, start[SHINGLE:])]
    return out, len(out)


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One 64-bit fingerprint per text: the bits set in over half of its hashes."""
    out = np.zeros(len(texts), U64)
    for lo, hi in pieces(texts):
        every, counts = [], []
        for text in texts[lo:hi]:
            hashes, n = _hashes(text)
            every += hashes
            counts.append(n)
        counts = np.array(counts)
        if not len(every):
            continue
        h = np.array(every, U64)
        first = np.cumsum(counts) - counts
        # lanes of one byte hold sums of up to 255 hashes
        blocks = -(-counts // 255)
        owner = np.repeat(np.arange(hi - lo), blocks)
        start = first[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        for byte in range(8):
            lanes = np.add.reduceat(_LANES[(h >> U64(8 * byte)) & U64(255)], start)
            for bit in range(8):
                total = np.bincount(owner, ((lanes >> U64(8 * bit)) & U64(255)).astype(float), hi - lo)
                out[lo:hi] |= (2 * total > counts).astype(U64) << U64(8 * byte + bit)
    return out


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, fp (a long) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            fp = np.concatenate([np.zeros(0, U64), *(fingerprints(utf8(part.column(2))) for part in parts(batch, 2))]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["doc_id", "text_hash", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def text_hash(text: str | Column) -> Column:
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Exclusive or of the positions 1 to 31 of the set bits; 0 for a word of the Hamming code."""
    out = np.zeros(len(words), np.int64)
    for position in range(1, BLOCK_BITS + 1):
        out ^= np.where((words >> U64(position - 1)) & U64(1), position, 0)
    return out


def _flips() -> np.ndarray:
    """By syndrome, the bits to flip to reach each code word within distance 2; the home first."""
    out = np.zeros((BLOCK_BITS + 1, 16), U64)
    for s in range(1, BLOCK_BITS + 1):
        pairs = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, BLOCK_BITS + 1) if 0 < (i ^ s) and i < (i ^ s)]
        out[s] = [1 << (s - 1), *pairs]
    return out


def anchored(fps: DataFrame) -> DataFrame:
    """anchor, fp, home: each fingerprint at every anchor that may hold a link of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = _flips()
        for batch in batches:
            fp = batch.column(0).to_numpy().view(U64)
            for block, shift in enumerate(BLOCK_SHIFTS):
                word = (fp >> U64(shift)) & U64((1 << BLOCK_BITS) - 1)
                syndrome = _syndromes(word)
                anchors = (word[:, None] ^ flips[syndrome]) | U64(block << BLOCK_BITS)
                used = np.ones(anchors.shape, bool)
                used[syndrome == 0, 1:] = False  # a code word has no other one within distance 2
                rows, cols = np.nonzero(used)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors[rows, cols].view(np.int64)), pa.array(fp[rows].view(np.int64)), pa.array(cols == 0)],
                    ["anchor", "fp", "home"],
                )

    return fps.mapInArrow(run, "anchor long, fp long, home boolean")


def _stars_of(fp: np.ndarray, home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Linked groups at one anchor: a member, and the others.

    Walks from a home to all it links to and from those to further homes. What has been reached is
    not compared again, so a dense group costs little more than its size.
    """
    homes, others = fp[home], fp[~home]
    while len(homes):
        root, waiting, found = homes[0], [(homes[0], True)], []
        homes = homes[1:]
        while waiting:
            x, is_home = waiting.pop()
            near = np.bitwise_count(homes ^ x) <= THRESHOLD
            reached, homes = homes[near], homes[~near]
            found.append(reached)
            waiting += [(y, True) for y in reached]
            if is_home:
                near = np.bitwise_count(others ^ x) <= THRESHOLD
                reached, others = others[near], others[~near]
                found.append(reached)
                if len(homes):
                    waiting += [(y, False) for y in reached]
        members = np.concatenate(found)
        if len(members):
            yield root, members


def links(fps: DataFrame) -> DataFrame:
    """u, v: edges between distinct fingerprints whose components are those of all links.

    ``fps`` is counted and read several times, so it should be stored.
    """
    # a number of tasks that adaptive execution doesn't lower, as it sees fingerprints and not their copies
    placed = anchored(fps.repartition(max(1, -(-fps.count() // PLACED)), "fp"))
    crowded = stored(placed.groupBy("anchor").count().where(F.col("count") > CROWD).select(F.col("anchor").alias("_anchor")), "crowded")
    # at most 32 / CROWD rows for each fingerprint; beyond the bound the join is Spark's to plan
    if crowded.count() <= BROADCAST_ROWS:
        crowded = F.broadcast(crowded)
    here = F.col("anchor") == F.col("_anchor")
    met = _links_at_anchors(placed.join(crowded, here, "left_anti"))
    return met.unionByName(_links_at_words(placed.join(crowded, here, "left_semi").select("fp").distinct())).distinct()


def _links_at_words(fps: DataFrame) -> DataFrame:
    """Links by common words within 1 bit of one fingerprint and 2 bits of the other."""
    single = [1 << i for i in range(64)]
    double = [a | b for i, a in enumerate(single) for b in single[:i]]
    flips = np.array([0, *single, *double], U64)
    close = np.arange(len(flips)) <= 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_numpy().view(U64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((fp ^ flips).view(np.int64)), pa.array(np.full(len(flips), fp).view(np.int64)), pa.array(close)],
                    ["word", "fp", "close"],
                )

    words = fps.mapInArrow(run, "word long, fp long, close boolean")
    # whatever is within 2 bits of a word links to each fingerprint within 1 bit of it
    centre = F.min(F.when(F.col("close"), F.col("fp"))).over(Window.partitionBy("word"))
    return words.select("fp", centre.alias("v")).where("v <> fp").select(F.col("fp").alias("u"), "v")


def _links_at_anchors(placed: DataFrame) -> DataFrame:
    """Links among the fingerprints of each anchor, which fit a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.diff(anchor)) + 1
            first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(anchor)]])
            any_home = np.add.reduceat(home.astype(np.int64), first) > 0
            u, v = [np.zeros(0, U64)], [np.zeros(0, U64)]
            for k in np.flatnonzero((last - first > 1) & any_home):
                for root, members in _stars_of(fp[first[k]:last[k]], home[first[k]:last[k]]):
                    u.append(members)
                    v.append(np.full(len(members), root, U64))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(u).view(np.int64)), pa.array(np.concatenate(v).view(np.int64))], ["u", "v"]
            )

        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy().view(U64)
            home = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            kept.append((anchor, fp, home))
            if anchor[-1] == kept[0][0][0]:
                continue  # all of one anchor so far
            a, f, h = (np.concatenate(x) for x in zip(*kept))
            end = np.searchsorted(a, a[-1])
            yield found(a[:end], f[:end], h[:end])
            kept = [(a[end:], f[end:], h[end:])]
        if kept:
            yield found(*(np.concatenate(x) for x in zip(*kept)))

    return placed.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "u long, v long")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, fp, root, first: ``root`` names the component, ``first`` its first document."""
    spark = docs.sparkSession
    path = new_dir(spark, "simhash")
    prints = with_fingerprints(docs, doc_id, text)
    prints.write.parquet(path)
    prints = spark.read.schema(prints.schema).parquet(path)
    # exact copies of a fingerprint end here: one row per value goes on
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = stored(prints.groupBy("fp").agg(F.min(row).alias("first")), "fingerprints")
    reached = stars(links(nodes.select("fp")))
    placed = nodes.join(reached, F.col("fp") == F.col("u"), "left").select("fp", "first", F.coalesce("v", "fp").alias("root"))
    firsts = placed.groupBy("root").agg(F.min("first").alias("least")).select(dealt_anew("root").alias("_root"), "least")
    # a component's fingerprints may be many, and so may be the rows of a fingerprint
    labels = placed.select("fp", "root").join(firsts, F.col("root") == F.col("_root")).select(
        dealt_anew("fp").alias("_fp"), "root", F.col("least").alias("first")
    )
    return prints.join(labels, F.col("fp") == F.col("_fp")).drop("_fp")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = components(documents(spark, sf_dir))
    return rows.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: the one with the smallest id.

    Rows with equal id and text are one document, of which the smallest row stays. Where all ids
    are null, the smallest hash of the text decides.
    """
    ship(spark)
    rows = components(docs)
    me = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    names = ["_no_id", "_id", "_text"]
    found = stored(
        rows.groupBy(*_document("doc_id", F.col("text_hash"))).agg(
            F.max(me.eqNullSafe(F.col("first"))).alias("_stays"), F.count(F.lit(1)).alias("_n")
        ),
        "names",
    )
    named = docs.select(*_document("doc_id", text_hash(docs["text"])), F.struct(*docs.columns).alias("_row"))
    once = found.where("_stays and _n = 1").select(names)
    repeated = found.where("_n > 1").select(*names, "_stays")
    many = repeated.count()
    if not many:
        return named.join(once, names, "left_semi").select("_row.*")
    if many > BROADCAST_NAMES:  # all rows are grouped, so texts still move once only
        least = named.groupBy(names).agg(F.min("_row").alias("_row"))
        return least.join(found.where("_stays").select(names), names, "left_semi").select("_row.*")
    # rows of a repeated document are told by a broadcast and end in their task, so one that everybody has is no hot key
    alone = named.join(F.broadcast(repeated.select(names)), names, "left_anti").join(once, names, "left_semi")
    least = named.join(F.broadcast(repeated.where("_stays").select(names)), names, "left_semi").groupBy(names).agg(F.min("_row").alias("_row"))
    return alone.select("_row.*").unionByName(least.select("_row.*"))


def _document(doc_id: str, text: Column) -> list[Column]:
    """What names a document, without nulls."""
    return [
        F.col(doc_id).isNull().alias("_no_id"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), text.alias("_text")
    ]
