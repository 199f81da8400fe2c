"""Exact substring deduplication with suffix arrays sorted in two stages.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. The suffixes
that can share so long a beginning are brought together first: every window of ``LENGTH`` bytes
has an anchor, the smallest hash of the ``GRAM``-byte strings inside, so equal windows have equal
anchors. Consecutive windows with one anchor make a segment. Anchors seen once (by a bitmap of
fixed size, whose errors only let more through) are left out; the segments of each other anchor
meet in one task, which sorts their suffixes:

1. suffixes smaller than their successors are sorted directly;
2. the others are induced by scanning the buckets of first bytes in order;
3. adjacent common prefixes of ``LENGTH`` bytes mark the windows that repeat.

Equal segments meet as counts, not as bytes. An anchor with more than ``HOT_SEGMENTS`` different
segments is split: its windows meet by digests of their bytes, spread over all tasks.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` stay whole; equal texts of at
least ``LENGTH`` bytes lose all their bytes, the first one too; ids may be null or repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.batches import U64, documents, joined, mix, runs, ship, span_hashes, utf8
from plinth.llm.skew import dealt_anew
from plinth.session import new_dir

LENGTH = 200
GRAM = 32
#: Windows of a segment at most; a longer run of windows with one anchor is cut, windows are not.
SEGMENT_WINDOWS = 512
#: The bitmap of anchors seen twice has 2**SLOT_BITS bits (32 MB), whatever the input.
SLOT_BITS = 28
SLICES = 1024
#: Bytes of text whose windows are hashed together; a longer text is a piece of its own.
HASHED_BYTES = 1 << 20
#: Anchors a task gathers before it passes them on.
GATHERED = 1 << 20
#: Segments a task remembers having passed on with their bytes.
REMEMBERED = 200_000
#: An anchor with more different segments than this is split.
HOT_SEGMENTS = 4000
#: Bytes of segments whose suffixes are sorted together.
SORTED_BYTES = 1 << 20
#: Parts segments; no byte of UTF-8.
SEPARATOR = 0xFF

_BYTE = mix(np.arange(1, 257, dtype=U64))


def _minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    known = 1
    while known * 2 <= width:
        values = np.minimum(values[:-known], values[known:])
        known *= 2
    rest = width - known
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """buf, base, doc, start, windows, anchor, again of all segments of some texts.

    ``start`` and ``windows`` place a segment's windows in its text; ``base`` is where each text
    starts in ``buf``; ``again`` tells that the anchor stands in the segment twice, so the segment
    may repeat something of itself.
    """
    buf, base, ends = joined(texts, b"\xff")
    none = np.zeros(0, np.int64)
    if len(buf) < LENGTH + 1:
        return buf, base, none, none, none, np.zeros(0, U64), np.zeros(0, bool)
    h, known = _BYTE[buf], 1
    while known < GRAM:
        h = h[:-known] * U64(0x9E3779B97F4A7C15 + 2 * known) + h[known:]
        known *= 2
    h = mix(h)
    least = _minimum(h, LENGTH - GRAM + 1)
    valid = np.zeros(len(least) + 1, np.int8)
    long = np.flatnonzero(ends - base >= LENGTH)
    np.add.at(valid, base[long], 1)
    np.add.at(valid, ends[long] - LENGTH + 1, -1)
    inside = np.cumsum(valid[:-1]) > 0
    # a run ends where the anchor changes or the text does
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    first[base[long]] = True
    start = np.flatnonzero(first)
    if not len(start):
        return buf, base, none, none, none, np.zeros(0, U64), np.zeros(0, bool)
    doc = np.searchsorted(base, start, "right") - 1
    stop = np.minimum(np.append(start[1:], len(least)), ends[doc] - LENGTH + 1)
    parts = -(-(stop - start) // SEGMENT_WINDOWS)
    owner = np.repeat(np.arange(len(start)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    start, stop = start[owner] + nth * SEGMENT_WINDOWS, np.minimum(stop[owner], start[owner] + (nth + 1) * SEGMENT_WINDOWS)
    anchor = least[start]
    # places of anchors, to see which stand twice in a segment
    values = np.unique(anchor)
    near = np.flatnonzero(h <= values[-1])
    at = np.minimum(np.searchsorted(values, h[near]), len(values) - 1)
    is_anchor = values[at] == h[near]
    keys = np.sort(at[is_anchor] * len(buf) + near[is_anchor])
    which = np.searchsorted(values, anchor) * len(buf)
    again = np.searchsorted(keys, which + stop + LENGTH - GRAM) - np.searchsorted(keys, which + start) > 1
    doc = doc[owner]
    return buf, base, doc, start - base[doc], stop - start, anchor, again | (parts[owner] > 1)


def parts_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Rows, first window and bytes of parts of about ``HASHED_BYTES``, which share no window."""
    rows, offsets, held, size = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 1), HASHED_BYTES):
            part = text[at:at + HASHED_BYTES + LENGTH - 1] if len(text) > HASHED_BYTES else text
            if size and size + len(part) > HASHED_BYTES:
                yield np.array(rows), np.array(offsets), held
                rows, offsets, held, size = [], [], [], 0
            rows.append(row)
            offsets.append(at)
            held.append(part)
            size += len(part) + 1
    if held:
        yield np.array(rows), np.array(offsets), held


# --- anchors that may repeat ---------------------------------------------------------------------


def _slots(anchor: np.ndarray) -> np.ndarray:
    # anchors are minima, so they are spread anew
    return (mix(anchor) >> U64(64 - SLOT_BITS)).astype(np.int64)


def seen_twice(texts: DataFrame) -> Broadcast:
    """A bitmap with the slots of all anchors that stand in two places. Its size is fixed."""
    width = SLOT_BITS - SLICES.bit_length() + 1

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed(slots: list[np.ndarray]) -> pa.RecordBatch:
            ordered = np.sort(np.concatenate(slots))
            cuts = np.searchsorted(ordered, np.arange(SLICES + 1) << width)
            low = (ordered & ((1 << width) - 1)).astype("<u4")
            used = np.flatnonzero(np.diff(cuts))
            return pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array([low[cuts[i]:cuts[i + 1]].tobytes() for i in used], pa.binary())], ["slice", "slots"]
            )

        held, size = [], 0
        for batch in batches:
            for _, _, parts in parts_of(utf8(batch.column(0))):
                *_, anchor, again = segments(parts)
                held += [_slots(anchor), _slots(anchor[again])]
                size += len(anchor) + int(again.sum())
                if size >= GATHERED:
                    yield passed(held)
                    held, size = [], 0
        if size:
            yield passed(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, slots in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part not in seen:
                    seen[part] = np.zeros(1 << width, np.uint8)
                found, n = np.unique(np.frombuffer(slots, "<u4"), return_counts=True)
                seen[part][found] = np.minimum(seen[part][found].astype(np.int64) + n, 2).astype(np.uint8)
        for part, times in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([np.packbits(times > 1).tobytes()], pa.binary())], ["slice", "twice"]
            )

    spark = texts.sparkSession
    slices = texts.mapInArrow(gather, "slice long, slots binary").repartition(SLICES // 16, "slice").mapInArrow(count, "slice long, twice binary")
    bits = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    for row in slices.collect():  # SLICES rows at most, 2**SLOT_BITS bits together
        bits[row["slice"] << (width - 3):(row["slice"] + 1) << (width - 3)] = np.frombuffer(row["twice"], np.uint8)
    return spark.sparkContext.broadcast(bits)


def _repeated(anchor: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slot = _slots(anchor)
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


# --- candidates ----------------------------------------------------------------------------------


def text_key(text: str | Column) -> list[Column]:
    """128 bits that stand for a text; equal texts have equal results and share them."""
    column = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(column), F.xxhash64(F.lit(1), column)]


def candidates(docs: DataFrame, text: str, twice: Broadcast) -> DataFrame:
    """t1, t2, start, windows, anchor, digest, again, bytes of segments whose anchor may repeat.

    ``bytes`` is null where the same task has passed on an equal segment.
    """
    schema = "t1 long, t2 long, start int, windows int, anchor long, digest long, again boolean, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, sent = twice.value, set()
        for batch in batches:
            for row, offset, parts in parts_of(utf8(batch.column(2))):
                buf, base, doc, start, windows, anchor, again = segments(parts)
                kept = np.flatnonzero(_repeated(anchor, bits))
                if not len(kept):
                    continue
                doc, start, windows, anchor, again = (x[kept] for x in (doc, start, windows, anchor, again))
                a = base[doc] + start
                b = a + windows + LENGTH - 1
                digest = span_hashes(buf, a, b)
                raw, own = buf.tobytes(), []
                for key, i, j in zip(zip(anchor.tolist(), digest.tolist()), a.tolist(), b.tolist()):
                    new = key not in sent
                    if new:
                        if len(sent) >= REMEMBERED:
                            sent.clear()
                        sent.add(key)
                    own.append(raw[i:j] if new else None)
                rows = pa.array(row[doc])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array((start + offset[doc]).astype(np.int32)),
                     pa.array(windows.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)),
                     pa.array(again), pa.array(own, pa.binary())],
                    ["t1", "t2", "start", "windows", "anchor", "digest", "again", "bytes"],
                )

    return docs.select(*[k.alias(n) for k, n in zip(text_key(text), ("t1", "t2"))], F.col(text).alias("text")).mapInArrow(run, schema)


# --- sorting -------------------------------------------------------------------------------------


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; the empty suffix is the smallest."""
    n = len(text)
    change = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    rises = np.append(text[change[:-1]] < text[change[:-1] + 1], False)
    return np.repeat(rises, np.diff(change, prepend=-1))


def two_stage_sort(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of a byte array in the order of their first ``depth`` bytes at least."""
    raw = text.tobytes()
    rising = smaller_than_next(text)
    # stage 1: direct sorting, bucket by bucket of the first byte
    direct = np.flatnonzero(rising)
    by_byte = direct[np.argsort(text[direct], kind="stable")]
    cuts = np.searchsorted(text[by_byte], np.arange(257))
    incoming: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def induce(found: np.ndarray, byte: int) -> None:
        """Hand on the predecessors with a larger first byte, in order."""
        before = found[found > 0] - 1
        before = before[text[before] > byte]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            places = np.flatnonzero(np.diff(first, prepend=-1))
            for part in np.split(before, places[1:]):
                incoming[text[part[0]]].append(part)

    incoming[raw[-1]].append(np.array([len(text) - 1]))  # precedes the empty suffix
    # stage 2: scan the buckets in order
    for byte in range(256):
        layer = np.concatenate(incoming[byte]) if incoming[byte] else np.zeros(0, np.int64)
        layers = []
        while len(layer):  # suffixes that begin with a run of this byte follow from shorter runs
            layers.append(layer)
            before = layer[layer > 0] - 1
            layer = before[text[before] == byte]
        own = by_byte[cuts[byte]:cuts[byte + 1]].tolist()
        own.sort(key=lambda i: raw[i:i + depth])
        bucket = np.concatenate([*layers, np.array(own, np.int64)])
        if len(bucket):
            out.append(bucket)
            induce(bucket, byte)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each suffix but the first, the bytes it shares with the one before, up to ``limit``."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(limit + 16, np.uint8)])
    word = np.zeros(n + limit + 8, U64)
    for k in range(8):
        word = (word << U64(8)) | padded[k:k + len(word)]
    a, b = order[:-1], order[1:]
    out, at = np.zeros(len(a), np.int64), np.arange(len(a))
    for done in range(0, limit, 8):
        differ = word[a[at] + done] ^ word[b[at] + done]
        same = differ == 0
        stopped = differ[~same]
        if len(stopped):
            # whole equal bytes at the front of the first differing word
            top = np.zeros(len(stopped), np.int64)
            for k in range(1, 8):
                top += (stopped >> U64(64 - 8 * k)) == 0
            out[at[~same]] = done + top
        at = at[same]
        if not len(at):
            break
    out[at] = limit
    return np.minimum(out, limit)


def repeated_windows(parts: list[bytes], windows: list[int]) -> list[np.ndarray]:
    """For each segment, which of its windows also start anywhere else in these segments."""
    sizes = np.array([len(p) + 1 for p in parts])
    base = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(p + b"\xff" for p in parts), np.uint8)
    may = np.zeros(len(text) + 1, np.int64)
    np.add.at(may, base, 1)
    np.add.at(may, base + np.array(windows), -1)
    starts = np.cumsum(may[:-1]) > 0
    order = two_stage_sort(text, LENGTH)
    order = order[starts[order]]
    equal = common_prefixes(text, order, LENGTH) >= LENGTH
    hit = np.zeros(len(text), bool)
    hit[order[:-1][equal]] = True
    hit[order[1:][equal]] = True
    return [hit[b:b + w] for b, w in zip(base, windows)]


def sort_segments(found: DataFrame) -> DataFrame:
    """anchor, digest, mask: bits of the windows that repeat among the segments of their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(groups: list[dict]) -> pa.RecordBatch:
            keys, parts, windows = [], [], []
            for group in groups:
                # a lone segment can only repeat itself
                if len(group["rows"]) > 1 or any(r[2] for r in group["rows"].values()):
                    for digest, (part, n, _) in group["rows"].items():
                        keys.append((group["anchor"], digest))
                        parts.append(part)
                        windows.append(n)
            hits = repeated_windows(parts, windows) if parts else []
            some = [i for i, h in enumerate(hits) if h.any()]
            return pa.RecordBatch.from_arrays(
                [pa.array([keys[i][0] for i in some], pa.int64()), pa.array([keys[i][1] for i in some], pa.int64()),
                 pa.array([np.packbits(hits[i]).tobytes() for i in some], pa.binary())],
                ["anchor", "digest", "mask"],
            )

        groups: list[dict] = []
        size = 0
        for batch in batches:
            for anchor, digest, n, again, part in zip(*(c.to_pylist() for c in batch.columns)):
                if not groups or groups[-1]["anchor"] != anchor:
                    if size >= SORTED_BYTES:
                        yield flush(groups)
                        groups, size = [], 0
                    groups.append({"anchor": anchor, "rows": {}})
                rows = groups[-1]["rows"]
                if digest not in rows:
                    rows[digest] = (part, n, again)
                    size += len(part)
        if groups:
            yield flush(groups)

    placed = found.select("anchor", "digest", "windows", "again", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return placed.mapInArrow(run, "anchor long, digest long, mask binary")


def digest_windows(found: DataFrame) -> DataFrame:
    """The same for anchors with very many segments: equal windows meet by 128 bits of digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed(held: list[tuple]) -> pa.RecordBatch:
            n = [len(h[2]) for h in held]
            columns = [np.repeat([h[k] for h in held], n) for k in (0, 1)]
            columns += [np.concatenate([h[k] for h in held]) for k in (2, 3, 4)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c.view(np.int64) if c.dtype == U64 else c) for c in columns], ["anchor", "digest", "at", "d1", "d2"]
            )

        held, size = [], 0
        for batch in batches:
            for anchor, digest, n, part in zip(*(c.to_pylist() for c in batch.columns)):
                buf, at = np.frombuffer(part, np.uint8), np.arange(n)
                ends = at + LENGTH
                held.append((anchor, digest, at.astype(np.int32), span_hashes(buf, at, ends), span_hashes(_FLIPPED[buf], at, ends)))
                size += n
                if size >= GATHERED // 4:
                    yield passed(held)
                    held, size = [], 0
        if held:
            yield passed(held)

    windows = found.select("anchor", "digest", "windows", "bytes").mapInArrow(
        run, "anchor long, digest long, at int, d1 long, d2 long"
    )
    # one row per task and window leaves the scan, so what all documents share is no hot group
    place = F.struct("digest", "at")
    twice = windows.groupBy("d1", "d2").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select(
        dealt_anew("d1").alias("e1"), F.col("d2").alias("e2")
    )
    hit = windows.join(twice, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left_semi")
    # a segment has SEGMENT_WINDOWS windows at most
    bits = hit.groupBy("anchor", "digest").agg(F.collect_set("at").alias("at"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = []
            for places in batch.column(2).to_pylist():
                mask = np.zeros(max(places) + 1, bool)
                mask[places] = True
                masks.append(np.packbits(mask).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(masks, pa.binary())], ["anchor", "digest", "mask"])

    return bits.mapInArrow(packed, "anchor long, digest long, mask binary")


_FLIPPED = np.random.default_rng(5).permutation(256).astype(np.uint8)


# --- spans ---------------------------------------------------------------------------------------


def repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """t1, t2, found: per text with repeated windows, structs of start, windows, mask (null: all)."""
    spark, place = docs.sparkSession, new_dir(docs.sparkSession, "suffixes")
    rows = docs.select(F.col(text).alias("text"))
    candidates(docs, text, seen_twice(rows)).write.option("compression", "zstd").parquet(place)
    found = spark.read.schema(
        "t1 long, t2 long, start int, windows int, anchor long, digest long, again boolean, bytes binary"
    ).parquet(place)

    # equal segments in two places: all their windows repeat
    whole = found.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "anchor", "digest", F.lit(None).cast("binary").alias("mask")
    )
    with_bytes = found.where("bytes is not null")
    # anchors worth sorting have two different segments, or one that may repeat itself
    anchors = with_bytes.groupBy("anchor").agg(
        (F.min("digest") != F.max("digest")).alias("differ"), F.max("again").alias("self"),
        F.approx_count_distinct("digest", 0.05).alias("segments"),
    ).where("differ or self").select(dealt_anew("anchor").alias("_anchor"), (F.col("segments") > HOT_SEGMENTS).alias("hot"))
    wanted = with_bytes.join(anchors, F.col("anchor") == F.col("_anchor")).drop("_anchor")
    # every task may have passed on a segment: one of each goes on
    wanted = wanted.dropDuplicates(["anchor", "digest"])
    chosen = new_dir(spark, "segments")
    wanted.select("anchor", "digest", "windows", "again", "bytes", "hot").write.option("compression", "zstd").parquet(chosen)
    chosen_rows = spark.read.schema(
        "anchor long, digest long, windows int, again boolean, bytes binary, hot boolean"
    ).parquet(chosen)
    partly = sort_segments(chosen_rows.where("not hot")).unionByName(digest_windows(chosen_rows.where("hot")))

    # a segment that repeats whole needs no mask
    marks = whole.unionByName(partly).groupBy("anchor", "digest").agg(
        F.max(F.col("mask").isNull()).alias("all"), F.max("mask").alias("mask")
    ).select(
        dealt_anew("anchor").alias("_anchor"), F.col("digest").alias("_digest"), F.when(~F.col("all"), F.col("mask")).alias("mask")
    )
    on = (F.col("anchor") == F.col("_anchor")) & (F.col("digest") == F.col("_digest"))
    hits = found.select("t1", "t2", "start", "windows", "anchor", "digest").join(marks, on)
    # copies of a text bring equal rows, which collapse before the shuffle; a text has few segments
    return hits.groupBy("t1", "t2").agg(F.collect_set(F.struct("start", "windows", "mask")).alias("found"))


def covered(size: int, found: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes of a text that repeated windows cover."""
    if not found:
        return []
    step = np.zeros(size + 1, np.int32)
    for f in found:
        if f["mask"] is None:
            a, b = np.array([0]), np.array([f["windows"]])
        else:
            mask = np.unpackbits(np.frombuffer(f["mask"], np.uint8))[:f["windows"]].astype(bool)
            a, b = runs(mask)
        np.add.at(step, f["start"] + a, 1)
        np.add.at(step, f["start"] + b + LENGTH - 1, -1)
    a, b = runs(np.cumsum(step[:-1]) > 0)
    return list(zip(a.tolist(), b.tolist()))


def remove_repeats(docs: DataFrame, text: str = "text", out: str = "_kept", carry: list[str] | None = None, valid: bool = False) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all but the text) and a struct ``out``.

    ``out`` has bytes (what is left), n_bytes, n_removed, n_spans. With ``valid`` the rest of a
    character that was cut is left out of ``bytes``, so that they are UTF-8 again.
    """
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    spans = repeats(docs, text)
    keys = [f"{out}_1", f"{out}_2"]
    keyed = docs.select(*carry, F.col(text).alias(f"{out}_text"), *[k.alias(n) for n, k in zip(keys, text_key(text))])
    found = spans.select(*[dealt_anew(t).alias(f"{n}_found") for n, t in zip(keys, ("t1", "t2"))], F.col("found").alias(f"{out}_found"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{k}_found") for k in keys])
    rows = keyed.join(found, on, "left").select(*carry, f"{out}_text", f"{out}_found")
    kept = T.StructType([
        T.StructField("bytes", T.BinaryType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    ])
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, size, removed, count = [], [], [], []
            for raw, found in zip(utf8(batch.column(n)), batch.column(n + 1).to_pylist()):
                cut = covered(len(raw), found)
                starts, ends = [*[a for a, _ in cut], len(raw)], [0, *[b for _, b in cut]]
                rest = b"".join(raw[a:b] for a, b in zip(ends, starts))
                left.append(rest.decode("utf-8", "ignore").encode() if valid and cut else rest)
                size.append(len(raw))
                removed.append(sum(b - a for a, b in cut))
                count.append(len(cut))
            struct = pa.StructArray.from_arrays(
                [pa.array(left, pa.binary()), *[pa.array(x, pa.int64()) for x in (size, removed, count)]], names=kept.names
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], struct], [*batch.schema.names[:n], out])

    return rows.mapInArrow(run, T.StructType([*[docs.schema[c] for c in carry], T.StructField(out, kept)]))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(documents(spark, sf_dir), carry=["doc_id"])
    return rows.select("doc_id", "_kept.n_bytes", "_kept.n_removed", "_kept.n_spans", F.sha2("_kept.bytes", 256).alias("kept_sha256"))


def stage_suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the repeated bytes.

    Where a cut falls inside a character, what is left of the character goes too. ``n_chars``, if
    there, counts the characters that are left. A null text becomes an empty one.
    """
    ship(spark)
    out = "_kept"
    while any(c.startswith(out) for c in docs.columns):
        out = "_" + out
    rows = remove_repeats(docs, out=out, valid=True)
    text, cut = F.col(f"{out}.bytes").cast("string"), F.col(f"{out}.n_removed") > 0
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(cut, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])
