"""Exact deduplication of word windows by super-k-mers.

A word goes if a window of ``WINDOW`` words that covers it also starts anywhere else. The minimiser
of a window is the smallest hash of the ``GRAM``-word strings inside, so equal windows have equal
minimisers. Consecutive windows that share one travel as one packed string, a super-k-mer, to the
bucket of their minimiser. There the suffixes of all strings are sorted by their first ``WINDOW``
words, and neighbours that agree in them are counted.

Frequent grams make poor minimisers: a line that everybody quotes would pull all that surrounds it
into one bucket. The ``HEAVY`` most frequent ones therefore rank behind all others, and a window
made of nothing else goes by its smallest string of ``LONG_GRAM`` words instead. This is a rule on
a window's content alone, so equal windows still meet.

What is equal inside a task leaves it once: a text that comes twice sends its strings once, with
their number, and a string that stands in two texts is known to repeat at once, so it goes to its
bucket as a bare count while its places go back on their own. A bucket thus sees a string once for
each task, however many documents hold it.

Defined cases: a null text has no words; a text of fewer words than a window stays whole; texts
that are equal and long enough lose all words, the first one too; ids may be null or repeat.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.batches import U64, documents, mix, runs, utf8
from plinth.llm.decontaminate import SuffixArray
from plinth.llm.skew import dealt_anew
from plinth.llm.suffix_dedup import text_key
from plinth.llm.words import cut, groups, placed, rolled

WINDOW = 35
GRAM = 5
LONG_GRAM = 20
#: Frequent grams that rank last, at most; what is left has less than this part of all words.
HEAVY = 1 << 16
#: Bytes of text whose grams are counted together.
COUNTED_BYTES = 8 << 20
#: Windows of a super-k-mer at most; a longer run is cut, windows are not.
MOST_WINDOWS = 512
#: Bytes of strings of a bucket, about; a byte of text makes ``SPREAD`` bytes of strings.
BUCKET_BYTES = 4 << 20
SPREAD = 3
#: Buckets a task sorts, about, one after the other.
BUCKETS_PER_TASK = 8
#: Bytes of text whose strings a task gathers before it passes them on.
GATHERED_BYTES = 12 << 20
#: Level of compression of the packed strings.
LEVEL = 6
#: Bytes of packed strings in one batch of rows.
BATCH_BYTES = 8 << 20

#: Parts the strings of a bucket; no byte of UTF-8.
BETWEEN = b" \xff "
_LAST = np.iinfo(U64).max
_PLACE = np.dtype([("t1", "<i8"), ("t2", "<i8"), ("part", "<i4"), ("start", "<i4")])
_MARK = np.dtype([("t1", "<i8"), ("t2", "<i8"), ("a", "<i4"), ("b", "<i4")])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    known = 1
    while known * 2 <= width:
        values = np.minimum(values[:-known], values[known:])
        known *= 2
    return np.minimum(values[:known - width], values[width - known:]) if width > known else values


def super_kmers(words: np.ndarray, first: np.ndarray, last: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, ...]:
    """text, start, windows, minimiser of the super-k-mers of some texts; ``start`` counts from the first word of all."""
    n = len(words) - WINDOW + 1
    if n < 1:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, U64))
    grams = mix(rolled(words, GRAM))
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)
        grams = np.where(heavy[at] == grams, _LAST, grams)
    least = _smallest(grams, WINDOW - GRAM + 1)
    common = least == _LAST
    if common.any():
        longer = _smallest(mix(rolled(words, LONG_GRAM)), WINDOW - LONG_GRAM + 1)
        least = np.where(common, mix(longer), least)
    valid = np.zeros(n + 1, np.int64)
    long = np.flatnonzero(last - first >= WINDOW)
    np.add.at(valid, first[long], 1)
    np.add.at(valid, last[long] - WINDOW + 1, -1)
    inside = np.cumsum(valid[:-1]) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    new[first[long]] = True
    start = np.flatnonzero(new)
    text = np.searchsorted(first, start, "right") - 1
    stop = np.minimum(np.append(start[1:], n), last[text] - WINDOW + 1)
    parts = -(-(stop - start) // MOST_WINDOWS)
    owner = np.repeat(np.arange(len(start)), parts)
    begin = start[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * MOST_WINDOWS
    return text[owner], begin, np.minimum(stop[owner] - begin, MOST_WINDOWS), least[begin]


def parts_of(texts: list[bytes], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, tuple]]:
    """Rows, number of the first word, and :func:`placed` words of parts, which share no window.

    A long text comes in parts, each with the words before it that windows of its own begin in.
    """
    before: list[bytes] = []
    seen, row = 0, -1
    for rows, parts in groups(texts, limit):
        offsets, held = [], []
        for r, part in zip(rows, parts):
            if r != row:
                before, seen, row = [], 0, r
            offsets.append(seen - len(before))
            held.append(b" ".join([*before, part]) if before else part)
            if len(part) < len(texts[r]):
                words = part.split()
                seen += len(words)
                before = [*before, *words][1 - WINDOW:]
        yield np.array(rows), np.array(offsets), placed(held)


# --- frequent grams ------------------------------------------------------------------------------


def heavy_grams(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Hashes of the most frequent grams in order, at most ``HEAVY``, and the bytes of all texts.

    A gram with more than one in ``HEAVY`` of all words has so many in some part of a task, so each
    part passes on those that have; their sums are exact enough to choose by. Any choice gives the
    same result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 0
        for batch in batches:
            once = {}  # copies of a text count once in a batch, as their strings travel once
            for key, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), utf8(batch.column(2))):
                once[key] = text
                size += len(text)
            for _, _, (_, words, _, _, first, last) in parts_of(list(once.values()), COUNTED_BYTES):
                found, n = np.unique(mix(rolled(words, GRAM)), return_counts=True)
                some = n > max(16, len(words) // HEAVY)
                if some.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[some].view(np.int64)), pa.array(n[some]), pa.array(np.zeros(int(some.sum()), np.int64))], ["gram", "n", "size"]
                    )
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([size])], ["gram", "n", "size"])

    counts = texts.mapInArrow(run, "gram long, n long, size long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    size = F.col("gram") == 0  # its one row; a real gram of hash 0 adds no bytes and need not be heavy
    rows = counts.orderBy(size.desc(), F.desc("n"), "gram").limit(HEAVY + 1).toArrow()  # 64 K rows at most
    grams, n = rows.column("gram").to_numpy(), rows.column("n").to_numpy()
    return np.sort(grams[(n > 0) & (grams != 0)].view(U64)), sum(rows.column("size").to_pylist())


# --- strings -------------------------------------------------------------------------------------

STRINGS = "bucket long, strings binary, counts binary, places binary, marks binary"


class Gathered:
    """Strings of a task, which :meth:`passed` sorts into buckets."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.copies: dict[tuple[int, int], int] = {}
        self.size = 0
        self.found: list[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def new(self, key: tuple[int, int], size: int) -> bool:
        """Whether a text is the first of its kind here."""
        n = self.copies.get(key, 0)
        self.copies[key] = n + 1
        self.size += 0 if n else size
        return n == 0

    def add(self, keys: np.ndarray, offsets: np.ndarray, words: tuple, heavy: np.ndarray) -> None:
        raw, hashes, a, b, first, last = words
        text, start, windows, least = super_kmers(hashes, first, last, heavy)
        if len(start):
            bucket = (mix(least ^ U64(0x5BD1E995)) % U64(self.buckets)).astype(np.int64)
            self.found.append((raw, a[start], b[start + windows + WINDOW - 2], bucket, keys[text],
                               start - first[text] + offsets[text], windows))

    def passed(self) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        if self.found:
            sizes = [len(f[3]) for f in self.found]
            raws, source = [f[0] for f in self.found], np.repeat(np.arange(len(sizes)), sizes)
            begin, end, bucket, key, start, windows = (np.concatenate([f[k] for f in self.found]) for k in range(1, 7))
            weight = np.array([self.copies[tuple(k)] for k in key.tolist()])
            order = np.argsort(bucket, kind="stable")
            marks: list[np.ndarray] = []
            codec = pa.Codec("zstd", compression_level=LEVEL)
            for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                strings: dict[bytes, int] = {}
                part = np.array([
                    strings.setdefault(raws[s][i:j], len(strings)) for s, i, j in zip(source[at].tolist(), begin[at].tolist(), end[at].tolist())
                ])
                total = np.bincount(part, weight[at]).astype("<i4")
                sure = total[part] > 1
                marks.append(_record(_MARK, *key[at[sure]].T, start[at[sure]], start[at[sure]] + windows[at[sure]]))
                places = _record(_PLACE, *key[at[~sure]].T, part[~sure], start[at[~sure]])
                packed = BETWEEN.join(strings)
                blob = len(packed).to_bytes(4, "little") + codec.compress(packed, asbytes=True)
                rows.append((int(bucket[at[0]]), blob, total.tobytes(), places.tobytes(), None))
                size += len(blob) + places.nbytes
                if size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
            # what is known to repeat goes back by way of any bucket
            known = np.concatenate(marks)
            lanes = (mix(known["t1"].astype(U64)) % U64(min(self.buckets, 64))).astype(np.int64)
            for lane in np.unique(lanes):
                rows.append((int(lane) * self.buckets // min(self.buckets, 64), None, None, None, known[lanes == lane].tobytes()))
        if rows:
            yield _batch(rows)
        self.__init__(self.buckets)


def _record(kind: np.dtype, *columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), kind)
    for name, column in zip(kind.names, columns):
        out[name] = column
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in STRINGS.split(", ")])


def strings(texts: DataFrame, heavy: np.ndarray, buckets: int) -> DataFrame:
    """The packed strings of all texts by bucket, with their counts and the places of those not known to repeat."""
    sent = texts.sparkSession.sparkContext.broadcast(heavy)  # HEAVY hashes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Gathered(buckets)
        for batch in batches:
            held, keys, size = [], [], 0
            for key, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), utf8(batch.column(2))):
                if gathered.new(key, len(text)):
                    held.append(text)
                    keys.append(key)
                    size += len(text)
                if size >= GATHERED_BYTES // 4 or gathered.size >= GATHERED_BYTES:
                    _add(gathered, held, keys, sent.value)
                    held, keys, size = [], [], 0
                    if gathered.size >= GATHERED_BYTES:
                        yield from gathered.passed()
            _add(gathered, held, keys, sent.value)
        yield from gathered.passed()

    return texts.mapInArrow(run, STRINGS)


def _add(gathered: Gathered, texts: list[bytes], keys: list[tuple[int, int]], heavy: np.ndarray) -> None:
    for rows, offsets, words in parts_of(texts, GATHERED_BYTES // 4):
        gathered.add(np.array(keys, np.int64).reshape(-1, 2)[rows], offsets, words, heavy)


# --- buckets -------------------------------------------------------------------------------------


def counted_windows(parts: list[bytes], weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each string, the runs of its windows that stand in two places; a string counts ``weights`` times."""
    number = defaultdict(count(1).__next__)
    number[b"\xff"] = 0
    tokens = BETWEEN.join([*parts, b""]).split()
    ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    ends = np.flatnonzero(ids == 0)
    begins = np.append(0, ends[:-1] + 1)
    step = np.zeros(len(ids) + 1, np.int64)
    step[begins] += 1
    step[ends - WINDOW + 1] -= 1
    is_window = np.cumsum(step[:-1]) > 0
    order = SuffixArray(ids, len(number), WINDOW).order
    order = order[is_window[order]]
    a, b = order[:-1], order[1:]
    same = np.arange(len(a))
    for k in range(WINDOW):
        same = same[ids[a[same] + k] == ids[b[same] + k]]
    new = np.ones(len(order), bool)
    new[same + 1] = False
    group = np.cumsum(new) - 1
    weight = np.repeat(weights, ends - begins + 1)
    repeated = np.zeros(len(ids), bool)
    repeated[order] = np.bincount(group, weight[order])[group] > 1
    a, b = runs(repeated)
    cuts = np.searchsorted(a, np.append(begins, len(ids)))
    return [(a[i:j] - s, b[i:j] - s) for i, j, s in zip(cuts, cuts[1:], begins)]


def marks(found: DataFrame, tasks: int) -> DataFrame:
    """t1, t2, a, b: windows a to b - 1 of a text stand in two places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: dict[bytes, int], weights: list[int], places: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            place = np.concatenate(places) if places else np.zeros(0, _PLACE)
            if not len(place):
                return  # all its places are known already
            runs_of = counted_windows(list(held), np.array(weights))
            n = np.array([len(a) for a, _ in runs_of])
            begin, end = (np.concatenate([r[k] for r in runs_of]) for k in (0, 1))
            first = np.cumsum(n) - n
            owner = np.repeat(np.arange(len(place)), n[place["part"]])
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(n[place["part"]]) - n[place["part"]], n[place["part"]])
            at = first[place["part"][owner]] + nth
            yield rows(place["t1"][owner], place["t2"][owner], place["start"][owner] + begin[at], place["start"][owner] + end[at])

        def rows(*columns: np.ndarray) -> pa.RecordBatch:
            kinds = [np.int64, np.int64, np.int32, np.int32]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, kinds)], ["t1", "t2", "a", "b"])

        now, held, weights, places = None, {}, [], []
        for batch in batches:
            for bucket, blob, counts, place, mark in zip(*(c.to_pylist() for c in batch.columns)):
                if mark is not None:
                    known = np.frombuffer(mark, _MARK)
                    yield rows(*(known[c] for c in _MARK.names))
                    continue
                if bucket != now:
                    yield from flush(held, weights, places)
                    now, held, weights, places = bucket, {}, [], []
                packed = pa.decompress(blob[4:], int.from_bytes(blob[:4], "little"), "zstd", asbytes=True)
                local = []
                for part, n in zip(packed.split(BETWEEN), np.frombuffer(counts, "<i4").tolist()):
                    at = held.setdefault(part, len(held))
                    local.append(at)
                    if at < len(weights):
                        weights[at] += n
                    else:
                        weights.append(n)
                place = np.frombuffer(place, _PLACE).copy()
                place["part"] = np.array(local)[place["part"]]
                places.append(place)
        yield from flush(held, weights, places)

    dealt = found.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "t1 long, t2 long, a int, b int")


def repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """t1, t2, found: for each text with repeated windows, their runs as structs of a and b."""
    texts = docs.select(*[k.alias(n) for k, n in zip(text_key(text), ("t1", "t2"))], F.col(text).alias("text"))
    heavy, size = heavy_grams(texts)
    buckets = max(1, -(-SPREAD * size // BUCKET_BYTES))
    found = marks(strings(texts, heavy, buckets), -(-buckets // BUCKETS_PER_TASK))
    return found.groupBy("t1", "t2").agg(F.collect_set(F.struct("a", "b")).alias("found"))


# --- texts ---------------------------------------------------------------------------------------


def left(text: bytes, spans: np.ndarray, limit: int = 1 << 20) -> tuple[int, int, list[bytes]]:
    """Number of words, of removed words, and what is left of a text: pieces of words joined by one space.

    ``spans`` has a row for each run of words to remove, which may overlap.
    """
    n = removed = 0
    kept = []
    for a, b in cut(text, limit):
        words = text[a:b].split()
        if len(spans):
            step = np.zeros(len(words) + 1, np.int64)
            near = np.clip(spans - n, 0, len(words))
            np.add.at(step, near[:, 0], 1)
            np.add.at(step, near[:, 1], -1)
            stays = np.cumsum(step[:-1]) == 0
            removed += len(words) - int(stays.sum())
            n += len(words)
            words = list(compress(words, stays.tolist()))
        else:
            n += len(words)
        if words:
            kept.append(b" ".join(words))
    return n, removed, kept


def remove_repeats(docs: DataFrame, text: str = "text", out: str = "_kept", carry: list[str] | None = None, keep_text: bool = True) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all but the text) and a struct ``out``.

    ``out`` has n_words, n_removed, sha256 of the words that are left, joined by one space, and,
    unless ``keep_text`` is false, these as ``text``.
    """
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    keys = [f"{out}_1", f"{out}_2"]
    keyed = docs.select(*carry, F.col(text).alias(f"{out}_text"), *[k.alias(n) for n, k in zip(keys, text_key(text))])
    spans = repeats(docs, text).select(*[dealt_anew(t).alias(f"{n}_found") for n, t in zip(keys, ("t1", "t2"))], F.col("found").alias(f"{out}_found"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{k}_found") for k in keys])
    rows = keyed.join(spans, on, "left").select(*carry, f"{out}_text", f"{out}_found")
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("sha256", T.StringType())]
    fields += [T.StructField("text", T.StringType())] if keep_text else []
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = []
            found = batch.column(n + 1)
            at, runs_of = found.offsets.to_numpy(), found.values
            spans = np.stack([runs_of.field(0).to_numpy(), runs_of.field(1).to_numpy() + WINDOW - 1], axis=1)
            for raw, i, j in zip(utf8(batch.column(n)), at, at[1:]):
                words, removed, kept = left(raw, spans[i:j])
                digest = hashlib.sha256()
                for k, piece in enumerate(kept):
                    digest.update(b" " + piece if k else piece)
                results.append((words, removed, digest.hexdigest(), *([b" ".join(kept).decode()] if keep_text else [])))
            columns = list(zip(*results)) if results else [()] * len(fields)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            struct = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.name for f in fields])
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], struct], [*batch.schema.names[:n], out])

    return rows.mapInArrow(run, T.StructType([*[docs.schema[c] for c in carry], T.StructField(out, T.StructType(fields))]))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(documents(spark, sf_dir), carry=["doc_id"], keep_text=False)
    return rows.select("doc_id", "_kept.n_words", "_kept.n_removed", F.col("_kept.sha256").alias("kept_sha256"))
