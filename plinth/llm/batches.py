"""Arrow batches of texts: UTF-8 bytes, bounded pieces, and byte arrays NumPy can work on."""

from __future__ import annotations

import os
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text worked on at once inside a task; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20

U64 = np.uint64


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed on the executors, or lies at the same path.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(column: pa.Array) -> list[bytes]:
    """Values as UTF-8 bytes; null is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    filled = column.cast(kind)
    return pc.fill_null(filled, b"").to_pylist()


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most ``limit`` bytes together, or one longer text alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def parts(batch: pa.RecordBatch, text: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut where column ``text`` reaches ``limit`` bytes; what a task makes of a part is let go with it."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
    start = size = 0
    for i, more in enumerate(sizes.tolist()):
        if size and size + more > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += more + 1
    if start < len(sizes):
        yield batch.slice(start)


_kept: dict[Hashable, object] = {}


def keep(key: Hashable, make: Callable[[], object]) -> object:
    """What a worker process keeps from task to task, for one key at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """A task that keeps nothing frees what tasks of another operator have left in its worker."""
    _kept.clear()
    pa.default_memory_pool().release_unused()


def joined(texts: list[bytes], sep: bytes = b"\x00") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one byte array with ``sep`` after each, and each text's start and end in it."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + len(sep)) - len(sep)
    buf = np.frombuffer(sep.join(texts) + sep if texts else b"", np.uint8)
    return buf, ends - sizes, ends


def table(marked: bytes) -> np.ndarray:
    """Lookup of 256 booleans, true for the bytes given."""
    out = np.zeros(256, bool)
    out[list(marked)] = True
    return out


#: The bytes that part words: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = table(b" \t\n\x0b\x0c\r")


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (the finaliser of MurmurHash3)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), U64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * U64(pow(base, done, 1 << 64))
        done += step
    return out[:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans have equal hashes wherever they lie.

    A long array is worked on part by part, for which ``starts`` must be in order.
    """
    if len(buf) > 2 * PIECE_BYTES:
        out = np.empty(len(starts), U64)
        cuts = np.append(np.searchsorted(starts, np.arange(0, len(buf), PIECE_BYTES)), len(starts))
        for lo, hi in zip(cuts, cuts[1:]):
            if lo < hi:
                a, b = starts[lo], ends[lo:hi].max()
                out[lo:hi] = _span_hashes(buf[a:b], starts[lo:hi] - a, ends[lo:hi] - a)
        return out
    return _span_hashes(buf, starts, ends)


def _span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up = _powers(_BASE, len(buf) + 1)
    # mixed bytes, as a polynomial over raw text bytes collides on related short words
    values = mix(np.arange(1, 257, dtype=U64))[buf]
    sums = np.zeros(len(buf) + 1, U64)
    np.cumsum(values * up[:-1], out=sums[1:])
    # multiplying by the inverse power brings each span back to position 0
    down = _powers(pow(_BASE, -1, 1 << 64), len(buf) + 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def group_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[start:end]`` for each range, alike wherever the range lies; 0 for empty ones."""
    if not len(starts):
        return np.zeros(0, values.dtype)
    padded = np.append(values, values.dtype.type(0))
    sums = np.add.reduceat(padded, np.stack([starts, ends], 1).ravel())[::2]
    return np.where(ends > starts, sums, values.dtype.type(0))
