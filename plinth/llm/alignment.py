"""Alignment of two tokenizers over the same bytes, and how often their tokens end together.

Both token sequences of a text cover the same bytes, so each is an array of end offsets. The arrays
are compared along a diagonal: from a pair of places (i, j) the next 2, 4, 8 … ends are compared at
the shift j - i, and as long as they are equal the tokens go one to one. Where they differ, the side
that is behind moves on until both end at the same byte; this closes an irregular group and updates
the shift. A text is cut at places that both tokenizers end at for certain, and the diagonals of
many such lanes are walked together in NumPy.

A task encodes each distinct piece of text once. What a text needs later (its pairs of linked ids)
is written to the shared folder, so texts are encoded once; the pairs are counted over the corpus
and the counts brought back. Two tokens that end together at the same byte are such that the
shorter one's bytes end the longer one, so the vocabularies alone bound the number of pairs
(:func:`pair_bound`), whatever the corpus holds.

Defined cases: texts that are null or empty, or whose tokens do not spell them out, have no tokens;
equal rows are aligned alike; ids may be null or repeat. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.batches import documents, utf8
from plinth.llm.words import SAFE_CUT
from plinth.session import new_dir

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Characters of text aligned at once; a longer text comes in segments.
SEGMENT = 1 << 18
#: Pieces of text in a lane, and ends compared at once in it at most.
LANE = 64
WIDEST = 256
#: Distinct pieces a worker remembers; beyond it starts anew.
KEPT_PIECES = 300_000
#: Texts whose results a worker holds before it hands them on.
ROWS = 500
#: Pieces given to the libraries in one call.
CALL = 2000

_BYTE = re.compile(r"^<0x([0-9A-F]{2})>$")


# --- vocabularies --------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for bytes: printable ones for themselves, then from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + k): b for k, b in enumerate(other)}}


def tokens_a(vocabulary: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; special tokens are none of them."""
    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
        model = json.load(file)
    special = {t["id"] for t in model["added_tokens"]}
    letters, out = _byte_letters(), [b""] * (1 + max([*model["model"]["vocab"].values(), *special]))
    for token, i in model["model"]["vocab"].items():
        if i not in special:
            out[i] = bytes(letters[c] for c in token)
    return out


def tokens_b(vocabulary: str) -> list[bytes]:
    """The bytes of each id of a piece vocabulary; control pieces stand for none."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    out = []
    for i in range(model.get_piece_size()):
        piece, byte = model.id_to_piece(i), _BYTE.match(model.id_to_piece(i))
        if model.is_control(i) or model.is_unknown(i):
            out.append(b"")
        else:
            out.append(bytes([int(byte[1], 16)]) if byte and model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """Pairs of tokens that can end together: one is the end of the other."""
    def ends(tokens: list[bytes], others: dict[bytes, int]) -> int:
        return sum(others.get(t[k:], 0) for t in tokens for k in range(len(t)))

    def counted(tokens: list[bytes]) -> dict[bytes, int]:
        out: dict[bytes, int] = {}
        for t in tokens:
            if t:
                out[t] = out.get(t, 0) + 1
        return out

    in_a, in_b = counted(a), counted(b)
    equal = sum(n * in_b.get(t, 0) for t, n in in_a.items())
    return ends(a, in_b) + ends(b, in_a) - equal


class Encoder:
    """Token ids of both vocabularies for texts with a space in front, each distinct piece once."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(vocabulary_a))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary_b))
        self.bytes_a, self.bytes_b = tokens_a(vocabulary_a), tokens_b(vocabulary_b)
        self.size_a, self.size_b = (np.array([len(t) for t in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        # ids as text, followed by what may come after them
        self.text_a, self.text_b = (
            np.array([f"{i}{mark}" for mark in marks for i in range(len(v))], object)
            for v, marks in ((self.bytes_a, ",|"), (self.bytes_b, ",;"))
        )
        # no merge crosses a space after another character if no piece holds one inside
        self.cuts = not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(len(self.bytes_b)))
        self.forget()

    def forget(self) -> None:
        """Start anew: numbers of pieces, and the ids of piece k from ``first[k]`` to ``first[k + 1]``."""
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]  # as long as all pieces kept
        self.first = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.spelled = np.zeros(0, bool)

    def pieces(self, text: str) -> list[str]:
        """Parts of a text that begins with a space; tokens of both sides end at each cut."""
        return SAFE_CUT.split(text) if self.cuts else [text]

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece; those not known are encoded first."""
        if len(self.known) > KEPT_PIECES:
            self.forget()
        missing = list(set(pieces).difference(self.known))
        new: list[tuple[np.ndarray, ...]] = []
        for at in range(0, len(missing), CALL):
            self._learn(missing[at:at + CALL], new)
        if new:
            whole, *ids_and_sizes = (np.concatenate(x) for x in zip(*new))
            self.spelled = np.append(self.spelled, whole)
            for k in (0, 1):
                self.ids[k] = np.append(self.ids[k], ids_and_sizes[k].astype(np.int32))
                self.first[k] = np.append(self.first[k], self.first[k][-1] + np.cumsum(ids_and_sizes[k + 2]))
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def _learn(self, pieces: list[str], new: list[tuple[np.ndarray, ...]]) -> None:
        """Number some pieces, and add to ``new`` whether each is spelled out, its ids on both sides and how many."""
        # pieces that end in no white space can follow one another: their borders are safe cuts as well
        open_ = [p for p in pieces if self.cuts and not p[-1].isspace()]
        others = [p for p in pieces if not self.cuts or p[-1].isspace()]
        for call in [open_, *[[p] for p in others]]:
            if not call:
                continue
            text = "".join(call)
            ids = [
                np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64),
                # the library for B puts the space in front by itself, but not before nothing
                np.array(self.b.encode(text[1:], num_threads=1) or [self.b.piece_to_id("▁")], np.int64),
            ]
            raw, cuts = text.encode(), np.cumsum([len(p.encode()) for p in call])
            places, whole = [], True
            for k, (vocabulary, sizes) in enumerate(((self.bytes_a, self.size_a), (self.bytes_b, self.size_b))):
                ends = np.cumsum(sizes[ids[k]])
                places.append(np.searchsorted(ends, cuts) + 1)
                whole &= np.isin(cuts, ends).all() and raw == b"".join(map(vocabulary.__getitem__, ids[k].tolist()))
            if not whole:  # some piece is not spelled out, or not by tokens of its own
                if len(call) > 1:
                    for piece in call:
                        self._learn([piece], new)
                    continue
                ids, places = [np.zeros(0, np.int64)] * 2, [np.zeros(1, np.int64)] * 2
            for piece in call:
                self.known[piece] = len(self.known)
            new.append((np.full(len(call), whole), *ids, *(np.diff(p, prepend=0) for p in places)))

    def tokens(self, numbers: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some pieces, and where each piece ends among them."""
        first = self.first[side]
        n = first[numbers + 1] - first[numbers]
        ends = np.cumsum(n)
        return self.ids[side][np.repeat(first[numbers] - (ends - n), n) + np.arange(int(n.sum()))].astype(np.int64), ends


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary_a: str, vocabulary_b: str) -> Encoder:
    """The encoder of this worker process, kept from task to task."""
    key = vocabulary_a, vocabulary_b
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


# --- diagonals -----------------------------------------------------------------------------------


def common_ends(a: np.ndarray, b: np.ndarray, lanes_a: np.ndarray, lanes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the two arrays of ends whose values are equal, in order.

    Lane k begins at ``lanes_a[k]`` and ``lanes_b[k]``; the places before both hold the same end, and
    so do the last places of the arrays. Ends rise within an array.
    """
    n = len(a)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # beyond the end nothing is equal any more
    a, b = np.append(a, -1), np.append(b, -2)
    stop = np.append(lanes_a[1:], n)
    i, shift = lanes_a.copy(), lanes_b - lanes_a
    width = np.full(len(i), 2)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    live = np.flatnonzero(i < stop)
    while len(live):
        irregular = []
        for w in np.unique(width[live]):
            lanes = live[width[live] == w]
            at = i[lanes][:, None] + np.arange(w)
            inside = at < stop[lanes][:, None]
            equal = inside & (a[np.minimum(at, n)] == b[np.minimum(at + shift[lanes][:, None], len(b) - 1)])
            run = np.where(equal.all(1), w, np.argmin(equal, 1))
            row, k = np.nonzero(np.arange(w) < run[:, None])
            found.append((at[row, k], at[row, k] + shift[lanes[row]]))
            i[lanes] += run
            through = run == w
            width[lanes[through]] = min(2 * w, WIDEST)
            irregular.append(lanes[~through])
        lanes = np.concatenate(irregular)
        lanes = lanes[i[lanes] < stop[lanes]]
        if len(lanes):
            # the side that is behind moves on until both end at the same byte
            x, y = i[lanes], i[lanes] + shift[lanes]
            open_ = np.arange(len(lanes))
            while len(open_):
                ends_a, ends_b = a[x[open_]], b[y[open_]]
                x[open_[ends_a < ends_b]] += 1
                y[open_[ends_b < ends_a]] += 1
                open_ = open_[ends_a != ends_b]
            found.append((x, y))
            i[lanes], shift[lanes], width[lanes] = x + 1, y - x, 2
        live = live[i[live] < stop[live]]
    x, y = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    order = np.argsort(x)
    return x[order], y[order]


@dataclass(frozen=True)
class Aligned:
    """Both ids of the tokens of some segments, and the places of the links among them."""

    a: np.ndarray
    b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    #: first and last token of each segment, on both sides, and its first and last link
    cuts_a: np.ndarray
    cuts_b: np.ndarray
    cuts_link: np.ndarray


def align(pieces: np.ndarray, segments: np.ndarray, coder: Encoder) -> Aligned:
    """Align segments, of which each ends at a place of ``segments`` in ``pieces``, the numbers of spelled pieces."""
    (a, ends_a), (b, ends_b) = coder.tokens(pieces, 0), coder.tokens(pieces, 1)
    starts_a, starts_b = np.append(0, ends_a), np.append(0, ends_b)
    lanes = np.arange(0, max(len(pieces), 1), LANE)
    link_a, link_b = common_ends(np.cumsum(coder.size_a[a]), np.cumsum(coder.size_b[b]), starts_a[lanes], starts_b[lanes])
    cuts = np.append(0, segments)
    return Aligned(a, b, link_a, link_b, starts_a[cuts], starts_b[cuts], np.searchsorted(link_a, starts_a[cuts]))


def written(found: Aligned, coder: Encoder) -> tuple[list[str], np.ndarray]:
    """The tokens in the order in which groups are written, each with the mark after it, and each segment's place there."""
    n_a, n_b = len(found.a), len(found.b)
    last_a, last_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    last_a[found.link_a] = len(coder.bytes_a)
    last_b[found.link_b] = len(coder.bytes_b)
    group_a = np.searchsorted(found.link_a, np.arange(n_a))
    group_b = np.searchsorted(found.link_b, np.arange(n_b))
    out = np.empty(n_a + n_b, object)
    # before a token of A stand the tokens of B of earlier groups; before one of B those of A up to its own
    out[np.arange(n_a) + np.append(0, found.link_b + 1)[group_a]] = coder.text_a[found.a + last_a]
    out[np.arange(n_b) + (found.link_a + 1)[group_b]] = coder.text_b[found.b + last_b]
    return out.tolist(), found.cuts_a + found.cuts_b


def segments_of(text: str, limit: int = 0) -> Iterator[str]:
    """A text in segments of about ``limit`` characters; each but the first begins with the space it was cut at."""
    at, limit = 0, limit or SEGMENT
    while len(text) - at > limit:
        cut = SAFE_CUT.search(text, at + limit)
        if cut is None:
            break
        yield text[at:cut.end()]
        at = cut.end()
    yield text[at:]


# --- corpus --------------------------------------------------------------------------------------

_ALIGNED = [
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()), T.StructField("groups_sha256", T.StringType()),
]
_PAIRS = [T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType())]


class _Document:
    """What is known of a text so far."""

    def __init__(self) -> None:
        self.n_a = self.n_b = self.n_links = 0
        self.digest = hashlib.sha256()
        self.pending = ""
        self.pairs: list[np.ndarray] = []

    def add(self, n_a: int, n_b: int, text: str, pairs: np.ndarray) -> None:
        self.n_a += n_a
        self.n_b += n_b
        self.n_links += len(pairs)
        # the last mark of all is left out
        self.digest.update((self.pending + text[:-1]).encode())
        self.pending = text[-1:]
        self.pairs.append(pairs)

    def row(self) -> tuple:
        if not self.n_a:
            return 0, 0, 0, 0, "", b"", b""
        pairs, times = np.unique(np.concatenate(self.pairs), return_counts=True)
        return self.n_a, self.n_b, self.n_links, self.n_links, self.digest.hexdigest(), pairs.astype("<u8").tobytes(), times.astype("<u4").tobytes()


def _aligned(texts: list[bytes], coder: Encoder) -> list[tuple]:
    states, spelled = [_Document() for _ in texts], np.ones(len(texts), bool)
    rows: list[int] = []
    sizes: list[int] = []
    held: list[str] = []

    def flush() -> None:
        row, size = np.array(rows), np.array(sizes)
        numbers = coder.numbers(held)
        owner = np.repeat(row, size)
        spelled[owner[~coder.spelled[numbers]]] = False
        whole = spelled[row]
        row = row[whole]
        found = align(numbers[spelled[owner]], np.cumsum(size[whole]), coder)
        tokens, place = written(found, coder)
        pairs = (found.a[found.link_a] << 32) | found.b[found.link_b]
        n_a, n_b = np.diff(found.cuts_a).tolist(), np.diff(found.cuts_b).tolist()
        for k, r in enumerate(row.tolist()):
            states[r].add(n_a[k], n_b[k], "".join(tokens[place[k]:place[k + 1]]), pairs[found.cuts_link[k]:found.cuts_link[k + 1]])
        for gathered in (rows, sizes, held):
            gathered.clear()

    size = 0
    for row, raw in enumerate(texts):
        if not raw:
            continue
        for segment in segments_of(" " + raw.decode()):
            pieces = coder.pieces(segment)
            rows.append(row)
            sizes.append(len(pieces))
            held.extend(pieces)
            size += len(segment)
            if size >= SEGMENT:
                flush()
                size = 0
    if rows:
        flush()
    return [d.row() if ok else _Document().row() for d, ok in zip(states, spelled)]


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256; pairs of linked ids (a << 32 | b) and their times, packed."""
    fields = [T.StructField("doc_id", docs.schema[doc_id].dataType), *_ALIGNED, *_PAIRS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary_a, vocabulary_b)
        kinds = [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                columns = list(zip(*_aligned(utf8(part.column(1)), coder)))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], [f.name for f in fields])

    return docs.select(doc_id, text).mapInArrow(run, T.StructType(fields))


def pair_counts(found: DataFrame) -> DataFrame:
    """a, b, n: how many links of the corpus hold the two ids; summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new = [np.frombuffer(b"".join(batch.column(k).to_pylist()), kind) for k, kind in ((0, "<u8"), (1, "<u4"))]
            pairs, at = np.unique(np.concatenate([pairs, new[0]]), return_inverse=True)
            times = np.bincount(at, np.concatenate([times, new[1]]), minlength=len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array((pairs >> np.uint64(32)).astype(np.int64)), pa.array((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(times)], ["a", "b", "n"]
        )

    return found.select("pairs", "times").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def token_alignment(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row."""
    spark, place = docs.sparkSession, new_dir(docs.sparkSession, "aligned")
    rows = aligned(docs, doc_id, text, vocabulary_a=vocabulary_a, vocabulary_b=vocabulary_b)
    rows.write.option("compression", "zstd").parquet(place)
    found = spark.read.schema(rows.schema).parquet(place)
    # bounded by the vocabularies (pair_bound), not by the corpus
    counts = pair_counts(found).toArrow()
    a, b, n = (counts.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    highest = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, b, n)
    keys = ((a << 32) | b).astype(np.uint64)
    order = np.argsort(keys)
    sent = spark.sparkContext.broadcast((keys[order], n[order], (n == highest[b])[order]))
    fields = [rows.schema["doc_id"], *_ALIGNED[:4], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), _ALIGNED[4]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = sent.value
        for batch in batches:
            sums, firsts = [], []
            for pairs, times in zip(batch.column(6).to_pylist(), batch.column(7).to_pylist()):
                at, times = np.searchsorted(keys, np.frombuffer(pairs, "<u8")), np.frombuffer(times, "<u4").astype(np.int64)
                sums.append(int((n[at] * times).sum()))
                firsts.append(int(times[best[at]].sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(firsts, pa.int64()), pa.array(sums, pa.int64()), batch.column(5)], [f.name for f in fields]
            )

    return found.mapInArrow(run, T.StructType(fields))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(documents(spark, sf_dir))
