"""Texts as words: parts of bounded size, cut where no word is, and hashes of the words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from plinth.llm.batches import PIECE_BYTES, SPACE, U64, joined, runs, span_hashes

_GAP = re.compile(rb"[\t-\r ]")
#: Where no token of byte-level BPE crosses: before a space that follows something other than white space.
SAFE_CUT = re.compile(r"(?<=\S)(?= )")


def cut(text: bytes, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Byte ranges of a text of about ``limit`` bytes, each ending after white space or at the end.

    A word longer than ``limit`` stays whole.
    """
    at = 0
    while len(text) - at > limit:
        gap = _GAP.search(text, at + limit - 1)
        if gap is None:
            break
        yield at, gap.end()
        at = gap.end()
    if at < len(text):
        yield at, len(text)


def groups(texts: list[bytes], limit: int = PIECE_BYTES, most: int = 1 << 30) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows and parts of texts, about ``limit`` bytes and at most ``most`` parts at once.

    The parts of a text follow one another, so a long text spreads over several groups.
    """
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for a, b in cut(text, limit) if len(text) > limit else ((0, len(text)),):
            if parts and (size + b - a > limit or len(parts) >= most):
                yield rows, parts
                rows, parts, size = [], [], 0
            rows.append(row)
            parts.append(text[a:b] if b - a < len(text) else text)
            size += b - a + 1
    if parts:
        yield rows, parts


def placed(parts: list[bytes], gaps: np.ndarray = SPACE) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All parts in one array of bytes: the bytes, hash, start and end of every word, and each part's first and last word.

    ``gaps`` tells which bytes stand between words; they include white space.
    """
    buf, starts, ends = joined(parts, b" ")
    a, b = runs(~gaps[buf])
    return buf.tobytes(), span_hashes(buf, a, b), a, b, np.searchsorted(a, starts), np.searchsorted(a, ends)


def rolled(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` words that follow one another."""
    out = np.zeros(max(len(words) - width + 1, 0), U64)
    for k in range(width):
        out = out * U64(0x9E3779B97F4A7C15) + words[k:k + len(out)]
    return out
