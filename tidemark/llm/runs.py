"""Splitting many texts at once into pre-tokens: runs of letters, numbers, spaces and other characters."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import regex

SPACE, LETTER, NUMBER, OTHER = range(4)
# The characters with Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# English contractions that are tokens of their own.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    low, high = "".join(map(chr, range(0xD800))), "".join(map(chr, range(0xE000, 0x110000)))
    for text, base in ((low, 0), (high, 0xE000)):
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
            for match in regex.finditer(pattern, text):
                table[base + match.start() : base + match.end()] = kind
    table[WHITE_SPACE] = SPACE
    return table


class Pieces:
    """Pre-tokens of a batch of texts: `codes` into `words`, and the piece at which each text starts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray):
        starts = np.append(cuts, len(data)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data)))
        coded = pieces.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.words = coded.dictionary
        self.first = np.searchsorted(cuts, offsets)


def _contractions(points: np.ndarray, kinds: np.ndarray, cut: np.ndarray, document_start: np.ndarray) -> None:
    marks = np.flatnonzero((points[:-1] == 0x27) & cut[: len(points) - 1] & (kinds[1:] == LETTER) & ~document_start[1 : len(points)])
    if not len(marks):
        return
    following = points[marks + 1]
    length = np.where(np.isin(following, [ord(c) for c in SHORT_ENDINGS]), 1, 0)
    two = marks + 2 < len(points)
    second = np.where(two, points[np.minimum(marks + 2, len(points) - 1)], 0)
    two &= ~document_start[np.minimum(marks + 2, len(points))]
    for ending in LONG_ENDINGS:
        length[two & (following == ord(ending[0])) & (second == ord(ending[1]))] = 2
    marks, length = marks[length > 0], length[length > 0]
    cut[marks + 1] = False
    cut[marks + 1 + length] = True


def pieces(data: np.ndarray, offsets: np.ndarray, join_space: bool, single_numbers: bool) -> Pieces:
    """Runs of one class, with contractions cut off.

    join_space: a space goes with the run after it, further white space stands alone.
    single_numbers: every number character is a piece.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    count = len(points)
    if not count:
        return Pieces(data, offsets, np.zeros(0, np.int64))
    byte_of = np.flatnonzero((data & 0xC0) != 0x80)
    kinds = classes()[points]
    document_start = np.zeros(count + 1, bool)
    document_start[np.searchsorted(byte_of, offsets)] = True
    cut = document_start.copy()
    cut[1:count] |= kinds[1:] != kinds[:-1]
    if single_numbers:
        cut[:count] |= kinds == NUMBER
    if join_space:
        after = np.flatnonzero((kinds[1:] != SPACE) & (kinds[:-1] == SPACE) & ~document_start[1:count]) + 1
        cut[after - 1] = True
        cut[after[points[after - 1] == 0x20]] = False
    _contractions(points, kinds, cut, document_start)
    return Pieces(data, offsets, byte_of[np.flatnonzero(cut[:count])])
