"""Word arrays of whole texts, from Arrow string buffers, without a Python object per word.

A batch is cut into slices of about ``SLICE_BYTES`` at document borders. Memory
is about 40 bytes per byte of a slice, or of the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: Anything but white space.
SOLID = "solid"
#: ASCII letters and digits, and everything beyond ASCII.
ALNUM = "alnum"
#: ASCII letters, and everything beyond ASCII.
LETTERS = "letters"

#: Tables made once per process. A plain dictionary: functions that use it are shipped by value with it,
#: where a caching decorator would be looked up by the module's name.
_made: dict[str, np.ndarray] = {}


def _table(kind: str) -> np.ndarray:
    if kind not in _made:
        inside = np.ones(256, bool)
        if kind == SOLID:
            inside[[0x20, *range(0x09, 0x0E)]] = False
        else:
            inside[:0x80] = False
            for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
                inside[low : high + 1] = kind != LETTERS or low > 0x40
        _made[kind] = inside
    return _made[kind]


def _lower() -> np.ndarray:
    if "lower" not in _made:
        table = np.arange(256, dtype=np.uint8)
        table[0x41:0x5B] += 0x20
        _made["lower"] = table
    return _made["lower"]


def _random() -> np.ndarray:
    if "random" not in _made:
        _made["random"] = np.random.Generator(np.random.PCG64(20)).integers(0, 2**64, size=256 * 256, dtype=np.uint64)
    return _made["random"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slice:
    """Some documents of a batch: their rows, bytes, and byte borders (one more than rows)."""

    rows: range
    raw: np.ndarray
    bounds: np.ndarray


def slices(texts: pa.Array, most: int = SLICE_BYTES, most_rows: int = 1 << 30) -> Iterator[Slice]:
    """The documents in order; null texts have no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, side="right")) - 1)
        last = min(last, first + most_rows)
        yield Slice(range(first, last), raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        first = last


@dataclass
class Words:
    """Words of a slice: byte borders, documents' first words (one more than documents), 64-bit hashes."""

    lower: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def document(self) -> np.ndarray:
        """The slice's document of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(part: Slice, kind: str, hashed: bool = True) -> Words:
    """Words with A-Z lower-cased; no word crosses documents."""
    lower = _lower()[part.raw]
    inside = _table(kind)[part.raw]
    edges = np.zeros(len(lower) + 1, bool)
    edges[part.bounds] = True
    starts = np.flatnonzero(inside & (edges[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edges[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    first = np.searchsorted(starts, part.bounds)
    hashes = np.zeros(0, np.uint64)
    if hashed and len(starts):
        lengths = ends - starts
        heads = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(heads[-1]) - np.repeat(heads[:-1], lengths)
        values = _random()[((at & 255) << 8) | lower[inside]]
        if int(lengths.max()) > 256:
            values = values * (2 * (at >> 8) + 1).astype(np.uint64)
        hashes = mix(np.add.reduceat(values, heads[:-1]))
    return Words(lower, starts, ends, first, hashes)


def shingles_at(hashes: np.ndarray, heads: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` word hashes that begin at each head."""
    total = mix(hashes[heads] + np.uint64(n))
    for k in range(1, n):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[heads + k])
    return total


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` word hashes."""
    return shingles_at(hashes, np.arange(max(0, len(hashes) - n + 1)), n)


@dataclass
class Plain:
    """A slice's words joined by single blanks; a zero byte stands before and after every document."""

    text: np.ndarray
    starts: np.ndarray  # of each word
    bounds: np.ndarray  # the zero bytes, one more than documents


def plain(w: Words) -> Plain:
    lengths = w.ends - w.starts
    document = w.document()
    n_words = np.diff(w.first)
    # every word is followed by one byte, every document without words has one byte as well
    bytes_of = np.bincount(document, lengths + 1, len(n_words)).astype(np.int64) + (n_words == 0)
    bounds = np.concatenate(([0], np.cumsum(bytes_of)))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1] + 1
    if len(starts):
        empty_before = np.cumsum(n_words == 0)
        starts = starts + empty_before[document]
    text = np.full(bounds[-1] + 1, 0x20, np.uint8)
    text[bounds] = 0
    if len(starts):
        heads = np.concatenate(([0], np.cumsum(lengths)))
        within = np.arange(heads[-1]) - np.repeat(heads[:-1], lengths)
        text[np.repeat(starts, lengths) + within] = w.lower[np.repeat(w.starts, lengths) + within]
    return Plain(text, starts, bounds)
