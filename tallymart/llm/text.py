"""Vectorised views of blocks of texts: words, n-gram hashes, sliding minima.

Everything here works on one block, a few hundred kilobytes of texts inside a task. A null text
counts as an empty one. Hashes are polynomials modulo 2^64 over mixed symbols, mixed once more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = re.compile("[^ \t-\r]+")
SEPARATORS = " \t\n\v\f\r"
BLOCK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_IS_SPACE = np.isin(np.arange(256), [ord(c) for c in SEPARATORS])
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base][:n]


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Sums of symbol times power; differences of them hash any run of symbols."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * _power(_BASE, len(symbols)), dtype=np.uint64, out=out[1:])
    return out


def run_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of symbols[start:end] for each pair; equal runs of equal length hash alike."""
    unit = _power(_INVERSE, len(prefix))[starts]
    length = np.asarray(ends - starts).astype(np.uint64)
    return mix((prefix[ends] - prefix[starts]) * unit + length * np.uint64(_BASE))


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _SYMBOLS[data]


def slide(f: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """f over every window of ``width`` values; len(x) - width + 1 results."""
    if len(x) < width:
        return x[:0]
    span = 1
    while span * 2 <= width:
        x = f(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return f(x[: len(x) - rest], x[rest:]) if rest else x


def minima(h: np.ndarray, allowed: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least hash of some window of ``width`` positions.

    ``allowed`` marks the windows (by start) that may choose. All equal minima are chosen, so the
    choice depends on the contents of the window alone.
    """
    least = slide(np.minimum, h, width)
    if not len(least):
        return np.zeros(0, np.int64)
    least = np.where(allowed[: len(least)], least, np.uint64(0))
    edge = np.zeros(width - 1, np.uint64)
    highest = slide(np.maximum, np.concatenate([edge, least, edge]), width)
    return np.flatnonzero((highest == h) & (highest > 0))


def owned(
    h: np.ndarray, at: np.ndarray, begins: np.ndarray, ends: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of which each chosen position is the minimum, the last among equals.

    ``h`` are the hashes of the positions ``at``, and the windows of a position begin from its
    ``begins`` to its ``ends``. Where the last comes before the first, there is none.
    """
    values = h.tolist()
    before, after, open_ = [-1] * len(at), [len(at)] * len(at), []
    for i, value in enumerate(values):
        while open_ and values[open_[-1]] >= value:
            after[open_.pop()] = i
        before[i] = open_[-1] if open_ else -1
        open_.append(i)
    edge = np.concatenate([at, [np.iinfo(np.int64).max, -1]])  # behind the last, before the first
    first = np.maximum.reduce([begins, at - width + 1, edge[before] + 1])
    return first, np.minimum.reduce([ends, at, edge[after] - width])


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text; a row is never cut."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    begin = 0
    while begin < len(total):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a block and the bounds of each text in them."""
    kind = pa.large_binary()
    raw = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"").cast(kind)
    raw = pa.concat_arrays([raw])
    _, offsets, data = raw.buffers()
    bounds = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
    if data is None or not len(raw):
        return np.zeros(0, np.uint8), np.zeros(len(raw) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """The words of a block of texts, as positions and hashes."""

    def __init__(self, texts: pa.Array):
        self.data, self.bounds = utf8(texts)
        n = len(self.data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~_IS_SPACE[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        here, before, after = inside[1:-1], inside[:-2], inside[2:]
        self.starts = np.flatnonzero(here & (~before | edge[:-1]))
        self.ends = np.flatnonzero(here & (~after | edge[1:])) + 1
        #: words[word_bounds[i]:word_bounds[i + 1]] are those of text i
        self.word_bounds = np.searchsorted(self.starts, self.bounds)
        self.prefix = prefix_hash(byte_symbols(self.data))
        self.hashes = run_hash(self.prefix, self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.word_bounds))

    def left(self) -> np.ndarray:
        """For each word, how many words of its text begin there or later."""
        return np.repeat(self.word_bounds[1:], np.diff(self.word_bounds)) - np.arange(len(self))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n words from each word on, and which of them stay in one text."""
        starts = np.arange(max(0, len(self) - n + 1))
        return run_hash(prefix_hash(self.hashes), starts, starts + n), self.left()[: len(starts)] >= n
