"""Words, shingles and lines of many texts at once, as numpy arrays over the UTF-8 bytes of a slice.

Hashes are 64-bit: every byte value has a random number, a word's hash is a polynomial of them, mixed.
Equal byte strings have equal hashes in every slice, task and run.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(int(BASE), -1, 2**64))
STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every bit depends on every bit of the input."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of the base and of its inverse, as many as the longest slice so far has needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            # Somewhat more than asked for, so that a little longer slices do not begin anew each time.
            size = max(n, min(len(self.up) * 5 // 4, len(self.up) + (1 << 20)))
            up, down = np.full(size, BASE), np.full(size, UNBASE)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each value starts (and the last ends); null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"") if column.null_count else column
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each non-empty byte range."""
    up, down = POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def owners(bounds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the text in which each position lies."""
    return np.searchsorted(bounds, starts, side="right") - 1


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of a per-byte (or per-item) array within each text."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # index of the text
    bounds: np.ndarray  # first word of each text, and the end of the last


def find_words(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes for which ``between`` is false; none crosses texts."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(between[data], out=inside[1:-1])
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    opens[cuts] = inside[1:-1][cuts]
    closes[cuts - 1] = inside[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(starts, ends, owners(bounds, starts), np.searchsorted(starts, bounds))


def find_lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces between line feeds; empty pieces of non-empty texts included."""
    feeds = np.flatnonzero(data == 10)
    texts = bounds[:-1][bounds[1:] > bounds[:-1]]
    starts = np.sort(np.concatenate([texts, feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([feeds, bounds[1:][bounds[1:] > bounds[:-1]]]), kind="stable")
    return starts, ends


def runs_of(hashes: np.ndarray, words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` consecutive words, and the index of the word each begins with."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * STEP + hashes[j : j + n]
    first = np.flatnonzero(words.text[:n] == words.text[k - 1 :])
    return mix(total[first]), first


def shingles(data: np.ndarray, bounds: np.ndarray, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray, Words]:
    """Distinct hashes of ``k``-word shingles, sorted by text and hash, the text of each, and the words.

    A text of 1 to ``k`` - 1 words has its whole sequence as its one shingle; one without words has none.
    """
    data = LOWER[data] if lower else data
    words = find_words(data, bounds)
    hashes = span_hashes(data, words.starts, words.ends)
    runs, first = runs_of(hashes, words, k)
    texts = words.text[first]
    counts = words.bounds[1:] - words.bounds[:-1]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            there = counts[short] > j
            whole[there] = whole[there] * STEP + hashes[words.bounds[short[there]] + j]
        runs = np.concatenate([runs, mix(whole + counts[short].astype(np.uint64))])
        texts = np.concatenate([texts, short])
    order = np.lexsort((runs, texts)) if len(runs) else np.zeros(0, dtype=np.int64)
    runs, texts = runs[order], texts[order]
    fresh = np.ones(len(runs), dtype=bool)
    fresh[1:] = (runs[1:] != runs[:-1]) | (texts[1:] != texts[:-1])
    return runs[fresh], texts[fresh], words
