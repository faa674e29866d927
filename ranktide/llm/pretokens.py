"""The pieces into which a byte-level BPE's pattern cuts texts, for many texts at once, and word tables on them.

The pattern is the public ``public_tokenizers.PATTERN``: contractions, letters, numbers and other characters, each with
at most one space before it, and white space. Its pieces tile a text, so a piece is known by its first character;
these are found from the classes of the characters without running the pattern.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from ranktide.llm.runtime import slices
from ranktide.llm.textscan import POWERS, mix

OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3
# What follows an apostrophe in the pattern's contractions.
ONE_LETTER = ("s", "t", "m", "d")
TWO_LETTERS = ("re", "ve", "ll")


@cache
def _classes() -> np.ndarray:
    """The class of every code point; made once in a worker, whose tasks share it."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
            for found in regex.finditer(pattern, every):
                table[low + found.start() : low + found.end()] = kind
    return table


class Pretokenizer:
    """Cuts texts into pieces and names each by a 64-bit hash of its characters."""

    def __init__(self) -> None:
        self.classes = _classes()
        self.values = mix(np.arange(1, 0x10001, dtype=np.uint64)) | np.uint64(1)

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of all texts, their bounds, first positions of all pieces, and the pieces' bounds by text."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in texts], out=bounds[1:])
        n = len(points)
        if not n:
            return points, bounds, np.zeros(0, dtype=np.int64), bounds
        kind = self.classes[points]
        edge = np.ones(n, dtype=bool)
        edge[1:] = kind[1:] != kind[:-1]
        edge[bounds[:-1][bounds[:-1] < n]] = True
        first = np.flatnonzero(edge)
        last = np.append(first[1:], n)
        text_start = np.zeros(n + 1, dtype=bool)
        text_start[bounds] = True
        begins = np.zeros(n, dtype=bool)
        begins[first] = True
        blank = kind[first] == BLANK
        followed = blank & ~text_start[last]
        # The last of several blanks is cut off; a space then belongs to what follows, another blank stands alone.
        begins[last[followed] - 1] = True
        joins = followed & (points[last - 1] == 32)
        begins[last[joins]] = False
        # An apostrophe of its own takes s, t, m, d, re, ve or ll with it.
        alone = np.flatnonzero((kind[first] == OTHER) & (last - first == 1) & (points[first] == 39) & begins[first] & ~text_start[last])
        after = last[alone]
        alone, after = alone[kind[after] == LETTER], after[kind[after] == LETTER]
        length = last[alone + 1] - after
        second = points[np.minimum(after + 1, n - 1)]
        taken = np.zeros(len(after), dtype=np.int64)
        for letters in ONE_LETTER:
            taken[points[after] == ord(letters)] = 1
        for one, two in TWO_LETTERS:
            taken[(points[after] == ord(one)) & (second == ord(two)) & (length > 1)] = 2
        hit = taken > 0
        begins[after[hit]] = False
        rest = hit & (taken < length)
        begins[(after + taken)[rest]] = True
        starts = np.flatnonzero(begins)
        return points, bounds, starts, np.searchsorted(starts, bounds)

    def names(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A hash of every piece."""
        up, down = POWERS.get(len(points) + 1)
        value = self.values[points & np.uint32(0xFFFF)] + (points >> np.uint32(16)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        total = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum(value * up[: len(points)], out=total[1:])
        ends = np.append(starts[1:], len(points))
        return mix((total[ends] - total[starts]) * down[starts])

    def named(self, words: list[str]) -> np.ndarray:
        """The names that the words have as pieces."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        return self.names(points, np.cumsum(lengths) - lengths)

    def distinct(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pieces, their names, the number of its distinct piece for each piece, and the bounds by text."""
        spell, names, number, by_text = self.spelled_later(texts)
        return spell(np.arange(len(names))), names, number, by_text

    def spelled_later(self, texts: list[str]) -> tuple[Callable[[np.ndarray], list[str]], np.ndarray, np.ndarray, np.ndarray]:
        """As ``distinct``, with a function that gives those pieces whose numbers are asked for; the names are in order."""
        points, _, starts, by_text = self.cut(texts)
        if not len(starts):
            return lambda wanted: [], np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), by_text
        named = self.names(points, starts)
        order = np.argsort(named)
        ranked = named[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        names, example = ranked[fresh], order[fresh]
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(fresh) - 1
        whole = "".join(texts)
        ends = np.append(starts[1:], len(points))

        def spell(wanted: np.ndarray) -> list[str]:
            at = example[wanted]
            return [whole[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]

        return spell, names, number, by_text


def gather(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of ``flat`` that begin at ``offsets``, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(offsets - before, lengths) + np.arange(total)]


class Numbers:
    """Numbers of names in the order in which these come, with 12 bytes for each."""

    def __init__(self) -> None:
        self.names = np.zeros(0, dtype=np.uint64)
        self.numbers = np.zeros(0, dtype=np.int32)

    def __len__(self) -> int:
        return len(self.names)

    def of(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each of some names, given in order and each once, and which of them are new."""
        at = np.searchsorted(self.names, names)
        there = at < len(self.names)
        there[there] = self.names[at[there]] == names[there]
        found = np.empty(len(names), dtype=np.int64)
        found[there] = self.numbers[at[there]]
        new = np.flatnonzero(~there)
        found[new] = len(self.names) + np.arange(len(new))
        self.names = np.insert(self.names, at[new], names[new])
        self.numbers = np.insert(self.numbers, at[new], found[new])
        return found, new


class Vocabulary:
    """Ids of words, kept between slices up to a number of words; ``encode`` gives those of new words, a sequence each."""

    def __init__(self, encode: Callable[[list[str]], list], most: int = 1_000_000) -> None:
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        # The words' names in order, and the place of each; some 50 bytes a word with its ids.
        self.names = np.zeros(0, dtype=np.uint64)
        self.places = np.zeros(0, dtype=np.int32)
        self.offsets = np.zeros(1 << 16, dtype=np.int64)
        self.lengths = np.zeros(1 << 16, dtype=np.int32)
        self.flat = np.zeros(1 << 18, dtype=np.uint32)
        self.used = 0

    def _add(self, ids: list) -> None:
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        have, total = len(self.names), int(lengths.sum())
        while have + len(ids) > len(self.offsets):
            self.offsets, self.lengths = np.append(self.offsets, self.offsets * 0), np.append(self.lengths, self.lengths * 0)
        while self.used + total > len(self.flat):
            self.flat = np.append(self.flat, self.flat * 0)
        self.lengths[have : have + len(ids)] = lengths
        self.offsets[have : have + len(ids)] = self.used + np.cumsum(lengths) - lengths
        if total:
            self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=total)
        self.used += total

    def ids(self, texts: list[str], cutter: Pretokenizer) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where those of each text begin."""
        pieces, names, number, by_text = cutter.distinct(texts)
        if not pieces:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        if len(self.names) + len(pieces) > max(self.most, len(pieces)):
            self.clear()
        # Places by name; new words are added at the end. The names of a slice are in order, too.
        at = np.searchsorted(self.names, names)
        there = at < len(self.names)
        there[there] = self.names[at[there]] == names[there]
        place = np.empty(len(names), dtype=np.int64)
        place[there] = self.places[at[there]]
        new = np.flatnonzero(~there)
        if len(new):
            place[new] = len(self.names) + np.arange(len(new))
            self._add(self.encode([pieces[i] for i in new.tolist()]))
            self.names = np.insert(self.names, at[new], names[new])
            self.places = np.insert(self.places, at[new], place[new])
        place = place[number]
        lengths = self.lengths[place].astype(np.int64)
        total = np.zeros(len(place) + 1, dtype=np.int64)
        np.cumsum(lengths, out=total[1:])
        return gather(self.flat, self.offsets[place], lengths), total[by_text]


def text_slices(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of several MB with their texts, null as empty."""
    for batch in slices(batches, limit=limit):
        yield batch, [t or "" for t in batch.column("text").to_pylist()]
