"""Texts that are awkward in every way, and plain versions of words, shingles and components."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

LONG = " ".join(f"w{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
NAMES = ("lang", "source", "n_chars", "token", "node", "score", "n", "_hash", "bucket", "block", "a", "b", "_words", "hash")

TEXTS = [
    None,
    "",
    " \t\n\x0b ",
    "one",
    "one two three",
    "One Two THREE",
    "The quick brown fox jumps over the lazy dog near the river bank today.",
    "The quick brown fox jumps over the lazy dog near the river bank today.",
    "the quick brown fox jumps over the lazy dog near the river bank today, again",
    f"first {PASSAGE} end\n{PASSAGE}\nunlike lines follow here in this text",
    f"{PASSAGE}\nother words stand in this second text",
    "ünï cödé 中文字 😀 don't can't we'll 12345 ²³ ''s   \r\n  tail ",
    "aaaa " * 200,
    "a" * 300,
    LONG,
]


def rows() -> list[tuple]:
    """Rows of doc_id, text and columns whose names operators use themselves; ids repeat, and one is null."""
    ids = [*range(len(TEXTS)), 9, 9, None]
    texts = [*TEXTS, TEXTS[9], "a different text of the ninth document with enough words", TEXTS[6]]
    return [(i, t, *([str(k)] * len(NAMES))) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


def documents(spark, data: list[tuple] | None = None):
    schema = "doc_id long, text string, " + ", ".join(f"`{name}` string" for name in NAMES)
    return spark.createDataFrame(rows() if data is None else data, schema)


def empty(spark):
    return documents(spark, [])


def words(text: str | None, lower: bool = True) -> list[str]:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text: str | None, k: int) -> frozenset:
    found = words(text)
    return frozenset(tuple(found[i : i + k]) for i in range(max(len(found) - k + 1, 1))) if found else frozenset()


def linked(sets: list[frozenset], percent: int) -> list[tuple[int, int]]:
    """All pairs of similar sets."""
    where = defaultdict(list)
    for i, members in enumerate(sets):
        for member in members:
            where[member].append(i)
    pairs = []
    for i, members in enumerate(sets):
        both = Counter(j for member in members for j in where[member] if j < i)
        pairs += [(j, i) for j, n in both.items() if 100 * n >= percent * (len(members) + len(sets[j]) - n)]
    return pairs


def roots(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
