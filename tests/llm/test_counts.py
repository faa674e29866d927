"""Token counts, spelling variants and conversation repair against the library and plain versions."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import documents, empty, rows
from pyspark.sql import functions as F

from ranktide.llm import conversations, spelling, tokencounts

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def model():
    pytest.importorskip("sentencepiece")
    pytest.importorskip("public_tokenizers")
    return tokencounts.load(tokencounts.vocabulary_path())


def counted(df, **options) -> Counter:
    return Counter(map(tuple, tokencounts.token_counts(df, **options).collect()))


def expected_counts(model, data: list[tuple]) -> Counter:
    found = Counter()
    for doc_id, text, *_ in data:
        n = len(model.encode(text or ""))
        found[doc_id, len((text or "").encode()), n, n > 4096] += 1
    return found


def test_token_counts_equal_the_library(spark, model):
    # With few broadcast pre-tokens most of them go through the join; with none all of them do.
    for most in (tokencounts.KNOWN, 40, 0):
        assert counted(documents(spark), most=most, size=1000) == expected_counts(model, rows())
    assert counted(empty(spark)) == Counter()
    assert tokencounts.token_counts(empty(spark)).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_token_counts_of_awkward_characters(spark, model):
    draw = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "a", "the", " The", "é", "ﬁ", "中文", "😀", "\x00", "\xa0", "12", "''", "́", "​", "𝔘"]
    data = [(i, "".join(draw.choices(parts, k=draw.randint(0, 30)))) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for most in (tokencounts.KNOWN, 25):
        assert counted(df, most=most, size=7) == expected_counts(model, data)


@needs_tables
def test_token_counts_of_a_table(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert counted(docs, most=500) == expected_counts(model, data)


def test_what_is_broadcast_is_bounded(spark):
    pieces = spark.createDataFrame([(str(i), i, 1) for i in range(1, 1001)], "piece string, n long, tokens long")
    for most in (0, 1, 100, 600, 1000, 5000):
        least = tokencounts.frequent_from(pieces, most)
        held = pieces.where(F.col("n") >= least).count()
        assert held <= most and (least == 1 or pieces.where(F.col("n") >= least // 2).count() > most)


def plain_words(data: list[tuple], every: int) -> dict[str, int]:
    found = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            hashed = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if hashed % every == 0:
                run = run[: hashed % len(run)] + run[hashed % len(run) + 1 :]
            found[run] += 1
    return {word: n for word, n in found.items() if len(word) >= 5 and n >= 3}


def plain_near(words) -> dict[str, set[str]]:
    """Near words by comparing each word without one letter, and with one letter left open."""
    holes = defaultdict(set)
    for word in words:
        holes[word].add(word)
        for i in range(len(word)):
            holes[word[:i] + word[i + 1 :]].add(word)
            holes[word[:i] + "*" + word[i + 1 :]].add(word)
    near = defaultdict(set)
    for hole, held in holes.items():
        for a in held:
            for b in held:
                if a != b and (len(a) != len(b) and hole in (a, b) or len(a) == len(b) and "*" in hole):
                    near[a].add(b)
    return near


def plain_variants(data: list[tuple], every: int) -> set[tuple]:
    words = plain_words(data, every)
    near = plain_near(words)
    forms = {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        if best is not None and words[best] >= 2 * n:
            forms[word] = best
    found = set()
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        found.add((word, form, root, n, len(near[word]), words[form] if form else None))
    return found


def variants(df, **options) -> list[tuple]:
    return [tuple(r) for r in spelling.spelling_variants(df, **options).collect()]


def test_variants_of_awkward_rows_equal_brute_force(spark):
    for every, size in ((97, 1 << 20), (2, 10)):
        got = variants(documents(spark), every=every, size=size)
        assert len(got) == len(set(got)) and set(got) == plain_variants(rows(), every)
    assert variants(empty(spark)) == []


def test_variants_of_dense_words_equal_brute_force(spark):
    # Few letters make many near words, ties and long chains of forms.
    draw = random.Random(8)
    data = []
    for i in range(60):
        words = ["".join(draw.choices("abç÷", k=draw.randint(4, 6))) for _ in range(250)]
        chain = ["seedling"[: 8 - k % 4] + "x" * (k % 5) for k in range(20) for _ in range(2 ** (k % 5))]
        data.append((i, " ".join(words + chain)))
    got = variants(spark.createDataFrame(data, "doc_id long, text string"))
    assert len(got) == len(set(got)) and set(got) == plain_variants(data, 97)
    assert max(r[4] for r in got) > 15 and sum(r[1] is not None and r[1] != r[2] for r in got) > 5


def test_pivots_are_disjoint_and_cheapest():
    draw = random.Random(2)
    for _ in range(500):
        word = "".join(draw.choices("abcd", k=draw.randint(5, 9)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)})
        ranks = dict(zip(grams, draw.sample(range(len(grams)), len(grams)), strict=True))
        prefix = spelling.prefix_of(word, ranks)
        chosen = spelling.pivots_of(prefix)
        every = [(a, b) for a in prefix[:3] for b in prefix[:3] if b[1] - a[1] >= 2]
        assert chosen[1][1] - chosen[0][1] >= 2
        assert sum(r for r, _ in chosen) == min(a[0] + b[0] for a, b in every)


@needs_tables
def test_variants_of_a_table_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = variants(docs, every=5)
    assert len(got) == len(set(got)) and set(got) == plain_variants(data, 5)


def given_roles(symbols: list[tuple[str, str]], audit: str) -> list[str] | None:
    """The role initials that an audit leaves, if it leaves a legal conversation; the grammar leaves one choice at most."""
    places, rows = [], iter(symbols)
    for letter in audit:
        row = next(rows) if letter != "I" else None
        places += [] if letter == "D" else [row[0] if letter == "K" else "ua"]
    return next((list(given) for given in itertools.product(*places) if re.fullmatch("(s?(ua)+)?", "".join(given))), None)


def plain_edits(symbols: list[tuple[str, str]]) -> tuple[int, str]:
    """The cheapest edits of (role initial, fault) rows, and of those the least string, by trying all of them."""
    best = None
    choices = ["D" if fault in ("blank", "duplicate") else "DKR" for _, fault in symbols]
    for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
        for edits in itertools.product(*choices):
            audit = "".join("I" * n + e for n, e in zip(inserts, (*edits, ""), strict=True))
            cost = 3 * sum(inserts) + sum({"K": 0, "R": 3, "D": 4}[e] for e in edits)
            cost += 3 * sum(fault == "truncated" and e != "D" for (_, fault), e in zip(symbols, edits, strict=True))
            if (best is None or (cost, audit) < best) and given_roles(symbols, audit) is not None:
                best = (cost, audit)
    return best


def plain_repairs(data: list[tuple]) -> set[tuple]:
    by_conversation = defaultdict(list)
    for conv_id, turn, role, text in data:
        by_conversation[conv_id].append((turn, " " if role is None else role, " " if text is None else text))
    found = set()
    for conv_id, rows_of in by_conversation.items():
        after = []
        for turn, role, text in sorted(rows_of, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())):
            key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
            damage = zlib.crc32(key.encode()) % 20
            text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
            role = "user" if damage == 4 else role
            after += [(turn, role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1)
        faults = []
        for i, (_, role, text) in enumerate(after):
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            seen = any((role, text) == other[1:] for other in after[:i])
            faults.append("blank" if not shown else "duplicate" if seen else "truncated" if shown[-1] not in ".!?" else "")
        turns = {turn for turn, _, _ in after if turn is not None}
        initials = [role[:1] for _, role, _ in after]
        symbols = list(zip([i if i in ("s", "u", "a") else "-" for i in initials], faults, strict=True))
        letters = ["x" if f in ("blank", "duplicate") else i.replace("-", "o").upper() if f else i.replace("-", "o") for i, f in symbols]
        cost, audit = plain_edits(symbols) if len(symbols) <= 4 else strings_from_the_end("".join(letters))
        rest, roles, out = iter(after), iter(given_roles(symbols, audit)), []
        for letter in audit:
            row = next(rest) if letter != "I" else (None, None, "")
            if letter == "D":
                continue
            initial = next(roles)
            out.append(f"{row[1] if letter == 'K' else {'u': 'user', 'a': 'assistant'}[initial]}:{row[2]}")
        found.add(
            (
                conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
            )
        )
    return found


def talk(spark, data: list[tuple]):
    """Conversations with further columns whose names the operator uses itself."""
    schema = "conv_id long, turn long, role string, text string, audit string, `left` string, copy string, kind string"
    return spark.createDataFrame([(*row, "x", "y", "z", "k") for row in data], schema)


def repairs(df) -> list[tuple]:
    return [tuple(r) for r in conversations.repair_conversations(df).collect()]


def random_talk(seed: int, count: int) -> list[tuple]:
    draw = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "sue"]
    texts = ["Yes.", "No!", "why?", "cut off", " ", "", None, "Done. \n\t", "é", "..", "\x0b?\x0c"]
    data = [
        (conv_id, draw.choice([*range(6), None]), draw.choice(roles), draw.choice(texts))
        for conv_id in range(count)
        for _ in range(draw.randint(1, 4))
    ]
    return data + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hello."), (None, None, "tool", None)]


def test_repairs_equal_brute_force(spark):
    data = random_talk(4, 250)
    got = repairs(talk(spark, data))
    expected = plain_repairs(data)
    assert len(got) == len(expected) and set(got) == expected
    assert {letter for row in got for letter in row[7]} == set("DIKR")
    assert repairs(talk(spark, [])) == []


def test_dropped_conversations_keep_a_row(spark):
    dropped = [c for c in range(200) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    got = repairs(talk(spark, [(c, 1, "user", "Hi.") for c in dropped]))
    assert len(got) == len(dropped) > 2
    assert {row[1:] for row in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_endings_are_made_once():
    draw = random.Random(6)
    signed = sorted({"".join(draw.choices("suaoSUAx", k=draw.randint(0, 5))) for _ in range(400)})
    endings, alone = conversations.Endings(), {}
    for reverse in signed:
        solved = endings.solve(reverse)
        alone[reverse] = conversations.Endings().solve(reverse)
        assert solved == alone[reverse]
    assert endings.made == len({r[: i + 1] for r in signed for i in range(len(r))})


def strings_from_the_end(symbols: str) -> tuple[int, str]:
    """Cost and audit with whole strings in a table of rows and states, for conversations too long to try all edits."""
    step = {"0s": "s", "0u": "u", "su": "u", "ua": "a", "au": "u"}
    rest = {"0": (0, ""), "a": (0, ""), "u": (3, "I"), "s": (6, "II")}
    for symbol in reversed(symbols):
        now = {}
        for state in "0sua":
            choices, at = [], state
            for inserted in range(4):
                cost, letters = 3 * inserted, "I" * inserted
                choices.append((cost + 4 + rest[at][0], letters + "D" + rest[at][1]))
                if symbol != "x":
                    extra = 3 if symbol.isupper() else 0
                    for given in "sua":
                        onward = step.get(at + given)
                        if onward and given == symbol.lower():
                            choices.append((cost + extra + rest[onward][0], letters + "K" + rest[onward][1]))
                        if onward and given != "s":
                            choices.append((cost + 3 + extra + rest[onward][0], letters + "R" + rest[onward][1]))
                at = step[at + ("a" if at == "u" else "u")]
            now[state] = min(choices)
        rest = now
    return rest["0"]


def test_long_signatures():
    draw = random.Random(9)
    signed = sorted("".join(draw.choices("suaoSUAx", weights=(1, 6, 6, 1, 1, 2, 2, 2), k=draw.randint(0, 400))) for _ in range(40))
    endings = conversations.Endings()
    for reverse in signed:
        assert endings.solve(reverse) == strings_from_the_end(reverse[::-1])


def test_a_long_conversation(spark):
    long = [(1, t, "assistant" if t % 2 else "user", f"Line {t}." if t % 7 else f"open {t}") for t in range(1, 5001)]
    (row,) = repairs(talk(spark, long))
    dropped = sum(zlib.crc32(f"1:{t}".encode()) % 20 == 0 for t in range(1, 5001))
    repeated = sum(zlib.crc32(f"1:{t}".encode()) % 20 == 3 for t in range(1, 5001))
    assert row[0] == 1 and len(row[7].replace("I", "")) == 5000 - dropped + repeated
    assert row[3] == repeated and row[4] >= 600 and "KR" in row[7]


@needs_tables
def test_repairs_of_a_table_equal_brute_force(spark):
    talks = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    data = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    got = repairs(talks)
    assert len(got) == len(set(got)) == len({row[0] for row in data}) and set(got) == plain_repairs(data)
