"""Decontamination, substring dedup, Jaccard join, suffix dedup and components against plain versions."""

from __future__ import annotations

import hashlib
import os
import random
import time
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from helpers import PASSAGE, documents, empty, linked, roots, rows, shingles, words
from pyspark.sql import functions as F

from ranktide.llm import catalog, contamination, jaccard, paragraphs, substrings
from ranktide.llm.components import components
from ranktide.session import shared_folder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def near(spark):
    """Texts with groups of near copies in chains, one of them large, and a line that a third shares."""
    draw = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    data, base = [], [draw.choice(vocabulary) for _ in range(80)]
    for i in range(160):
        text = list(base) if i % 3 == 0 else [draw.choice(vocabulary) for _ in range(draw.randint(1, 90))]
        for _ in range(draw.randint(0, 4)):
            text[draw.randrange(len(text))] = draw.choice(vocabulary)
        lines = [" ".join(text[:40]), " ".join(text[40:])]
        if i % 3 == 1:
            lines.insert(1, "a line that a third of all texts has word for word in the middle")
        if i % 7 == 0:
            base = text
        data.append((i * 3, "\n".join(lines)))
    return data


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (3, 2)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join_equals_brute_force(spark, near, k, percent):
    sets = [shingles(t, k) for _, t in near]
    component = roots(len(near), linked(sets, percent))
    expected = {(d, len(s), near[c][0]) for (d, _), s, c in zip(near, sets, component, strict=True)}
    df = spark.createDataFrame(near, "doc_id long, text string")
    assert {tuple(r) for r in jaccard.near_duplicates(df, k, percent).collect()} == expected
    kept = {r["doc_id"] for r in jaccard.one_of_each(df, k, percent).collect()}
    assert kept == {near[c][0] for c in component}


def _frozen(spark):
    folder = os.path.join(shared_folder(spark).removeprefix("file:"), spark.sparkContext.applicationId, "frozen")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_shared_passage_makes_a_pair_once(spark, monkeypatch):
    draw = random.Random(3)
    own = lambda i: " ".join(f"o{i}x{draw.randrange(10**6)}" for _ in range(200))
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{own(i)} {passage} {own(i)}" for i in range(12)] + [own(99)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Every shingle is in the prefix, as if the passage were rarer than what surrounds it.
    monkeypatch.setattr(jaccard, "choose_prefix", lambda frequency, least: (1, len(frequency)))
    seen, pairs_between = [], jaccard.pairs_between_components

    def recorded(placed, percent):
        seen.append(placed.groupBy("token", "weight").agg(F.count("*").alias("n")).collect())
        return pairs_between(placed, percent)

    monkeypatch.setattr(jaccard, "pairs_between_components", recorded)
    before = _frozen(spark)
    found = jaccard.near_duplicates(df, 4, 85)
    assert len(_frozen(spark) - before) == 1  # the result; what it was made from is gone
    assert {r.component_id for r in found.collect()} == set(range(13))
    assert [(r["weight"], r["n"]) for r in seen[0]] == [(57, 12)]


def test_small_parities_tell_sets_below_the_threshold(spark):
    """Of pairs of 400 members nearly all at 0.8 are left out, those of 1,200 that share little too, and none from 0.85 on."""
    draw = np.random.default_rng(6)

    def pairs(size: int, shared: int, count: int) -> list[tuple]:
        found = []
        for _ in range(count):
            values = draw.integers(0, 2**64, 2 * size - shared, dtype=np.uint64)
            sides = (values[:size], values[size - shared :])
            tables = [jaccard.small_parities(s, np.zeros(size, dtype=np.int64), 1) for s in sides]
            found.append((size, size, *(int(t[name][0]) for t in tables for name in jaccard.PARITY)))
        return found

    names = ["n_x", "n_y", *(f"{name}_{side}" for side in "xy" for name in jaccard.PARITY)]
    passing = lambda rows: spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names)).where(jaccard.may_be_similar(85, "x", "y")).count()
    assert passing(pairs(400, 356, 50)) <= 10  # 356 of 444
    assert passing(pairs(1200, 100, 50)) == 0
    assert passing(pairs(400, 368, 50)) == passing(pairs(1200, 1103, 50)) == 50  # 85.2 and 85.0 %


def test_equal_lists_are_told_from_others(spark):
    lists = {1: (10, 11), 2: (10, 11), 3: (10, 12), 4: (11, 12), 5: (10, 11, 12), 6: (12, 10)}
    data = [(token, node, 30, 1) for token, nodes in lists.items() for node in nodes]
    data += [(7, 10, 30, 1), (7, 11, 30, 2)]  # the same nodes, with another number of matches
    found = jaccard.one_for_equal_lists(spark.createDataFrame(data, "token long, node long, n long, matches int"))
    assert {(r.token, r.weight) for r in found.collect()} == {(1, 2), (3, 2), (4, 1), (5, 1), (7, 1)}


def test_prefixes_share_enough_for_every_choice(monkeypatch):
    """Pairs at the threshold meet min(l) times whatever l each side chooses."""
    draw = random.Random(2)
    for _ in range(300):
        n = draw.randint(1, 60)
        x = set(draw.sample(range(200), n))
        y = set(x)
        for item in draw.sample(sorted(x), min(n, draw.randint(0, 6))):
            y.discard(item)
        y |= set(draw.sample(range(200, 260), draw.randint(0, 5)))
        if not y or 100 * len(x & y) < 85 * len(x | y):
            continue
        for lx in range(1, 5):
            for ly in range(1, 5):
                prefixes = []
                for items, matches in ((x, lx), (y, ly)):
                    least = -(-85 * len(items) // 100)
                    matches = min(matches, least)
                    prefixes.append((matches, set(sorted(items)[: len(items) - least + matches])))
                assert len(prefixes[0][1] & prefixes[1][1]) >= min(prefixes[0][0], prefixes[1][0])


def test_jaccard_join_of_awkward_rows(spark):
    got = jaccard.near_duplicates(documents(spark)).collect()
    assert len(got) == len(rows())
    by_id = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert by_id[7] == by_id[6] == 6 and by_id[5] == by_id[4] == 4 and by_id[1] == 1
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert [r["n_shingles"] for r in got if r["doc_id"] == 0] == [0]
    assert jaccard.near_duplicates(empty(spark)).count() == 0
    kept = jaccard.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [0, 1, 2, 3, 4, 6, 8, 9, 10, 11, 12, 13, 14]


def plain_repeats(data, length=50):
    """For each document the words that lie in ``length`` words in a row that stand in an earlier document, or earlier in it."""
    first, found = {}, {}
    for d, t in sorted(data):
        listed = words(t)
        hit = [False] * len(listed)
        for i in range(len(listed) - length + 1):
            at = first.setdefault(tuple(listed[i : i + length]), (d, i))
            if at[0] != d or i >= at[1] + length:
                hit[i : i + length] = [True] * length
        found[d] = hit
    return found


def covered(repeated, data):
    """For each document which words its removed spans cover."""
    found = {d: [False] * len(words(t)) for d, t in data}
    for r in repeated:
        span = found[r["doc_id"]][r["first_word"] : r["first_word"] + r["n_words"]]
        assert len(span) == r["n_words"] >= 50 and not any(span) and r["kept_doc_id"] <= r["doc_id"]
        found[r["doc_id"]][r["first_word"] : r["first_word"] + r["n_words"]] = [True] * len(span)
    return found


@pytest.fixture(scope="module")
def passages():
    """Texts of rare words into which passages of 51 to 200 words are put, whatever the lines, some with a word changed."""
    draw = random.Random(11)
    fresh = (f"x{i}" for i in range(10**9))
    shared = [[next(fresh) for _ in range(n)] for n in (51, 52, 60, 75, 120, 200)]
    data = []
    for i in range(150):
        text = [next(fresh) for _ in range(draw.randint(0, 150))]
        for _ in range(draw.randint(0, 2)):
            passage = list(draw.choice(shared))
            if len(passage) > 100 and draw.random() < 0.5:
                passage[len(passage) // 2] = next(fresh)
            at = draw.randint(0, len(text))
            text[at:at] = passage
        if i % 3 == 0:
            text += [f"license{k}" for k in range(30)]
        data.append((i * 2, "".join(w + draw.choice([" "] * 30 + ["\n", " \n\n ", "\t"]) for w in text)))
    return data


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_substring_dedup_finds_all_long_repeats_and_nothing_else(spark, passages, size):
    df = spark.createDataFrame(passages, "doc_id long, text string")
    repeated = paragraphs.repeated_paragraphs(df, size=size).collect()
    got, exact = covered(repeated, passages), plain_repeats(passages)
    seen = set()
    for d, t in passages:
        listed = words(t)
        for i, word in enumerate(listed):
            # What an earlier text has goes. What goes stands earlier, but for a changed word between parts that do.
            near = seen.intersection(listed[max(i - 8, 0) : i + 9])
            assert not exact[d][i] or got[d][i]
            assert not got[d][i] or word in seen or len(near) > 8
            assert not (got[d][i] and word.startswith("license"))
        seen.update(listed)
    left = {d: [w for w, gone in zip(words(t), got[d], strict=True) if not gone] for d, t in passages}
    cut = paragraphs.without_copies(df, spark.createDataFrame(repeated)).collect()
    assert {r["doc_id"]: words(r["text"]) for r in cut} == {d: ws for d, ws in left.items() if ws or not any(got[d])}
    assert sum(map(any, got.values())) > 50


def test_bands_meet_one_after_the_other(spark, monkeypatch):
    text = " ".join(f"v{i}" for i in range(400))
    texts = [text, text.replace("v7 ", "u7 ").replace("v200 ", "u200 "), text]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    steps, write, remove = [], paragraphs.written, paragraphs.drop

    def written(table):
        steps.append(tuple(table.columns))
        return write(table)

    monkeypatch.setattr(paragraphs, "written", written)
    monkeypatch.setattr(paragraphs, "drop", lambda *tables: steps.extend(["dropped"] * len(tables)) or remove(*tables))
    assert paragraphs.repeated_paragraphs(df, bands=(3, 2)).count()
    band = ("token", "node", "hub")
    assert steps[:3] == [band] * 3 and steps.count(band) == 3
    # What only the pairs need goes before the texts are fetched.
    at = steps.index(("a", "b"))
    assert steps[at + 1 : at + 3] == ["dropped", "dropped"] and steps[at + 3] == ("node", "members")


def test_paragraphs_that_stand_alone_are_written_once(spark, monkeypatch):
    """Of most paragraphs neither a copy nor a similar one is there; no table behind the first has their rows."""
    shared = " ".join(f"s{i}" for i in range(80))
    texts = [" ".join(f"o{i}x{j}" for j in range(600)) + f" {shared.replace('s7 ', f'u{i} ')}" * (i < 3) for i in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = []
    for name in ("freeze", "written"):
        write = getattr(paragraphs, name)
        monkeypatch.setattr(paragraphs, name, lambda table, write=write: sizes.append((kept := write(table)).count()) or kept)
    assert {r["doc_id"] for r in paragraphs.repeated_paragraphs(df).collect()} == {1, 2}
    assert sizes[0] > 100 and max(sizes[1:]) < sizes[0] / 3


def test_texts_are_fetched_in_rounds(spark, monkeypatch):
    """No shuffle holds the texts of all documents."""
    shared = " ".join(f"v{i}" for i in range(300))
    texts = [f"{' '.join(f'o{i}x{j}' for j in range(60))} {shared.replace('v7 ', f'u{i} ')}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    calls, fetch = [], paragraphs._with_texts

    def fetched(docs, places, *columns):
        calls.append((columns, {r["doc_id"] for r in docs.collect()}, {r["doc_id"] for r in places.collect()}))
        return fetch(docs, places, *columns)

    monkeypatch.setattr(paragraphs, "_with_texts", fetched)
    found = paragraphs.repeated_paragraphs(df, bands=(3, 2)).collect()
    assert {r["doc_id"] for r in found} == set(range(1, 30)) and {r["kept_doc_id"] for r in found} == {0}
    for columns in {c for c, _, _ in calls}:
        rounds = [(docs, places) for c, docs, places in calls if c == columns]
        assert len(rounds) == paragraphs.TEXT_ROUNDS > 1 and all(places <= docs for docs, places in rounds)
        assert sorted(i for docs, _ in rounds for i in docs) == list(range(30)) and all(len(docs) < 30 for docs, _ in rounds)


def test_near_paragraphs_are_linked_by_exact_similarity(spark):
    """Of two paragraphs of 20 words whose last word differs 15 of 17 shingles are the same; of others fewer than 80 %."""
    base = [f"b{i}" for i in range(20)]
    sets = {0: base, 1: base[:-1] + ["z"], 2: base[:10] + ["q"] + base[11:], 3: [f"c{i}" for i in range(20)]}
    members = {n: sorted({hash(tuple(w[i : i + 5])) for i in range(16)}) for n, w in sets.items()}
    rows = list(members.items())
    pairs = spark.createDataFrame([(a, b) for a in sets for b in sets if a < b], "a long, b long")
    got = paragraphs.similar_pairs(pairs, spark.createDataFrame(rows, paragraphs.SETS), 80)
    assert [tuple(r) for r in got.collect()] == [(0, 1)]
    bits = paragraphs.parities(np.array([members[n] for n in sets], dtype=np.int64).view(np.uint64)).tolist()
    met = spark.createDataFrame([(7, n, hub) for n, hub in ((0, 0), (1, 0), (2, 0), (3, 0))] + [(8, 3, 1), (8, 0, 3)], "token long, node long, hub long")
    found = paragraphs.pairs_by_hubs(met, spark.createDataFrame(list(enumerate(bits)), "node long, bits long"), 80)
    assert (0, 1) in {tuple(r) for r in found.collect()} and (0, 3) not in {tuple(r) for r in found.collect()}


def test_parities_never_exclude_similar_sets():
    draw = np.random.default_rng(4)
    for _ in range(300):
        a = draw.integers(0, 2**63, 16, dtype=np.uint64)
        b = a.copy()
        b[draw.integers(16)] = draw.integers(0, 2**63)
        a[draw.integers(16)] = a[draw.integers(16)]  # a shingle that comes twice
        x, y = (paragraphs.parities(s[None, :])[0] for s in (a, b))
        both, total = len(set(a.tolist()) & set(b.tolist())), len(set(a.tolist())) + len(set(b.tolist()))
        differ = ((int(x) ^ int(y)) & (2**64 - 1)).bit_count()
        assert 100 * both < 80 * (total - both) or differ * 180 <= 2 * 16 * 20


def test_window_minima_and_sections():
    draw = random.Random(3)
    for _ in range(50):
        values = np.array([draw.randint(0, 9) for _ in range(draw.randint(40, 90))], dtype=np.uint64)
        for length in (1, 2, 7, 30):
            got = paragraphs.window_minima(values, length)
            assert got.tolist() == [max(range(i, i + length), key=lambda j: (-int(values[j]), j)) for i in range(len(values) - length + 1)]
        text = "".join(draw.choices(["a", "bc ", " ", "\n", "déf"], k=200)).encode()
        parts = list(paragraphs.sections(text, 17, 3))
        everything = text.split()
        for (place, part, first, own), after in zip(parts, [*parts[1:], None], strict=True):
            assert text[place : place + len(part)] == part and part.split() == everything[first : first + len(part.split())]
            assert after is None or (after[2] == first + own and len(part.split()) >= min(own + 3, len(everything) - first))


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.8, 0.9):
        bands, length = paragraphs.tune_bands(similarity, 0.999, 20)
        assert 1 - (1 - similarity**length) ** bands >= 0.999 or length == 1


def test_substring_dedup_of_awkward_rows(spark):
    df = documents(spark)
    repeated = paragraphs.repeated_paragraphs(df)
    found = {(r["doc_id"], r["first_word"], r["n_words"], r["kept_doc_id"]) for r in repeated.collect()}
    # The second passage of the ninth text repeats its first; in one row of the id 9 it comes before the other text of it.
    assert (9, 62, 60, 9) in found and (10, 0, 60, 9) in found
    assert {d for d, *_ in found} <= {9, 10, 12, 13}
    cut = paragraphs.without_copies(df, repeated)
    assert cut.columns == df.columns
    assert [r["text"] for r in cut.where("doc_id = 10").collect()] == ["other words stand in this second text"]
    assert cut.where("doc_id IS NULL").count() == 1 and cut.where("doc_id = 9").count() == 3
    assert paragraphs.repeated_paragraphs(empty(spark)).count() == 0
    assert paragraphs.without_copies(empty(spark), paragraphs.repeated_paragraphs(empty(spark))).count() == 0
    odd = df.withColumnsRenamed({"lang": "_text", "source": "__spans", "score": "version", "a": "first_char", "b": "doc"})
    assert paragraphs.without_copies(odd, repeated).columns == odd.columns


def test_earliest_by_hash_and_by_bytes(monkeypatch):
    draw = random.Random(12)
    data = np.frombuffer("".join(draw.choices("ab", k=40)).encode() * 6 + bytes(draw.choices(b"abc", k=400)), dtype=np.uint8)
    positions = np.array([draw.randrange(len(data) - substrings.LENGTH) for _ in range(500)])
    ids = np.array([draw.randrange(50) for _ in positions])
    monkeypatch.setattr(substrings, "COMPARED", 7)
    strings = [data[p : p + substrings.LENGTH].tobytes() for p in positions]
    least = {}
    for text, i in zip(strings, ids.tolist(), strict=True):
        least[text] = min(i, least.get(text, i))
    expected = [least[text] for text in strings]
    assert substrings.earliest(data, positions, ids).tolist() == expected
    assert substrings.earliest_by_bytes(data, positions, ids).tolist() == expected
    # One hash for all strings: the bytes decide.
    monkeypatch.setattr(substrings, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), dtype=np.uint64))
    assert substrings.earliest(data, positions, ids).tolist() == expected
    assert substrings.earliest(data, positions[:0], ids[:0]).tolist() == []


def plain_removal(data):
    first: dict[bytes, int] = {}
    contents = sorted((d, (t or "").encode()) for d, t in data)
    for d, content in contents:
        for p in range(len(content) - 49):
            first.setdefault(content[p : p + 50], d)
    result = set()
    for d, content in contents:
        gone = bytearray(len(content))
        for p in range(len(content) - 49):
            if first[content[p : p + 50]] < d:
                gone[p : p + 50] = b"\1" * 50
        spans = sum(g and (not p or not gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(c for c, g in zip(content, gone, strict=True) if not g)
        result.add((d, len(content), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result


def digests(df):
    found = substrings.without_repeats(df)
    return {
        (r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in found.collect()
    }


def test_suffix_dedup_equals_brute_force(spark, near, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 5_000)
    periodic = [(1000, "ab" * 100), (1001, "ba" * 60 + "x"), (1002, "b" + "ab" * 30), (1003, "é" * 40), (1004, "x" + "é" * 40)]
    data = [*near, *periodic]
    assert digests(spark.createDataFrame(data, "doc_id long, text string").repartition(5)) == plain_removal(data)


def between_lines(n):
    """Every document has one line between other texts, and two of three have the same end."""
    draw, line, data = random.Random(11), "a line of some fifty-four bytes that all documents have", []
    for i in range(n):
        before, after = (" ".join(f"{draw.randrange(10**6):06d}" for _ in range(12)) for _ in range(2))
        data.append((i, f"{before}\n{line}\n{after}\n" + "same end of many " * 5 * (i % 3 > 0)))
    return data


def test_suffix_dedup_with_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_POSITIONS", 200)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 15_000)
    data = between_lines(400) + [(7, "rows that repeat an id " * 9), (7, "rows that repeat an id " * 9), (9, "rows that repeat an id " * 9)]
    assert digests(spark.createDataFrame(data, "doc_id long, text string").repartition(4)) == plain_removal(data)


def shuffle_files(spark):
    """Names of the shuffle files that the session has on disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for top in folders for _, _, names in os.walk(top) for name in names if name.endswith(".data")}


def test_suffix_dedup_lets_go_of_what_its_steps_have_shuffled(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 15_000)
    df = spark.createDataFrame(between_lines(400), "doc_id long, text string").repartition(4)
    before = shuffle_files(spark)
    found = substrings.without_repeats(df)
    until = time.monotonic() + 30  # Spark's cleaner works beside the driver
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert found.count() == 400


def test_suffix_dedup_sends_each_run_in_one_round(monkeypatch):
    monkeypatch.setattr(substrings, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rows = pa.RecordBatch.from_pylist([{"doc_id": i, "text": text} for i, text in between_lines(300)])
    [block] = substrings._to_blocks(iter([rows]))
    buckets = 9
    [digests] = substrings._digester(buckets)(iter([block]))
    parts = [substrings._shared(digests.slice(i, 1), 200) for i in range(digests.num_rows)]
    shared = [{name: part[name][0].as_py() for name in ("bucket", "flags")} for part in parts]
    row = pa.RecordBatch.from_pylist([block.to_pylist()[0] | {"shared": shared}])

    def sent(turn, rounds):
        return [r for batch in substrings._sender(buckets, turn, rounds)(iter([row])) for r in batch.to_pylist() if r["runs"]]

    whole, parted = sent(0, 1), [sent(turn, 3) for turn in range(3)]
    assert sorted((r["bucket"], r["runs"]) for rows in parted for r in rows) == sorted((r["bucket"], r["runs"]) for r in whole)
    assert all(r["bucket"] % 3 == turn for turn, rows in enumerate(parted) for r in rows)
    assert max(sum(len(r["runs"]) for r in rows) for rows in parted) < 0.6 * sum(len(r["runs"]) for r in whole)


class Counting:
    """numpy, with the items that some functions have made or read."""

    def __init__(self):
        self.items = 0

    def __getattr__(self, name):
        function = getattr(np, name)
        if name not in ("bincount", "isin"):
            return function

        def counted(values, *args, **kwargs):
            result = function(values, *args, **kwargs)
            self.items += len(result) + (len(args[0]) if name == "isin" else 0)
            return result

        return counted


def test_suffix_dedup_does_not_work_through_a_block_for_each_bucket(monkeypatch):
    def block(n_buckets):
        text = np.full(10_000, 65, dtype=np.uint8)
        bounds = np.array([0, len(text)], dtype="<i8").tobytes()
        ranges = [substrings._pack(np.array([[60 * i], [60 * i + 50]], dtype="<u4").tobytes()) for i in range(n_buckets)]
        columns = [[0], [[1]], [bounds], [substrings._pack(text.tobytes())], [ranges]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "doc_ids", "bounds", "content", "ranges"])

    def bucket(n_blocks):  # of 4096 anchors, half of them in two blocks
        digests = np.arange(4096, dtype="<u4") // 2 if n_blocks > 1 else np.arange(4096, dtype="<u4")
        parts = [digests[i::n_blocks] for i in range(n_blocks)]
        sizes = [substrings._pack(np.ones(len(p), dtype="<u2").tobytes()) for p in parts]
        several = [np.packbits(np.zeros(len(p), dtype=bool)).tobytes() for p in parts]
        columns = {"bucket": [0] * n_blocks, "block": list(range(n_blocks)), "digests": [p.tobytes() for p in parts]}
        return pa.table(columns | {"several": several, "sizes": sizes})

    items = {}
    for n in (2, 128):
        monkeypatch.setattr(substrings, "np", counting := Counting())
        [batch] = substrings._remover(iter([block(n)]))
        items["removed", n] = counting.items
        spans = batch.column("spans")[0].as_py()
        assert spans == [{"start": 60 * i, "end": 60 * i + 50} for i in range(n)]
        monkeypatch.setattr(substrings, "np", counting := Counting())
        substrings._shared(bucket(n), 1 << 16)
        items["shared", n] = counting.items
    assert items["removed", 128] == items["removed", 2] and items["shared", 128] <= 2 * items["shared", 2]


def test_shared_anchors_by_block():
    def flags(*blocks):
        """Of blocks of (digest, whether in several documents, size): which are shared and which hot."""
        columns = {"bucket": [3] * len(blocks), "block": list(range(len(blocks)))}
        columns["digests"] = [np.array([d for d, _, _ in b], dtype="<u4").tobytes() for b in blocks]
        columns["several"] = [np.packbits(np.array([m for _, m, _ in b])).tobytes() for b in blocks]
        columns["sizes"] = [substrings._pack(np.array([n for _, _, n in b], dtype="<u2").tobytes()) for b in blocks]
        found = substrings._shared(pa.table(columns), 10).column("flags").to_pylist()
        split = [(f[: len(f) // 2], f[len(f) // 2 :]) for f in found]
        bits = lambda x, n: np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=n).tolist()
        return [(bits(x, len(b)), bits(y, len(b))) for (x, y), b in zip(split, blocks, strict=True)]

    # 5 is in two blocks and hot by both, 7 in several documents of its block, 9 twice in its block, 8 and 6 in none of these ways.
    first, second = [(5, False, 6), (7, True, 1), (8, False, 1)], [(5, False, 6), (9, False, 1), (9, False, 1), (6, False, 11)]
    assert flags(first, second) == [([1, 1, 0], [1, 0, 0]), ([1, 1, 1, 0], [1, 0, 0, 1])]


def test_an_anchor_of_all_documents_spreads_over_buckets():
    """What a bucket gets, by plain exchanges: no bucket has much more than its share."""
    data, buckets = between_lines(1200), 40
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    batches = [pa.RecordBatch.from_pylist([{"doc_id": d, "text": t} for d, t in data[i : i + 100]], schema) for i in range(0, 1200, 100)]
    blocks = [substrings._block([batch], number) for number, batch in enumerate(batches)]
    digested = pa.Table.from_batches(substrings._digester(buckets)(iter(blocks)))
    flags: dict[int, list] = {}
    for b in set(digested.column("bucket").to_pylist()):
        for r in substrings._shared(digested.filter(pc.equal(digested.column("bucket"), b)), 2000).to_pylist():
            flags.setdefault(r["block"], []).append({"bucket": r["bucket"], "flags": r["flags"]})
    asked = [pa.RecordBatch.from_pylist([b.to_pylist()[0] | {"shared": flags[n]}]) for n, b in enumerate(blocks)]
    sent = pa.Table.from_batches(substrings._sender(buckets)(iter(asked))).to_pylist()
    positions = [0] * buckets
    for r in sent:
        if r["runs"] is not None:
            positions[r["bucket"]] += int(substrings._received(r["runs"])[1].sum())
    assert max(positions) < 3 * sum(positions) / buckets


def test_suffix_dedup_of_awkward_rows(spark):
    got = substrings.without_repeats(documents(spark)).collect()
    assert len(got) == len(rows())
    assert [len(r["spans"]) for r in got if r["doc_id"] is None] == [0]
    assert all(bytes(r["kept"]) == b"" for r in got if r["doc_id"] == 7)
    assert sorted(len(r["spans"]) for r in got if r["doc_id"] == 9) == [0, 0, 0]  # equal ids don't remove from each other
    assert substrings.without_repeats(empty(spark)).count() == 0


def test_decontamination_of_awkward_rows(spark):
    items = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank", "x"),
        (1, "The quick brown fox jumps over the lazy dog near the river bank", "x"),
        (2, None, "x"),
        (3, "", "x"),
        (4, "one two", "x"),
        (None, "one", "x"),
        (5, "unknown words that never occur anywhere at all here", "x"),
        (6, PASSAGE.upper() + " and some more", "x"),
    ]
    found = contamination.contained_items(documents(spark), spark.createDataFrame(items, "item_id long, text string, hash string"))
    pairs = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert pairs == {(6, 1), (7, 1), (8, 1), (4, 4), (5, 4), (9, 6), (10, 6)}
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert contamination.contained_items(documents(spark), no_items).count() == 0
    assert contamination.contained_items(empty(spark), spark.createDataFrame(items, "item_id long, text string, hash string")).count() == 0
    clean = contamination.without_contaminated(documents(spark), spark.createDataFrame(items, "item_id long, text string, hash string"))
    assert clean.columns == documents(spark).columns and clean.where("doc_id IN (4, 5, 6, 7, 8, 9, 10)").count() == 0
    assert clean.where("doc_id IS NULL").count() == 1


def test_containment_search_beyond_broadcast(spark, monkeypatch):
    """The joins give the same if nothing may be broadcast."""
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", 0)
    items = [(1, "the quick brown fox jumps over the lazy dog near"), (6, PASSAGE)]
    found = contamination.contained_items(documents(spark), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(6, 1), (7, 1), (8, 1), (9, 6), (10, 6)}


def test_a_tenth_of_an_item_may_be_changed(spark):
    """Items found in long texts although words are changed, as long as 80 % of their shingles are there."""
    draw = random.Random(9)
    items, texts, expected = [], [], set()
    for item in range(30):
        content = [f"i{item}w{j}" for j in range(draw.randint(10, 120))]
        items.append((item, " ".join(content)))
        for copy in range(3):
            changed = list(content)
            for j in draw.sample(range(len(content)), copy * len(content) // 40):
                changed[j] = "other"
            filler = [f"f{draw.randrange(5000)}" for _ in range(3000)]
            texts.append((item * 3 + copy, " ".join([*filler, *changed, *filler])))
            n = len(content) - 4
            shared = len(shingles(" ".join(content), 5) & shingles(texts[-1][1], 5))
            if 100 * shared >= 80 * n:
                expected.add((item * 3 + copy, item, n, shared))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = contamination.contained_items(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in found.collect()} == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_its_sql(spark, name):
    from check_oracle import compare, open_duckdb

    equal, note = compare(spark, open_duckdb(FOLDER), FOLDER, name)
    assert equal, note


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_suffix_dedup_of_the_documents(spark):
    data = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in catalog.QUERIES["op7_suffix_dedup"](spark, FOLDER).collect()}
    assert got == plain_removal(data)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_substring_dedup_of_the_documents(spark):
    data = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got, exact = covered(catalog.QUERIES["op2_substring_dedup"](spark, FOLDER).collect(), data), plain_repeats(data)
    asked = sum(map(sum, exact.values()))
    assert asked > 1000
    # A repeat is carried on by its first copy only, which another one may exceed.
    assert sum(g and e for d in exact for g, e in zip(got[d], exact[d], strict=True)) >= 0.97 * asked
    assert all(any(exact[d]) or sum(g) <= 0.9 * len(g) for d, g in got.items() if len(g) > 200)
