"""Operator 2: substring dedup by passages.

A paragraph is a piece of ``PASSAGE`` words that begins where the text itself says so, whatever its lines: at the least hash
of five-word shingles in a window of ``WINDOW`` of them. Two texts that share ``LONG`` words in a row share such a window, hence
its least hash, hence a whole paragraph. Paragraphs with the same words are one node, named by a 64-bit hash. MinHash
signatures are cut into bands, tuned so that a pair at the threshold meets in a band with the wanted recall; paragraphs that
meet are compared exactly, by Jaccard similarity of their whole sets; verified links make components, and of each component
every copy but the first (the smallest doc_id, then the first place) is removable.

Removable paragraphs of a document that overlap are one stretch; it is carried on to both sides as far as the words are those of
the first copy. Stretches that then meet, or leave no more than ``GAP`` words between them in both texts, are one passage, and
a passage of ``LONG`` words or more goes. Shorter repetitions, such as license lines, stay.

Copies are one node, so that a band of copies costs no more than its size. Of the nodes of a band only those are compared whose
parities, 64 bits that come along, leave it possible that they are similar. Of texts only those are fetched in which something
is compared or removed, once for each of these.

Defined results: null texts and texts of fewer words have nothing to remove; rows with a null doc_id are left as they are
and remove nothing elsewhere; rows that repeat a doc_id are one document if their texts are equal, and else documents in the order of
their texts' hashes; an empty table gives an empty result; a text of any length is worked through in sections; columns besides
doc_id and text are ignored by the search and passed on by ``without_copies``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.llm.components import components
from ranktide.llm.runtime import BATCH_ROWS, documents, drop, lean, ready, slices, table, to_batches, written
from ranktide.llm.textscan import LOWER, STEP, find_words, mix, runs_of, span_hashes
from ranktide.session import forget_shuffles, freeze

WORDS = 5
PERCENT = 80
LONG = 50
PASSAGE = 20
WINDOW = LONG - PASSAGE  # shingles
GAP = 8
RECALL = 0.88  # at the threshold; whole paragraphs above it share 15 of 17 shingles or all, and meet with 0.97 or always
MOST_BANDS = 3
SECTION_BYTES = 1 << 20
TEXT_ROUNDS = 2  # in which texts are fetched, so that the shuffle of a round is gone when the next begins

SHINGLES = PASSAGE - WORDS + 1
AFTER = WINDOW + PASSAGE + WORDS  # words that a section has behind its own
DOCUMENT = ("doc_id", "version")


def tune_bands(similarity: float, recall: float = RECALL, most_bands: int = MOST_BANDS) -> tuple[int, int]:
    """Bands and rows of a band: the longest rows, hence fewest chance meetings, that reach the recall."""
    best = (most_bands, 1)
    for rows in range(1, 17):
        for bands in range(1, most_bands + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                best = (bands, rows)
                break
    return best


def _blank(value: int) -> bool:
    return value == 32 or 9 <= value <= 13


def sections(text: bytes, size: int, after: int = AFTER) -> Iterator[tuple[int, bytes, int, int]]:
    """A text in sections of about ``size`` bytes: place, bytes, number of the first word, and how many words are its own.

    A section ends behind a word, and has the next ``after`` words, which are the next section's, as well.
    """
    start, first = 0, 0
    while start < len(text):
        end = min(start + size, len(text))
        while end < len(text) and not _blank(text[end]):
            end += 1
        stop, left = end, after
        while stop < len(text) and left:
            while stop < len(text) and _blank(text[stop]):
                stop += 1
            while stop < len(text) and not _blank(text[stop]):
                stop += 1
            left -= 1
        count = 1 << 62 if end == len(text) else len(text[start:end].split())
        yield start, text[start:stop], first, count
        start, first = end, first + count


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all parts, with A-Z lowered, and their bounds."""
    bounds = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return LOWER[np.frombuffer(b"".join(parts), dtype=np.uint8)], bounds


def _hashed(texts: list[bytes], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text where its words begin, and their hashes; a long one is worked through in sections."""
    if sum(map(len, texts)) <= 4 * size:
        data, bounds = _joined(texts)
        words = find_words(data, bounds)
        hashes = span_hashes(data, words.starts, words.ends)
        for i in range(len(texts)):
            own = slice(words.bounds[i], words.bounds[i + 1])
            yield words.starts[own] - bounds[i], hashes[own]
        return
    for text in texts:
        starts, hashes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for place, part, _, _ in sections(text, size, 0):
            data, bounds = _joined([part])
            words = find_words(data, bounds)
            starts.append(words.starts + place)
            hashes.append(span_hashes(data, words.starts, words.ends))
        yield np.concatenate(starts), np.concatenate(hashes)


def _shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of words in a row, given theirs."""
    total = np.zeros(max(len(hashes) - WORDS + 1, 0), dtype=np.uint64)
    for j in range(WORDS):
        total = total * STEP + hashes[j : j + len(total)]
    return mix(total)


def window_minima(values: np.ndarray, length: int) -> np.ndarray:
    """For every window of ``length`` values the place of its least value, the last one of equals."""
    place, width = np.arange(len(values)), 1

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] <= values[a], b, a)

    while width * 2 <= length:
        place = better(place[: len(place) - width], place[width:])
        width *= 2
    rest = length - width
    return better(place[: len(place) - rest], place[rest:]) if rest else place


def anchors(runs: np.ndarray, bounds: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles at which paragraphs begin, and the part of each; ``own`` windows of each part count."""
    if len(runs) < WINDOW:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    least = window_minima(runs, WINDOW)
    part = np.searchsorted(bounds, np.arange(len(least)), side="right") - 1
    inside = np.arange(len(least)) - bounds[part]
    valid = (inside < own[part]) & (np.arange(len(least)) + WINDOW <= bounds[part + 1])
    found, at = np.unique(least[valid], return_index=True)
    part = part[valid][at]
    whole = found + SHINGLES <= bounds[part + 1]
    return found[whole], part[whole]


def _signed(bands: int, rows: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [f"band_{i}" for i in range(bands)]
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "version", "start", "node", "bits", *names)]
    )
    random = np.random.Generator(np.random.PCG64(7))
    factors = random.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def groups(texts: list[str | None]) -> Iterator[list[tuple[int, bytes, int, int]]]:
        """Sections, with the row of each, that are worked on at once."""
        held: list[tuple[int, bytes, int, int]] = []
        for row, text in enumerate(texts):
            for _, part, first, own in sections((text or "").encode(), size):
                held.append((row, part, first, own))
                if sum(len(h[1]) for h in held[-2:]) > size or len(held) >= BATCH_ROWS:
                    yield held
                    held = []
        if held:
            yield held

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for group in groups(batch.column("text").to_pylist()):
                row, parts, first, own = zip(*group, strict=True)
                data, bounds = _joined(list(parts))
                words = find_words(data, bounds)
                runs, begins = runs_of(span_hashes(data, words.starts, words.ends), words, WORDS)
                bounds = np.searchsorted(begins, words.bounds)
                found, part = anchors(runs, bounds, np.array(own, dtype=np.int64))
                if not len(found):
                    continue
                sets = runs[found[:, None] + np.arange(SHINGLES)]
                name = np.zeros(len(found), dtype=np.uint64)
                for j in range(SHINGLES):
                    name = name * STEP + sets[:, j]
                row_of = pa.array(np.array(row, dtype=np.int64)[part])
                columns = {
                    "doc_id": batch.column("doc_id").take(row_of),
                    "version": batch.column("version").take(row_of),
                    "start": np.array(first, dtype=np.int64)[part] + found - bounds[part],
                    "node": mix(name).view(np.int64),
                    "bits": parities(sets),
                }
                for b, column in enumerate(names):
                    joined = np.full(len(found), b, dtype=np.uint64)
                    for j in range(b * rows, (b + 1) * rows):
                        joined = mix(joined + mix(sets * factors[j] + shifts[j]).min(axis=1))
                    columns[column] = joined.view(np.int64)
                yield to_batches(columns, schema)

    return sign


def _at_places(work: Callable, schema: pa.Schema, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows that ``work`` makes of each text with its list of ``places``, given where its words begin and their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            listed = batch.select(["doc_id", "version", "places"]).to_pylist()
            for row, text, (starts, hashes) in zip(listed, texts, _hashed(texts, size), strict=True):
                rows += work(row, text, starts, hashes)
            if rows:
                yield to_batches(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    return run


SETS = "node long, members array<long>"
SETS_SCHEMA = pa.schema([("node", pa.int64()), ("members", pa.list_(pa.int64()))])


def _set_rows(row: dict, text: bytes, starts: np.ndarray, hashes: np.ndarray) -> list[tuple]:
    """Nodes with their sets of shingles."""
    sets = [np.unique(_shingles(hashes[p["start"] : p["start"] + PASSAGE])) for p in row["places"]]
    return [(p["node"], s.view(np.int64).tolist()) for p, s in zip(row["places"], sets, strict=True)]


def parities(sets: np.ndarray) -> np.ndarray:
    """For each row of shingles the parities of 64 cells of its distinct ones."""
    ordered = np.sort(sets, axis=1)
    cells = np.uint64(1) << (ordered >> np.uint64(9) & np.uint64(63))
    cells[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = 0
    return np.bitwise_xor.reduce(cells, axis=1).view(np.int64)


CONTEXTS_SCHEMA = pa.schema([("component", pa.int64()), ("side", pa.string()), ("words", pa.binary())])


def _around(hashes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a paragraph backwards and on before it, and forwards and on behind it, as 32 bits of their hashes."""
    reach = WINDOW + WORDS
    some = (hashes[max(start - reach, 0) : start + PASSAGE + reach] >> np.uint64(32)).astype(np.uint32)
    at = min(start, reach)
    return some[: at + PASSAGE][::-1], some[at:]


def _context_rows(row: dict, text: bytes, starts: np.ndarray, hashes: np.ndarray) -> list[tuple]:
    found = []
    for p in row["places"]:
        before, after = _around(hashes, p["start"])
        found += [(p["component"], "before", before.tobytes()), (p["component"], "after", after.tobytes())]
    return found


def _beyond(own: np.ndarray, other: bytes | None) -> int:
    """How many words beyond the edge of a paragraph are those of its first copy; below 0, by how many it falls short.

    Both begin at the paragraph's other edge and go on beyond this one. The first copy may be a similar paragraph, which begins
    some words earlier or later; the shift at which most of the paragraph agrees counts.
    """
    if other is None:
        return 0
    there, best = np.frombuffer(other, dtype=np.uint32), (-1, 0, np.zeros(0, dtype=bool))
    for shift in (0, 1, -1, 2, -2):
        mine, kept = own[max(shift, 0) :], there[max(-shift, 0) :]
        n = min(len(mine), len(kept))
        same = mine[:n] == kept[:n]
        agree = int(same[:PASSAGE].sum())
        if agree > best[0]:
            best = (agree, max(shift, 0), same)
        if agree == PASSAGE:  # no shift agrees in more
            break
    _, skipped, same = best
    at = min(PASSAGE - skipped, len(same))
    if at and same[at - 1]:
        while at < len(same) and same[at]:
            at += 1
    else:
        while at and not same[at - 1]:
            at -= 1
    return at + skipped - PASSAGE


SPANS = "doc_id long, version long, first_word long, n_words long, first_char long, n_chars long, kept_doc_id long"
SPANS_SCHEMA = pa.schema([(part.split()[0], pa.int64()) for part in SPANS.split(", ")])


def stretches(starts: list[int]) -> list[tuple[int, int]]:
    """First and last index of the paragraphs, in order, that overlap or leave no word between them."""
    found, first = [], 0
    for i in range(1, len(starts) + 1):
        if i == len(starts) or starts[i] > starts[i - 1] + PASSAGE:
            found.append((first, i - 1))
            first = i
    return found


def _span_rows(row: dict, text: bytes, starts: np.ndarray, hashes: np.ndarray) -> list[tuple]:
    places = sorted((p for p in row["places"] if p["side"] is None), key=lambda p: p["start"])
    around = {(p["start"], p["side"]): p["words"] for p in row["places"] if p["side"] is not None}
    spans: list[list[int]] = []
    before = None
    for first, last in stretches([p["start"] for p in places]):
        head, tail = places[first], places[last]
        start = head["start"] - _beyond(_around(hashes, head["start"])[0], around.get((head["start"], "before")))
        end = tail["start"] + PASSAGE + _beyond(_around(hashes, tail["start"])[1], around.get((tail["start"], "after")))
        # A few words between go with their sides if these stand in one text, about as far from each other.
        shift = before is not None and (head["start"] - before["start"]) - (head["kept_start"] - before["kept_start"])
        of_one = before is not None and head["kept_doc_id"] == before["kept_doc_id"] and abs(shift) <= GAP
        if spans and start <= spans[-1][1] + GAP * of_one:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end, head["kept_doc_id"]])
        before = tail
    if not (spans := [s for s in spans if s[1] - s[0] >= LONG]):
        return []
    rows = []
    for start, end, kept in spans:
        low = int(starts[start])
        high = int(starts[end]) if end < len(starts) else len(text)
        first_char = len(text[:low].decode())
        rows.append((row["doc_id"], row["version"], start, end - start, first_char, len(text[low:high].decode()), kept))
    return rows


def _with_texts(docs: DataFrame, places: DataFrame, *columns: str) -> DataFrame:
    """Texts of the documents in which there are places, with a list of these, which the text itself bounds.

    A document that is there twice comes twice.
    """
    listed = places.groupBy(*DOCUMENT).agg(F.collect_list(F.struct(*columns)).alias("places"))
    return docs.join(listed, list(DOCUMENT)).select(*DOCUMENT, "text", "places")


def in_round(table: DataFrame, number: int) -> DataFrame:
    """The rows of a table of documents, or of places in them, that belong to one of ``TEXT_ROUNDS``."""
    return table.where(F.pmod(F.xxhash64(*DOCUMENT), F.lit(TEXT_ROUNDS)) == number)


def _sets(docs: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """The set of shingles of every node, from the text of its place."""
    found = _with_texts(docs, places, "node", "start").mapInArrow(lean(_at_places(_set_rows, SETS_SCHEMA, size)), schema=SETS)
    return found.dropDuplicates(["node"])


def _contexts(docs: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """The words around the paragraphs of the components at some places."""
    found = _with_texts(docs, places, "start", "component")
    return found.mapInArrow(lean(_at_places(_context_rows, CONTEXTS_SCHEMA, size)), schema="component long, side string, words binary")


def _spans(docs: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """The passages to remove, from the removable paragraphs and what is around their first copies."""
    found = _with_texts(docs, places, "start", "kept_doc_id", "kept_start", "side", "words")
    return found.mapInArrow(lean(_at_places(_span_rows, SPANS_SCHEMA, size)), schema=SPANS).distinct()


def _close(percent: int, x: str, y: str):
    """Whether the parities of two paragraphs allow them to be similar: a cell in which they differ has an unshared shingle."""
    differ = F.bit_count(F.col(x).bitwiseXOR(F.col(y)))
    return differ * (100 + percent) <= 2 * SHINGLES * (100 - percent)


def pairs_by_hubs(met: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of nodes that meet in a band and may be similar by their parities: of each node with the smallest one of
    the band, and of the others of the band with each other. Frozen.

    ``met`` has token, node and hub, ``bits`` a row per node. What does not fit is left out within the joins.
    """
    placed = met.join(bits, "node")
    hubs = bits.withColumnsRenamed({"node": "hub", "bits": "hub_bits"})
    first = placed.where(F.col("node") != F.col("hub")).join(hubs, "hub").where(_close(percent, "bits", "hub_bits"))
    first = first.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    others = placed.where(F.col("node") != F.col("hub")).select("token", "node", "bits")
    later = others.withColumnsRenamed({"node": "node_b", "bits": "bits_b"})
    second = others.join(later, "token").where((F.col("node") < F.col("node_b")) & _close(percent, "bits", "bits_b"))
    return written(first.union(second.select(F.col("node").alias("a"), F.col("node_b").alias("b"))).distinct())


def similar_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of nodes whose whole sets are similar. Frozen."""
    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(sets.select(F.col("node").alias(side), F.col("members").alias(f"members_{side}")), side)
    both = F.size(F.array_intersect("members_a", "members_b"))
    total = F.size("members_a") + F.size("members_b")
    return freeze(sides.where(100 * both >= percent * (total - both)).select("a", "b"))


def repeated_paragraphs(df: DataFrame, percent: int = PERCENT, bands: tuple[int, int] | None = None, size: int = SECTION_BYTES) -> DataFrame:
    """The passages that repeat an earlier one.

    ``doc_id``, ``version`` (the hash of its text), ``first_word`` and ``n_words``, ``first_char`` and ``n_chars`` (from its first
    word to the word behind it) and ``kept_doc_id``, where its beginning stands first. Written, as its texts are fetched in rounds.
    """
    ready(df.sparkSession)
    docs = documents(df).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).withColumn("version", F.xxhash64("text"))
    count, rows = bands or tune_bands(percent / 100)
    names = [f"band_{i}" for i in range(count)]
    ddl = "doc_id long, version long, start long, node long, bits long" + "".join(f", {n} long" for n in names)
    signed = freeze(docs.mapInArrow(lean(_signed(count, rows, size)), schema=ddl))

    # Bands in which different nodes meet; equal ones are one node. One band after the other, so that the shuffles of one are gone
    # when the next begins.
    met = None
    for name in names:
        # The rows are dealt out once; the buckets are made where they then are.
        postings = signed.select("node", F.col(name).alias("token")).repartition("token")
        buckets = postings.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("_other"))
        of_band = postings.join(buckets.where(F.col("hub") != F.col("_other")).select("token", "hub"), "token").distinct()
        of_band = written(of_band)
        met = of_band if met is None else met.union(of_band)
    listed = signed.drop(*names)

    # Of each node that meets another or comes again its first place and how often it comes; the rows of all others are read no more
    # than once by a step that follows.
    place = F.struct(*DOCUMENT, "start")
    nodes = listed.groupBy("node").agg(F.min(place).alias("_kept"), F.count("*").alias("_places"), F.first("bits").alias("bits"))
    meeting = met.select("node").distinct().withColumn("_meets", F.lit(True))
    nodes = nodes.join(meeting, "node", "left").where(F.col("_meets") | (F.col("_places") > 1))
    nodes = written(nodes.drop("_meets"))
    pairs = pairs_by_hubs(met, nodes.select("node", "bits"), percent)
    paired = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    firsts = nodes.drop("bits").join(paired.withColumn("_paired", F.lit(True)), "node", "left")
    firsts = freeze(firsts.where(F.col("_paired") | (F.col("_places") > 1)))
    drop(met, nodes)
    forget_shuffles(df.sparkSession)
    places = firsts.where("_paired").select("node", "_kept.*")
    parts = [written(_sets(in_round(docs, i), in_round(places, i), size)) for i in range(TEXT_ROUNDS)]
    sets = reduce(DataFrame.union, parts)
    links = similar_pairs(pairs, sets, percent)
    drop(pairs, sets)
    grouped = written(components(links))

    # The first place of each paragraph that comes again, and of its component.
    placed = firsts.join(grouped, "node", "left").where(F.col("component").isNotNull() | (F.col("_places") > 1))
    placed = written(placed)
    of_component = placed.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("_kept").alias("_first"))
    classes = placed.join(of_component, "component", "left").select(
        "node", F.coalesce("component", "node").alias("component"), F.coalesce("_first", "_kept").alias("kept")
    )
    kept_at = [F.col(f"kept.{c}").alias(f"kept_{c}") for c in (*DOCUMENT, "start")]
    classes = freeze(classes.select("node", "component", *kept_at))
    same = (F.col("doc_id") == F.col("kept_doc_id")) & (F.col("version") == F.col("kept_version"))
    removable = listed.select(*DOCUMENT, "start", "node").join(classes, "node").where(~same | (F.col("start") >= F.col("kept_start") + PASSAGE))
    removable = written(removable.drop("node"))
    drop(signed, firsts, placed)
    classes = classes.select("component", "kept_doc_id", "kept_version", "kept_start").distinct()

    # The words around the first copies of the paragraphs at the ends of each stretch.
    at = F.array_sort(F.collect_list(F.struct("start", "component")))
    ordered = removable.groupBy(*DOCUMENT).agg(at.alias("at"))

    def ends_of(side: str):
        """The paragraphs that have none before them, or behind them, in their stretch."""
        if side == "before":
            alone = lambda p, i: (i == 0) | (p["start"] > F.get("at", i - 1)["start"] + PASSAGE)
        else:
            alone = lambda p, i: (i == F.size("at") - 1) | (F.get("at", i + 1)["start"] > p["start"] + PASSAGE)
        return F.transform(F.filter("at", alone), lambda p: F.struct(p["start"], p["component"], F.lit(side).alias("side")))

    ends = ordered.select(*DOCUMENT, F.explode(F.concat(ends_of("before"), ends_of("after"))).alias("end"))
    ends = written(ends.select(*DOCUMENT, "end.*"))
    wanted = ends.select("component").distinct()
    first_copies = classes.join(wanted, "component", "left_semi").select(
        F.col("kept_doc_id").alias("doc_id"), F.col("kept_version").alias("version"), F.col("kept_start").alias("start"), "component"
    )
    first_copies = written(first_copies)
    parts = [written(_contexts(in_round(docs, i), in_round(first_copies, i), size)) for i in range(TEXT_ROUNDS)]
    contexts = written(reduce(DataFrame.union, parts).dropDuplicates(["component", "side"]))
    drop(first_copies, *parts)
    around = ends.join(contexts, ["component", "side"]).select(*DOCUMENT, "start", "side", "words")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("side", "string"), ("words", "binary"))]
    here = removable.select(*DOCUMENT, "start", "kept_doc_id", "kept_start", *nothing)
    listed = here.unionByName(around, allowMissingColumns=True)
    spans = [written(_spans(in_round(docs, i), in_round(listed, i), size)) for i in range(TEXT_ROUNDS)]
    drop(contexts, ends, removable)
    return reduce(DataFrame.union, spans)


def without_copies(df: DataFrame, repeated: DataFrame) -> DataFrame:
    """``df`` with the repeated passages cut out of ``text``; documents of which no word is left are dropped."""
    # Own names for what is joined, as the documents may have columns of any name.
    free = "_"
    while any(c.lower().startswith(free) for c in df.columns):
        free += "_"
    doc, version, spans, new = f"{free}doc", f"{free}version", f"{free}spans", f"{free}text"
    cut = repeated.groupBy(F.col("doc_id").alias(doc), F.col("version").alias(version)).agg(
        F.array_sort(F.collect_list(F.struct("first_char", "n_chars"))).alias(spans)
    )
    text = F.col("text").cast("string")
    same = (F.col("doc_id").cast("long") == F.col(doc)) & (F.xxhash64(text) == F.col(version))
    # What is between the passages, and behind the last one.
    span, before = F.col(spans), lambda i: F.get(spans, i - 1)
    from_char = lambda i: F.when(i == 0, F.lit(0)).otherwise(before(i)["first_char"] + before(i)["n_chars"])
    kept = F.transform(span, lambda s, i: text.substr((from_char(i) + 1).cast("int"), (s["first_char"] - from_char(i)).cast("int")))
    rest = text.substr((from_char(F.size(span)) + 1).cast("int"), F.length(text))
    joined = df.join(cut, same, "left").withColumn(new, F.concat(F.array_join(kept, ""), rest))
    emptied = F.col(spans).isNotNull() & ~F.col(new).rlike(r"[^\x20\x09-\x0D]")
    changed = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.col(new)).alias("text")
    return joined.where(~emptied).select(*(changed if c == "text" else F.col(c) for c in df.columns))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(table(spark, sf_dir, "documents"))
