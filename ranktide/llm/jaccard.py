"""Operator 3: n-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct shingles. All sets are ordered by one global order, rare shingles first, by counts
over all documents. Two sets of Jaccard similarity t or more share at least l of their first n - ceil(t n) + l shingles,
for every l; each document chooses the l that costs least by the estimated frequencies of its shingles: a longer prefix
has more postings, but a pair must then meet l times before it is verified. A pair needs as many shared prefix
shingles as the smaller of its two numbers l.

Work that would grow with the square of a group is avoided in steps. Equal sets are one node. Shingles that stand in the
same nodes' prefixes, such as those of a passage that some texts share, are one token with a weight. Within the
documents that share a prefix shingle and a size class, each is first compared with a few that stand for its shingles;
the links found are joined to components. Only then, pairs of different components that share a prefix shingle are
compared, all of them, so that no link between components is lost; pairs within a component can't change the result.

Before texts are fetched, a pair's parity tables give a lower bound of how much the sets differ, which drops nearly all
pairs that merely share a passage. Verification is exact on the 64-bit hashes of the shingles of both whole texts.

The frequencies come from a count sketch of CELLS counters, filled by all documents; it only decides the order and the
prefix lengths, never the result. Its size is fixed, and it travels to the tasks as a broadcast.

Defined results: texts without words have an empty set and no link; a null doc_id gets its set size and a null component;
rows that repeat a doc_id are one node with several sets; an empty table gives an empty result; columns besides doc_id
and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranktide.llm.components import components
from ranktide.llm.runtime import documents, drop, lean, ready, slices, table, to_batches, written
from ranktide.llm.textscan import LOWER, find_words, mix, runs_of, shingles, span_hashes, utf8
from ranktide.session import application_folder, freeze, passing_tables

CELLS = 1 << 22
CELLS_PER_ROW = 1 << 16
HUBS = 3  # smaller members with which a document is compared before components are formed
MOST_MATCHES = 4
PARITY = tuple(f"parity_{i}" for i in range(16))  # columns of the small parity table, 64 cells each
VERIFY_COST = 20.0  # of a candidate, in postings read


def _sketcher(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("part", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.int64)
        for batch in slices(batches):
            data, bounds = utf8(batch.column("text"))
            data = LOWER[data]
            words = find_words(data, bounds)
            runs, _ = runs_of(span_hashes(data, words.starts, words.ends), words, k)
            cells += np.bincount((runs % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        if cells.any():
            rows = cells.reshape(-1, CELLS_PER_ROW)
            yield to_batches({"part": np.arange(len(rows)), "counts": [_packed(r) for r in rows]}, schema)

    return count


def _packed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype="<i8")


def _add_up(parts: pa.Table) -> pa.Table:
    total = np.zeros(CELLS_PER_ROW, dtype=np.int64)
    for packed in parts.column("counts").to_pylist():
        total += _unpacked(packed)
    return pa.table({"part": parts.column("part")[:1].cast(pa.int32()), "counts": pa.array([_packed(total)], pa.binary())})


def count_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Counters of the shingles of all documents, by hash."""
    # Tasks' counters are added in two steps, so that no task gets those of all tasks.
    partial = docs.select("text").mapInArrow(lean(_sketcher(k)), schema="part int, counts binary")
    some = partial.withColumn("_some", F.spark_partition_id() % 16).groupBy("part", "_some").applyInArrow(_add_up, schema="part int, counts binary")
    rows = some.groupBy("part").applyInArrow(_add_up, schema="part int, counts binary").collect()
    cells = np.zeros(CELLS, dtype=np.int64)
    for row in rows:
        start = row["part"] * CELLS_PER_ROW
        cells[start : start + CELLS_PER_ROW] = _unpacked(bytes(row["counts"]))
    # What a cell of rare shingles holds is no frequency of any of them.
    return np.minimum(np.maximum(cells - int(np.median(cells)), 0), 2**31 - 1).astype(np.int32)


def choose_prefix(frequency: np.ndarray, least: int) -> tuple[int, int]:
    """The number of matches l of least cost and its prefix length, for frequencies in prefix order.

    ``least`` is the overlap that any similar set has with this one.
    """
    n = len(frequency)
    reach = np.cumsum(frequency[: n - least + MOST_MATCHES], dtype=np.float64)
    best = None
    for matches in range(1, min(MOST_MATCHES, least) + 1):
        length = n - least + matches
        cost = length + reach[length - 1] * (1 + VERIFY_COST / matches)
        if best is None or cost < best[0]:
            best = (cost, matches, length)
    return best[1], best[2]


SETS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("key_a", pa.int64()),
        ("key_b", pa.int64()),
        ("matches", pa.int32()),
        ("prefix", pa.list_(pa.int64())),
        ("bits", pa.binary()),
        *((name, pa.int64()) for name in PARITY),
    ]
)


def _set_maker(k: int, percent: int, cells) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = cells.value
        for batch in slices(batches):
            data, bounds = utf8(batch.column("text"))
            hashes, owner, _ = shingles(data, bounds, k)
            n = batch.num_rows
            sizes = np.bincount(owner, minlength=n)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            sums = []
            for salt in (1, 2):
                total = np.zeros(len(hashes) + 1, dtype=np.uint64)
                np.cumsum(mix(hashes + np.uint64(salt)), out=total[1:])
                sums.append((total[starts[1:]] - total[starts[:-1]]).view(np.int64))
            small = small_parities(hashes, owner, n)
            frequency = counts[(hashes % np.uint64(CELLS)).astype(np.int64)]
            rank = np.minimum(frequency, 0xFFFF).astype(np.uint64) << np.uint64(48) | hashes >> np.uint64(16)
            order = np.lexsort((hashes, rank, owner))
            hashes, frequency = hashes[order].view(np.int64), frequency[order]
            matches, prefixes, bits = np.zeros(n, dtype=np.int64), [], []
            for i in range(n):
                size = int(sizes[i])
                own = slice(starts[i], starts[i] + size)
                bits.append(parity(hashes[own]))
                if not size:
                    prefixes.append([])
                    continue
                matches[i], length = choose_prefix(frequency[own], -(-percent * size // 100))
                prefixes.append(hashes[own][:length])
            columns = {"doc_id": batch.column("doc_id"), "n_shingles": sizes, "key_a": sums[0], "key_b": sums[1]}
            columns |= small
            yield to_batches(columns | {"matches": matches, "prefix": prefixes, "bits": bits}, SETS)

    return make


def parity(hashes: np.ndarray) -> bytes:
    """A bit for each of about half as many cells as the set has members: whether the cell's members are odd in number."""
    cells = max(64, 1 << max(int(len(hashes)) // 2 - 1, 1).bit_length())
    odd = np.bincount(((hashes.view(np.uint64) >> np.uint64(7)) % np.uint64(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of members that two sets don't share, from their parities.

    A cell whose parities differ has at least one such member. The larger table is folded to the smaller one's size.
    """
    x, y, n, m = int.from_bytes(a, "little"), int.from_bytes(b, "little"), len(a) * 8, len(b) * 8
    while n > m:
        n //= 2
        x = (x >> n) ^ (x & (1 << n) - 1)
    while m > n:
        m //= 2
        y = (y >> m) ^ (y & (1 << m) - 1)
    return (x ^ y).bit_count()


def _possible(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, bits_a, bits_b = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))
            # Similar sets differ in at most (1 - t) / (1 + t) of the sum of their sizes.
            keep = [
                least_difference(x, y) * (100 + percent) <= (100 - percent) * (n + m)
                for n, m, x, y in zip(n_a, n_b, bits_a, bits_b, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sift


def possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) without those whose sets certainly differ too much; ``nodes`` has node, n and bits. Frozen."""
    sides = pairs
    for side in ("a", "b"):
        own = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
        sides = sides.join(own, side)
    sides = sides.where(_fits(percent, "n_a", "n_b")).select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return freeze(sides.mapInArrow(lean(_possible(percent)), schema="a long, b long").distinct())


def _similar(k: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "text_a"), "text_b"):
            sides = []
            for name in ("text_a", "text_b"):
                hashes, owner, _ = shingles(*utf8(batch.column(name)), k)
                sides.append((mix(hashes + mix(owner.astype(np.uint64))), np.bincount(owner, minlength=batch.num_rows), owner))
            (keys_a, size_a, owner_a), (keys_b, size_b, _) = sides
            both = np.bincount(owner_a[np.isin(keys_a, keys_b)], minlength=batch.num_rows)
            linked = (both > 0) & (100 * both >= percent * (size_a + size_b - both))
            yield to_batches({"a": batch.column("a").filter(pa.array(linked)), "b": batch.column("b").filter(pa.array(linked))}, schema)

    return compare


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose texts' sets are similar; ``texts`` has a text for every node. Frozen."""
    pairs = freeze(pairs)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = texts.join(nodes, "node", "left_semi")
    sides = pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
    sides = sides.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b")
    return freeze(sides.mapInArrow(lean(_similar(k, percent)), schema="a long, b long").distinct())


def small_parities(hashes: np.ndarray, owner: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """For each of ``n`` sets the parities of 64 cells in each of the columns of ``PARITY``."""
    cells = 64 * len(PARITY)
    cell = owner * cells + ((hashes >> np.uint64(7)) % np.uint64(cells)).astype(np.int64)
    odd = (np.bincount(cell, minlength=n * cells) & 1).astype(bool).reshape(n, cells)
    packed = np.packbits(odd, axis=1, bitorder="little").view("<i8").reshape(n, len(PARITY))
    return {name: packed[:, i] for i, name in enumerate(PARITY)}


def may_be_similar(percent: int, x: str, y: str):
    """Whether the sizes and the small parities of two sets, in columns of these suffixes, allow them to be similar."""
    differ = sum(F.bit_count(F.col(f"{p}_{x}").bitwiseXOR(F.col(f"{p}_{y}"))) for p in PARITY)
    total = F.col(f"n_{x}") + F.col(f"n_{y}")
    return _fits(percent, f"n_{x}", f"n_{y}") & (differ * (100 + percent) <= total * (100 - percent))


def _fits(percent: int, x: str, y: str):
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def pairs_with_hubs(placed: DataFrame) -> DataFrame:
    """Pairs (a < b or not) of a node with members of other components that stand for tokens it has.

    ``placed`` has token, weight, size class, node, matches and component. A token and class is stood for by the smallest node of
    its smallest component; of those a node meets, the HUBS with the most shared tokens are taken.
    """
    hubs = placed.groupBy("token", "_class").agg(F.min(F.struct("component", "node", "matches")).alias("hub"))
    met = placed.join(hubs, ["token", "_class"]).where(F.col("component") != F.col("hub.component"))
    pairs = met.groupBy("node", F.col("hub.node").alias("hub")).agg(
        F.sum("weight").alias("_shared"), F.min(F.least("matches", "hub.matches")).alias("_needed")
    )
    best = Window.partitionBy("node").orderBy(F.desc("_shared"), "hub")
    ranked = pairs.where(F.col("_shared") >= F.col("_needed")).withColumn("_place", F.row_number().over(best))
    return ranked.where(F.col("_place") <= HUBS).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def pairs_between_components(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of nodes of different components that share enough tokens.

    ``placed`` has a row for each token of a node: token, weight, node, n (size), matches, component and the small parities. The
    largest component of a token is paired with the others, not with itself; pairs whose sizes or parities no similar pair
    can have are left out within the join.
    """
    per_component = placed.groupBy("token", "component").agg(F.count("*").alias("_n"))
    main = per_component.groupBy("token").agg(F.max(F.struct("_n", "component")).alias("_main"), F.count("*").alias("_components"))
    main = main.where(F.col("_components") > 1).select("token", F.col("_main.component").alias("main"))
    open_ones = freeze(placed.join(main, "token"))
    columns = ("node", "n", "matches", "component", *PARITY)
    x = open_ones.where(F.col("component") != F.col("main")).select("token", *(F.col(c).alias(f"{c}_x") for c in columns))
    y = open_ones.select("token", "weight", "main", *(F.col(c).alias(f"{c}_y") for c in columns))
    met = x.join(y, "token").where(
        (F.col("component_x") != F.col("component_y"))
        & ((F.col("node_x") < F.col("node_y")) | (F.col("component_y") == F.col("main")))
        & may_be_similar(percent, "x", "y")
    )
    pairs = met.groupBy(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).agg(
        F.sum("weight").alias("_shared"), F.min(F.least("matches_x", "matches_y")).alias("_needed")
    )
    return pairs.where(F.col("_shared") >= F.col("_needed")).select("a", "b")


def one_for_equal_lists(lists: DataFrame) -> DataFrame:
    """One token for all that stand in the same nodes, and as its ``weight`` how many these are.

    ``lists`` has token, node, n and matches. A passage that a few texts share gives a token for each of its words, and every one of them
    would make the same pairs anew. Lists are told apart by their lengths and the sums of two hashes of their nodes.
    """
    halves = []
    for seed in (1, 2):
        name = F.xxhash64(F.lit(seed), "node", "n", "matches")
        halves += [F.sum(name.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(name, 32))]
    named = lists.groupBy("token").agg(F.count("*").alias("_n"), *(h.alias(f"_sum_{i}") for i, h in enumerate(halves)))
    same = named.groupBy("_n", *(f"_sum_{i}" for i in range(len(halves))))
    return same.agg(F.min("token").alias("token"), F.count("*").alias("weight")).select("token", "weight")


def near_duplicates(df: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``df``.

    Documents of ``k``-word shingle similarity of ``percent`` % or more are linked; a component's id is its smallest. The result
    is written, and the tables behind it are removed.
    """
    spark = ready(df.sparkSession)
    path = application_folder(spark, "frozen")
    with passing_tables(spark):
        found = _near_duplicates(df, k, percent)
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _near_duplicates(df: DataFrame, k: int, percent: int) -> DataFrame:
    spark = df.sparkSession
    docs = documents(df)
    cells = spark.sparkContext.broadcast(count_sketch(docs, k))
    ddl = "doc_id long, n_shingles long, key_a long, key_b long, matches int, prefix array<long>, bits binary"
    ddl += "".join(f", {name} long" for name in PARITY)
    sets = freeze(docs.mapInArrow(lean(_set_maker(k, percent, cells)), schema=ddl))

    known = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    key = ["key_a", "key_b", "n_shingles"]
    # Equal sets have equal prefixes; the row with the smallest id stands for them.
    first_rows = known.groupBy(*key).agg(F.min(F.struct("doc_id", "matches", "prefix", "bits", *PARITY)).alias("_first"))
    nodes = freeze(first_rows.select(*key, "_first.*").withColumnsRenamed({"doc_id": "node", "n_shingles": "n"}))
    members = known.select("doc_id", *key).join(nodes.select("key_a", "key_b", F.col("n").alias("n_shingles"), "node"), key)
    members = freeze(members.select("doc_id", "node").distinct())
    several = members.groupBy("doc_id").agg(F.min("node").alias("b"), F.count("*").alias("_n")).where(F.col("_n") > 1)
    links = members.join(several, "doc_id").select(F.col("node").alias("a"), "b")

    # Postings of the shingles that several nodes have in their prefixes.
    postings = nodes.select(F.explode("prefix").alias("token"), "node", "n", "matches")
    shared = postings.groupBy("token").agg(F.min("node").alias("_first"), F.max("node").alias("_last"))
    shared = shared.where(F.col("_first") != F.col("_last")).select("token")
    size_class = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int")
    lists = freeze(postings.join(shared, "token").withColumn("_class", size_class))
    met = lists.join(one_for_equal_lists(lists), "token")
    met = written(met.join(nodes.select("node", "n", *PARITY), ["node", "n"]))
    drop(lists)

    texts = docs.withColumnRenamed("doc_id", "node")
    links = freeze(links)
    placed, compared, grouped = met.withColumn("component", F.col("node")), None, None
    for pairs_of in (pairs_with_hubs, pairs_with_hubs, lambda p: pairs_between_components(p, percent)):
        if compared is None:
            pairs = pairs_of(placed)
        else:
            placed = freeze(met.join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node")))
            pairs = pairs_of(placed).join(compared, ["a", "b"], "left_anti")
        pairs = possible(pairs, nodes, percent)
        compared = pairs if compared is None else compared.union(pairs)
        fresh = verified(pairs, texts, k, percent)
        if grouped is None or not fresh.isEmpty():  # without new links the components stay
            links = freeze(links.union(fresh))
            grouped = freeze(components(links))

    placed_members = members.join(grouped, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    placed_members = placed_members.groupBy("doc_id").agg(F.min("component").alias("component"))
    result = sets.select("doc_id", "n_shingles").join(placed_members, "doc_id", "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(df: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with one document of each component, that of the smallest id; rows without an id stay."""
    found = near_duplicates(df, k, percent)
    others = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    repeated = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id")
    kept = df.join(others, "doc_id", "left_anti").select(*df.columns)
    if repeated.isEmpty():
        return kept
    # Rows that repeat an id are a group of their own; the one with the first text stays.
    once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(F.col("text").alias("_text"), *df.columns)).alias("_row"))
    rows = once.select(*(F.col(f"_row.{c}").alias(c) for c in df.columns))
    return kept.join(repeated, "doc_id", "left_anti").select(*df.columns).unionByName(rows)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85)


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes nx ON nx.doc_id = x.doc_id JOIN sizes ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n
  HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
