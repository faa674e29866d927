"""Operator 13: repair of the structure of conversations by a suffix-shared automaton.

A conversation's signature has one symbol per row: the role's initial and the row's fault. What the cheapest edits from a row on
cost depends only on the rest of the signature and on the state of the grammar ``(s?(ua)+)?`` in which the row is met. All
signatures are read from their ends, in sorted order: two neighbours share the nodes of their common ending, so every distinct
ending is one node of an acyclic automaton, and its cost to go and its first best edit are computed once for each grammar
state, for all conversations that end so. The best edits of an ending are its first edit and those of the node that follows,
which is why a node holds one letter and one successor per state instead of a string.

What travels: rows are dealt out by conv_id and sorted within a task, and read as a stream, once to make the signatures and
once, behind the conversation's audit, to hash what is left; no conversation is ever gathered, except for its signature and
audit of one letter a row and the digests by which repeated rows are found (16 bytes a row). Signatures are range-partitioned by their reverse and conv_id, so that
a signature shared by many conversations is spread over tasks; an ending that lies in two ranges is a node in both.

Defined results: nulls in any column read as one space: a null text is blank, a null role is none of the known, a null conv_id
is a conversation of its own, also in the key of the damage, where a null turn is a space too; turns that are null come first and do not count for gaps; rows of
one turn are taken by role and text; repeated rows are duplicates; conversations of which no row is left have zeros, an empty
audit and the hash of nothing; an empty table gives an empty result; other columns are ignored, whatever their names.
Texts are compared by 128-bit digests of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.llm.runtime import ready, slices, table, to_batches
from ranktide.session import freeze

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
DAMAGES = 20

# Symbols of a signature: the role's initial, in capitals if the row is truncated; "o" for other roles; "x" must go.
MUST_GO = "x"
ROLES = {"s": "system", "u": "user", "a": "assistant"}
# Grammar states, and where the initials lead: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ENDS = (START, ASSISTANT)
# The one role that can be given to a row or put in at a state, as reroled and inserted rows are never of the system.
GIVEN = ("u", "u", "a", "u")
LEGAL = {"su", "ua", "au"}

SIGNED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, reverse string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
HELD_ROWS = 500


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _edits(symbol: str, state: int, after: list[tuple]) -> Iterator[tuple[int, str, int]]:
    """Cost, letter and next state of every edit of a row, ``after`` being what follows."""
    yield DELETE + after[state][0], "D", state
    if symbol == MUST_GO:
        return
    extra = TRUNCATED if symbol.isupper() else 0
    onward = STEP[state].get(symbol.lower())
    if onward is not None:
        yield KEEP + extra + after[onward][0], "K", onward
    onward = STEP[state][GIVEN[state]]
    yield REROLE + extra + after[onward][0], "R", onward


def node(symbol: str | None, after: list[tuple] | None) -> list[tuple]:
    """For each grammar state: cost to go, letter of the first best edit, state behind it, and whether it takes the row.

    ``symbol`` is None at the end of a conversation. Of equally cheap edits the first letter decides, since each letter leads to one
    state only: the least first letter and the best rest make the least string.
    """
    found: list[tuple | None] = [None] * 4
    for state in range(4):
        if symbol is None:
            found[state] = (0, "", state, False) if state in ENDS else None
        else:
            found[state] = min((cost, letter, onward, True) for cost, letter, onward in _edits(symbol, state, after))
    # Insertions stay at the row; two rounds reach every state, and more would come back to a state at a cost.
    for _ in range(3):
        for state in range(4):
            onward = STEP[state][GIVEN[state]]
            if found[onward] is not None:
                inserted = (INSERT + found[onward][0], "I", onward, False)
                if found[state] is None or inserted[:2] < found[state][:2]:
                    found[state] = inserted
    return found


class Endings:
    """The nodes of the endings of one signature after another; what two neighbours share is not computed again."""

    def __init__(self) -> None:
        self.reverse = ""
        self.nodes = [node(None, None)]
        self.made = 0

    def solve(self, reverse: str) -> tuple[int, str]:
        """Cost and audit of a signature that is given from its end."""
        shared, most = 0, min(len(reverse), len(self.reverse))
        while shared < most and reverse[shared] == self.reverse[shared]:
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in reverse[shared:]:
            self.nodes.append(node(symbol, self.nodes[-1]))
            self.made += 1
        self.reverse = reverse
        at, state, audit = len(reverse), START, []
        while True:
            _, letter, onward, takes = self.nodes[at][state]
            if not letter:
                return self.nodes[-1][START][0], "".join(audit)
            audit.append(letter)
            at, state = at - takes, onward


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(df: DataFrame) -> DataFrame:
    """The rows after damage, and with ``left`` false the dropped ones, by which their conversations are remembered."""
    hashed = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % DAMAGES
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _text("role").alias("was"),
        _text("text").alias("of"),
        hashed.alias("damage"),
    )
    text = F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.translate("of", ".!?", "")).otherwise(F.col("of"))
    copies = F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select(
        "conv_id", "turn", "was", "of", (F.col("damage") != 0).alias("left"),
        F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("was")).alias("role"),
        text.alias("text"), copies,
    )


# Rows of a conversation in their order; a conversation's audit, where there is one, comes before its rows.
IN_ORDER = ("turn", "was", "of", "copy")  # null turns first


class Conversation:
    """Counts and signature of one conversation, row by row."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.symbols, self.seen = conv_id, [], set()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.initial = self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, end: str, digest: bytes) -> None:
        """A row by its turn, role, last character that is no white space (empty if blank), and digest."""
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.faults["illegal"] += 1
        self.initial = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        symbol = initial if initial in ROLES else "o"
        if not end:
            self.faults["blank"] += 1
            symbol = MUST_GO
        elif digest in self.seen:
            self.faults["duplicate"] += 1
            symbol = MUST_GO
        elif end not in ".!?":
            self.faults["truncated"] += 1
            symbol = symbol.upper()
        self.seen.add(digest)
        self.symbols.append(symbol)

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults.values(), "".join(reversed(self.symbols)))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= HELD_ROWS:
            yield to_batches(dict(zip(schema.names, zip(*held, strict=True), strict=True)), schema)
            held = []
    if held:
        yield to_batches(dict(zip(schema.names, zip(*held, strict=True), strict=True)), schema)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def conversations() -> Iterator[tuple]:
        current = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "end", "digest", "left"))
            for conv_id, turn, role, end, digest, left in zip(*columns, strict=True):
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        yield current.row()
                    current = Conversation(conv_id)
                if left:
                    current.add(turn, role, end, digest)
        if current is not None:
            yield current.row()

    yield from _batches(conversations(), _schema(SIGNED))


def signatures(rows: DataFrame) -> DataFrame:
    """One row per conversation: its counts, and its signature from the end as ``reverse``."""
    end = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    dealt = rows.withColumns({"end": end, "digest": F.unhex(F.md5(F.concat("role", F.lit("\0"), "text").cast("binary")))})
    dealt = dealt.select("conv_id", "turn", "was", "of", "copy", "role", "end", "digest", "left")
    dealt = dealt.repartition("conv_id").sortWithinPartitions("conv_id", *IN_ORDER)
    return dealt.select("conv_id", "turn", "role", "end", "digest", "left").mapInArrow(_sign, schema=SIGNED)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema(AUDITED)
    endings = Endings()
    for batch in batches:
        solved = [endings.solve(reverse) for reverse in batch.column("reverse").to_pylist()]
        columns = {name: batch.column(name) for name in ("conv_id", *COUNTS)}
        yield to_batches(columns | {"cost": [c for c, _ in solved], "audit": [a for _, a in solved]}, schema)


AUDITED = SIGNED.replace("reverse string", "cost long, audit string")


def audits(signed: DataFrame) -> DataFrame:
    """Cost and audit of every conversation, with its counts."""
    order = [F.col("reverse"), F.col("conv_id")]
    return signed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_solve, schema=AUDITED)


class Repair:
    """The hash of what the edits of an audit leave of a conversation, row by row."""

    def __init__(self, row: tuple) -> None:
        self.row, self.audit, self.at, self.state = row, row[-1], 0, START
        self.digest, self.empty = hashlib.sha256(), True

    def _put(self, role: str, initial: str, text: str) -> None:
        self.digest.update((("" if self.empty else "\n") + f"{role}:{text}").encode())
        self.empty, self.state = False, STEP[self.state][initial]

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            given = GIVEN[self.state]
            self._put(ROLES[given], given, "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, role[:1], text)
        elif edit == "R":
            given = GIVEN[self.state]
            self._put(ROLES[given], given, text)

    def result(self) -> tuple:
        self._insert()
        return (*self.row, self.digest.hexdigest())


REPAIRED = AUDITED + ", repaired_sha256 string"


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _schema(AUDITED)]

    def conversations() -> Iterator[tuple]:
        current = None
        for batch in slices(batches):
            columns = [batch.column(c).to_pylist() for c in (*names, "role", "text")]
            for *row, role, text in zip(*columns, strict=True):
                if row[-1] is not None:
                    if current is not None:
                        yield current.result()
                    current = Repair(tuple(row))
                else:
                    current.add(role, text)
        if current is not None:
            yield current.result()

    yield from _batches(conversations(), _schema(REPAIRED))


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with the hash of every conversation after its edits."""
    nothing = {name: F.lit(None).cast(kind).alias(name) for name, kind in audited.dtypes}
    heads = audited.select(
        "*", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        *(F.lit(None).cast("string").alias(c) for c in ("was", "of")), F.lit(0).alias("copy"),
        *(F.lit(None).cast("string").alias(c) for c in ("role", "text")),
    )
    bodies = rows.where("left").select(
        "conv_id", *(nothing[name] for name in audited.columns if name != "conv_id"), F.lit(1).alias("kind"), "turn", "was", "of", "copy", "role", "text"
    )
    dealt = heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *IN_ORDER)
    return dealt.select(*audited.columns, "role", "text").mapInArrow(_repair, schema=REPAIRED)


def repair_conversations(df: DataFrame) -> DataFrame:
    """One row per conv_id of ``df``: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256."""
    ready(df.sparkSession)
    rows = damaged(df)
    # Both are written once: range bounds are sampled from the first, and the second is met with rows by position.
    signed = freeze(signatures(rows))
    audited = freeze(audits(signed))
    return repaired(rows, audited).select(
        "conv_id", *COUNTS, "cost", "audit", "repaired_sha256"
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))
