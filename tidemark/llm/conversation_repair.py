"""Repair of the turn structure of conversations, as a lightest derivation.

A conversation is repaired by edits (keep, re-role, delete, insert) so that its roles
read as an optional system turn and then user and assistant in turn. A repair item says
that the rows so far are edited and which role came last; deductions lead from it to the
next items by one edit each. Values are pairs (cost, audit), the audit being the edits'
initials; every deduction's function is monotone and never gives less than its
antecedent, as an edit only adds to both. So Knuth's algorithm applies: the agenda pops
the least value, which is final for its item, until the goal item is popped. (Of two
audits of one item and cost neither begins with the other: both hold a letter for every
row, and a longer one would have paid for an insertion.)

A long conversation is spread over tasks: rows are range-partitioned in order, each task
derives the items of its piece from every role the piece may begin after, and the items
of pieces are antecedents of the items of the whole. Only hashing the repaired text,
which SHA-256 does byte after byte, passes a conversation through one task, as a stream.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructType

from tidemark.llm.scans import in_order
from tidemark.llm.workspace import materialize

Value = tuple[int, str]
#: The role that came last: none, system, user, assistant. Repaired conversations end in the first or the last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NONE, SYSTEM, USER, ASSISTANT)
GOALS = (NONE, ASSISTANT)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: Rows whose items one agenda derives, and tables of items that one agenda joins.
SEGMENT_ROWS, JOINED = 256, 16
BLANK_FAULT, DUPLICATE_FAULT, TRUNCATED_FAULT = 1, 2, 3


def lightest(axioms: Iterable[tuple[Hashable, Value]], deductions: Callable[[Hashable, Value], Iterable[tuple[Hashable, Value]]], goal: Hashable = None) -> dict[Hashable, Value]:
    """Least values of the items that can be derived, up to ``goal`` if it is given.

    ``deductions`` lists, for an item just finalised, the consequents whose antecedents
    are then all final, with their values.
    """
    agenda = [(value, item) for item, value in axioms]
    heapq.heapify(agenda)
    final: dict[Hashable, Value] = {}
    while agenda:
        value, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value
        if item == goal:
            break
        for consequent, new in deductions(item, value):
            if consequent not in final:
                heapq.heappush(agenda, (new, consequent))
    return final


def _spoken(last: int, symbol: str) -> list[tuple[int, int, str]]:
    """(role then last, cost, letter) of the edits that leave the row in."""
    extra = TRUNCATED if symbol.isupper() else 0
    after = ASSISTANT if last == USER else USER
    out = [(after, REROLE + extra, "R")]
    kept = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(symbol.lower())
    if kept == after or (kept == SYSTEM and last == NONE):
        out.append((kept, extra, "K"))
    return out


@lru_cache(1 << 16)
def _segment(rows: str, last: int) -> tuple[tuple[int, Value], ...]:
    """Least value for each role that may come last, from one that came last before the rows.

    A row is the initial of its role (o for others), upper case if truncated; x must go.
    """

    def deductions(item, value):
        (at, role), (cost, audit) = item, value
        yield (at, ASSISTANT if role == USER else USER), (cost + INSERT, audit + "I")
        if at < len(rows):
            yield (at + 1, role), (cost + DELETE, audit + "D")
            if rows[at] != "x":
                for then, price, letter in _spoken(role, rows[at]):
                    yield (at + 1, then), (cost + price, audit + letter)

    found = lightest([((0, last), (0, ""))], deductions)
    return tuple((role, found[len(rows), role]) for role in STATES if (len(rows), role) in found)


Items = dict[int, dict[int, Value]]


def _joined(tables: list[Items], last: int, goal: bool = False) -> dict[int, Value]:
    """Items of several pieces in a row: one of the whole so far and one of the next piece give the next.

    With ``goal`` only the least value of a repaired conversation, under NONE.
    """
    end = (len(tables) + 1, NONE) if goal else None

    def deductions(item, value):
        at, role = item
        if at < len(tables):
            for then, (cost, audit) in tables[at].get(role, {}).items():
                yield (at + 1, then), (value[0] + cost, value[1] + audit)
        elif goal and role in GOALS:
            yield end, value

    found = lightest([((0, last), (0, ""))], deductions, end)
    if goal:
        return {NONE: found[end]}
    return {role: found[len(tables), role] for role in STATES if (len(tables), role) in found}


def fold(tables: list[Items], starts: Iterable[int]) -> Items:
    """The items of pieces in a row, as those of one piece; joined like a tree, so that audits are copied few times."""
    while len(tables) > 1:
        tables = [{s: _joined(tables[i : i + JOINED], s) for s in (starts if i == 0 else STATES)} for i in range(0, len(tables), JOINED)]
    return tables[0]


def items_of(rows: str, starts: Iterable[int]) -> Items:
    """Items of the rows of a piece, from each role in ``starts``."""
    cuts = range(0, max(len(rows), 1), SEGMENT_ROWS)
    tables = [{s: dict(_segment(rows[i : i + SEGMENT_ROWS], s)) for s in (starts if i == 0 else STATES)} for i in cuts]
    return fold(tables, starts)


def cheapest(tables: list[Items]) -> Value:
    """Cost and audit of the best repair of the pieces in a row."""
    return _joined([fold(tables, (NONE,))], NONE, goal=True)[NONE] if tables else (0, "")


def damaged(conversations: DataFrame) -> DataFrame:
    """(name, conv_id, turn, role, text, gone) after the damage; a dropped row stays, marked as gone."""
    plain = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    code = F.crc32(F.concat(plain["conv_id"], F.lit(":"), plain["turn"]).cast("binary")) % 20
    rows = conversations.select(plain["conv_id"].alias("name"), "conv_id", "turn", code.alias("code"), plain["role"].alias("role"), plain["text"].alias("text"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("name", "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("code") == 0).alias("gone"), times.alias("copy")).drop("copy")


def _digest() -> Column:
    return F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)


def _order() -> list[Column]:
    return [F.col("name"), F.col("turn").asc_nulls_first(), F.col("digest")]


def _rows(damage: DataFrame) -> DataFrame:
    """(name, block, pos, conv_id, turn, symbol, initial, fault) of all rows, in order of pos; the symbol of gone rows is null."""
    spoken = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    facts = damage.select(
        "name", "conv_id", "turn", "gone", _digest().alias("digest"), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (spoken == "").alias("blank"), (~F.substring(spoken, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    placed = in_order(facts, _order(), "repair-rows")
    seen = placed.filter("not gone and not blank").groupBy("name", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("fresh"))
    fault = F.when(F.col("blank"), BLANK_FAULT).when(F.col("fresh").isNull(), DUPLICATE_FAULT).when(F.col("truncated"), TRUNCATED_FAULT).otherwise(0)
    marked = placed.join(seen, "pos", "left").withColumn("fault", fault)
    symbol = F.when(F.col("fault").isin(BLANK_FAULT, DUPLICATE_FAULT), "x").when(F.col("fault") == TRUNCATED_FAULT, F.upper("initial")).otherwise(F.col("initial"))
    return marked.select("name", F.shiftright("pos", 33).alias("block"), "pos", "conv_id", "turn", F.when(~F.col("gone"), symbol).alias("symbol"), "initial", "fault")


COUNTS = ["blank", "duplicate", "truncated", "illegal"]
PIECE = "name string, block bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, turns bigint, items array<struct<start:int,last:int,cost:bigint,audit:string>>"
LEGAL = {"su", "ua", "au"}


class _Piece:
    """Counts and row symbols of the rows of one conversation in one block."""

    def __init__(self, name: str, block: int, pos: int, conv_id):
        self.name, self.block, self.conv_id = name, block, conv_id
        # Only the first conversation of a block can have begun in the one before.
        self.starts = STATES if pos & ((1 << 33) - 1) == 0 else (NONE,)
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None
        self.rows: list[str] = []

    def add(self, turn, symbol: str, initial: str, fault: int) -> None:
        self.rows.append(symbol)
        self.faults[fault] += 1
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def row(self) -> tuple:
        items = [
            {"start": start, "last": last, "cost": cost, "audit": audit}
            for start, found in items_of("".join(self.rows), self.starts).items() for last, (cost, audit) in found.items()
        ]
        return (self.name, self.block, self.conv_id, *self.faults[1:], self.illegal, self.first, self.last, self.low, self.high, self.turns, items)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), field.type) for c, field in zip(zip(*rows), schema)], schema=schema)


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    piece: _Piece | None = None
    for batch in batches:
        out = []
        columns = (batch.column(n).to_pylist() for n in ("name", "block", "pos", "conv_id", "turn", "symbol", "initial", "fault"))
        for name, block, pos, conv_id, turn, symbol, initial, fault in zip(*columns):
            if piece is None or (piece.name, piece.block) != (name, block):
                if piece:
                    out.append(piece.row())
                piece = _Piece(name, block, pos, conv_id)
            if symbol is not None:
                piece.add(turn, symbol, initial, fault)
        if out:
            yield _record(out, schema)
    if piece:
        yield _record([piece.row()], schema)


def _decided(name: str, pieces: list[dict]) -> tuple:
    """Counts, cost and audit of a conversation from its pieces in order."""
    some = [p for p in pieces if p["first"] is not None]
    counts = [sum(p[c] for p in some) for c in COUNTS]
    counts[3] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(some, some[1:]))
    timed = [p for p in some if p["turns"]]
    turns = sum(p["turns"] for p in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
    gaps = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
    tables = []
    for piece in some:
        table: Items = {}
        for item in piece["items"]:
            table.setdefault(item["start"], {})[item["last"]] = (item["cost"], item["audit"])
        tables.append(table)
    cost, audit = cheapest(tables)
    return (name, pieces[0]["conv_id"], gaps, *counts, cost, audit)


def _decisions(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for batch in batches:
        out = []
        for piece in batch.to_pylist():
            if held and held[0]["name"] != piece["name"]:
                out.append(_decided(held[0]["name"], held))
                held = []
            held.append(piece)
        if out:
            yield _record(out, schema)
    if held:
        yield _record([_decided(held[0]["name"], held)], schema)


class Repaired:
    """SHA-256 of a repaired conversation, fed with its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last, self.begun, self.digest = audit, 0, NONE, False, hashlib.sha256()

    def _say(self, role: str | None, text: str) -> None:
        after = ASSISTANT if self.last == USER else USER
        if role is None:
            role = "assistant" if after == ASSISTANT else "user"
        elif self.last == NONE and role[:1] == "s":
            after = SYSTEM
        self.digest.update((("\n" if self.begun else "") + f"{role}:{text}").encode())
        self.last, self.begun = after, True

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._say(None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._say(role if edit == "K" else None, text)

    def hex(self) -> str:
        self._insert()
        return self.digest.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch], names: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each conversation's decision comes first, then its rows."""
    known, repaired = None, None
    for batch in batches:
        out = []
        for decision, role, text in zip(*(batch.column(n).to_pylist() for n in ("decision", "role", "text"))):
            if decision is not None:
                if repaired:
                    out.append((*known, repaired.hex()))
                known, repaired = [decision[n] for n in names], Repaired(decision["audit"])
            else:
                repaired.row(role, text)
        if out:
            yield _record(out, schema)
    if repaired:
        yield _record([(*known, repaired.hex())], schema)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``conversations`` has conv_id, turn, role and text; they are damaged as the query
    states. Other columns, whatever their names, are not looked at. Nulls count as one
    space; the rows without conv_id are one conversation. Rows of equal turn come in the
    order of a digest of their role and text; repeated rows are rows like any other, the
    later ones duplicates. Very long texts are read once to judge and once to hash them.
    An empty table gives no rows.
    """
    kind = conversations.schema["conv_id"].dataType
    damage = damaged(conversations.withColumn("turn", F.col("turn").cast("bigint")))
    rows = _rows(damage).repartition("name", "block").sortWithinPartitions("name", "block", "pos")
    piece = StructType.fromDDL(PIECE)
    piece = StructType([*piece.fields[:2], StructType().add("conv_id", kind).fields[0], *piece.fields[2:]])
    pieces = rows.mapInArrow(lambda b, s=to_arrow_schema(piece): _pieces(b, s), piece)
    decision = StructType().add("name", "string").add("conv_id", kind)
    for column in ("gaps", *COUNTS, "cost"):
        decision = decision.add(column, LongType())
    decision = decision.add("audit", "string")
    decided = pieces.repartition("name").sortWithinPartitions("name", "block").mapInArrow(lambda b, s=to_arrow_schema(decision): _decisions(b, s), decision)
    decided = materialize(decided, "repair-decisions")

    texts = damage.filter("not gone").select("name", F.lit(None).cast(decision).alias("decision"), "turn", _digest().alias("digest"), "role", "text")
    empty = F.lit(None).cast("string")
    first = decided.select("name", F.struct(*decided.columns).alias("decision"), F.lit(None).cast("bigint").alias("turn"), empty.alias("digest"), empty.alias("role"), empty.alias("text"))
    met = first.unionByName(texts).repartition("name").sortWithinPartitions("name", F.col("decision").isNull(), F.col("turn").asc_nulls_first(), "digest")
    names = decision.names[1:]
    out = StructType([*decision.fields[1:], *StructType().add("repaired_sha256", "string").fields])
    return met.select("decision", "role", "text").mapInArrow(lambda b, s=to_arrow_schema(out): _hashed(b, names, s), out)
