"""Conversations repaired at least cost by generalised LR parsing; see ``grammar`` for the parser.

Rows are range-sorted by (conversation, turn with null first, role, SHA-256 of role and text, place
in the input), so one conversation may lie in many tasks. A task reads its rows as a stream.
A conversation that begins and ends inside a task is parsed and written there. The others, and those
beyond PIECE bytes, become pieces: the tops that each possible stack leads to, a few numbers, and the
rows. The numbers of a conversation are joined in order, which gives each piece the stack it starts
and ends with; pieces are then parsed again by themselves, and one stream per conversation takes the
SHA-256 of what they become. So no task holds more rows than a piece, however long the conversation.

Faults: the first of blank (nothing but white space), duplicate (role and text seen earlier in the
conversation), truncated (does not end in one of ``.!?``). Which rows are duplicates is found by an
aggregate over digests; their places join the sort as rows of their own.

Nulls: a null role or text counts as one space, a null turn comes first, a null conversation id is a
conversation of its own. Empty and very long texts are rows like others. Ties: rows of one turn go by
role, then by digest. Repeated rows are duplicates. An empty table gives no rows. Only the four
columns are read, so further ones cannot clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.grammar import Parser
from cohortloom.llm.staging import stage

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
# Bytes of text after which a conversation goes on in another piece.
PIECE = 4 << 20
# Whole conversations that are handed back together.
TOGETHER = 2000
# What a row of the sort stands for: its conversation alone, the mark of the duplicate that follows, itself.
NAME, DUPLICATE, ROW = 0, 1, 2

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = "conv {}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"

_parser = Parser()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, present: rows as crc32(`conv_id:turn`) % 20 damages them.

    0 takes a row away (``present`` is false), 1 empties its text, 2 removes its sentence ends,
    3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    name = F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space)
    )
    case = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(case == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (case != 0).alias("present"),
        F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


class _Unit:
    """Rows of a conversation as one task sees them."""

    def __init__(self, conv, piece: int = 0, head: bool = False):
        self.conv, self.piece, self.head = conv, piece, head
        self.symbols: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.bytes = self.illegal = self.distinct = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.turns: tuple | None = None

    def add(self, turn, role: str, text: str, duplicate: bool) -> None:
        initial = role[:1]
        fault, mark = None, ""
        content = text.rstrip(SPACE)
        if not content:
            fault, mark = "blank", "!"
        elif duplicate:
            fault, mark = "duplicate", "!"
        elif content[-1] not in ENDS:
            fault, mark = "truncated", "~"
        if fault:
            self.faults[fault] += 1
        if self.roles:
            self.illegal += self.roles[-1][:1] + initial not in LEGAL
        if turn is not None:
            if self.turns is None:
                self.turns, self.distinct = (turn, turn), 1
            elif turn != self.turns[1]:
                self.turns, self.distinct = (self.turns[0], turn), self.distinct + 1
        self.symbols.append((initial if initial in ("s", "u", "a") else "x") + mark)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text) + 16

    def counts(self) -> dict:
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return {"gaps": gaps, **self.faults, "illegal": self.illegal}


def _lines(unit_roles, unit_texts, edits) -> Iterator[str]:
    """The rows that edits make of rows."""
    for role, text, row in zip(unit_roles, unit_texts, edits):
        for letter, symbol in row:
            if letter == "K":
                yield f"{role}:{text}"
            elif letter == "R":
                yield f"{NAMES[symbol]}:{text}"
            elif letter == "I":
                yield f"{NAMES[symbol]}:"


def _inserted(edits) -> list[str]:
    return [f"{NAMES[symbol]}:" for _, symbol in edits]


def _letters(edits: Iterable) -> str:
    return "".join(letter for row in edits for letter, _ in row)


def _whole(unit: _Unit) -> dict:
    """The result of a conversation that lies in one unit."""
    frontier, cost, back = _parser.run(unit.symbols)
    more, place, last = _parser.accept(frontier)
    edits = _parser.edits(back, place)
    lines = [*_lines(unit.roles, unit.texts, edits), *_inserted(last)]
    return {
        "conv": unit.conv, **unit.counts(), "cost": cost + more, "audit": _letters([*edits, last]),
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


PIECES = (
    RESULT + ", open boolean, unit long, summary string, first_initial string, last_initial string, n long,"
    " first_turn long, last_turn long, turns long, symbols string, roles array<string>, texts array<string>"
)


def _piece(unit: _Unit, task: int) -> dict:
    return {
        "conv": unit.conv, **unit.faults, "illegal": unit.illegal, "open": True, "unit": (task << 32) + unit.piece,
        "summary": json.dumps(_parser.summary(unit.symbols)), "n": len(unit.roles),
        "first_initial": unit.roles[0][:1] if unit.roles else None,
        "last_initial": unit.roles[-1][:1] if unit.roles else None,
        "first_turn": unit.turns and unit.turns[0], "last_turn": unit.turns and unit.turns[1], "turns": unit.distinct,
        "symbols": " ".join(unit.symbols), "roles": unit.roles, "texts": unit.texts,
    }


def _units(schema: pa.Schema, limit: int):
    """Results of whole conversations and pieces of the others, from sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, unit, pieces, duplicate, out = TaskContext.get().partitionId(), None, 0, False, []

        def handed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema)
            out.clear()
            return made

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "kind"))
            for conv, turn, role, text, kind in zip(*columns):
                if unit is None:
                    unit = _Unit(conv, head=True)
                elif conv != unit.conv:
                    if unit.head:
                        pieces += 1
                        out.append(_piece(unit, task))
                    else:
                        out.append(_whole(unit) | {"open": False})
                    unit = _Unit(conv, pieces)
                elif unit.bytes > limit:
                    pieces += 1
                    out.append(_piece(unit, task))
                    yield handed()
                    unit = _Unit(conv, pieces, head=True)
                if kind == ROW:
                    unit.add(turn, role, text, duplicate)
                duplicate = kind == DUPLICATE
                if len(out) >= TOGETHER:
                    yield handed()
        if unit is not None:
            out.append(_piece(unit, task))
            yield handed()

    return run


DECIDED = RESULT + ", unit long, begin int, finish int, last string"


def _decide(schema: pa.Schema):
    """First and last stack of every piece, and the conversation's numbers with its last piece."""

    def closed(pieces: list[dict], back: list, frontier, cost: int, totals: dict) -> list[dict]:
        more, place, last = _parser.accept(frontier)
        begins, rows = 0, []
        ends = []
        for links in reversed(back):
            place, end = links[place]
            ends.append(end)
        for piece, end in zip(pieces, reversed(ends)):
            rows.append({**piece, "begin": begins, "finish": end})
            begins = end
        low, high, distinct = totals.pop("low"), totals.pop("high"), totals.pop("distinct")
        totals.pop("initial")
        gaps = 0 if low is None else high - low + 1 - distinct
        rows[-1] |= {**totals, "gaps": gaps, "cost": cost + more, "last": "".join(symbol for _, symbol in last)}
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, pieces, back, frontier, cost, totals = None, [], [], ((0, 0),), 0, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if pieces and row["conv"] != conv:
                    out += closed(pieces, back, frontier, cost, totals)
                    pieces = []
                if not pieces:
                    conv, back, frontier, cost = row["conv"], [], ((0, 0),), 0
                    totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0)
                    totals |= {"low": None, "high": None, "initial": None}
                summary = [[tuple(x) for x in tops] for tops in json.loads(row["summary"])]
                frontier, more, links = _parser.join(frontier, summary)
                cost += more
                back.append(links)
                pieces.append({"conv": conv, "unit": row["unit"]})
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    totals[name] += row[name]
                if row["n"]:
                    if totals["initial"] is not None:
                        totals["illegal"] += totals["initial"] + row["first_initial"] not in LEGAL
                    totals["initial"] = row["last_initial"]
                if row["turns"]:
                    totals["distinct"] += row["turns"] - (row["first_turn"] == totals["high"])
                    totals["low"] = row["first_turn"] if totals["low"] is None else totals["low"]
                    totals["high"] = row["last_turn"]
            yield pa.RecordBatch.from_pylist(out, schema)
        if pieces:
            yield pa.RecordBatch.from_pylist(closed(pieces, back, frontier, cost, totals), schema)

    return run


REPAIRED = RESULT + ", unit long, lines long, repaired binary, final boolean"


def _repair(schema: pa.Schema):
    """Audit and text of every piece between its two stacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                frontier, _, back = _parser.run(row["symbols"].split(), row["begin"])
                edits = _parser.edits(back, [stack for stack, _ in frontier].index(row["finish"]))
                last = [("I", x) for x in row["last"] or ""]
                lines = [*_lines(row["roles"], row["texts"], edits), *_inserted(last)]
                made = {name: row[name] for name in ("conv", "unit", *COUNTS)}
                made |= {
                    "audit": _letters([*edits, last]), "lines": len(lines), "repaired": "\n".join(lines).encode(),
                    "final": row["last"] is not None,
                }
                yield pa.RecordBatch.from_pylist([made], schema)

    return run


def _digest(schema: pa.Schema):
    """One result per conversation from the stream of its repaired pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, audit, begun = hashlib.sha256(), [], False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["lines"]:
                    digest.update((b"\n" if begun else b"") + row["repaired"])
                    begun = True
                audit.append(row["audit"])
                if row["final"]:
                    made = {name: row[name] for name in ("conv", *COUNTS)}
                    out.append(made | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                    digest, audit, begun = hashlib.sha256(), [], False
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _arrow(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    """A schema in both forms; conversation ids keep their type."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ddl = ddl.format(dict(df.dtypes)["conv"])
    return ddl, to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)


def _sorted(rows: DataFrame) -> DataFrame:
    """All rows in order, with the marks of duplicates and the names of conversations without rows."""
    subject = F.concat_ws(":", F.length("role"), "role", "text")
    rows = rows.select(
        "conv", "turn", "role", "text", F.unhex(F.sha2(subject, 256)).alias("digest"),
        F.monotonically_increasing_id().alias("at"), F.when(F.col("present"), ROW).otherwise(NAME).alias("kind"),
    )
    keys = ["conv", "turn", "role", "digest", "at"]
    narrow = rows.where(F.col("kind") == ROW).select(*keys)
    several = narrow.groupBy("conv", "digest").agg(
        F.min(F.struct("turn", "at")).alias("first"), F.count("*").alias("n")
    )
    several = several.where("n > 1").select(
        F.col("conv").alias("_conv"), F.col("digest").alias("_digest"), F.col("first.at").alias("_at")
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    marks = narrow.join(several, same).where(F.col("at") != F.col("_at"))
    marks = marks.select(*keys, F.lit(None).cast("string").alias("text"), F.lit(DUPLICATE).alias("kind"))
    text = F.when(F.col("kind") == ROW, F.col("text")).alias("text")
    stream = rows.select(*keys, text, "kind").unionByName(marks)
    return stream.repartitionByRange(*keys).sortWithinPartitions(*keys, "kind").drop("digest", "at")


def _streamed(df: DataFrame) -> DataFrame:
    """All rows of a conversation in one task, in the order of its units."""
    return df.repartition("conv").sortWithinPartitions("conv", "unit")


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Result per conversation of ``rows`` (conv, turn, role, text, present).

    A row that is not ``present`` only says that its conversation exists.
    """
    ddl, arrow = _arrow(rows, PIECES)
    units = stage(_sorted(rows).mapInArrow(_units(arrow, piece), ddl), "units")
    names = [f.name for f in _arrow(rows, RESULT)[1]]
    open_ = units.where("open")
    ddl, arrow = _arrow(rows, DECIDED)
    decided = _streamed(open_.drop("symbols", "roles", "texts")).mapInArrow(_decide(arrow), ddl)
    decided = stage(decided, "decided").drop("audit", "repaired_sha256")
    ddl, arrow = _arrow(rows, REPAIRED)
    held = open_.select("unit", "symbols", "roles", "texts").join(decided, "unit")
    repaired = stage(held.mapInArrow(_repair(arrow), ddl), "repaired")
    ddl, arrow = _arrow(rows, RESULT)
    joined = _streamed(repaired).mapInArrow(_digest(arrow), ddl)
    return units.where("NOT open").select(*names).unionByName(joined)
