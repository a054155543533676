"""Conversation structure repair by weighted CYK interval parsing.

A conversation is valid if its roles' initials match ``(s?(ua)+)?``. Rows may
be kept (K), given the role user or assistant (R), deleted (D), and rows with
empty text inserted (I); the cheapest edits win, ties go to the least audit
string (the edits' letters in order).

The repair grammar is in Chomsky normal form. Its nonterminals [p, q] say what
a span of rows does to the position in the pattern: it leads from place p to
place q. Rules: [p, q] -> [p, r] [r, q] for spans of two parts, and terminals for
one row (kept, reroled or deleted). Insertions are rules for the empty span;
their closure is computed once and put around every terminal. A cell holds the
least (cost, audit) for each nonterminal of one span, and cells are combined
bottom-up by span length: 1, 2, 4, ... rows. Every split of a span gives the
same cell, because the rules of [p, q] are complete for every r, so one split
is enough and a conversation of n rows takes n - 1 combinations instead of the
n^3 / 6 of all splits (a test holds both against each other). Among audits of
one span and equal cost none is a prefix of another (it would have fewer
insertions, so a lower cost); the least audit of a whole is therefore made of
the least audits of its parts.

On Spark: a first pass over narrow rows (no texts; 128-bit hashes decide what
repeats) gives each conversation its verdict; a second one sends the texts to
their verdict in order and streams them through the edits. Both sort inside
tasks, which may spill, and hold no texts of a conversation together: what a
task remembers is about 150 bytes per row of the conversation at hand, whose
verdict is one row with a letter for each edit anyway.

Defined cases: nulls of role and text count as one space; rows follow turn,
null first, and inside a turn role and then a hash of the text; a null
conversation id is a conversation of its own; repeated rows are duplicates; an
empty table gives an empty table; other columns may be null or bear any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import fingerprint, ship

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Places in the pattern: before it, after the system row, after a user row, after an assistant row.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
PLACES, START, ENDS = range(4), 0, (0, 3)
LEGAL = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}
# A row's fault, the first that holds.
CLEAN, CUT_SHORT, DUPLICATE, BLANK = range(4)

Cell = dict[tuple[int, int], tuple[int, str]]      # nonterminal -> least (cost, audit)
VERDICT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: the rules [p, q] -> [p, r] [r, q]."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in PLACES:
            after = right.get((r, q))
            if after is not None:
                known, total = out.get((p, q)), cost + after[0]
                if known is None or total <= known[0]:
                    found = (total, audit + after[1])
                    if known is None or found < known:
                        out[p, q] = found
    return out


def least(a: Cell, b: Cell) -> Cell:
    return {k: min(x[k] for x in (a, b) if k in x) for k in {*a, *b}}


def _closure() -> Cell:
    """The empty span: any number of insertions."""
    none: Cell = {(p, p): (0, "") for p in PLACES}
    one: Cell = {(p, q): (INSERT, "I") for c in NAMES for p, q in STEPS[c].items()}
    cell = none
    while (wider := least(none, combine(one, cell))) != cell:
        cell = wider
    return cell


EMPTY = _closure()


@lru_cache(maxsize=None)
def terminal(initial: str, fault: int) -> Cell:
    """The cell of one row, with insertions on both sides."""
    cell: Cell = {(p, p): (DELETE, "D") for p in PLACES}
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT_SHORT else 0
        edits = [(extra, "K", initial), *[(REROLE + extra, "R", c) for c in NAMES]]
        for cost, letter, c in edits:
            cell = least(cell, {(p, q): (cost, letter) for p, q in STEPS.get(c, {}).items()})
    return combine(combine(EMPTY, cell), EMPTY)


def parse(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Least (cost, audit) of rows given as (role's initial, fault)."""
    cells = [terminal(*row) for row in rows] or [EMPTY]
    while len(cells) > 1:
        pairs = [combine(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(cells) - len(cells) % 2:]
    return min(cells[0][START, q] for q in ENDS if (START, q) in cells[0])


@lru_cache(maxsize=65_536)
def _parse_short(rows: tuple[tuple[str, int], ...]) -> tuple[int, str]:
    return parse(list(rows))


class _Judge:
    """Counts and parses the rows of one conversation, given in order."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, int]] = []
        self.seen: set[tuple[int, int]] = set()
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = None

    def add(self, turn: int | None, initial: str, blank: bool, cut_short: bool, mark: tuple[int, int]) -> None:
        fault = BLANK if blank else DUPLICATE if mark in self.seen else CUT_SHORT if cut_short else CLEAN
        self.seen.add(mark)
        self.faults[fault] += 1
        if self.rows and self.rows[-1][0] + initial not in LEGAL:
            self.illegal += 1
        self.rows.append((initial, fault))
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.turns == 0 else self.first, turn, self.turns + 1

    def verdict(self) -> tuple[int, int, int, int, int, int, str]:
        cost, audit = _parse_short(tuple(self.rows)) if len(self.rows) <= 16 else parse(self.rows)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT_SHORT], self.illegal, cost, audit


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and order -> one verdict per conversation."""
    current, judge, kind = None, None, None

    def table(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found))
        return pa.record_batch([pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:-1]],
                                pa.array(columns[-1], pa.string())], names=["conv_id", *VERDICT, "audit"])

    for batch in batches:
        kind, found = batch.schema.field("conv_id").type, []
        columns = [batch.column(c).to_pylist() for c in
                   ("conv_id", "turn", "initial", "blank", "cut_short", "h1", "h2", "present")]
        for conv, turn, initial, blank, cut_short, h1, h2, present in zip(*columns):
            if judge is None or conv != current:
                if judge is not None:
                    found.append((current, *judge.verdict()))
                current, judge = conv, _Judge()
            if present:
                judge.add(turn, initial, blank, cut_short, (h1, h2))
        if found:
            yield table(found)
    if judge is not None:
        yield table([(current, *judge.verdict())])


class Editor:
    """Applies an audit to its rows, given in order; yields (letter, role, text) of what the repair holds."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.made = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2     # the pattern begins with a system row

    def _role(self) -> str:
        role = NAMES["ua"[(self.made - self.odd) % 2]]
        return role

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield "I", self._role(), ""
            self.at, self.made = self.at + 1, self.made + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            yield letter, role if letter == "K" else self._role(), text
            self.made += 1


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, int, Iterator]]:
    """Verdict and text rows in order -> (is a verdict, batch, index, what this row adds to the conversation before or at hand)."""
    editor = None
    for batch in batches:
        audits, roles, texts = (batch.column(c) for c in ("audit", "role", "text"))
        for i, is_text in enumerate(batch.column("is_text").to_pylist()):
            if is_text:
                yield 1, batch, i, editor.row(roles[i].as_py(), texts[i].as_py())
            else:
                yield 0, batch, i, editor.inserts() if editor is not None else iter(())
                editor = Editor(audits[i].as_py())
    if editor is not None:
        yield 0, None, 0, editor.inserts()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation: its verdict and the hash of the repaired lines."""
    out: list[tuple] = []
    schema, values, digest, lines = None, None, None, 0

    def table() -> pa.RecordBatch:
        columns = list(zip(*out))
        return pa.record_batch([pa.array(c, schema.field(n).type) for n, c in zip(names, columns)] +
                               [pa.array(columns[-1], pa.string())], names=[*names, "repaired_sha256"])

    names = ["conv_id", *VERDICT, "audit"]
    for is_text, batch, i, edits in _edited(batches):
        for _, role, text in edits:
            digest.update((b"\n" if lines else b"") + role.encode() + b":" + text.encode())
            lines += 1
        if not is_text:
            if digest is not None:
                out.append((*values, digest.hexdigest()))
            if batch is not None:
                schema = batch.schema
                values, digest, lines = [batch.column(n)[i].as_py() for n in names], hashlib.sha256(), 0
            if out and (batch is None or len(out) >= 10_000):
                yield table()
                out = []


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per row of the repaired conversation."""
    out: list[tuple] = []
    conv, kind, place, size = None, None, 0, 0

    def table() -> pa.RecordBatch:
        ids, places, letters, roles, texts = zip(*out)
        return pa.record_batch([pa.array(ids, kind), pa.array(places, pa.int64()), *[pa.array(c, pa.string()) for c in (letters, roles, texts)]],
                               names=["conv_id", "place", "edit", "role", "text"])

    for is_text, batch, i, edits in _edited(batches):
        for letter, role, text in edits:
            out.append((conv, place, letter, role, text))
            place, size = place + 1, size + len(text)
        if not is_text and batch is not None:
            kind, conv, place = batch.schema.field("conv_id").type, batch.column("conv_id")[i].as_py(), 0
        if out and (batch is None or len(out) >= 10_000 or size >= 4 << 20):
            yield table()
            out, size = [], 0
    if out:
        yield table()


def _ordered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    space = F.lit(" ")
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
                        (F.lit(True) if present is None else F.col(present)).alias("present"))
    h1, h2 = fingerprint("role", "text")
    return rows.withColumns({"h1": h1, "h2": h2})


def _passes(turns: DataFrame, finish: Callable, schema: str, names: tuple[str, str, str, str], present: str | None) -> DataFrame:
    ship(turns.sparkSession)
    rows = _ordered(turns, *names, present)
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["turn", "role", "h1", "h2"]          # nulls first
    marks = rows.select(
        "conv_id", *order, "present", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")).alias("cut_short"))
    verdicts = marks.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(
        _judged, f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in VERDICT) + ", audit string")
    texts = rows.where("present").select("conv_id", *order, "text", F.lit(True).alias("is_text"))
    both = verdicts.withColumn("is_text", F.lit(False)).unionByName(texts, allowMissingColumns=True)
    placed = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_text", *order)
    return placed.mapInArrow(finish, f"conv_id {kind}, {schema}")


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows whose boolean column ``present`` is false only say that their
    conversation exists.
    """
    schema = ", ".join(f"{c} bigint" for c in VERDICT) + ", audit string, repaired_sha256 string"
    return _passes(turns, _digests, schema, (conv_id, turn, role, text), present)


def repaired_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", present: str | None = None) -> DataFrame:
    """The repaired conversations: one row (conv_id, place, edit, role, text) per row they hold."""
    return _passes(turns, _lines, "place bigint, edit string, role string, text string", (conv_id, turn, role, text), present)


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with faults planted by a hash of conv_id and turn.

    Of 20 residues, 0 drops the row (``present`` becomes false), 1 empties its
    text, 2 removes its ends of sentences, 3 repeats it, 4 sets its role to user.
    """
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(True), F.when(F.col("fate") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("fate") != 0).alias("present"),
                       F.explode(copies).alias("__copy")).drop("__copy")
