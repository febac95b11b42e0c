"""Conversation structure repair by weighted CYK parsing of edits.

A repaired conversation reads `(s?(ua)+)?` in the initials of its roles. The repair grammar is in Chomsky
normal form: a nonterminal stands for a way through that pattern from one place to another, derives two
nonterminals that meet at a place, or one row under an edit (keep, rerole, delete). A cell holds, for
each nonterminal over a span of rows, the least (cost, audit); rows' cells are closed under insertions
before and after the row. Cells are combined bottom-up by span length over all splits, in spans of up to
`SPAN` parts: rows first, then spans of rows, and so on, so that work grows with the rows. Two audits of
one span and one cost are never a prefix of each other (what the longer had more would be
paid insertions), so the least audit of a whole has the least audits of its parts.

A conversation may own most rows. Rows are dealt out by ranges of their order, each task parses its part
of a conversation to one cell, and the few cells of a conversation meet afterwards. Only the digest of the
repaired text, which is sequential by nature, is made by one task a conversation, in a stream.

Defined cases: a null role or text is one space; a null conv_id is a conversation of its own. Rows go by
turn, null first; rows of one turn go by role, then by the SHA-256 of conversation, role and text, so equal
rows stand together. A row whose role starts with none of s, u, a (or is empty) can't be kept. No rows after
damage give zeros, an empty audit and the digest of the empty text. An empty table gives an empty result.
Further columns don't matter.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import counted_join
from shelfline.session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPAN = 12
SPACES = " \t\n\x0b\x0c\r"

# Places in the pattern: at its start, behind the system row, behind a user row, behind an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
PAIRS = [(p, q) for p in range(4) for q in range(4) if p <= q or (p, q) == (ASSISTANT, USER)]
_AT = {pair: i for i, pair in enumerate(PAIRS)}
#: (whole, left, right): a nonterminal and the two it derives.
RULES = [(_AT[p, q], _AT[p, r], _AT[r, q]) for p, q in PAIRS for r in range(4) if (p, r) in _AT and (r, q) in _AT]

Cell = list  # of (cost, audit) or None, by nonterminal


def _combine(best: Cell, left: Cell, right: Cell) -> None:
    """Lower `best` by what `left` and then `right` derive."""
    for whole, a, b in RULES:
        x, y = left[a], right[b]
        if x is None or y is None:
            continue
        cost, now = x[0] + y[0], best[whole]
        if now is None or cost < now[0]:
            best[whole] = (cost, x[1] + y[1])
        elif cost == now[0]:
            audit = x[1] + y[1]
            if audit < now[1]:
                best[whole] = (cost, audit)


def _insertions() -> Cell:
    """What insertions alone derive."""
    cell: Cell = [(0, "") if p == q else None for p, q in PAIRS]
    for (p, initial), q in STEPS.items():
        if initial in "ua":
            cell[_AT[p, q]] = (INSERT, "I")
    for _ in PAIRS:
        _combine(cell, list(cell), list(cell))
    return cell


INSERTIONS = _insertions()


@lru_cache(maxsize=64)
def row_cell(symbol: str) -> Cell:
    """The cell of one row, closed under insertions on both sides.

    `symbol` is the initial of its role and its fault: `b` blank, `d` duplicate, `t` truncated or `-` none.
    """
    initial, fault = symbol
    cell: Cell = [(DELETE, "D") if p == q else None for p, q in PAIRS]
    if fault not in "bd":
        more = TRUNCATED if fault == "t" else 0
        edits = [((p, q), (KEEP + more, "K")) for (p, i), q in STEPS.items() if i == initial]
        edits += [((p, q), (REROLE + more, "R")) for (p, i), q in STEPS.items() if i in "ua"]
        for pair, edit in edits:
            now = cell[_AT[pair]]
            cell[_AT[pair]] = edit if now is None else min(now, edit)
    before: Cell = [None] * len(PAIRS)
    _combine(before, INSERTIONS, cell)
    after: Cell = [None] * len(PAIRS)
    _combine(after, before, INSERTIONS)
    return after


def parse(parts: list[Cell]) -> Cell:
    """The cell of the whole span: CYK over all spans of its parts, the shorter first, at all splits."""
    table = {(i, i + 1): cell for i, cell in enumerate(parts)}
    for length in range(2, len(parts) + 1):
        for i in range(len(parts) - length + 1):
            best: Cell = [None] * len(PAIRS)
            for k in range(i + 1, i + length):
                _combine(best, table[i, k], table[k, i + length])
            table[i, i + length] = best
    return table[0, len(parts)] if parts else INSERTIONS


@lru_cache(maxsize=8192)
def _parse_rows(symbols: tuple[str, ...]) -> Cell:
    return parse([row_cell(s) for s in symbols])


class Spans:
    """Takes the rows or cells of a conversation in order and combines every `SPAN` of them to one, level by level."""

    def __init__(self) -> None:
        self.symbols: list[str] = []
        self.levels: list[list[Cell]] = []

    def add_row(self, symbol: str) -> None:
        self.symbols.append(symbol)
        if len(self.symbols) == SPAN:
            self._close_rows()

    def _close_rows(self) -> None:
        if self.symbols:
            self.add_cell(_parse_rows(tuple(self.symbols)))
            self.symbols = []

    def add_cell(self, cell: Cell, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(cell)
        if len(self.levels[level]) == SPAN:
            whole, self.levels[level] = parse(self.levels[level]), []
            self.add_cell(whole, level + 1)

    def whole(self) -> Cell:
        self._close_rows()
        last: list[Cell] = []
        for cells in self.levels:
            if cells or last:
                last = [parse(cells + last)]
        return last[0] if last else INSERTIONS


class Portion:
    """What is known of the rows of a conversation between two points of their order."""

    COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self) -> None:
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.first = self.last = self.low = self.high = None
        self.spans = Spans()

    def add(self, symbol: str, turn: int | None) -> None:
        self._follow(symbol[0], symbol[0], turn, turn, turn is not None)
        self.counts["rows"] += 1
        for fault, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated")):
            self.counts[name] += symbol[1] == fault
        self.spans.add_row(symbol)

    def _follow(self, first: str, last: str, low: int | None, high: int | None, turns: int) -> None:
        if self.last is not None:
            self.counts["illegal"] += self.last + first not in ("su", "ua", "au")
        self.first, self.last = self.first or first, last
        if low is not None:
            self.counts["turns"] += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high

    def packed(self) -> str:
        return json.dumps([self.counts, self.first, self.last, self.low, self.high, self.spans.whole()])

    def add_packed(self, text: str) -> None:
        counts, first, last, low, high, cell = json.loads(text)
        if counts["rows"]:
            self._follow(first, last, low, high, counts["turns"])
            for name in self.COUNTS[:-1]:
                self.counts[name] += counts[name]
            self.spans.add_cell([tuple(x) if x else None for x in cell])

    def repair(self) -> tuple[int, str]:
        """The least cost and audit."""
        cell = self.spans.whole()
        return min(x for x in (cell[_AT[START, end]] for end in ENDS) if x is not None)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.counts["turns"]


class Editor:
    """Applies an audit to the rows of a conversation as they come; roles follow from the audit's length."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at = audit, 0
        left = len(audit) - audit.count("D")
        self.turn = -1 if left % 2 else 0  # a system row comes first in a repair of odd length

    def _role(self) -> str:
        self.turn += 1
        return "user" if self.turn % 2 else "assistant"

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield "I", self._role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The (edit, role, text) up to and including this row; a deleted row gives none of its own."""
        yield from self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            expected = self._role()
            yield edit, expected if edit == "R" else role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def damage(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, present) with faults chosen by the CRC-32 of `conv_id:turn`, modulo 20.

    0 drops the row (it stays, not present, to name its conversation), 1 empties its text, 2 removes ends of sentences, 3
    repeats it, 4 makes it the user's. Nulls count as one space.
    """
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", filled(conv_id), filled(turn)).cast("binary")) % 20
    given = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), filled(role).alias("role"),
                      filled(text).alias("text"), kind.alias("kind"))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return given.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                        changed.alias("text"), (F.col("kind") != 0).alias("present"), F.explode(times).alias("_")).drop("_")


ORDER = ["conv_id", "turn", "role", "digest", "row"]


def _numbered(df: DataFrame) -> DataFrame:
    """The rows with their place in the order: a number of their own and a digest of conversation, role and text."""
    full = df.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                     F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce("present", F.lit(True)).alias("present"))
    told = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.length("role").cast("string"), "role", "text")
    return full.select("conv_id", "turn", "role", F.unhex(F.sha2(told, 256)).alias("digest"),
                       F.monotonically_increasing_id().alias("row"), "text", "present")


def _symbols(rows: DataFrame) -> DataFrame:
    """The rows in the order's columns with a symbol each; a row that isn't present has none."""
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = F.when(last == "", "b").when(F.col("row") != F.col("first"), "d").when(~last.isin(".", "!", "?"), "t").otherwise("-")
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("?")
    told = rows.where("present").select(*ORDER, last.alias("last"))
    # Copies agree in conversation, role and text; the first of them is no duplicate.
    copies = materialize(told.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(
        F.col("turn").isNotNull().alias("a"), "turn", "row"))["row"].alias("first")), "copies")
    marked = counted_join(rows.where("present").select(*ORDER, "text"), copies, "digest", "n")
    absent = rows.where(~F.col("present")).select(*ORDER, F.lit(None).cast("string").alias("symbol"))
    return marked.select(*ORDER, F.concat(known, fault).alias("symbol")).unionByName(absent)


_GONE = object()


def _portions(symbols: DataFrame) -> DataFrame:
    """(conv_id, part, packed): one row for each conversation and task that has rows of it."""
    def task(batches):
        part = TaskContext.get().partitionId()
        now, portion = _GONE, Portion()

        def closed():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([part], pa.int32()),
                                               pa.array([portion.packed()])], names=["conv_id", "part", "packed"])

        for batch in batches:
            for conv, turn, symbol in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if conv != now or now is _GONE:
                    if now is not _GONE:
                        yield closed()
                    now, portion = conv, Portion()
                if symbol is not None:
                    portion.add(symbol, turn)
        if now is not _GONE:
            yield closed()

    spread = symbols.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return spread.select("conv_id", "turn", "symbol").mapInArrow(task, "conv_id long, part int, packed string")


def _conversations(rows: DataFrame) -> DataFrame:
    """For each conversation first its packed portions, then its rows, in order and in one partition."""
    none = {c: F.lit(None).cast(dict(rows.dtypes)[c]).alias(c) for c in ORDER[1:]}
    portions = _portions(_symbols(rows)).select(
        "conv_id", F.lit(0).alias("kind"), "part", *none.values(), F.col("packed").alias("text"))
    told = rows.where("present").select("conv_id", F.lit(1).alias("kind"), F.lit(0).alias("part"), *ORDER[1:], "text")
    order = ["conv_id", "kind", "part", *ORDER[1:]]
    return (portions.unionByName(told).repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "kind", "role", "text"))


def _told(batches) -> Iterator[tuple[int | None, int, str | None, str]]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(4)))


def _streamed(batches, start, step, end):
    """Folds each conversation of a sorted stream; `start` gets the conversation and all its portions as one."""
    now, portion, state = _GONE, Portion(), None
    for conv, kind, role, text in _told(batches):
        if conv != now or now is _GONE:
            if now is not _GONE:
                yield from end(state if state is not None else start(now, portion))
            now, portion, state = conv, Portion(), None
        if kind == 0:
            portion.add_packed(text)
            continue
        if state is None:
            state = start(now, portion)
        yield from step(state, role, text)
    if now is not _GONE:
        yield from end(state if state is not None else start(now, portion))


class _Digest:
    def __init__(self, conv: int | None, portion: Portion) -> None:
        self.conv, self.portion = conv, portion
        self.cost, self.audit = portion.repair()
        self.editor, self.sha, self.any = Editor(self.audit), hashlib.sha256(), False

    def take(self, edits) -> None:
        for _, role, text in edits:
            self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def repair_digests(df: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, present) rows: its faults, the cheapest repair and its digest.

    Rows that aren't present only name their conversation. Runs jobs when called.
    """
    def task(batches):
        names = [f.split()[0] for f in RESULT.split(", ")]
        found: list[tuple] = []

        def step(state: _Digest, role: str, text: str):
            state.take(state.editor.row(role, text))
            return ()

        def end(state: _Digest):
            state.take(state.editor.end())
            n = state.portion.counts
            yield (state.conv, state.portion.gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], state.cost,
                   state.audit, state.sha.hexdigest())

        def batch() -> pa.RecordBatch:
            kinds = [pa.string() if c in ("audit", "repaired_sha256") else pa.int64() for c in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

        size = 0
        for row in _streamed(batches, _Digest, step, end):
            found.append(row)
            size += len(row[-2])
            if len(found) == 2048 or size > 1 << 20:
                yield batch()
                found, size = [], 0
        if found:
            yield batch()

    rows = materialize(_numbered(df), "conversation-rows")
    return _conversations(rows).mapInArrow(task, RESULT)


def repair(df: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the rows of the repaired conversations in order. Runs jobs when called.

    `edit` is K for a kept, R for a reroled and I for an inserted row.
    """
    def task(batches):
        class Rows(_Digest):
            def __init__(self, conv, portion) -> None:
                super().__init__(conv, portion)
                self.n = 0

            def numbered(self, edits):
                for edit in edits:
                    yield (self.conv, self.n, *edit)
                    self.n += 1

        found: list[tuple] = []
        size = 0
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                                              names=["conv_id", "position", "edit", "role", "text"])

        for row in _streamed(batches, Rows, lambda s, role, text: s.numbered(s.editor.row(role, text)),
                             lambda s: s.numbered(s.editor.end())):
            found.append(row)
            size += len(row[-1])
            if len(found) == 2048 or size > 1 << 20:
                yield batch()
                found, size = [], 0
        if found:
            yield batch()

    rows = materialize(_numbered(df), "conversation-rows")
    return _conversations(rows).mapInArrow(task, "conv_id long, position long, edit string, role string, text string")
