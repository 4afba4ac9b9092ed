"""Repair of the structure of conversations by the cheapest edits.

Every row of a conversation may be kept, get another role (user or assistant)
or be deleted, and messages may be inserted, until the initials of the roles
read ``(s?(ua)+)?``.  The places between rows and the states of that pattern
form an acyclic graph whose edges are the edits.  An edge's weight is one
integer: its high digits are the edit's cost, and its low digits, of a fixed
width, hold one digit for each place of the audit (the initials of the edits, in
ASCII order from 1, zero where the audit has ended).  The least sum of weights
is therefore the least cost, and of equal costs the least audit; an ordinary
shortest path in integers decides everything.  A path's place in the audit is the
number of its edits, so a node is (rows read, state, insertions made).

The rows of a conversation come to one task in the order of their turns,
sorted by Spark, and are read as a stream.  Of a conversation the task holds
one number and one running hash for each open node, and one letter of audit
for each row, never its texts.  Low digits cover ``PLACES`` places: from time
to time the digits that all open nodes have passed are replaced by one digit,
the rank of the audit so far, which keeps the order of all sums.  A node that
costs more than another from which everything can be reached that it reaches
is closed.  The contract's hash runs over a conversation's whole repaired text
in order, so one conversation is one task's work, in bounded memory.

Faults of a row, the first that holds: blank (no character but blanks),
duplicate (role and text are those of an earlier row), truncated (the last
character that is not blank ends no sentence).

Defined cases: a null role or text is one space, and so is a null conv_id or
turn in the damage rule; a null turn comes first; rows of one turn are in the
order of role and text; rows of a null conv_id are one conversation; a
conversation without rows after the damage has zeros, an empty audit and the
hash of the empty text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.shipping import ship
from ledgerlens.llm.text import BLANKS

# Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Digit of each edit's initial, in ASCII order.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = {v: k for k, v in DIGITS.items()}

# States of the pattern: nothing yet, after the system row, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a role's initial.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The states from which all that a state accepts is accepted.
COVERED_BY = {START: (START,), SYSTEM: (START, SYSTEM, ASSISTANT), USER: (USER,), ASSISTANT: (START, ASSISTANT)}
FINAL = (START, ASSISTANT)
_ROLES = ("user", "assistant")

#: Places of the audit that low digits cover.
PLACES = 64
_BITS = 3
_RANK_BITS = 16
_LOW = _BITS * PLACES
_COST = _RANK_BITS + _LOW
_OUT_ROWS = 512

BLANK, DUPLICATE, CUT, SOUND = "blank", "duplicate", "truncated", ""


class _Path:
    """The best path to a node: weight, audit before the low digits (linked pieces), running hash of what it keeps."""

    __slots__ = ("weight", "audit", "sha", "some")

    def __init__(self, weight, audit, sha, some):
        self.weight, self.audit, self.sha, self.some = weight, audit, sha, some


class Repair:
    """Shortest path over the rows of one conversation, given one after another."""

    def __init__(self):
        self.rows = self.base = 0
        self.open = {(START, 0): _Path(0, None, hashlib.sha256(), False)}

    def _step(self, path: _Path, made: int, cost: int, letter: str) -> int:
        place = self.rows + made - self.base
        return path.weight + (cost << _COST) + (DIGITS[letter] << _BITS * (PLACES - 1 - place))

    @staticmethod
    def _put(nodes: dict, node: tuple[int, int], weight: int, path: _Path, line: bytes | None) -> None:
        old = nodes.get(node)
        if old is not None and old.weight <= weight:
            return
        sha, some = path.sha, path.some
        if line is not None:
            sha = sha.copy()
            sha.update(b"\n" + line if some else line)
            some = True
        nodes[node] = _Path(weight, path.audit, sha, some)

    def _insertions(self) -> None:
        """Edges that insert a message before the next row."""
        todo = list(self.open)
        while todo:
            state, made = node = todo.pop()
            path = self.open[node]
            for role in _ROLES:
                after = NEXT.get((state, role[0]))
                if after is None:
                    continue
                weight = self._step(path, made, INSERT, "I")
                if any(p.weight >> _COST < weight >> _COST and s in COVERED_BY[after] for (s, _), p in self.open.items()):
                    continue
                new = (after, made + 1)
                old = self.open.get(new)
                self._put(self.open, new, weight, path, f"{role}:".encode())
                if self.open[new] is not old:
                    todo.append(new)

    def _close(self) -> None:
        cheapest = [min((p.weight >> _COST for (s, _), p in self.open.items() if s in COVERED_BY[q]), default=0)
                    for q in range(4)]
        self.open = {n: p for n, p in self.open.items() if p.weight >> _COST <= cheapest[n[0]]}

    def _settle(self) -> None:
        """Make room in the low digits: what all open paths have passed becomes the rank of their audits."""
        passed = min(self.rows + made for _, made in self.open) - self.base
        left = _BITS * (PLACES - passed)
        heads = {n: (p.weight >> left) & ((1 << _RANK_BITS + _BITS * passed) - 1) for n, p in self.open.items()}
        rank = {h: r for r, h in enumerate(sorted(set(heads.values())))}
        for node, path in self.open.items():
            path.audit = (path.audit, heads[node] & ((1 << _BITS * passed) - 1), passed)
            path.weight = ((path.weight >> _COST) << _COST) + (rank[heads[node]] << _LOW) \
                + ((path.weight & ((1 << left) - 1)) << _BITS * passed)
        self.base += passed

    def add(self, role: str, text: str, fault: str) -> None:
        """The next row."""
        self._insertions()
        new: dict[tuple[int, int], _Path] = {}
        for (state, made), path in self.open.items():
            self._put(new, (state, made), self._step(path, made, DELETE, "D"), path, None)
            if fault in (BLANK, DUPLICATE):
                continue
            more = TRUNCATED if fault == CUT else 0
            after = NEXT.get((state, role[:1]))
            if after is not None:
                self._put(new, (after, made), self._step(path, made, KEEP + more, "K"), path,
                          f"{role}:{text}".encode("utf-8", "surrogatepass"))
            for other in _ROLES:
                after = NEXT.get((state, other[0]))
                if after is not None:
                    self._put(new, (after, made), self._step(path, made, REROLE + more, "R"), path,
                              f"{other}:{text}".encode("utf-8", "surrogatepass"))
        self.open = new
        self.rows += 1
        self._close()
        if max(self.rows + made for _, made in self.open) - self.base > PLACES - 8:
            self._settle()

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, sha256 of the repaired rows)."""
        self._insertions()
        best = min((p for (s, _), p in self.open.items() if s in FINAL), key=lambda p: p.weight)
        low = best.weight & ((1 << _LOW) - 1)
        pieces = [(low, PLACES)]
        audit = best.audit
        while audit is not None:
            audit, digits, places = audit
            pieces.append((digits, places))
        letters = [_LETTER.get((digits >> _BITS * (places - 1 - i)) & 7, "")
                   for digits, places in reversed(pieces) for i in range(places)]
        return best.weight >> _COST, "".join(letters), best.sha.hexdigest()


_FOUND = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
          ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


class _Conversation:
    """Counts of one conversation and its repair."""

    def __init__(self):
        self.repair, self.faults = Repair(), {BLANK: 0, DUPLICATE: 0, CUT: 0, SOUND: 0}
        self.low = self.turn = self.before = None
        self.turns = self.illegal = 0

    def add(self, turn, role, text, fault):
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.turn = turn
        if self.before is not None and (self.before, role[:1]) not in (("s", "u"), ("u", "a"), ("a", "u")):
            self.illegal += 1
        self.before = role[:1]
        self.faults[fault] += 1
        self.repair.add(role, text, fault)

    def row(self):
        gaps = 0 if self.turn is None else self.turn - self.low + 1 - self.turns
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, *self.repair.result()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of a stream of rows sorted by conversation and order."""
    kind, out, last, now = None, [], None, None

    def flush():
        columns = list(zip(*out, strict=True))
        names = ["conv_id", *(n for n, _ in _FOUND)]
        types = [kind, *(t for _, t in _FOUND)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, turn, role, text, live, fault in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if now is None or conv != last:
                if now is not None:
                    out.append((last, *now.row()))
                    if len(out) >= _OUT_ROWS:
                        yield flush()
                        out.clear()
                last, now = conv, _Conversation()
            if live:
                now.add(turn, role, text, fault)
    if now is not None:
        out.append((last, *now.row()))
        yield flush()


def _spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live): the rows after the damage rule.  A dropped row stays, not
    live, so that its conversation is known."""
    h = F.crc32(F.concat(_spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn"))).cast("binary")) % 20
    out = rows.select("conv_id", "turn", _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"),
                      h.alias("h"))
    text = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")) \
        .otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("h") == 3, 2).otherwise(1)
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("h") != 0).alias("live"),
                      F.explode(F.array_repeat(F.lit(1), times)).alias("copy")).drop("copy")


def repair(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Faults, cheapest repair and hash of each conversation of ``rows`` (conv_id, turn, role, text, live)."""
    spaced = rows.select("conv_id", "turn", _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"), "live")
    ship(spark)
    # One shuffle: the window's groups lie within a conversation.
    alike = Window.partitionBy("conv_id", "live", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    end = F.regexp_extract("text", rf"([^{BLANKS}])[{BLANKS}]*\z", 1)
    fault = (F.when(end == "", BLANK).when(F.col("nth") > 1, DUPLICATE)
             .when(~end.isin(".", "!", "?"), CUT).otherwise(SOUND))
    ordered = (spaced.repartition("conv_id").withColumn("nth", F.row_number().over(alike)).withColumn("fault", fault)
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "nth"))
    kinds = {pa.int64(): T.LongType(), pa.string(): T.StringType()}
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType),
                           *(T.StructField(n, kinds[t]) for n, t in _FOUND)])
    return ordered.select("conv_id", "turn", "role", "text", "live", "fault").mapInArrow(_repaired, schema)
