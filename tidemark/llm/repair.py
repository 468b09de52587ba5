"""Least repairs of conversations by layers of cost.

A repaired conversation's roles read ``(s?(ua)+)?`` by their initials. A row is kept (cost 0), given the role
user or assistant (1) or deleted (2); a user or an assistant without text is inserted anywhere (5). Rows that
are blank or were said before must go; a row whose text breaks off costs 5 more if it stays.

For each row and each cost there is a bitset of the grammar's states from which the rest of the conversation
can be brought to an end at that cost. The layers are made from the last row to the first, each from cheaper
layers of the next row and of its own row (insertions), and the first layer that holds the start's state is the
cost. The states' costs differ by ``SPREAD`` at most, as insertions lead from any state of a turn to any other,
so a row keeps the layers from its own least cost on, and that is one of few patterns: each is made once, and
numbered. A trace from the start takes at each row the ASCII-least edit whose state is in the layer that is left;
an edit leads to one state, so the least audit needs no search.

Edge cases: rows are taken by turn, nulls first, and rows of one turn by role and a digest of role and text; a null role or text, and
a null conv_id or turn in what is hashed, is one blank; rows of a null conv_id are a conversation; repeated rows
are duplicates; of equal rows of one turn the first stays; a role with another initial cannot be kept; a conversation
without rows has cost 0 and an empty audit; an empty table gives an empty result; other columns are ignored.

A conversation's faults, and which of its texts came before, are found by all tasks. Its edits follow from one
another, and its digest is one sequential hash, so for these its rows pass through one task in order, a batch at
a time: first a byte a row, then the texts beside the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import checkpoint, join_hot, map_arrow, table

QUERY = "op12_conversation_repair"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: States by what came last: nothing, system, user, assistant. A turn may end at first and after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = 1 << START | 1 << ASSISTANT
#: Where a kept row of some initial leads from each state, and where a row does that may take any role.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ANY = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
#: How far the least costs of two states of one row can be apart: two insertions.
SPREAD = 2 * INSERT
#: Row kinds: what must go, else whether the text breaks off, times the role's initial.
GO, WHOLE, BROKEN = range(3)
ROLES = ("user", "assistant")
_INITIALS = ("s", "u", "a", "")


def kind(fault: int, role: str) -> int:
    initial = role[:1]
    return fault * 4 + (_INITIALS.index(initial) if initial in KEPT else 3)


def _sources(step: dict[int, int], states: int) -> int:
    """The states from which ``step`` leads into ``states``."""
    return sum(1 << s for s, t in step.items() if states >> t & 1)


class Layers:
    """Patterns of layers: for each cost above the row's least one, the states that can end at it or below."""

    def __init__(self):
        self.patterns: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int]] = {}
        self.last = self._number(self._inserted([ENDS] * (SPREAD + 1)))[0]

    def _inserted(self, rows: list[int]) -> list[int]:
        """Layers with insertions, which go from a layer to the one ``INSERT`` above it, cheapest first."""
        for c in range(len(rows)):
            rows[c] |= (rows[c - 1] if c else 0) | (_sources(ANY, rows[c - INSERT]) if c >= INSERT else 0)
        return rows

    def _number(self, rows: list[int]) -> tuple[int, int]:
        least = next(c for c, states in enumerate(rows) if states)
        pattern = tuple(rows[least : least + SPREAD + 1])
        if pattern not in self.numbers:
            self.numbers[pattern] = len(self.patterns)
            self.patterns.append(pattern)
        return self.numbers[pattern], least

    def step(self, after: int, row: int) -> tuple[int, int]:
        """The pattern before a row of some kind, and how much its least cost is above the one after it."""
        if (got := self.steps.get((after, row))) is None:
            nxt, fault, initial = self.patterns[after], row // 4, _INITIALS[row % 4]
            rows = [0] * (SPREAD + DELETE + SPREAD + 1)
            at = lambda c: nxt[min(c, SPREAD)] if c >= 0 else 0
            extra = TRUNCATED if fault == BROKEN else 0
            for c in range(len(rows)):
                rows[c] = at(c - DELETE)
                if fault != GO:
                    rows[c] |= _sources(KEPT.get(initial, {}), at(c - KEEP - extra)) | _sources(ANY, at(c - REROLE - extra))
            got = self.steps[after, row] = self._number(self._inserted(rows))
        return got

    def solve(self, kinds: bytes) -> tuple[int, str]:
        """(cost, audit) of rows by their kinds."""
        numbers, rises, at = [self.last], [0], self.last
        for row in reversed(kinds):
            at, rise = self.step(at, row)
            numbers.append(at)
            rises.append(rise)
        numbers.reverse()
        rises.reverse()
        base = sum(rises)  # the least cost of the row that the trace is at
        cost = left = base + next(c for c, states in enumerate(self.patterns[at]) if states >> START & 1)
        audit, state, i, n = [], START, 0, len(kinds)

        def ends(number: int, least: int, state: int, cost: int) -> bool:
            return cost >= least and bool(self.patterns[number][min(cost - least, SPREAD)] >> state & 1)

        while i < n or left:
            row = kinds[i] if i < n else None
            if row is not None:
                after, extra = base - rises[i], TRUNCATED if row // 4 == BROKEN else 0
                if ends(numbers[i + 1], after, state, left - DELETE):
                    audit.append("D")
                    left, base, i = left - DELETE, after, i + 1
                    continue
            if ends(numbers[i], base, ANY[state], left - INSERT):
                audit.append("I")
                left, state = left - INSERT, ANY[state]
                continue
            to = KEPT.get(_INITIALS[row % 4], {}).get(state)
            if to is not None and ends(numbers[i + 1], after, to, left - KEEP - extra):
                audit.append("K")
                left -= KEEP + extra
            else:
                audit.append("R")
                to, left = ANY[state], left - REROLE - extra
            state, base, i = to, after, i + 1
        return cost, "".join(audit)


class Edits:
    """Applies an audit to roles, one row after the other, and says what turns come of it."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[str]:
        """Roles of the turns that are inserted before the next row, or at the end."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state, self.at = ANY[self.state], self.at + 1
            yield ROLES[self.state - USER]

    def role(self, role: str) -> str | None:
        """The next row's role, or None if it is deleted. Insertions before it come first."""
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "D":
            return None
        if edit == "R":
            self.state = ANY[self.state]
            return ROLES[self.state - USER]
        self.state = KEPT[role[:1]][self.state]
        return role


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place", "turn", "role", "said")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, said, fault) of rows (conv_id, turn, role, text, there); a row that is not ``there``
    only names its conversation.

    ``said`` is a digest of role and text, ``place`` orders null turns and absent rows first. ``fault`` is blank,
    duplicate, truncated or null; of rows that are equal in all but a text said earlier only the order tells which is the first,
    and this is left to whoever reads them in order.
    """
    role, text = F.col("role"), F.col("text")
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    last = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
    place = F.when(~F.col("there"), 0).when(F.col("turn").isNull(), 1).otherwise(2)
    rows = rows.withColumns({"place": place, "said": said, "last": last, "blank": last == ""})
    # one key for conversation and text, so that a frequent one can be told and joined by broadcast
    keyed = checkpoint(rows.withColumn("key", F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), "said"), 256)))
    real = keyed.where("there and not blank")
    first = checkpoint(real.groupBy("key").agg(F.min(F.struct("place", "turn")).alias("first"), F.count("*").alias("n")).where("n > 1"))
    again = join_hot(real.join(first.select("key"), "key", "left_semi"), first, "key", "n") if not first.isEmpty() else None
    fault = F.when(F.col("blank"), "blank").when(~F.col("last").isin(".", "!", "?"), "truncated")
    columns = ["conv_id", "place", "turn", "role", "text", "said"]
    if again is None:
        return keyed.select(*columns, F.when(F.col("there"), fault).alias("fault"))
    once = keyed.join(first.select("key").withColumn("more", F.lit(True)), "key", "left").where("more is null or blank or not there")
    dup = F.when(F.struct("place", "turn") > F.col("first"), "duplicate").otherwise(fault)
    return once.select(*columns, F.when(F.col("there"), fault).alias("fault")).unionByName(again.select(*columns, dup.alias("fault")))


_SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame) -> DataFrame:
    """A conversation's counts of faults, least cost and audit, from ``faults``' rows."""
    names = [x.split()[0] for x in _SUMMARY.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers, conv, state = Layers(), None, None

        def done():
            kinds, counts, turns, illegal = state["kinds"], state["counts"], state["turns"], state["illegal"]
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
            return (conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, *layers.solve(bytes(kinds)))

        for b in batches:
            out = []
            for c, place, turn, role, said, fault in zip(*(b.column(k).to_pylist() for k in range(6))):
                if state is None or c != conv:
                    if state is not None:
                        out.append(done())
                    conv = c
                    state = {"kinds": bytearray(), "counts": dict.fromkeys(("blank", "duplicate", "truncated"), 0), "turns": [0, 0, 0], "illegal": 0, "before": None, "row": None}
                if not place:
                    continue
                if fault != "blank" and state["row"] == (turn, said):  # an equal row of the same turn
                    fault = "duplicate"
                state["row"] = (turn, said)
                if fault:
                    state["counts"][fault] += 1
                t = state["turns"]
                if turn is not None and (not t[2] or turn != t[1]):
                    t[0], t[1], t[2] = (t[0] if t[2] else turn), turn, t[2] + 1
                initial = role[:1]
                state["illegal"] += state["before"] is not None and state["before"] + initial not in ("su", "ua", "au")
                state["before"] = initial
                state["kinds"].append(kind(GO if fault in ("blank", "duplicate") else BROKEN if fault else WHOLE, role))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if k == 7 else pa.int64()) for k, x in enumerate(zip(*out))], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string() if k == 7 else pa.int64()) for k, x in enumerate(done())], names=names)

    return map_arrow(_in_order(rows.select("conv_id", "place", "turn", "role", "said", "fault")), run, _SUMMARY)


def repaired(rows: DataFrame, summary: DataFrame, read=None, schema: str = "conv_id long, n long, role string, text string") -> DataFrame:
    """The turns (conv_id, n, role, text) of repaired conversations; their rows come in order within a partition.

    ``read(conv_id, turns)`` may stand in for a turn's own row: it is given the conversation's summary and an iterator of
    (role, text), and yields rows of ``schema``.
    """
    summary_names = [x.split()[0] for x in _SUMMARY.split(", ")][1:]
    packed = F.struct(*summary_names)
    head = summary.select("conv_id", F.lit(-1).alias("place"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("said"), F.lit("").alias("text"), packed.alias("summary"))
    body = rows.where("place > 0").select("conv_id", "place", "turn", "role", "said", "text", F.lit(None).cast(head.schema["summary"].dataType).alias("summary"))
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    read = read or (lambda conv_id, summary, turns: ((conv_id, n, role, text) for n, (role, text) in enumerate(turns)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 5, 6))))
        held = next(source, None)
        out, size = [], 0

        def turns(edits: Edits, conv_id):
            nonlocal held
            while held is not None and held[1] > 0 and held[0] == conv_id:
                yield from ((role, "") for role in edits.inserted())
                role, text = edits.role(held[2]), held[3]
                held = next(source, None)
                if role is not None:
                    yield role, text
            yield from ((role, "") for role in edits.inserted())

        while held is not None:
            conv_id, summary = held[0], held[4]
            held = next(source, None)
            for row in read(conv_id, summary, turns(Edits(summary["audit"]), conv_id)):
                out.append(row)
                size += sum(len(x) for x in row if isinstance(x, str)) + 100
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

    return map_arrow(_in_order(head.unionByName(body)).select("conv_id", "place", "turn", "role", "said", "text", "summary"), run, schema)


def digests(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """The summaries with the hash of each repaired conversation's ``role:text`` lines."""
    names = [x.split()[0] for x in _SUMMARY.split(", ")][1:]

    def read(conv_id, summary, turns):
        h, sep = hashlib.sha256(), ""
        for role, text in turns:
            h.update(f"{sep}{role}:{text}".encode("utf-8", "surrogatepass"))
            sep = "\n"
        yield (conv_id, *(summary[k] for k in names), h.hexdigest())

    return repaired(rows, summary, read, _SUMMARY + ", repaired_sha256 string")


def whole(conversations: DataFrame) -> DataFrame:
    """Rows as ``faults`` takes them, all there, with nulls of role and text as a blank."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text"), F.lit(True).alias("there"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults by a hash of conversation and turn: some go, are emptied, lose their ends, come twice or are a user's."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    rows = whole(conversations).withColumn("code", code)
    times = F.explode(F.when(F.col("code") == 3, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("code") != 0).alias("there"), times).drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checkpoint(faults(damaged(table(spark, sf_dir, "conversations"))))
    return digests(rows, audits(rows))
