"""Chat formatting by schema fingerprints.

The nested field paths of a table's schema, or of a JSON record, are hashed; the hash picks a
declarative mapping (``LAYOUTS``) that says where conversations, turns, roles and texts are, and the
record becomes canonical turns (conv_id, turn, role, text). A layout is known by the hash of all its
paths, with or without its id. If the hash of a record's paths is not known, that of those paths is
looked up which any layout has, so fields that no mapping speaks of don't matter; only a record that
mixes fields of several layouts is held against each, the one with the most fields first. ``render`` writes turns as

    ### role
    text</turn>

with a backslash before each backslash, ``### `` and ``</turn>`` of a text (and each line end of a
role), so that what a text says is never taken for the template. Output comes a turn a row, in order,
with the span of the row that is under the loss mask: the texts of assistants. ``Reader`` reads such
output back from pieces of any length.

Edge cases: a null text or role is empty; a null turn comes first; turns with the same number are
ordered by what they say; repeated rows are turns of their own; a null conv_id is a conversation; an
empty table gives an empty result; a layout that no mapping knows raises ValueError in a table and
gives no turns, but an entry of ``unknown_layouts``, in a JSON record. Other columns of a table are
ignored as long as the mapped paths are there.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_arrow, map_rows, table

QUERY = "op2_chat_format"
TURN, END, ESCAPE = "### ", "</turn>\n", "\\"
_CONTROL = re.compile(r"\\|### |</turn>")
_ESCAPED = re.compile(r"\\([\s\S])")


@dataclass(frozen=True)
class Layout:
    """Where a record's turns are. A path names nested fields; ``[]`` after a name stands for a list's items.

    ``turns``: the list of turns, or empty if each row is a turn. ``fixed``: turns of the record
    itself, as (role, paths of its text, joined by line ends; empty ones are left out).
    """

    conversation: str = "id"
    turns: str = ""
    order: str = ""
    role: str = ""
    text: str = ""
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self, id: bool = True) -> list[str]:
        """The leaf paths of the layout, with that of a record's id or without."""
        inside = [f"{self.turns}[].{p}" if self.turns else p for p in (self.order, self.role, self.text) if p]
        return sorted([*([self.conversation] if id else []), *inside, *(p for _, ps in self.fixed for p in ps)])


#: The layouts known; more can be given to ``from_table`` and ``from_json``.
LAYOUTS = (
    Layout("conv_id", "", "turn", "role", "text"),
    Layout("id", "messages", "", "role", "content"),
    Layout("id", "conversations", "", "from", "value", roles={"human": "user", "gpt": "assistant"}),
    Layout("id", fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("id", fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("id", fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("id", fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("id", fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("id", fixed=(("user", ("data.question",)), ("assistant", ("data.answer",)))),
)


def fingerprint(paths) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def schema_paths(schema: T.DataType, at: str = "") -> list[str]:
    """The leaf paths of a Spark type."""
    if isinstance(schema, T.StructType):
        return [p for f in schema for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, at + "[]")
    return [at]


def record_paths(record, at: str = "") -> set[str]:
    """The leaf paths of a JSON value; an empty list or object is a leaf."""
    if isinstance(record, dict) and record:
        return set().union(*(record_paths(v, f"{at}.{k}" if at else k) for k, v in record.items()))
    if isinstance(record, list) and record:
        return set().union(*(record_paths(v, at + "[]") for v in record))
    return {at}


class Layouts:
    """Picks a layout by fingerprint."""

    def __init__(self, layouts=LAYOUTS):
        self.known = {fingerprint(x.paths(id)): x for x in layouts for id in (False, True)}
        self.fields = {p for x in layouts for p in x.paths()}
        self.by_size = sorted(layouts, key=lambda x: (-len(x.paths(False)), x.paths(False)))
        self.seen: dict[str, tuple[str, Layout | None]] = {}

    def find(self, paths) -> tuple[str, Layout | None]:
        """How a layout was found (all, fields, parts or none), and which."""
        own = set(paths)
        if x := self.known.get(fingerprint(own)):
            return "all", x
        if x := self.known.get(fingerprint(own & self.fields)):
            return "fields", x
        x = next((x for x in self.by_size if own.issuperset(x.paths(False))), None)
        return ("parts", x) if x else ("none", None)

    def pick(self, paths) -> Layout | None:
        key = fingerprint(paths)
        if key not in self.seen:
            if len(self.seen) >= 10_000:
                self.seen.clear()
            self.seen[key] = self.find(paths)
        return self.seen[key][1]


def from_table(df: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of a table whose schema has a known layout."""
    layout = Layouts(layouts).pick(schema_paths(df.schema))
    if layout is None:
        raise ValueError(f"no mapping for the layout {fingerprint(schema_paths(df.schema))}: {sorted(schema_paths(df.schema))}")
    path = lambda p: F.col(".".join(f"`{x}`" for x in p.split(".")))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    conv = path(layout.conversation).cast("long").alias("conv_id")
    if layout.fixed:
        filled = lambda ps: F.concat_ws("\n", *[F.nullif(path(p).cast("string"), F.lit("")) for p in ps])
        turns = F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), filled(ps).alias("text")) for i, (r, ps) in enumerate(layout.fixed)])
        return df.select(conv, F.explode(turns).alias("t")).select("conv_id", "t.turn", "t.role", "t.text").where("role <> 'system' or text <> ''")
    if layout.turns:
        rows = df.select(conv, F.posexplode(path(layout.turns)).alias("turn", "t"))
        item = lambda p: F.col("t")[p]
        order = item(layout.order) if layout.order else F.col("turn")
    else:
        rows, item, order = df, path, path(layout.order)
    role = text(item(layout.role))
    for old, new in layout.roles.items():
        role = F.when(text(item(layout.role)) == old, new).otherwise(role)
    return rows.select(F.col("conv_id") if layout.turns else conv, order.cast("long").alias("turn"), role.alias("role"), text(item(layout.text)).alias("text"))


def record_turns(record: dict, layout: Layout) -> Iterator[tuple[int, str, str]]:
    """(turn, role, text) of a JSON record."""

    def get(at, path):
        for k in path.split("."):
            at = at.get(k) if isinstance(at, dict) else None
        return "" if at is None else at if isinstance(at, str) else json.dumps(at)

    if layout.fixed:
        for i, (role, paths) in enumerate(layout.fixed):
            text = "\n".join(x for p in paths if (x := get(record, p)))
            if role != "system" or text:
                yield i, role, text
        return
    items = record.get(layout.turns) or [] if layout.turns else [record]
    for i, t in enumerate(items):
        role = get(t, layout.role)
        yield int(get(t, layout.order) or 0) if layout.order else i, layout.roles.get(role, role), get(t, layout.text)


def _parsed(text):
    try:
        record = json.loads(text or "")
    except ValueError:
        return None
    return record if isinstance(record, dict) else None


def from_json(df: DataFrame, id_col: str, json_col: str, layouts=LAYOUTS) -> DataFrame:
    """Canonical turns of JSON records of any known layouts; ``id_col`` is the conversation's id."""

    def batch(b):
        pick, rows = Layouts(layouts).pick, []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            record = _parsed(text)
            layout = record and pick(record_paths(record))
            rows += [(i, *t) for t in record_turns(record, layout)] if layout else []
        return dict(zip(("conv_id", "turn", "role", "text"), zip(*rows) if rows else ([], [], [], [])))

    return map_rows(df.select(F.col(id_col).cast("long").alias("conv_id"), F.col(json_col).alias("text")), batch, "conv_id long, turn long, role string, text string")


def unknown_layouts(df: DataFrame, id_col: str, json_col: str, layouts=LAYOUTS) -> DataFrame:
    """(conv_id, layout): records that have no mapping, with their fingerprint (null: not a JSON object)."""

    def batch(b):
        pick, rows = Layouts(layouts).pick, []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            record = _parsed(text)
            if not (record and pick(record_paths(record))):
                rows.append((i, fingerprint(record_paths(record)) if record is not None else None))
        return {"conv_id": [r[0] for r in rows], "layout": [r[1] for r in rows]}

    return map_rows(df.select(F.col(id_col).cast("long").alias("conv_id"), F.col(json_col).alias("text")), batch, "conv_id long, layout string")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: ESCAPE + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text stands in it."""
    head = TURN + escape(role).replace("\n", ESCAPE + "\n") + "\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def render(turns: DataFrame, together: bool = False) -> DataFrame:
    """(conv_id, piece, loss_start, loss_end): a formatted turn a row, in the order of conversations and turns.

    loss_start and loss_end count the piece's characters under the loss mask; both are null outside
    of assistants' texts. Rows are formatted before they move, and the order runs over the partitions,
    so a conversation with very many turns is formatted and written by many tasks. With ``together``
    each conversation is in one partition, as ``digest`` needs it, in no order among others.
    """

    def batch(b):
        got = [render_turn(r or "", t or "") for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        own = [r == "assistant" for r in b.column(2).to_pylist()]
        return {"conv_id": b.column(0), "turn": b.column(1), "role": b.column(2), "text": b.column(3), "piece": [g[0] for g in got], "loss_start": [g[1] if a else None for g, a in zip(got, own)], "loss_end": [g[2] if a else None for g, a in zip(got, own)]}

    rows = map_rows(turns.select("conv_id", "turn", "role", "text"), batch, "conv_id long, turn long, role string, text string, piece string, loss_start long, loss_end long", text=3)
    rows = rows.drop("role", "text")
    dealt = rows.repartition("conv_id") if together else rows.repartitionByRange("conv_id", "turn", "piece")
    return dealt.sortWithinPartitions("conv_id", "turn", "piece").drop("turn")


class Reader:
    """Turns from formatted text that comes in pieces. ``feed`` yields (what, text): a role, parts of its text, an end."""

    _MARK = re.compile(r"\\[\s\S]|</turn>\n|\n")

    def __init__(self):
        self.held, self.role = "", None

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        text, at = self.held + piece, 0
        while True:
            if self.role is None:  # at a header, which ends with an unescaped line end
                m = next((m for m in self._MARK.finditer(text, at + len(TURN)) if m[0] == "\n"), None)
                if not m:
                    break
                if not text.startswith(TURN, at):
                    raise ValueError("a turn must start with its mark")
                self.role, at = unescape(text[at + len(TURN) : m.start()]), m.end()
                yield "role", self.role
            m = next((m for m in self._MARK.finditer(text, at) if m[0] == END), None)
            if not m:
                # an escape or an end that may go on in the next piece stays
                keep = next((n for n in range(min(len(END), len(text) - at), 0, -1) if END.startswith(text[len(text) - n :])), 0)
                upto = len(text) - keep
                slashes = upto - at - len(text[at:upto].rstrip(ESCAPE))
                upto -= slashes % 2
                if upto > at:
                    yield "text", unescape(text[at:upto])
                    at = upto
                break
            yield "text", unescape(text[at : m.start()])
            yield "end", ""
            self.role, at = None, m.end()
        self.held = text[at:]


def digest(formatted: DataFrame) -> DataFrame:
    """What rendered rows say, read back from them, a row a conversation.

    A digest runs over a conversation's turns one after the other, so its rows pass through one task,
    a batch at a time: it takes rows that are rendered ``together``.
    """
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        conv, state = None, None

        def done():
            n, turns, chars, loss, size, reader = state
            if reader.held or reader.role is not None:
                raise ValueError(f"conversation {conv} ends inside a turn")
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=list(names))

        for b in batches:
            rows = []
            for c, piece, start, end in zip(*(b.column(k).to_pylist() for k in range(4))):
                if state is None or c != conv:
                    if state is not None:
                        rows.append(done())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, Reader()]
                for what, part in state[5].feed(piece):
                    state[0] += what == "end"
                    state[1].update((part if what == "text" else part + "\n").encode("utf-8", "surrogatepass"))
                if start is not None:
                    text = unescape(piece[start:end])
                    state[2] += len(text)
                    state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
            if rows:
                yield out(rows)
        if state is not None:
            yield out([done()])

    return map_arrow(formatted.select("conv_id", "piece", "loss_start", "loss_end"), run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digest(render(from_table(rows.unionByName(own)), together=True))
