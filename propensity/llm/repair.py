"""Conversation structure repair by Knuth's lightest-derivation agenda.

Items are ``[i, state]``: the first i rows of a conversation are edited and the
roles written so far lead to ``state`` of the automaton of ``(s?(ua)+)?``.  Every
row gives a premise (its initial, its fault); a deduction takes an item and the
premise of row i to ``[i + 1, state']`` (Keep, Rerole, Delete), or an item alone to
``[i, state']`` (Insert).  A derivation weighs (cost, audit): the cost of its edits
and their initials in order.  A deduction adds to the cost or leaves it and appends
to the audit, so it is superior to its antecedents; two derivations of one item
with equal cost are never prefixes of one another (the letters fix rows, roles and
cost), so it is monotone too.  The agenda pops the lightest item, which is then
final; the first goal item popped is the cheapest repair with the least audit.  Of a
conversation in order only the n items on its path of Keeps are popped.

Rows are dealt by conversation and sorted by turn once; a window over the sorted
texts of a conversation marks the repeated ones.  A task reads its rows as a stream,
in segments of at most ``SEGMENT_ROWS`` rows and ``SEGMENT_BYTES`` of text: the four
end states of a segment, each finalised by the agenda, are the axioms of the next.
Whatever their audits share is written out, and only the difference is kept, so a
task holds one segment however long a conversation is.  (A digest over a whole
conversation reads its text in order, so one conversation is one task's stream.)

Defined cases: NULL roles and texts count as one space, NULL turns sort first,
rows of one turn are ordered by role and text; rows with a NULL conversation id
are one conversation; an empty role counts as a space (no place accepts it); other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_ROWS = 512
SEGMENT_BYTES = 8 << 20
SPACE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: state -> {initial of the next role: state after it}
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: state -> (state after, role) of a rerole or insert
GIVEN = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
GOALS = (START, ASSISTANT)
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
CLEAN, TRUNCATED, BLANK, DUPLICATE = range(4)


def fault(text: str, repeated: bool) -> int:
    """The first fault of a row."""
    body = text.rstrip(SPACE)
    if not body:
        return BLANK
    if repeated:
        return DUPLICATE
    return CLEAN if body[-1] in ".!?" else TRUNCATED


def lightest(premises: list[tuple[str, int]], axioms: list[tuple[int, str, int]], ends) -> dict:
    """Agenda over one segment.  ``premises``: (initial, fault) per row; ``axioms``:
    (cost, audit, state) before its first row.  Returns {state: (cost, audit, axiom's
    state, length of the axiom's audit)} for the end states; with ``ends`` (goal
    states) only the first of them that is popped."""
    n = len(premises)
    agenda = [(cost, audit, 0, state, state, len(audit)) for cost, audit, state in axioms]
    heapq.heapify(agenda)
    final, found = set(), {}
    push, pop = heapq.heappush, heapq.heappop
    while agenda:
        cost, audit, i, state, origin, own = pop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n:
            if ends is None or state in ends:
                found[state] = (cost, audit, origin, own)
                if ends is not None or len(found) == 4:
                    break
        after = GIVEN[state][0]
        if (i, after) not in final:
            push(agenda, (cost + INSERT_COST, audit + "I", i, after, origin, own))
        if i == n:
            continue
        initial, what = premises[i]
        if (i + 1, state) not in final:
            push(agenda, (cost + DELETE_COST, audit + "D", i + 1, state, origin, own))
        if what <= TRUNCATED:
            worse = TRUNCATED_COST if what else 0
            kept = NEXT[state].get(initial)
            if kept is not None and (i + 1, kept) not in final:
                push(agenda, (cost + worse, audit + "K", i + 1, kept, origin, own))
            if (i + 1, after) not in final:
                push(agenda, (cost + worse + REROLE_COST, audit + "R", i + 1, after, origin, own))
    return found


def apply_edits(rows: list[tuple[str, str]], state: int, edits: str):
    """(edit, role, text) of the rows that ``edits`` write, from ``state`` on."""
    at = 0
    for edit in edits:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = rows[at]
            state = NEXT[state][role[:1]]
        else:
            role, text = GIVEN[state][1], rows[at][1] if edit == "R" else ""
            state = GIVEN[state][0]
        at += edit != "I"
        yield edit, role, text


class _Conversation:
    """The running repair of one conversation: counts, open derivations, digests."""

    def __init__(self, key, sink):
        self.key, self.sink = key, sink
        self.rows, self.premises, self.bytes = [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.turn = self.before = None
        self.turns, self.any = 0, False
        self.written = []                               # audit letters that all derivations share
        self.open = {START: (0, "", sink.begin())}      # state -> (cost, audit left, its sink's state)

    def add(self, turn, role, text, repeated):
        self.any = True
        if turn is not None:
            if turn != self.turn:
                self.turns, self.turn = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial, what = role[:1] or " ", fault(text, repeated)
        self.blank += what == BLANK
        self.duplicate += what == DUPLICATE
        self.truncated += what == TRUNCATED
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.rows.append((role or " ", text))
        self.premises.append((initial, what))
        self.bytes += len(text)
        if len(self.rows) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES:
            self._segment(None)

    def _segment(self, ends):
        found = lightest(self.premises, [(c, a, s) for s, (c, a, _) in self.open.items()], ends)
        after = {state: (cost, audit, self.sink.extend(
                     self.open[origin][2], apply_edits(self.rows, origin, audit[own:])))
                 for state, (cost, audit, origin, own) in found.items()}
        audits = [a for _, a, _ in after.values()]
        first, last = min(audits), max(audits)
        shared = next((k for k, (x, y) in enumerate(zip(first, last)) if x != y), min(len(first), len(last)))
        self.written.append(first[:shared])
        self.open = {s: (c, a[shared:], sink) for s, (c, a, sink) in after.items()}
        self.rows, self.premises, self.bytes = [], [], 0

    def close(self):
        self._segment(GOALS)
        (cost, audit, sink), = self.open.values()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
                "".join(self.written) + audit, self.sink.end(sink))


class _Digest:
    """sha256 of the repaired ``role:text`` lines."""

    @staticmethod
    def begin():
        return hashlib.sha256(), False

    @staticmethod
    def extend(state, turns):
        digest, some = state[0].copy(), state[1]
        for _, role, text in turns:
            digest.update((("\n" if some else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
            some = True
        return digest, some

    @staticmethod
    def end(state):
        return state[0].hexdigest()


class _Turns:
    """The repaired turns themselves."""

    @staticmethod
    def begin():
        return ()

    @staticmethod
    def extend(state, turns):
        return state, list(turns)                       # linked: end states share what came before

    @staticmethod
    def end(state):
        parts = []
        while state:
            state, part = state
            parts.append(part)
        return [turn for part in reversed(parts) for turn in part]


def _stream(batches, sink):
    """Reports of the conversations of a sorted task, one after another."""
    now = None
    for batch in batches:
        keys, turns, roles, texts, seen, gone = (c.to_pylist() for c in batch.columns)
        for key, turn, role, text, repeated, absent in zip(keys, turns, roles, texts, seen, gone):
            if now is None or key != now.key:
                if now is not None:
                    yield now.close()
                now = _Conversation(key, sink)
            if not absent:
                now.add(turn, role, text, repeated)
    if now is not None:
        yield now.close()


REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
_BLOCK = 4096


def _report(schema):
    def run(batches):
        block = []
        for row in _stream(batches, _Digest):
            block.append(row)
            if len(block) == _BLOCK:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block), schema.types)],
                                                 schema=schema)
                block = []
        if block:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block), schema.types)],
                                             schema=schema)
    return run


def _turns(schema):
    def run(batches):
        for key, *_, turns in _stream(batches, _Turns):
            for at in range(0, len(turns), _BLOCK):
                part = turns[at:at + _BLOCK]
                columns = [[key] * len(part), range(at, at + len(part)), *zip(*part)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)],
                                                 schema=schema)
    return run


def _ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str, absent: Column | None) -> DataFrame:
    gone = F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))
    plain = rows.select(
        F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").cast("long").alias("_turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("_role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("_text"), gone.alias("_gone"))
    same = Window.partitionBy("_conv", "_gone", "_role", "_text").orderBy(F.asc_nulls_first("_turn"))
    order = ["_conv", F.asc_nulls_first("_turn"), "_role", "_text", "_seen"]
    return (plain.repartition("_conv").withColumn("_seen", F.row_number().over(same) > 1)
            .sortWithinPartitions(*order).select("_conv", "_turn", "_role", "_text", "_seen", "_gone"))


def _schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", absent: Column | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair's cost and audit, and
    the digest of the repaired lines.  Rows for which ``absent`` holds only name
    their conversation."""
    sorted_rows = _ordered(rows, conv, turn, role, text, absent)
    ddl = f"{conv} {sorted_rows.schema['_conv'].dataType.simpleString()}, {REPORT}"
    return sorted_rows.mapInArrow(_report(_schema(rows.sparkSession, ddl)), ddl)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", absent: Column | None = None) -> DataFrame:
    """The repaired conversations: conversation id, position (from 0), edit (K, R or
    I), role, text.  Holds the texts of one conversation at a time."""
    sorted_rows = _ordered(rows, conv, turn, role, text, absent)
    ddl = (f"{conv} {sorted_rows.schema['_conv'].dataType.simpleString()}, position long, "
           "edit string, role string, text string")
    return sorted_rows.mapInArrow(_turns(_schema(rows.sparkSession, ddl)), ddl)


def damage(rows: DataFrame, kinds: int = 20) -> DataFrame:
    """Reproducible faults by crc32(``conv_id:turn``) modulo ``kinds``: 0 marks the row
    dropped (``dropped``), 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it,
    4 makes it the user's.  NULLs count as one space."""
    space = F.lit(" ")
    shown = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % kinds
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind"))
            .select("conv_id", "turn",
                    F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_kind") <= 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    (F.col("_kind") == 0).alias("dropped"),
                    F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2)))
                              .otherwise(F.array(F.lit(1)))).alias("_copy"))
            .drop("_copy"))
