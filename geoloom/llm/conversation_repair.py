"""Repair of the structure of conversations by a rank-compressed dynamic programme.

A repair edits each turn (Keep, Rerole, Delete) and may Insert empty turns before it, so that the roles read
(s?(ua)+)?. One macro edit, a run of inserts with the edit of the turn after it, is one letter of an alphabet of codes,
none of which begins another: comparing audits is comparing their codes one after the other. So a layer of the programme
needs no audit strings. It holds, for each state of the grammar, the least cost and the rank of its audit among the
layer's; costs are counted from the least of them. There are few such layers, each made once and numbered, and a turn is
a step from a number to a number. Parent pointers belong to the steps, and the audit is read off them at the end.

Rows are dealt out by conversation, sorted, and streamed: first the facts of its turns, then the texts. A task holds a
few bytes for each turn of the conversation at hand, and never its texts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Stage, pick, released

#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, or the role of the last turn; the role of the next turn by the state before it, and the states that a kept turn leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
TURN = (USER, USER, ASSISTANT, USER)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The macro edits in their order; two inserts go round the grammar's loop, so more are never cheaper.
RUN = 2
CODES = sorted("I" * k + edit for k in range(RUN + 1) for edit in "DKR")
#: From any state the turns to come cost at most so much more than from any other: inserts that make its last role the other's, or a system turn deleted. States that cost more than the least and this are on no cheapest way, and without them there are few layers.
FARTHEST = RUN * INSERT + DELETE
#: Faults of a turn.
NONE, BLANK, DUPLICATE, CUT = range(4)
# White space, ends of sentences, initials of roles, pairs of them that may follow each other.
SPACE, STOPS, INITIALS, LEGAL = " \t\n\x0b\x0c\r", ".?!", "sua", {"su", "ua", "au"}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Rows and bytes of a batch of results.
BATCH_ROWS, BATCH_BYTES = 4096, 1 << 22

#: For each state (least cost, rank of its audit), or None where it cannot be.
Layer = tuple[tuple[int, int] | None, ...]


def step(layer: Layer, initial: str, fault: int) -> tuple[Layer, int, tuple]:
    """(the layer after a turn, the cost from which its costs count, for each of its states the parent state and macro edit)."""
    reached: list[list[tuple[int, int, int, int]]] = [[] for _ in layer]
    for parent, at in enumerate(layer):
        if at is None:
            continue
        state = parent
        for k in range(RUN + 1):
            edits = [("D", state, DELETE)]
            if fault in (NONE, CUT):
                stays = TRUNCATED if fault == CUT else 0
                edits.append(("R", TURN[state], stays + REROLE))
                if (state, initial) in KEPT:
                    edits.append(("K", KEPT[state, initial], stays))
            for edit, to, price in edits:
                reached[to].append((at[0] + k * INSERT + price, at[1], CODES.index("I" * k + edit), parent))
            state = TURN[state]
    least = min(min(x) for x in reached if x)[0]
    best = [min(x) if x and min(x)[0] <= least + FARTHEST else None for x in reached]
    ranks = {audit: i for i, audit in enumerate(sorted({b[1:3] for b in best if b}))}
    return tuple(b and (b[0] - least, ranks[b[1:3]]) for b in best), least, tuple(b and (b[3], b[2]) for b in best)


def ending(layer: Layer) -> tuple[int, int, int]:
    """(cost, state, inserts after the last turn) of the cheapest end, with the least audit of several."""
    ends = []
    for last, at in enumerate(layer):
        state = last
        for k in range((RUN + 1) if at else 0):
            if state in (START, ASSISTANT):
                ends.append((at[0] + k * INSERT, at[1], k, last))
            state = TURN[state]
    cost, _, k, last = min(ends)
    return cost, last, k


class Automaton:
    """Layers by number, and the steps between them, made when first taken."""

    def __init__(self):
        first: Layer = ((0, 0), None, None, None)
        self.layers, self.numbers, self.steps = [first], {first: 0}, {}

    def take(self, layer: int, turn: int) -> tuple[int, int, tuple]:
        """(number of the next layer, cost, parents). turn: four times the place of its initial in INITIALS (3 for others) and its fault."""
        found = self.steps.get((layer, turn))
        if found is None:
            to, cost, parents = step(self.layers[layer], (*INITIALS, "")[turn >> 2], turn & 3)
            number = self.numbers.setdefault(to, len(self.layers))
            if number == len(self.layers):
                self.layers.append(to)
            found = self.steps[layer, turn] = number, cost, parents
        return found


class Conversation:
    """One conversation: the facts of its turns in order, then their texts in the same order."""

    def __init__(self, automaton: Automaton, conv_id):
        self.automaton, self.conv_id = automaton, conv_id
        self.turns, self.layers, self.layer, self.cost = bytearray(), array("H"), 0, 0
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.first, self.last, self.distinct = None, None, 0
        self.codes: bytearray | None = None
        self.at, self.state, self.place = 0, START, 0

    def _turn(self, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        turn = 4 * (INITIALS.index(initial) if initial and initial in INITIALS else 3) + fault
        self.turns.append(turn)
        self.layers.append(self.layer)
        self.layer, cost, _ = self.automaton.take(self.layer, turn)
        self.cost += cost

    def fact(self, turn, role: str, fault: int, opens: bool, copies: int) -> None:
        """Equal rows of one turn; opens: none of an earlier turn has their role and text."""
        if turn is not None:
            self.distinct += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        for k in range(copies):
            self._turn(role[:1], fault if fault == BLANK or (opens and k == 0) else DUPLICATE)

    def solve(self) -> None:
        """Reads the macro edits off the parent pointers."""
        cost, state, self.tail = ending(self.automaton.layers[self.layer])
        self.cost += cost
        self.codes = bytearray(len(self.turns))
        for i in range(len(self.turns) - 1, -1, -1):
            state, self.codes[i] = self.automaton.take(self.layers[i], self.turns[i])[2][state]

    def _inserted(self, k: int) -> Iterator[tuple]:
        for _ in range(k):
            self.state = TURN[self.state]
            yield "I", ROLES[self.state], b""

    def text(self, role: str, text: bytes) -> Iterator[tuple]:
        """(edit, role, text) of what the repair makes of the next turn."""
        if self.codes is None:
            self.solve()
        code = CODES[self.codes[self.at]]
        self.at += 1
        yield from self._inserted(len(code) - 1)
        if code[-1] == "R":
            self.state = TURN[self.state]
            yield "R", ROLES[self.state], text
        elif code[-1] == "K":
            self.state = KEPT[self.state, role[:1]]
            yield "K", role, text

    def close(self) -> Iterator[tuple]:
        if self.codes is None:
            self.solve()
        yield from self._inserted(self.tail)

    def report(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit)"""
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, self.cost, "".join(CODES[c] for c in self.codes) + "I" * self.tail


def _walked(batches) -> Iterator[tuple]:
    """(conversation, edit, role, text) for each turn of the repaired conversations, and (conversation, None, None, None) after each one's last."""
    automaton, now = Automaton(), None
    for batch in batches:
        ids, kinds, turns, roles, faults, opens, copies = (batch.column(i).to_pylist() for i in range(7))
        texts = batch.column(7).cast(pa.binary())
        for i, conv_id in enumerate(ids):
            if now is None or conv_id != now.conv_id:
                if now:
                    yield from ((now, *x) for x in now.close())
                    yield now, None, None, None
                now = Conversation(automaton, conv_id)
            if kinds[i] == 1:
                now.fact(turns[i], roles[i], faults[i], opens[i], copies[i])
            elif kinds[i] == 2:
                yield from ((now, *x) for x in now.text(roles[i], texts[i].as_py()))
    if now:
        yield from ((now, *x) for x in now.close())
        yield now, None, None, None


def _batches(rows: Iterator[tuple], schema: pa.Schema, sizes: int):
    """Batches of rows; sizes: the column whose lengths count as bytes."""
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += len(row[sizes])
        if len(kept) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), schema.types, strict=True)], schema.names)
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), schema.types, strict=True)], schema.names)


def _reports(kind: pa.DataType):
    schema = pa.schema([("conv_id", kind), *((k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def rows(batches):
        digest = hashlib.sha256()
        for now, edit, role, text in _walked(batches):
            if edit is None:
                yield now.conv_id, *now.report(), digest.hexdigest()
                digest = hashlib.sha256()
            else:
                digest.update(b"\n" * (now.place > 0) + role.encode() + b":")
                digest.update(text)
                now.place += 1

    return released(lambda batches: _batches(rows(batches), schema, 7))


def _turns(kind: pa.DataType):
    schema = pa.schema([("conv_id", kind), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.binary())])

    def rows(batches):
        for now, edit, role, text in _walked(batches):
            if edit:
                yield now.conv_id, now.place, edit, role, text
                now.place += 1

    return released(lambda batches: _batches(rows(batches), schema, 4))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with faults put in by crc32 of `conv_id:turn` modulo 20, nulls read as one space: 0 drops a row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes its role `user`."""
    base = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")))
    base = base.withColumn("fault", F.crc32(key) % 20).where("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(F.coalesce("text", F.lit(" ")), "[.!?]", "")).otherwise(F.coalesce("text", F.lit(" ")))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    return base.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))).drop("col")


def _streamed(conversations: DataFrame, ids: DataFrame | None) -> DataFrame:
    """What _walked() reads, by conversation: (conv_id, kind, turn, role, fault, opens, copies, text), kind 1 for facts and 2 for texts, both by turn (nulls first), role and digest of the text; kind 0 for each of ids."""
    base = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    base = base.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    ended = F.rtrim("text", F.lit(SPACE))
    fault = F.when(ended == "", BLANK).when(F.right(ended, F.lit(1)).isin(*STOPS), NONE).otherwise(CUT)
    texts = base.withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = Stage(conversations.sparkSession, "repair").table(texts.withColumn("fault", fault).groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.count("*").alias("copies")))
    # The first turn of each role and text is marked by one row more that counts for nothing, so no key has to be joined or gathered.
    first = rows.groupBy("conv_id", "role", "digest", "fault").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    marks = first.select("conv_id", F.col("first.turn").alias("turn"), "role", "digest", "fault", F.lit(0).cast("long").alias("copies"), F.lit(True).alias("opens"))
    facts = rows.withColumn("opens", F.lit(False)).unionByName(marks).groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").alias("copies"), F.max("opens").alias("opens"))
    columns = {"kind": "int", "turn": "long", "role": "string", "digest": "binary", "fault": "int", "opens": "boolean", "copies": "long", "text": "string"}
    every = None
    for kind, part in enumerate((ids, facts, texts)):
        if part is not None:
            part = part.withColumn("kind", F.lit(kind))
            part = part.select("conv_id", *(F.col(c) if c in part.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()))
            every = part if every is None else every.unionByName(part)
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "role", "digest")]
    return every.repartition("conv_id").sortWithinPartitions(*keys).select("conv_id", "kind", "turn", "role", "fault", "opens", "copies", "text")


def _kind(df: DataFrame) -> tuple[str, pa.DataType]:
    kind = df.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) of the repaired conversations: place from 0 without gaps, edit K, R or I. The rules are those of repair_report()."""
    name, kind = _kind(conversations)
    out = _streamed(conversations, None).mapInArrow(_turns(kind), f"conv_id {name}, place long, edit string, role string, text binary")
    return out.withColumn("text", F.decode("text", "UTF-8"))


def repair_report(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row for each conversation of conversations, and of ids if given: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns come in order of turn, nulls first; those of one turn in order of role and of their texts' digests. Null roles
    and texts count as one space, so a null text is blank and a null role can only be changed or deleted. Rows with a null
    conv_id are a conversation of their own. Repeated rows are duplicates. Conversations of ids without rows have zeros, an
    empty audit and the digest of the empty string. Extra columns are ignored; empty tables give an empty result.

    A conversation's digest and audit are made by one task, as both are values of one row; it holds five bytes a turn for them.
    """
    name, kind = _kind(conversations)
    schema = f"conv_id {name}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _streamed(conversations, None if ids is None else ids.select("conv_id").distinct()).mapInArrow(_reports(kind), schema)
