"""Repair of conversations: the cheapest edits after which the roles read as an optional system turn and then pairs of user and assistant.

Turns are kept (0), given the role user or assistant (2), deleted (3; blank and repeated ones always are), and empty turns are put in
between (2); a turn that breaks off costs 1 more unless it is deleted. Of equally cheap edits, those whose initials are
least in ASCII order win.

The edits of a run of turns are found depth first by branch and bound: an explicit stack of prefixes, lower bounds of what the
turns that are left cost, the best whole edit so far (cost, audit) as the incumbent, and a table for each node, a turn and a
state of the grammar, of the best prefix that came there. A prefix goes if its bound is no better than the incumbent or its
node has seen one as good; an empty stack proves the incumbent best.

A conversation of any length is cut into blocks of turns. Each block is solved on its own for all states it may be entered and
left in; blocks are then joined by one row each, and the edits go back to the turns by their places.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, map_arrow, written

BLOCK = 256
#: Costs of edits.
REROLE, DELETE, INSERT, BROKEN = 2, 3, 2, 1
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn; where a conversation may end.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
CACHE_ENTRIES = 20_000

_SPACE = " \t\n\x0b\x0c\r"
_FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_NEXT = (USER, USER, ASSISTANT, USER)  # the state that the one wanted role leads to
_NEVER = 1 << 60


def _steps(state: int, code: str) -> list[tuple[str, int, int]]:
    """Edits of a turn in a state: initial, cost, next state. Codes are s, u, a, or x for other roles, capital if the turn
    breaks off, and - for one that has to go."""
    steps = [("D", DELETE, state)]
    if code != "-":
        late, kind = BROKEN * code.isupper(), code.lower()
        if kind in _FOLLOWS[state]:
            steps.append(("K", late, _FOLLOWS[state][kind]))
        if _FOLLOWS[state].get(kind) != _NEXT[state]:
            steps.append(("R", REROLE + late, _NEXT[state]))
    return steps


_STEPS = {(state, code): _steps(state, code) for state in range(4) for code in "-suaxSUAX"}


def bounds(codes: str, goals: tuple[int, ...]) -> list[list[int]]:
    """What the turns from each place on cost at least, by state, if a goal is to be reached."""
    least = [[0 if q in goals else _NEVER for q in range(4)]]
    for code in (None, *reversed(codes)):
        if code is not None:
            after = least[-1]
            least.append([min(cost + after[to] for _, cost, to in _STEPS[q, code]) for q in range(4)])
        here = least[-1]
        here[USER] = min(here[USER], INSERT + here[ASSISTANT])
        for q in (ASSISTANT, START, SYSTEM):
            here[q] = min(here[q], INSERT + here[USER])
    return least[::-1]


def search(codes: str, entry: int, goals: tuple[int, ...] = ENDS, least: list[list[int]] | None = None) -> tuple[int, str, int] | None:
    """The cheapest edit of a run of turns: cost, audit and the goal it ends in; None if no goal can be reached."""
    least = least or bounds(codes, goals)
    if least[0][entry] >= _NEVER:
        return None
    incumbent: tuple[int, str, int] | None = None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, "", 0, entry)]
    while stack:
        cost, audit, at, state = stack.pop()
        bound = cost + least[at][state]
        if incumbent and (bound > incumbent[0] or (bound == incumbent[0] and audit >= incumbent[1])):
            continue
        if seen.get((at, state), (_NEVER, "")) <= (cost, audit):
            continue
        seen[at, state] = (cost, audit)
        if at == len(codes) and state in goals and (incumbent is None or (cost, audit) < incumbent[:2]):
            incumbent = (cost, audit, state)
        ways = [(INSERT + least[at][_NEXT[state]], "I", INSERT, at, _NEXT[state])]
        if at < len(codes):
            ways += [(more + least[at + 1][to], edit, more, at + 1, to) for edit, more, to in _STEPS[state, codes[at]]]
        ways.sort(reverse=True)  # the most promising one is popped first
        stack += [(cost + more, audit + edit, to_at, to) for promise, edit, more, to_at, to in ways if promise < _NEVER]
    return incumbent


def ways_through(codes: str, whole: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a block; of a whole conversation only the best one."""
    if whole:
        cost, audit, state = search(codes, START)
        return [(START, state, cost, audit)]
    found = []
    for goal in range(4):
        least = bounds(codes, (goal,))
        for entry in range(4):
            best = search(codes, entry, (goal,), least)
            if best:
                found.append((entry, goal, *best[:2]))
    return found


def edits_of(codes: str, entry: int, audit: str) -> list[tuple[str, int | None, str | None]]:
    """Edit, place of the turn (none for a new one) and new role (none if it stays) of each letter of an audit."""
    out, at, state = [], 0, entry
    for edit in audit:
        role = None
        if edit in "IR":
            state = _NEXT[state]
            role = "assistant" if state == ASSISTANT else "user"
        elif edit == "K":
            state = _FOLLOWS[state][codes[at].lower()]
        out.append((edit, None if edit == "I" else at, role))
        at += edit != "I"
    return out


def _blocks(batches: Iterator[pa.RecordBatch], part: int, size: int) -> Iterator[pa.RecordBatch]:
    """Sorted turns (key first) with their block, place and whether the block is all of its conversation for certain."""
    number, carry = part << 32, None

    def out(table: pa.Table, alone: bool) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        columns = [pa.array([number] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([alone] * n)]
        held = table.combine_chunks().to_batches()[0]
        yield pa.RecordBatch.from_arrays([*held.columns, *columns], names=[*held.schema.names, "block", "place", "alone"])

    whole = False  # whether the carried rows begin their conversation for certain; a range's first rows may not
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([carry, table]) if carry else table
        keys = table.column(0).to_pylist()
        starts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        for a, b in zip(starts, starts[1:]):
            ended, begins = b < len(keys), whole or a > 0
            while b - a > size or (ended and b > a):
                stop = min(b, a + size)
                yield from out(table.slice(a, stop - a), begins and ended and stop == b)
                number, a, begins = number + 1, stop, False
            if not ended:
                carry, whole = table.slice(a, b - a), begins
    if carry:
        yield from out(carry, False)


def placed(df: DataFrame, conv: str, turn: str, role: str, text: str, size: int = BLOCK) -> DataFrame:
    """key, turn, role, text, block, place and alone of every turn, dealt by ranges, so that a long conversation is cut.

    A copy's number is part of the order, so ranges also cut through equal rows.
    """
    key = conversation_key(F.col(conv))
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    given = df.select(key.alias("key"), F.col(turn).cast("long").alias("turn"), *said).withColumn("copy", F.monotonically_increasing_id())
    order = ["key", "turn", "role", "text", "copy"]
    kinds = "key string, turn long, role string, text string, block long, place int, alone boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks(batches, TaskContext.get().partitionId(), size)

    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy")
    return map_arrow(dealt, run, kinds)


def faults(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """key, block, place, alone, kind (s, u, a, x), code and fault (blank, duplicate, truncated or null) of every turn."""
    pos = (F.col("block") * size + F.col("place")).alias("pos")
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))).alias("same")
    firsts = turns.select("key", same, pos).groupBy("key", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    end = F.rtrim("text", F.lit(_SPACE))
    initial = F.substring("role", 1, 1)
    slim = turns.select(
        "key", "block", "place", "alone", pos, (end == "").alias("empty"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("broken"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("kind"),
    ).join(firsts, "pos", "left")
    fault = F.when(F.col("empty"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("broken"), "truncated")
    code = F.when(fault.isin("blank", "duplicate"), "-").when(F.col("broken"), F.upper("kind")).otherwise(F.col("kind"))
    return slim.select("key", "block", "place", "alone", "kind", fault.alias("fault"), code.alias("code"))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the ways through each block to rows of key, block, alone, kinds, codes, ..."""
    cache: dict = kept("repair", dict)
    for batch in batches:
        ways = []
        for alone, codes in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
            if (codes, alone) not in cache:
                if len(cache) >= CACHE_ENTRIES:
                    cache.clear()
                cache[codes, alone] = [dict(zip(("entry", "exit", "cost", "audit"), w, strict=True)) for w in ways_through(codes, alone)]
            ways.append(cache[codes, alone])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ways, _WAYS)], names=[*batch.schema.names, "ways"])


_WAYS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_EDITS = pa.list_(pa.struct([("edit", pa.string()), ("place", pa.int32()), ("role", pa.string())]))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order of conversation and block: the way taken through each, and illegal steps from one turn to the next.

    Of the blocks of a conversation only the best way to each exit is held.
    """
    key, states, held = None, {}, []

    def out() -> Iterator[pa.RecordBatch]:
        best = min((states[q], q) for q in ENDS if q in states)
        taken, q = [], best[1]
        for block, kinds, codes, by_exit, before in reversed(held):
            entry, cost, audit = by_exit[q]
            line = before + kinds
            illegal = sum(line[k : k + 2] not in ("su", "ua", "au") for k in range(len(line) - 1))
            edits = [dict(zip(("edit", "place", "role"), e, strict=True)) for e in edits_of(codes, entry, audit)]
            taken.append((block, cost, audit, illegal, edits))
            q = entry
        for k in range(0, len(taken), 100):
            block, cost, audit, illegal, edits = zip(*taken[k : k + 100], strict=True)
            columns = [pa.array([key] * len(block)), pa.array(block, pa.int64()), pa.array(cost, pa.int64()), pa.array(audit), pa.array(illegal, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(edits, _EDITS)], names=["key", "block", "cost", "audit", "illegal", "edits"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["key"] != key:
                if held:
                    yield from out()
                key, states, held = row["key"], {START: (0, "")}, []
            after: dict[int, tuple[int, str]] = {}
            by_exit: dict[int, tuple[int, int, str]] = {}
            for way in row["ways"]:
                if way["entry"] in states:
                    cost, audit = states[way["entry"]]
                    here = (cost + way["cost"], audit + way["audit"])
                    if way["exit"] not in after or here < after[way["exit"]]:
                        after[way["exit"]], by_exit[way["exit"]] = here, (way["entry"], way["cost"], way["audit"])
            before = held[-1][1][-1:] if held else ""
            held.append((row["block"], row["kinds"], row["codes"], by_exit, before))
            states = after
    if held:
        yield from out()


class Repair:
    """What ``repair`` found: ``conversations`` and ``turns``."""

    def __init__(self, conversations: DataFrame, turns: DataFrame):
        self.conversations, self.turns = conversations, turns


def conversation_key(conv: Column) -> Column:
    """The text that stands for a conversation's id in the results; empty for a null id."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", size: int = BLOCK) -> Repair:
    """Faults, the cheapest edits and the repaired turns of every conversation.

    ``conversations``: key (see ``conversation_key``), gaps, blank, duplicate, truncated, illegal, cost and audit, a row each.
    ``turns``: key, block and seq (their order), edit, role and text of every turn, kept, new or deleted ones.

    Turns stand in order of turn (nulls first), role, text. A null role or text is one space, a null id is a conversation of its
    own, and nulls in ``turn`` are not counted in gaps. Repeated rows are duplicates; an empty table gives no rows; other
    columns are not read. Texts of any length are only looked at from their end. A task holds a block of turns, or the best
    ways through the blocks of one conversation, which are as long as its audit.
    """
    turns = written(placed(df, conv, turn, role, text, size), "turns")
    found = faults(turns, size)
    letters = F.sort_array(F.collect_list(F.struct("place", "kind", "code")))
    counted = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    blocks = found.groupBy("key", "block").agg(letters.alias("letters"), F.bool_and("alone").alias("alone"), *counted)
    line = lambda name: F.array_join(F.transform("letters", lambda x: x[name]), "")
    slim = blocks.select("key", "block", "alone", line("kind").alias("kinds"), line("code").alias("codes"), "blank", "duplicate", "truncated")
    ways = T.ArrayType(T.StructType([
        T.StructField("entry", T.IntegerType()), T.StructField("exit", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
    ]))
    solved = written(map_arrow(slim, _solved, T.StructType([*slim.schema.fields, T.StructField("ways", ways)]), "repair"), "blocks")
    dealt = solved.select("key", "block", "kinds", "codes", "ways").repartition("key").sortWithinPartitions("key", "block")
    kinds = "key string, block long, cost long, audit string, illegal long, edits array<struct<edit: string, place: int, role: string>>"
    taken = written(map_arrow(dealt, _joined, kinds), "edits")

    pieces = F.sort_array(F.collect_list(F.struct("block", "audit")))
    told = taken.groupBy("key").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda x: x["audit"]), "").alias("audit"),
    )
    sums = solved.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    gaps = turns.groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    conversations = told.join(sums, "key").join(gaps, "key").select(
        "key", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )

    each = taken.select("key", "block", F.posexplode("edits").alias("seq", "e")).select("key", "block", "seq", "e.*")
    given = turns.select("block", "place", F.col("role").alias("was"), "text")
    stay = each.filter("place IS NOT NULL").join(given, ["block", "place"])
    stay = stay.select("key", "block", "seq", "edit", F.coalesce("role", "was").alias("role"), "text")
    new = each.filter("place IS NULL").select("key", "block", "seq", "edit", "role", F.lit("").alias("text"))
    return Repair(conversations, stay.unionByName(new))
