"""Chat formatting: the cheapest repair of the roles, then the rendered turns.

Legal chats are an automaton: at the start the system or the user may speak, after the
system the user, after the user the assistant, after the assistant the user; a chat ends
after the assistant. For each turn the repair keeps or relabels its role, merges it into the
turn before if that has the role, or puts an empty turn before it. Costs add up, and dynamic
programming over the automaton's states finds the least.

A turn is a matrix over (min, +), so a chat may be cut anywhere: each part of a partition
gives the product of its turns' matrices, the few chats that lie across partitions are put
together from those, and each part is then traced back by itself. Turns are sorted by range,
so not even a chat that holds a third of all turns comes together in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import cut_lineage, ship_code

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
RELABEL, MERGE, INSERT = 2, 1, 3
_FAR = 1 << 40
#: Speaker that may follow a state, and the state after it.
_LEGAL = {START: {0: SYSTEM, 1: USER}, SYSTEM: {1: USER}, USER: {2: ASSISTANT}, ASSISTANT: {1: USER}}
_SPEAKER = {SYSTEM: 0, USER: 1, ASSISTANT: 2}

OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"
TURN = "conv_id {conv}, turn {turn}, role string, copies long, new_role string, merged boolean, inserted string, cost long, rendered string, seq long"


@dataclass(frozen=True)
class Move:
    cost: int
    after: int
    role: int
    merged: bool
    inserted: int  # a role, -1 for none


def moves(state: int, role: int) -> list[Move]:
    """Ways to take a turn of a role (-1: none of the known) in a state, cheapest first."""
    found = []
    for new in range(3):
        cost = 0 if new == role else RELABEL
        if _SPEAKER.get(state) == new:
            found.append(Move(cost + MERGE, state, new, True, -1))
        if new in _LEGAL[state]:
            found.append(Move(cost, _LEGAL[state][new], new, False, -1))
        else:
            for empty, middle in _LEGAL[state].items():
                if new in _LEGAL[middle]:
                    found.append(Move(cost + INSERT, _LEGAL[middle][new], new, False, empty))
    return sorted(found, key=lambda m: (m.cost, m.merged, m.inserted, m.role))


#: Best move by role, state and next state.
_BEST: dict[int, list[list[Move | None]]] = {}
for _role in range(-1, 3):
    _BEST[_role] = [[next((m for m in moves(s, _role) if m.after == e), None) for e in range(STATES)] for s in range(STATES)]
#: Cost of ending a chat in a state; after the system both empty turns are needed.
ENDING = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
_LAST = {SYSTEM: (1, 2), USER: (2,)}


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES else -1


def step(costs: list[int], role: int) -> list[int]:
    """Least cost of each state after one more turn."""
    best = _BEST[role]
    return [min((costs[s] + best[s][e].cost for s in range(STATES) if best[s][e] is not None and costs[s] < _FAR), default=_FAR) for e in range(STATES)]


def segment_matrix(roles: list[int]) -> list[list[int]]:
    rows = []
    for s in range(STATES):
        costs = [_FAR] * STATES
        costs[s] = 0
        for r in roles:
            costs = step(costs, r)
        rows.append(costs)
    return rows


def trace(roles: list[int], first: int, last: int) -> list[Move]:
    """The moves of the cheapest way from one state to another; of equal ways always the same."""
    table = [[_FAR] * STATES]
    table[0][first] = 0
    for r in roles:
        table.append(step(table[-1], r))
    out, e = [], last
    for i in range(len(roles) - 1, -1, -1):
        best = _BEST[roles[i]]
        s = min((s for s in range(STATES) if best[s][e] is not None and table[i][s] < _FAR), key=lambda s: (table[i][s] + best[s][e].cost, s))
        out.append(best[s][e])
        e = s
    return out[::-1]


def best_end(costs: list[int]) -> int:
    return min(range(STATES), key=lambda e: (costs[e] + ENDING[e], e))


def _path(matrices: list[list[list[int]]]) -> list[tuple[int, int]]:
    """First and last state of each part of a chat, from the parts' matrices in order."""
    table = [[0 if s == START else _FAR for s in range(STATES)]]
    for m in matrices:
        table.append([min(table[-1][s] + m[s][e] for s in range(STATES)) for e in range(STATES)])
    e = best_end(table[-1])
    out = []
    for i in range(len(matrices) - 1, -1, -1):
        s = min(range(STATES), key=lambda s: (table[i][s] + matrices[i][s][e], s))
        out.append((s, e))
        e = s
    return out[::-1]


def _segments(batches):
    """Rows of a sorted partition by chat: (conv_id, rows)."""
    held, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if rows and row[0] != held:
                yield held, rows
                rows = []
            held = row[0]
            rows.append(row)
    if rows:
        yield held, rows


def repair(turns: DataFrame) -> DataFrame:
    """One row per distinct turn (conv_id, turn, role, text) with its repair and rendering.

    Turns go by number, then role, then text. Rows equal in all four are one turn; `copies`
    says how many. Role names are taken without case; a null or unknown role has to be
    relabelled. A null text is empty; rows without conv_id are one chat. `rendered` is what
    the turn adds to its chat: an inserted empty turn, the role's head unless it is merged
    (then a line end), the text, and the end mark once the next turn isn't merged; the
    chat's rendering is these in the order of `seq`. `merged` turns belong to the turn before. Other
    columns don't matter; no rows give no rows.
    """
    spark = turns.sparkSession
    ship_code(spark)
    kinds = dict(turns.dtypes)
    known = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    order = ["conv_id", "turn", "role", "h", "text"]
    ranged = known.withColumn("h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_turns = cut_lineage(ranged.select("conv_id", "turn", "role", "text", "copies"))

    schema = pa.schema([("part", pa.int64()), ("edge", pa.bool_()), ("matrix", pa.list_(pa.int64())), ("conv", pa.string())])

    def ends(batches):
        """Matrices of the first and the last chat of a partition; others are whole."""
        part = TaskContext.get().partitionId()
        first = last = None
        for conv, rows in _segments(batches):
            m = segment_matrix([role_number(r[2]) for r in rows])
            last = (conv, m)
            first = first or last
        for edge, found in ((False, first), (True, last)):
            if found and not (edge and last is first):
                yield pa.RecordBatch.from_pylist([{"part": part, "edge": edge, "matrix": sum(found[1], []), "conv": repr(found[0])}], schema=schema)

    told = sorted_turns.mapInArrow(ends, "part long, edge boolean, matrix array<long>, conv string").orderBy("part", "edge").collect()
    # Chats across partitions: at most one begins in each, so this is as small as they are few.
    plan: dict[tuple[int, str], tuple[int, int, bool, bool]] = {}
    at = 0
    while at < len(told):
        run = [told[at]]
        while at + len(run) < len(told) and told[at + len(run)].conv == run[0].conv:
            run.append(told[at + len(run)])
        if len(run) > 1:
            square = [[r.matrix[4 * i : 4 * i + 4] for i in range(4)] for r in run]
            for i, (r, (s, e)) in enumerate(zip(run, _path(square))):
                plan[r.part, r.conv] = (s, e, i == 0, i == len(run) - 1)
        at += len(run)
    # Whether the part after a cut begins with a merged turn isn't known yet; it writes the
    # end mark of the turn before itself.
    shared = spark.sparkContext.broadcast(plan)
    out_schema = TURN.format(conv=kinds["conv_id"], turn=kinds["turn"])
    names = [c.split()[0] for c in out_schema.split(", ")]

    def render(batches):
        part = TaskContext.get().partitionId()
        types = None
        waiting: list[tuple] = []
        seq = part << 33
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field(0).type, first.schema.field(1).type, pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def all_batches():
            yield first
            yield from batches

        for conv, rows in _segments(all_batches()):
            roles = [role_number(r[2]) for r in rows]
            s, e, begins, closes = shared.value.get((part, repr(conv)), (START, None, True, True))
            if e is None:
                costs = [_FAR] * STATES
                costs[START] = 0
                for r in roles:
                    costs = step(costs, r)
                e = best_end(costs)
            way = trace(roles, s, e)
            for i, (row, m) in enumerate(zip(rows, way)):
                text = "\n" if m.merged else ("" if begins and i == 0 else CLOSE)
                if m.inserted >= 0:
                    text += OPEN.format(ROLES[m.inserted]) + CLOSE
                if not m.merged:
                    text += OPEN.format(ROLES[m.role])
                text += row[3] or ""
                cost = m.cost
                if closes and i == len(rows) - 1:
                    text += CLOSE + "".join(OPEN.format(ROLES[r]) + CLOSE for r in _LAST.get(e, ()))
                    cost += ENDING[e]
                waiting.append((row[0], row[1], row[2], row[4], ROLES[m.role], m.merged, ROLES[m.inserted] if m.inserted >= 0 else None, cost, text, seq))
                seq += 1
            if len(waiting) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), types)], names)
                waiting.clear()
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), types)], names)

    return sorted_turns.mapInArrow(render, out_schema)
