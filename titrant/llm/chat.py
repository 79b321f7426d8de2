"""Chat formatting: minimum-cost role repair, then rendering.

A legal conversation has at most one system turn, at its start, and then user and assistant in turn, user first; it may
end with either. The automaton's state is the role of the last turn. Each input turn is kept, relabelled (``RELABEL``;
``UNKNOWN`` if its role is none of the three and it becomes user or assistant), merged into the turn before (``MERGE``, beside any relabelling) or
preceded by an empty turn of the missing role (``INSERT``); dynamic programming finds the cheapest legal sequence. Ties
go to the first of: keep or relabel, merge, insert; and to the roles in the order of ``ROLES``.

A conversation may be any share of the table. Rows are range-partitioned and sorted by conversation and turn, so a long
one lies in several partitions. Each partition sums up its first and its last conversation as a matrix of least costs
from state to state; these compose, and as there are two for each partition, the driver works out the
costs and then, going back, the states at partition borders. Each partition repairs its own rows between these, with the
same result as if the conversation were in one place.

The result has one row per input turn; ``piece`` is its share of the rendering (with any empty turn before it, or as a
continuation of the turn it is merged into), so a conversation's rendering is its pieces in order.

Edge cases: a null turn sorts first; turns with equal numbers are ordered by role, the text's hash and place; repeated rows are
turns of their own. A null conv_id is a conversation. A null or unknown role is relabelled, a null text is empty. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .storage import partitions_for, shared_folder

ROLES = ("system", "user", "assistant")
RELABEL, UNKNOWN, MERGE, INSERT = 4, 2, 1, 3
START, STATES = 0, 4  # state 1 + r: the last turn has role r
NEXT = {0: (0, 1), 1: (1,), 2: (2,), 3: (1,)}  # roles that may follow in each state
FAR = 1 << 50

Step = tuple[int, str, int, int]  # cost, action, role, inserted role or -1


def _steps() -> list[list[list[Step | None]]]:
    """For each input role (3: unknown), the cheapest step from state to state."""
    out = []
    for given in range(4):
        table: list[list[Step | None]] = [[None] * STATES for _ in range(STATES)]
        for s in range(STATES):
            options: list[Step] = []
            for role in range(3):
                change = 0 if role == given else UNKNOWN if given == 3 and ROLES[role] != "system" else RELABEL
                name = "keep" if role == given else "relabel"
                if role in NEXT[s]:
                    options.append((change, name, role, -1))
                if s == 1 + role:
                    options.append((change + MERGE, "merge", role, -1))
                options += [(change + INSERT, name, role, q) for q in NEXT[s] if role in NEXT[1 + q]]
            for step in options:
                old = table[s][1 + step[2]]
                if old is None or step[0] < old[0]:
                    table[s][1 + step[2]] = step
        out.append(table)
    return out


STEPS = _steps()


def role_number(role: str | None) -> int:
    return ROLES.index(role) if role in ROLES else 3


Matrix = list[list[int]]


def cost_matrix(roles: list[int]) -> Matrix:
    """Least costs from state to state over some turns."""
    out = [[0 if i == j else FAR for j in range(STATES)] for i in range(STATES)]
    for r in roles:
        table = STEPS[r]
        out = [[min((row[k] + table[k][j][0] for k in range(STATES) if table[k][j] and row[k] < FAR), default=FAR) for j in range(STATES)] for row in out]
    return out


def compose(a: Matrix, b: Matrix) -> Matrix:
    return [[min(FAR, min(a[i][k] + b[k][j] for k in range(STATES))) for j in range(STATES)] for i in range(STATES)]


def forward(roles: list[int], begin: list[int]) -> tuple[list[int], list[list[int]]]:
    """Least costs by state after some turns, from those before them; for each turn and state, the least state before it."""
    cost, back = begin, []
    for r in roles:
        table = STEPS[r]
        now, via = [FAR] * STATES, [-1] * STATES
        for j in range(STATES):
            for k in range(STATES):
                if table[k][j] and cost[k] < FAR and cost[k] + table[k][j][0] < now[j]:
                    now[j], via[j] = cost[k] + table[k][j][0], k
        back.append(via)
        cost = now
    return cost, back


OUTSET = [0 if s == START else FAR for s in range(STATES)]


def repair(roles: list[int], begin: list[int] | None = None, end: int | None = None) -> list[Step]:
    """The cheapest steps, given the costs by state before the first turn (none: the outset) and the last state (none: the cheapest)."""
    cost, back = forward(roles, begin or OUTSET)
    state = min(range(STATES), key=lambda s: cost[s]) if end is None else end
    out = []
    for r, via in zip(reversed(roles), reversed(back), strict=True):
        out.append(STEPS[r][via[state]][state])
        state = via[state]
    return out[::-1]


def entry_states(roles: list[int], begin: list[int]) -> list[int]:
    """For each last state, the state in which the cheapest way to it begins (-1: there is none)."""
    cost, back = forward(roles, begin)
    out = []
    for state in range(STATES):
        if cost[state] >= FAR:
            state = -1
        for via in reversed(back):
            state = via[state] if state >= 0 else -1
        out.append(state)
    return out


Border = tuple[int, object]  # a partition, and the key of its first or last conversation


def border_costs(segments: list[tuple[int, object, Matrix]]) -> dict[Border, tuple[list[int], list[int]]]:
    """For every border conversation, the costs by state before and after its rows in that partition. ``segments`` are in order of partition."""
    out: dict[Border, tuple[list[int], list[int]]] = {}
    costs, last = OUTSET, None
    for part, key, m in segments:
        before = costs if last is not None and last[0] == key else OUTSET
        costs, last = [min(FAR, min(before[k] + m[k][j] for k in range(STATES))) for j in range(STATES)], (key,)
        out[part, key] = (before, costs)
    return out


def border_ends(segments: list[Border], costs: dict[Border, tuple[list[int], list[int]]], entries: dict[Border, list[int]]) -> dict[Border, int]:
    """For every border conversation, the state after its rows in that partition, found from its last partition back."""
    out: dict[Border, int] = {}
    state, following = -1, None
    for part, key in reversed(segments):
        if following is None or following[0] != key:
            after = costs[part, key][1]
            state = min(range(STATES), key=lambda s: after[s])
        out[part, key] = state
        state, following = entries[part, key][state], (key,)
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[list]]]:
    """Conversations of a partition, in order, with their rows as columns."""
    key, held, any_row = None, [[], [], []], False
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for k, *row in zip(*columns, strict=True):
            if any_row and k != key:
                yield key, held
                held = [[], [], []]
            key, any_row = k, True
            for c, v in zip(held, row, strict=True):
                c.append(v)
    if any_row:
        yield key, held


def render(role: int, text: str, step: Step) -> str:
    if step[1] == "merge":
        return f"{text}\n"
    before = f"<|{ROLES[step[3]]}|>\n\n" if step[3] >= 0 else ""
    return f"{before}<|{ROLES[step[2]]}|>\n{text}\n"


def format_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, new_role, action, inserted_role, cost, piece`` for every row."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    rows = df.select(F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").alias("t"), F.col(f"`{role}`").alias("r"), F.col(f"`{text}`").alias("x"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.monotonically_increasing_id().alias("i"))
    # a checkpoint keeps partitions and their order, so both passes see the same ones, whatever executors are lost
    ordered = rows.repartitionByRange(partitions_for(rows), "c", "t", "r", "h", "i").sortWithinPartitions("c", "t", "r", "h", "i").drop("h", "i").checkpoint()

    key_field = T.StructField("c", ordered.schema["c"].dataType)
    summary = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("which", T.IntegerType()), key_field, T.StructField("m", T.ArrayType(T.LongType()))])
    summary_arrow = to_arrow_schema(summary)

    def edges(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
        """What ``work`` finds for the first and the last conversation of a partition, one row each."""
        part, first, last = TaskContext.get().partitionId(), None, None
        for n, (key, (_, roles, _)) in enumerate(_runs(batches)):
            last = (n, key, roles)
            first = first or last
        for which, got in ((0, first), (1, last)):
            if got is not None and (which == 0 or got[0] > 0):
                row = [part, which, got[1], work(part, got[1], [role_number(r) for r in got[2]])]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, summary_arrow, strict=True)], schema=summary_arrow)

    found = sorted(ordered.mapInArrow(lambda b: edges(b, lambda _part, _key, roles: [v for row in cost_matrix(roles) for v in row]), summary).collect(), key=lambda x: (x.part, x.which))
    segments = [(x.part, x.c) for x in found]
    costs = border_costs([(x.part, x.c, [list(x.m[STATES * i : STATES * (i + 1)]) for i in range(STATES)]) for x in found])
    entries = {(x.part, x.c): list(x.m) for x in ordered.mapInArrow(lambda b: edges(b, lambda part, key, roles: entry_states(roles, costs[part, key][0])), summary).collect()}
    ends = border_ends(segments, costs, entries)
    schema = T.StructType([
        T.StructField("conv_id", ordered.schema["c"].dataType), T.StructField("turn", ordered.schema["t"].dataType), T.StructField("role", T.StringType()), T.StructField("new_role", T.StringType()),
        T.StructField("action", T.StringType()), T.StructField("inserted_role", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("piece", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[list] = [[] for _ in schema]

        def flush() -> pa.RecordBatch:
            nonlocal held
            out = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(held, arrow, strict=True)], schema=arrow)
            held = [[] for _ in schema]
            return out

        for key, (turns, roles, texts) in _runs(batches):
            begin, end = costs[part, key][0] if (part, key) in costs else None, ends.get((part, key))
            for t, r, x, step in zip(turns, roles, texts, repair([role_number(r) for r in roles], begin, end), strict=True):
                values = (key, t, r, ROLES[step[2]], step[1], ROLES[step[3]] if step[3] >= 0 else None, step[0], render(step[2], x or "", step))
                for c, v in zip(held, values, strict=True):
                    c.append(v)
                if len(held[0]) >= 4096:
                    yield flush()
        if held[0]:
            yield flush()

    return ordered.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return format_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
