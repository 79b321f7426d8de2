"""Structure repair of damaged conversations: cheapest edits, and of these the least in order of letters.

A repaired conversation's role initials are nothing, or pairs of user and assistant after at most one system turn. Rows
are kept (no cost, only where the role's initial may follow), reroled to user or assistant, or deleted; empty turns of
user or assistant are inserted anywhere. Blank and duplicate rows must be deleted; a truncated row costs ``TRUNCATED``
more unless it is.

Method: nodes are (rows consumed, role of the last turn), arcs are edits. Least costs forward from the outset and
backward from the end tell the optimal arcs: those whose two costs and own cost add up to the whole cost. Along these
tight arcs, starting from the outset, the set of nodes that the letters so far lead to (the frontier) moves over the
least letter that leaves it, until the end.

A conversation may be any share of the table. Rows are range-partitioned and sorted, so a long one lies in several
partitions. Each partition sums up its first and last conversation as a matrix of least costs; the driver composes
these, two for each partition, into the costs forward and backward at partition borders. A second pass finds, for each
frontier in which a border conversation may enter a partition, the one in which it leaves. With these the last pass
repairs every partition by itself. What conversations in several partitions give is then put in order; their digest,
which by its definition takes one byte after the other, is computed as the pieces stream by, and only the letters of
their edits are held together, as they are one value of the result.

Edge cases: conversations are those of the rows before the damage; one without a row left has zeros, an empty audit and
the digest of nothing. Null roles and texts are one space, a null turn or conv_id is one space in the key of the damage;
null turns come first, a null conv_id is a conversation of its own. Rows with equal turns are ordered by role and then
the text's digest; of rows equal in all of these, the later ones are duplicates. A role's initial is its first letter;
an empty role has none and fits nowhere. Texts are taken whole, however long. An empty table gives no rows. Further
columns don't matter, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .storage import partitions_for, settled, shared_folder

BLANKS = " \t\n\x0b\x0c\r"
CLOSERS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
CYCLE = 20
GOOD, BLANK, DUPLICATE, CUT = range(4)

OUTSET, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEXT = {(OUTSET, "s"): SYSTEM, (OUTSET, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (OUTSET, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}
FAR = 1 << 60

Arc = tuple[str, int, int, str]  # letter, cost, state after, initial of the new turn ("" if there is none)
Row = tuple[str, int]  # initial, fault

INSERTS: dict[int, list[Arc]] = {s: [("I", INSERT, t, c) for (s0, c), t in NEXT.items() if s0 == s and c in NAMES] for s in range(STATES)}


def row_arcs(state: int, initial: str, fault: int) -> list[Arc]:
    """The edits of a row in a state."""
    out: list[Arc] = [("D", DELETE, state, "")]
    if fault in (BLANK, DUPLICATE):
        return out
    more = TRUNCATED if fault == CUT else 0
    if (state, initial) in NEXT:
        out.append(("K", more, NEXT[state, initial], initial))
    return out + [("R", REROLE + more, t, c) for (s, c), t in NEXT.items() if s == state and c in NAMES]


ARCS = {(s, i, f): row_arcs(s, i, f) for s in range(STATES) for i in ("s", "u", "a", "") for f in range(4)}

Vector = list[int]
Matrix = list[Vector]


def inserted(cost: Vector) -> Vector:
    """Least costs by state with any insertions after them."""
    out = list(cost)
    for _ in range(STATES):
        for s in range(STATES):
            for _, c, t, _ in INSERTS[s]:
                out[t] = min(out[t], out[s] + c)
    return out


def uninserted(cost: Vector) -> Vector:
    """Least costs from each state on, with any insertions before what ``cost`` is counted from."""
    out = list(cost)
    for _ in range(STATES):
        for s in range(STATES):
            out[s] = min([out[s], *[c + out[t] for _, c, t, _ in INSERTS[s]]])
    return out


def forward(rows: list[Row], begin: Vector) -> list[Vector]:
    """Least costs to each state before every row and at the end."""
    out = [inserted(begin)]
    for initial, fault in rows:
        now = [FAR] * STATES
        for s, cost in enumerate(out[-1]):
            for _, c, t, _ in ARCS[s, initial, fault]:
                now[t] = min(now[t], cost + c)
        out.append(inserted(now))
    return out


def backward(rows: list[Row], end: Vector) -> list[Vector]:
    """Least costs from each state on, before every row and at the end."""
    out = [uninserted(end)]
    for initial, fault in reversed(rows):
        after = out[-1]
        out.append(uninserted([min(c + after[t] for _, c, t, _ in ARCS[s, initial, fault]) for s in range(STATES)]))
    return out[::-1]


FIRST: Vector = [0 if s == OUTSET else FAR for s in range(STATES)]
LAST: Vector = [0 if s in ENDS else FAR for s in range(STATES)]


def traversed(rows: list[Row], before: list[Vector], after: list[Vector], frontier: frozenset[int], ends: bool) -> tuple[list[Arc], frozenset[int]]:
    """The edits along the least letters, and the frontier behind the last row. ``ends``: whether the conversation does, so that insertions may follow.

    A letter leads from a state to one state only (who may speak next follows from who spoke last), so an edit is known
    from its letter and the frontier.
    """
    total = min(b + a for b, a in zip(before[0], after[0], strict=True))
    out: list[Arc] = []
    i = 0
    while True:
        if i == len(rows):
            if not ends or any(s in ENDS and before[i][s] == total for s in frontier):
                return out, frontier
            arcs = [(*x, s, i) for s in frontier for x in INSERTS[s]]
        else:
            arcs = [(*x, s, i + 1) for s in frontier for x in ARCS[(s, *rows[i])]] + [(*x, s, i) for s in frontier for x in INSERTS[s]]
        tight = [x for x in arcs if before[i][x[4]] + x[1] + after[x[5]][x[2]] == total]
        least = min(x[0] for x in tight)
        chosen = [x for x in tight if x[0] == least]
        out.append(chosen[0][:4])
        frontier = frozenset(x[2] for x in chosen)
        i = chosen[0][5]


def cost_matrix(rows: list[Row]) -> Matrix:
    return [forward(rows, [0 if i == j else FAR for j in range(STATES)])[-1] for i in range(STATES)]


Border = tuple[int, object]  # a partition, and the key of its first or last conversation


def border_costs(segments: list[tuple[int, object, Matrix]]) -> dict[Border, tuple[Vector, Vector, bool, bool]]:
    """For each segment of a border conversation, in order of partition: costs to the states before it, costs from the states behind it on, whether it is the first, whether it is the last."""
    n = len(segments)
    same = [k > 0 and segments[k][1] == segments[k - 1][1] for k in range(n + 1) if k < n] + [False]
    starts: list[Vector] = []
    for k, _ in enumerate(segments):
        m = segments[k - 1][2] if same[k] else None
        starts.append([min(FAR, min(starts[k - 1][i] + m[i][j] for i in range(STATES))) for j in range(STATES)] if m else FIRST)
    ends: list[Vector] = [LAST] * n
    for k in range(n - 2, -1, -1):
        if same[k + 1]:
            m = segments[k + 1][2]
            ends[k] = [min(FAR, min(m[i][j] + ends[k + 1][j] for j in range(STATES))) for i in range(STATES)]
    return {(part, key): (starts[k], ends[k], not same[k], not same[k + 1]) for k, (part, key, _) in enumerate(segments)}


def damaged(df: DataFrame) -> DataFrame:
    """``c, t, r, x, copies`` of each row after the damage (0 copies: dropped, only the conversation is left)."""
    rows = df.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.coalesce("role", F.lit(" ")).alias("r"), F.coalesce("text", F.lit(" ")).alias("x"))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(named("c"), F.lit(":"), named("t")).cast("binary")), F.lit(CYCLE))
    rows = rows.withColumn("kind", kind)
    dropped = F.col("kind") == 0
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("x", CLOSERS, "")).otherwise(F.col("x"))
    role = F.when(dropped, "").when(F.col("kind") == 4, "user").otherwise(F.col("r"))
    copies = F.when(dropped, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long")
    return rows.select("c", F.when(~dropped, F.col("t")).alias("t"), role.alias("r"), text.alias("x"), copies.alias("copies"))


def intact(df: DataFrame) -> DataFrame:
    """``c, t, r, x, copies`` of rows as they are."""
    return df.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.coalesce("role", F.lit(" ")).alias("r"), F.coalesce("text", F.lit(" ")).alias("x"), F.lit(1).cast("long").alias("copies"))


def faulted(rows: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies, and the fault of the first copy.

    A row was seen earlier if its role and text have an earlier turn in the conversation. The least turn is aggregated
    (on the map side first) and joined back by the turn too, so a text that fills a conversation isn't gathered.
    """
    rows = rows.groupBy("c", "t", "r", "x").agg(F.sum("copies").alias("copies")).withColumn("h", F.unhex(F.sha2("x", 256)))
    present = rows.filter("copies > 0")
    first = present.groupBy("c", "r", "h").agg(F.max(F.col("t").isNull()).alias("none"), F.min("t").alias("t")).select(F.col("c").alias("fc"), F.when(~F.col("none"), F.col("t")).alias("ft"), F.col("r").alias("fr"), F.col("h").alias("fh"), F.lit(True).alias("new"))
    joined = rows.join(first, F.col("c").eqNullSafe(F.col("fc")) & F.col("t").eqNullSafe(F.col("ft")) & (F.col("r") == F.col("fr")) & (F.col("h") == F.col("fh")), "left")
    bare = F.rtrim("x", F.lit(BLANKS))
    fault = F.when(bare == "", BLANK).when(F.col("new").isNull(), DUPLICATE).when(F.right(bare, F.lit(1)).isin(*CLOSERS), GOOD).otherwise(CUT)
    return joined.select("c", "t", "r", "h", "x", "copies", fault.alias("fault"))


COUNTS = ("blank", "duplicate", "truncated", "illegal")
_FIELDS = "turns long, low long, high long, head_turn long, tail_turn long, head string, tail string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, digest string, piece string"


class _Segment:
    """What some consecutive rows of one conversation give."""

    def __init__(self):
        self.rows: list[Row] = []
        self.at: list[int] = []  # of each row of ``rows``, the place of its role and text
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns = 0
        self.low = self.high = self.head_turn = self.tail_turn = self.head = self.tail = None
        self.counts = dict.fromkeys(COUNTS, 0)

    def add(self, turn: int | None, role: str, text: str | None, copies: int, fault: int) -> None:
        if not copies:
            return
        if turn is not None:
            if self.turns == 0 or turn != self.tail_turn:
                self.turns += 1
            if self.low is None:
                self.low = self.head_turn = turn
            self.high = self.tail_turn = turn
        for k in range(copies):
            now = fault if k == 0 or fault == BLANK else DUPLICATE
            if now:
                self.counts[COUNTS[now - 1]] += 1
            if self.head is None:
                self.head = role[:1]
            else:
                self.counts["illegal"] += self.tail + role[:1] not in LEGAL_PAIRS
            self.tail = role[:1]
            self.rows.append((role[:1] if role[:1] in ("s", "u", "a") else "", now))
            self.at.append(len(self.roles))
        self.roles.append(role)
        self.texts.append(text)

    def pieces(self, edits: list[Arc]) -> Iterator[str]:
        """``role:text`` of each repaired turn."""
        k = 0
        for letter, _, _, initial in edits:
            if letter == "I":
                yield f"{NAMES[initial]}:"
                continue
            if letter != "D":
                at = self.at[k]
                yield f"{self.roles[at] if letter == 'K' else NAMES[initial]}:{self.texts[at]}"
            k += 1

    def summary(self) -> list:
        return [self.turns, self.low, self.high, self.head_turn, self.tail_turn, self.head, self.tail, *self.counts.values()]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, _Segment]]:
    key, held = None, None
    for batch in batches:
        for c, *row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)], strict=True):
            if held is None or c != key:
                if held is not None:
                    yield key, held
                key, held = c, _Segment()
            held.add(*row)
    if held is not None:
        yield key, held


FRONTIERS = [frozenset([s]) for s in range(STATES)]


def repair(rows: DataFrame) -> DataFrame:
    """The conversations of ``c, t, r, x, copies``: one row each, as :func:`query` says."""
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    # a checkpoint keeps partitions and their order, so all passes see the same ones, whatever executors are lost
    keyed = faulted(rows)
    ordered = keyed.repartitionByRange(partitions_for(keyed), "c", "t", "r", "h").sortWithinPartitions("c", "t", "r", "h").drop("h").checkpoint()
    slim = ordered.select("c", "t", "r", F.lit(None).cast("string").alias("x"), "copies", "fault")

    conv = T.StructField("c", ordered.schema["c"].dataType)
    summary = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("which", T.IntegerType()), conv, T.StructField("m", T.ArrayType(T.LongType()))])
    summary_arrow = to_arrow_schema(summary)

    def edges(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
        """What ``work`` finds for the first and the last conversation of a partition, one row each."""
        part, first, last = TaskContext.get().partitionId(), None, None
        for n, (key, segment) in enumerate(_segments(batches)):
            last = (n, key, segment)
            first = first or last
        for which, got in ((0, first), (1, last)):
            if got is not None and (which == 0 or got[0] > 0):
                values = [part, which, got[1], work((part, got[1]), got[2].rows)]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, summary_arrow, strict=True)], schema=summary_arrow)

    found = sorted(slim.mapInArrow(lambda b: edges(b, lambda _, rows: [v for row in cost_matrix(rows) for v in row]), summary).collect(), key=lambda x: (x.part, x.which))
    segments = [(x.part, x.c) for x in found]
    borders = border_costs([(x.part, x.c, [list(x.m[STATES * i : STATES * (i + 1)]) for i in range(STATES)]) for x in found])
    entry: dict[Border, frozenset[int]] = {}
    if not all(first and last for _, _, first, last in borders.values()):

        def leaving(border: Border, rows: list[Row]) -> list[int]:
            """By state of entry, the states of the frontier behind the last row, as bits (0: no way through)."""
            begin, end, _, last = borders[border]
            before, after = forward(rows, begin), backward(rows, end)
            total = min(b + a for b, a in zip(before[0], after[0], strict=True))
            return [sum(1 << s for s in traversed(rows, before, after, f, last)[1]) if any(before[0][s] + after[0][s] == total for s in f) else 0 for f in FRONTIERS]

        exits = {(x.part, x.c): list(x.m) for x in slim.mapInArrow(lambda b: edges(b, leaving), summary).collect()}
        frontier = frozenset([OUTSET])
        for border in segments:
            if borders[border][2]:
                frontier = frozenset([OUTSET])
            entry[border] = frontier
            bits = 0
            for s in frontier:
                bits |= exits[border][s]
            frontier = frozenset(s for s in range(STATES) if bits >> s & 1)

    out_schema = T.StructType([conv, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), *T.StructType.fromDDL(_FIELDS)])
    out_arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each whole conversation; for each segment of another, a row with its share and one for each of its pieces."""
        part = TaskContext.get().partitionId()
        held: list[list] = []

        def flush() -> pa.RecordBatch:
            nonlocal held
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], f.type) for k, f in enumerate(out_arrow)], schema=out_arrow)
            held = []
            return out

        for key, segment in _segments(batches):
            begin, end, first, last = borders.get((part, key), (FIRST, LAST, True, True))
            before, after = forward(segment.rows, begin), backward(segment.rows, end)
            edits, _ = traversed(segment.rows, before, after, entry.get((part, key), frozenset([OUTSET])), last)
            whole = first and last
            share = [*segment.summary(), sum(e[1] for e in edits), "".join(e[0] for e in edits)]
            if whole:
                held.append([key, part, -1, *share, hashlib.sha256("\n".join(segment.pieces(edits)).encode()).hexdigest(), None])
            else:
                held.append([key, part, 0, *share, None, None])
                for k, piece in enumerate(segment.pieces(edits), 1):
                    held.append([key, part, k, *[None] * len(share), None, piece])
                    if len(held) >= 4096:
                        yield flush()
            if len(held) >= 4096:
                yield flush()
        if held:
            yield flush()

    done = settled(ordered.mapInArrow(run, out_schema), "repaired")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    shown = [F.col("c").alias("conv_id"), gaps.alias("gaps"), *COUNTS, "cost", "audit", F.col("digest").alias("repaired_sha256")]
    wholes = done.filter("place = -1")
    if all(first and last for _, _, first, last in borders.values()):
        return wholes.select(*shown)
    joined_schema = T.StructType([f for f in out_schema if f.name not in ("part", "place", "piece")])
    joined_arrow = to_arrow_schema(joined_schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations in several partitions, from their segments and pieces in order."""
        names, state = out_schema.names, None

        def shown(state: dict) -> pa.RecordBatch:
            row = [state["key"], *state["sums"], "".join(state["audit"]), state["hash"].hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, joined_arrow, strict=True)], schema=joined_arrow)

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)], strict=True):
                r = dict(zip(names, row, strict=True))
                if state is None or state["key"] != r["c"]:
                    if state is not None:
                        yield shown(state)
                    state = {"key": r["c"], "sums": None, "audit": [], "hash": hashlib.sha256(), "pieces": 0}
                if r["piece"] is not None:
                    state["hash"].update(b"\n" * (state["pieces"] > 0) + r["piece"].encode())
                    state["pieces"] += 1
                    continue
                state["audit"].append(r["audit"])
                now = [r[k] for k in ("turns", "low", "high", "head_turn", "tail_turn", "head", "tail", *COUNTS, "cost")]
                state["sums"] = now if state["sums"] is None else merged(state["sums"], now)
        if state is not None:
            yield shown(state)

    parts = done.filter("place >= 0").repartition("c").sortWithinPartitions("c", "part", "place").mapInArrow(join, joined_schema)
    return wholes.select(*shown).unionByName(parts.select(*shown))


def merged(a: list, b: list) -> list:
    """Two shares of a conversation, one behind the other: turns, low, high, first and last turn, first and last initial, counts, cost."""
    either = lambda x, y: y if x is None else x
    turns = a[0] + b[0] - (a[4] is not None and a[4] == b[3])
    counts = [x + y for x, y in zip(a[7:], b[7:], strict=True)]
    if a[6] is not None and b[5] is not None:
        counts[COUNTS.index("illegal")] += a[6] + b[5] not in LEGAL_PAIRS
    return [turns, either(a[1], b[1]), either(b[2], a[2]), either(a[3], b[3]), either(b[4], a[4]), either(a[5], b[5]), either(b[6], a[6]), *counts]


def query(spark, sf_dir: str) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
