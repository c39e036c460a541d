"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in
turn, from a user turn to an assistant turn. Each input turn is kept: it may be
merged into the turn before (same role), relabelled, or preceded by empty turns.
Dynamic programming over the automaton (states: nothing yet, system, user,
assistant) finds the repair of least cost; of equal costs the earliest state in
that order. The repaired sequence is then rendered, a fragment for each input
turn; the fragments of a conversation, joined by ``pos``, are its rendering.

Scale: a conversation is never gathered. The turns of all conversations, in their
total order, are cut into ranges at sampled keys (``operators.ranges``), so one
conversation, even one whose turns all have the same number or none, goes to many
tasks. Within a conversation and range every ``segment`` turns are a segment, by
position: a 4 x 4 matrix of least costs between states. Matrices are chained per
conversation (one small row per segment), and each segment then repairs itself
between its known states, which stand before its turns in the stream of a task.
Texts are shuffled once; a task holds the turns of one segment.

Defined cases: a null or unknown role costs a relabelling; a null text is empty;
turns sort by turn number (null last), then role and text, so ties and repeated
rows have a fixed order; a null conversation id is a conversation of its own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etalage.operators.ranges import MOST_RANGES, range_of, sampled_bounds

from .streams import groups, written

ROLES = ("system", "user", "assistant")
MERGE, RELABEL, INSERT = 1, 3, 2
SEGMENT = 256
#: turns of a range, if there are that many
RANGE_TURNS = 100_000
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INF = 1 << 40

#: empty turns needed before a turn of the role may follow the state (None: never)
_FILL: dict[tuple[int, int], tuple[int, ...] | None] = {
    (_START, _SYSTEM): (), (_START, _USER): (), (_START, _ASSISTANT): (_USER,),
    (_SYSTEM, _SYSTEM): None, (_SYSTEM, _USER): (), (_SYSTEM, _ASSISTANT): (_USER,),
    (_USER, _SYSTEM): None, (_USER, _USER): (_ASSISTANT,), (_USER, _ASSISTANT): (),
    (_ASSISTANT, _SYSTEM): None, (_ASSISTANT, _USER): (), (_ASSISTANT, _ASSISTANT): (_USER,),
}
#: empty turns that end a conversation legally
_CLOSE = {_START: (), _SYSTEM: (_USER, _ASSISTANT), _USER: (_ASSISTANT,), _ASSISTANT: ()}
CLOSING = np.array([INSERT * len(_CLOSE[s]) for s in range(4)])


def _step(role: int) -> tuple[np.ndarray, np.ndarray]:
    """Cost from each state to each for a turn of this role (0: unknown), and whether it merges."""
    cost, merges = np.full((4, 4), _INF), np.zeros((4, 4), bool)
    for s in range(4):
        for t in (_SYSTEM, _USER, _ASSISTANT):
            label = 0 if t == role else RELABEL
            fill = _FILL[s, t]
            if fill is not None:
                cost[s, t] = label + INSERT * len(fill)
            if s == t and label + MERGE <= cost[s, t]:
                cost[s, t], merges[s, t] = label + MERGE, True
    return cost, merges


_STEPS = [_step(r) for r in range(4)]
_CODE = {r: k + 1 for k, r in enumerate(ROLES)}


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least cost through both: the (min, +) product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _INF)


def segment_cost(roles: list[str | None]) -> np.ndarray:
    total = np.where(np.eye(4, dtype=bool), 0, _INF)
    for r in roles:
        total = chain(total, _STEPS[_CODE.get(r, 0)][0])
    return total


def repair(roles: list[str | None], entry: int = _START, exit_: int | None = None) -> list[tuple[int, bool, tuple[int, ...], int]]:
    """For each turn (state after it, merged, empty turns before it, cost), at least cost.

    ``exit_`` is the state to end in; None: the one from which closing is cheapest.
    """
    costs = [np.where(np.arange(4) == entry, 0, _INF)]
    for r in roles:
        costs.append(np.minimum((costs[-1][:, None] + _STEPS[_CODE.get(r, 0)][0]).min(axis=0), _INF))
    state = int(np.argmin(costs[-1] + CLOSING)) if exit_ is None else exit_
    out = []
    for k in range(len(roles) - 1, -1, -1):
        step, merges = _STEPS[_CODE.get(roles[k], 0)]
        before = int(np.argmin(costs[k] + step[:, state]))
        merged = bool(merges[before, state])
        out.append((state, merged, () if merged else _FILL[before, state], int(step[before, state])))
        state = before
    return out[::-1]


def _head(role: int) -> str:
    return f"<|{ROLES[role - 1]}|>\n"


_TURN_END = "<|end|>\n"


def _pieces(rows: Iterator[dict], size: int) -> Iterator[list[dict]]:
    """A stream in lists of ``size``."""
    while piece := list(itertools.islice(rows, size)):
        yield piece


_ORDER = ["conv_id", "none", "turn", "role", "tie"]
_COSTS = pa.schema([("conv_id", pa.int64()), ("seg", pa.int32()), ("k", pa.int64()), ("cost", pa.list_(pa.int64()))])
_KNOWN = pa.schema([("conv_id", pa.int64()), ("seg", pa.int32()), ("part", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()), ("final", pa.bool_())])
_OUT = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("new_role", pa.string()), ("merged", pa.bool_()),
    ("inserted", pa.list_(pa.string())), ("cost", pa.int64()), ("seg", pa.int64()), ("k", pa.int64()), ("last", pa.bool_()), ("rendered", pa.string())])


def repair_chats(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 segment: int = SEGMENT, ranges: int | None = None) -> DataFrame:
    """One row per input turn: conv_id, turn, role, new_role, merged, inserted (roles of
    the empty turns before it), cost, seg and k (its place: range, number in it), last, rendered.

    The fragment of a conversation's last turn also holds the empty turns that close
    it, and their cost. ``ranges`` is how many ranges the turns are cut into.
    """
    rows = chats.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).isNull().alias("none"), F.col(turn).cast("long").alias("turn"),
        F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = rows.count()
    if ranges is None:
        parts = int(chats.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        ranges = max(1, min(MOST_RANGES, 4 * parts, -(-n // RANGE_TURNS)))
    bounds = sampled_bounds(rows, _ORDER, ranges, n)
    rows = rows.withColumn("seg", range_of(rows, _ORDER, bounds))
    by, order = ["conv_id", "seg"], [F.col(c).asc_nulls_first() for c in _ORDER[1:]]

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for key, stream in groups(batches, by):
            for k, piece in enumerate(_pieces(stream, segment)):
                yield *key, k, segment_cost([r["role"] for r in piece]).ravel().tolist()

    light = rows.select(*by, "none", "turn", "role", "tie")
    costs = light.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(
        lambda b: written(matrices(b), _COSTS), "conv_id long, seg int, k long, cost array<long>")

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), stream in groups(batches, ["conv_id"]):
            group = [(r["seg"], r["k"], np.array(r["cost"]).reshape(4, 4)) for r in stream]
            into = [np.where(np.arange(4) == _START, 0, _INF)]
            for _, _, m in group:
                into.append(np.minimum((into[-1][:, None] + m).min(axis=0), _INF))
            state = int(np.argmin(into[-1] + CLOSING))
            for i in range(len(group) - 1, -1, -1):
                seg, k, m = group[i]
                before = int(np.argmin(into[i] + m[:, state]))
                yield conv, seg, k, before, state, i == len(group) - 1
                state = before

    known = costs.repartition("conv_id").sortWithinPartitions(*by, "k").mapInArrow(
        lambda b: written(states(b), _KNOWN), "conv_id long, seg int, part long, entry int, leave int, final boolean")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, seg), stream in groups(batches, by):
            # a segment's states come first, then all turns; one small row in ``segment`` turns is held
            ahead: list[tuple[int, int, bool]] = []
            first = next(stream)
            while first["kind"] == 0:
                ahead.append((first["entry"], first["leave"], first["final"]))
                first = next(stream)
            place = 0
            for (entry, leave, final), piece in zip(ahead, _pieces(itertools.chain([first], stream), segment), strict=True):
                moves = repair([r["role"] for r in piece], entry, leave)
                for k, (r, (state, merged, fill, cost)) in enumerate(zip(piece, moves, strict=True)):
                    last = final and k == len(piece) - 1
                    # a turn is ended by the fragment after it, so no fragment needs to know the next
                    opened = "" if k == 0 and entry == _START else _TURN_END
                    text = "\n" + r["text"] if merged else opened + "".join(_head(x) + _TURN_END for x in fill) + _head(state) + r["text"]
                    if last:
                        text += _TURN_END + "".join(_head(x) + _TURN_END for x in _CLOSE[state])
                        cost += INSERT * len(_CLOSE[state])
                    yield (conv, r["turn"], r["role"], ROLES[state - 1], merged, [ROLES[x - 1] for x in fill], cost, seg, place, last, text)
                    place += 1

    both = known.withColumn("kind", F.lit(0)).unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    turns = both.select(*by, "kind", "part", "entry", "leave", "final", "none", "turn", "role", "tie", "text")
    return turns.repartition(*by).sortWithinPartitions(*by, "kind", "part", *order).mapInArrow(
        lambda b: written(render(b), _OUT),
        "conv_id long, turn long, role string, new_role string, merged boolean, inserted array<string>, cost long, "
        "seg long, k long, last boolean, rendered string")
