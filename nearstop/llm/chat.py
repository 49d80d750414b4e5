"""Repair the roles of chats at least cost, and render the repaired turns.

A legal chat is an optional system turn followed by user and assistant turns in alternation, ending
with the assistant. Each turn may be merged into the turn before, get another role, or have an
empty turn put before it. Dynamic programming over the automaton of legal turns finds the cheapest
repair. The cost of a stretch of turns is a matrix from state to state, and matrices of neighbouring
stretches combine, so a chat of any length is split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.llm.common import group_key
from nearstop.scratch import materialise

ROLES = ("system", "user", "assistant")
#: States: the role of the last turn, and the start of the chat.
START, STATES = 3, 4
MERGE, RELABEL, INSERT = 1.0, 3.0, 2.0
#: A null or unknown role has to get a role; that costs less than changing a known one.
NAME = 1.5
NEVER = float("inf")
#: Consecutive turns that one task repairs together.
STRETCH = 4096

#: For each state before and each role of the next turn: the roles of empty turns put between.
#: None where the turn cannot follow.
BETWEEN = {
    (START, 0): (), (START, 1): (), (START, 2): (1,),
    (0, 0): (), (0, 1): (), (0, 2): (1,),
    (1, 0): None, (1, 1): (), (1, 2): (),
    (2, 0): None, (2, 1): (), (2, 2): (),
}
#: Turns put after the last one.
CLOSING = {START: (), 0: (1, 2), 1: (2,), 2: ()}
CLOSING_COST = np.array([
    INSERT * len(CLOSING[state]) for state in range(STATES)
])
EDGE = pa.schema([
    ("_conv", pa.string()), ("_stretch", pa.int64()), ("_rows", pa.int64()),
    ("_cost", pa.list_(pa.float64())),
])
MADE = (
    ("place", pa.int64()), ("new_role", pa.string()), ("action", pa.string()),
    ("inserted", pa.int32()), ("total_cost", pa.float64()), ("rendered", pa.string()),
)


#: Cost from each state to the role of the next turn, without relabelling.
MOVES = np.array([[
    NEVER if BETWEEN[state, role] is None
    else INSERT * len(BETWEEN[state, role]) + (MERGE if state == role else 0.0)
    for role in range(len(ROLES))
] for state in range(STATES)])


def _labels(role) -> np.ndarray:
    """Cost of giving a turn each of the roles."""
    if role not in ROLES:
        return np.full(len(ROLES), NAME)
    return np.array([0.0 if name == role else RELABEL for name in ROLES])


def _step(cost: np.ndarray, role) -> tuple[np.ndarray, np.ndarray]:
    """Extend costs (by any rows, per state) by a turn; also the state each best came from."""
    through = cost[:, :, None] + MOVES[None] + _labels(role)[None, None]
    came = through.argmin(axis=1)
    best = np.full(cost.shape, NEVER)
    best[:, :len(ROLES)] = np.take_along_axis(through, came[:, None], axis=1)[:, 0]
    return best, came


def _chats(rows: pa.Table) -> Iterator[tuple[int, int]]:
    """Begin and end of each chat in the rows of a stretch."""
    keys = rows["_conv"].to_pylist()
    begin = 0
    for n in range(1, len(keys) + 1):
        if n == len(keys) or keys[n] != keys[begin]:
            yield begin, n
            begin = n


def _edge_costs(rows: pa.Table) -> pa.Table:
    """For the first and the last chat of a stretch the matrix of least costs, state to state.

    Only these can go on in another stretch.
    """
    rows = rows.sort_by("_nr")
    roles, keys = rows["role"].to_pylist(), rows["_conv"].to_pylist()
    chats = list(_chats(rows))
    out = []
    for begin, end in dict.fromkeys((chats[0], chats[-1])):
        cost = np.full((STATES, STATES), NEVER)
        np.fill_diagonal(cost, 0.0)
        for role in roles[begin:end]:
            cost, _ = _step(cost, role)
        out.append({
            "_conv": keys[begin], "_stretch": rows["_stretch"][0].as_py(), "_rows": end - begin,
            "_cost": cost.ravel().tolist(),
        })
    return pa.Table.from_pylist(out, schema=EDGE)


def _choose_states(stretches: pd.DataFrame) -> pd.DataFrame:
    """The states before and after each stretch of one long chat on its cheapest repair."""
    ordered = stretches.sort_values("_stretch")
    matrices = [np.array(c, dtype=float).reshape(STATES, STATES) for c in ordered["_cost"]]
    cost, back = np.full(STATES, NEVER), []
    cost[START] = 0.0
    for matrix in matrices:
        through = cost[:, None] + matrix
        back.append(through.argmin(axis=0))
        cost = through.min(axis=0)
    last = cost + CLOSING_COST
    state, states = int(last.argmin()), []
    for came in reversed(back):
        states.append((int(came[state]), state))
        state = int(came[state])
    begins, ends = zip(*reversed(states), strict=True)
    counts = ordered["_rows"].to_numpy()
    return pd.DataFrame({
        "_conv": ordered["_conv"].to_numpy(), "_stretch": ordered["_stretch"].to_numpy(),
        "_begin": begins, "_end": ends, "_first": counts.cumsum() - counts,
        "_last": np.arange(len(ordered)) == len(ordered) - 1, "_total": float(last.min()),
    })


def _piece(before: int, role: int, between: tuple, text: str, closing: tuple | None) -> str:
    """The rendered part of a turn; the parts of a chat in order make up the whole."""
    if before == role:
        out = [f"\n{text}"]
    else:
        out = ["<|end|>\n" if before != START else ""]
        out += [f"<|{ROLES[r]}|>\n<|end|>\n" for r in between]
        out += [f"<|{ROLES[role]}|>\n{text}"]
    if closing is not None:
        out += ["<|end|>\n", *[f"<|{ROLES[r]}|>\n<|end|>\n" for r in closing]]
    return "".join(out)


def _path(roles: list, begin: int, end: int | None) -> tuple[list[tuple[int, int]], float]:
    """States before and after each turn on the cheapest way; any end if ``end`` is None."""
    cost = np.full((1, STATES), NEVER)
    cost[0, begin] = 0.0
    back = []
    for role in roles:
        cost, came = _step(cost, role)
        back.append(came[0])
    closed = cost[0] + CLOSING_COST
    state, path = int(closed.argmin()) if end is None else end, []
    for came in reversed(back):
        path.append((int(came[state]), state))
        state = int(came[state])
    return path[::-1], float(closed.min())


def _repair(rows: pa.Table) -> pa.Table:
    """Repair and render the turns of a stretch; a long chat between its chosen states."""
    rows = rows.sort_by("_nr")
    roles, texts = rows["role"].to_pylist(), rows["text"].to_pylist()
    begins, ends, lasts, firsts, totals = (
        rows[c].to_pylist() for c in ("_begin", "_end", "_last", "_first", "_total")
    )
    out = []
    for a, b in _chats(rows):
        long = begins[a] is not None
        path, total = _path(roles[a:b], begins[a] if long else START, ends[a])
        total, last = (totals[a], lasts[a]) if long else (total, True)
        for n, (before, role) in enumerate(path):
            between = () if before == role else BETWEEN[before, role]
            closing = CLOSING[role] if last and n == b - a - 1 else None
            action = ["relabel"] * (roles[a + n] != ROLES[role]) + ["merge"] * (before == role)
            action += ["insert"] * bool(between or closing)
            out.append((
                (firsts[a] or 0) + n, ROLES[role], "+".join(action) or "keep",
                len(between) + len(closing or ()), total,
                _piece(before, role, between, texts[a + n] or "", closing),
            ))
    made = [pa.array(column, kind) for column, (_, kind) in zip(zip(*out), MADE, strict=True)]
    kept = [rows[c] for c in ("conv_id", "turn", "role")]
    return pa.table(kept + made, names=["conv_id", "turn", "role", *[name for name, _ in MADE]])


def repair_chats(turns: DataFrame) -> DataFrame:
    """Repair and render every chat of ``turns`` (conv_id, turn, role, text; extras are ignored).

    One row per turn: conv_id, turn, role, place (order in the chat from 0), new_role, action (keep,
    or relabel, merge and insert joined by +), inserted (empty turns put before it, and after it if
    it is the last), total_cost (of its chat) and rendered; the rendered parts of a chat in order
    of place are its whole text. Turns are ordered by turn (null last), then role and text, so
    ties and repeated rows have a fixed order. A null or unknown role gets a role, a null text is
    empty, turns with a null conv_id are one chat. An empty table gives an empty result.

    A chat of any length is spread over ranges of rows and cut into stretches of ``STRETCH`` turns.
    """
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "role", "text", "_tie")]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.select(
        "conv_id", "turn", "role", "text", group_key("conv_id").alias("_conv"),
        F.monotonically_increasing_id().alias("_tie"),
    ).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_tie").withColumn(
        "_nr", F.monotonically_increasing_id()
    )
    dealt = materialise(dealt.withColumn("_stretch", F.floor(F.col("_nr") / STRETCH)), "turns")
    edges = dealt.select("_conv", "_stretch", "_nr", "role").groupBy("_stretch").applyInArrow(
        _edge_costs, "_conv string, _stretch long, _rows long, _cost array<double>"
    )
    edges = materialise(edges, "edges")
    long = edges.groupBy("_conv").count().where("count > 1").select("_conv")
    states = materialise(edges.join(long, "_conv", "left_semi").groupBy("_conv").applyInPandas(
        _choose_states,
        "_conv string, _stretch long, _begin int, _end int, _first long, _last boolean,"
        " _total double",
    ), "states")
    kinds = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn", "role")}
    return dealt.join(states, ["_conv", "_stretch"], "left").groupBy("_stretch").applyInArrow(
        _repair,
        ", ".join(f"{c} {kind}" for c, kind in kinds.items())
        + ", place long, new_role string, action string, inserted int, total_cost double,"
        " rendered string",
    )
