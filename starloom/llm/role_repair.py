"""Minimum-cost repair of conversation roles, and the rendered turns.

A legal conversation is an optional system turn, then user and assistant turns in alternation, beginning with user. Every turn
of a conversation is given a role; it may be appended to the turn before (merge), take another role (relabel), and have
empty turns put in front of it (insert). Each of these has a cost, and the cheapest repair is found by dynamic programming over the
automaton's states (the role of the turn before): a turn is a matrix of costs from state to state, and matrices are
combined by (min, +), which is associative. So a conversation of more than SEGMENT turns is cut into segments: the matrix of
each segment is computed in a task of its own, the matrices of one conversation are chained to find the states at the cuts, and
every segment is then decoded between its two states.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import keep
from starloom.operators.numbering import number_rows

# Roles (states 1 to 3; state 0 is the beginning) and the costs of a repair.
ROLES = ("system", "user", "assistant")
OTHER = len(ROLES)
MERGE, RELABEL, INSERT = 2, 3, 4
NEVER = 1 << 40
SEGMENT = 4096
BATCH_TURNS = 100_000


def _follows(before: int, role: int) -> bool:
    """Whether a turn of a role may stand after a state."""
    return {1: before == 0, 2: before in (0, 1, 3), 3: before == 2}[role]


def _tables() -> tuple[np.ndarray, np.ndarray, list[tuple[str, str]]]:
    """Cost and action of each original role, state before and state after; the names of actions with what they insert.

    Of equally cheap ways: none inserted before any, a turn of its own before a merge.
    """
    names: list[tuple[str, str]] = []
    cost = np.full((OTHER + 1, 4, 4), NEVER, np.int64)
    action = np.zeros((OTHER + 1, 4, 4), np.int16)
    for role in range(OTHER + 1):
        for before in range(4):
            for after in range(1, 4):
                relabel = 0 if role == after - 1 else RELABEL
                word = "keep" if not relabel else "relabel"
                ways = []
                if _follows(before, after):
                    ways.append((relabel, word, ""))
                for one in (2, 3):
                    if _follows(before, one) and _follows(one, after):
                        ways.append((relabel + INSERT, word, ROLES[one - 1]))
                    for two in (2, 3):
                        if _follows(before, one) and _follows(one, two) and _follows(two, after):
                            ways.append((relabel + 2 * INSERT, word, f"{ROLES[one - 1]},{ROLES[two - 1]}"))
                if before == after:
                    ways.append((relabel + MERGE, "merge" if not relabel else "relabel and merge", ""))
                if ways:
                    best = min(ways, key=lambda w: w[0])
                    cost[role, before, after] = best[0]
                    if best[1:] not in names:
                        names.append(best[1:])
                    action[role, before, after] = names.index(best[1:])
    return cost, action, names


COST, ACTION, NAMES = _tables()


def chain(matrices: np.ndarray) -> np.ndarray:
    """(min, +) product of a run of state matrices."""
    out = matrices[0]
    for m in matrices[1:]:
        out = np.minimum((out[:, :, None] + m[None, :, :]).min(1), NEVER)
    return out


def decode(roles: np.ndarray, sizes: np.ndarray, entry: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """States after every turn of runs of turns (padded rows), between given states; leave of -1 is any user or assistant."""
    n, longest = roles.shape
    best = np.full((n, 4), NEVER, np.int64)
    best[np.arange(n), entry] = 0
    back = np.zeros((longest, n, 4), np.int8)
    for t in range(longest):
        ways = best[:, :, None] + COST[roles[:, t]]
        on = (t < sizes)[:, None]
        back[t] = np.where(on, ways.argmin(1), np.arange(4))
        best = np.where(on, np.minimum(ways.min(1), NEVER), best)
    open_ = np.where(np.arange(4) >= 2, best, NEVER)
    # a conversation may end after user or assistant; one that cannot (a lone system turn) ends where it is cheapest
    free = np.where((open_.min(1) < NEVER), open_.argmin(1), best.argmin(1))
    state = np.where(leave < 0, free, leave)
    path = np.zeros((n, longest), np.int64)
    rows = np.arange(n)
    for t in range(longest - 1, -1, -1):
        path[:, t] = state
        state = back[t][rows, state]
    return path


def _role_number(column: str) -> Column:
    low = F.lower(F.trim(F.col(column)))
    number = F.lit(OTHER)
    for i, role in enumerate(ROLES):
        number = F.when(low == role, i).otherwise(number)
    return number


def _segments(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal (part, segment)."""
    parts, segments = rows["part"].to_numpy(), rows["segment"].to_numpy()
    change = np.flatnonzero((parts[1:] != parts[:-1]) | (segments[1:] != segments[:-1])) + 1
    edges = [0, *change.tolist(), len(rows)]
    yield from zip(edges[:-1], edges[1:])


def _matrices(long: DataFrame) -> DataFrame:
    """(part, segment, matrix) of every segment of the long conversations."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        roles = group.sort_values("position")["role_number"].to_numpy()
        return pd.DataFrame({"part": [group["part"].iloc[0]], "segment": [group["segment"].iloc[0]],
                             "matrix": [chain(COST[roles]).ravel().tolist()]})

    return long.select("part", "segment", "position", "role_number").groupBy("part", "segment").applyInPandas(
        run, "part string, segment long, matrix array<long>")


def _cuts(matrices: DataFrame) -> DataFrame:
    """(part, segment, entry, leave): the states at the ends of each segment of a long conversation, one row per SEGMENT turns."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("segment")
        steps = np.array(group["matrix"].tolist(), np.int64).reshape(-1, 4, 4)
        best = np.full(4, NEVER, np.int64)
        best[0] = 0
        back = []
        for m in steps:
            ways = best[:, None] + m
            back.append(ways.argmin(0))
            best = np.minimum(ways.min(0), NEVER)
        state = 2 + int(best[2:].argmin())
        ends = []
        for b in reversed(back):
            ends.append(state)
            state = int(b[state])
        ends = ends[::-1]
        return pd.DataFrame({"part": group["part"], "segment": group["segment"], "entry": [0, *ends[:-1]], "leave": ends})

    return matrices.groupBy("part").applyInPandas(run, "part string, segment long, entry int, leave int")


OUT = ["conv_id", "turn", "position", "role", "action", "inserted", "cost", "rendered"]


def repair(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, position, role, action, inserted, cost, rendered.

    conversations needs conv_id, turn, role and text; other columns are not read. Turns are ordered by turn (NULL first), then role and
    text; position counts them from 1. Joining `rendered` in this order gives the conversation, each turn between
    <|role|> and <|end|> lines; "<|" inside a text becomes "< |". Roles other than the three, and NULL, cost a relabel whatever they
    become; NULL text is empty; rows with a NULL conv_id form one conversation; repeated rows are turns of their own. A
    conversation ends after user or assistant, so a lone system turn is relabelled. An empty table gives an empty result.
    """
    part = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))  # a name for NULL as well
    rows = conversations.select("conv_id", "turn", "role", "text").withColumns(
        {"part": part, "role_number": _role_number("role").cast("int")})
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    long_ids = keep(rows.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > SEGMENT), "long")
    some_long = not long_ids.isEmpty()
    last = F.col("position") == F.col("turns")
    nothing = F.lit(None).cast("int")
    columns = ["conv_id", "turn", "text", "role_number", "part", "segment", "position", "turns", "entry", "leave"]

    def numbered(some: DataFrame, window: bool) -> DataFrame:
        if window:
            by = W.partitionBy("part").orderBy(*order)
            return some.withColumns({
                "position": F.row_number().over(by).cast("long"), "turns": F.count("*").over(W.partitionBy("part")),
                "segment": F.lit(0).cast("long"), "entry": nothing, "leave": nothing})
        placed = number_rows(some.drop("n"), ["part", *order], "place")
        firsts = placed.groupBy("part").agg(F.min("place").alias("first"), F.count("*").alias("turns"))
        placed = placed.join(firsts, "part").withColumn("position", F.col("place") - F.col("first") + 1)
        return keep(placed.withColumn("segment", F.floor((F.col("position") - 1) / SEGMENT)).drop("place", "first"), "segments")

    short = rows.join(long_ids.select("part"), "part", "left_anti") if some_long else rows
    ready = numbered(short, True).select(*columns)
    if some_long:
        long = numbered(rows.join(long_ids.select("part"), "part", "left_semi"), False)
        cuts = _cuts(keep(_matrices(long), "matrices"))
        ready = ready.unionByName(long.join(cuts, ["part", "segment"]).select(*columns))
    ready = ready.withColumn("last", last).repartition("part", "segment").sortWithinPartitions("part", "segment", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        for batch in batches:
            pending.append(batch)
            whole = pa.Table.from_batches(pending)
            edges = list(_segments(whole.select(["part", "segment"]).to_pandas())) if whole.num_rows else []
            if len(edges) > 1:
                yield from _repaired(whole.slice(0, edges[-1][0]), edges[:-1])
                whole = whole.slice(edges[-1][0])
            pending = whole.to_batches()
        whole = pa.Table.from_batches(pending) if pending else None
        if whole is not None and whole.num_rows:
            yield from _repaired(whole, list(_segments(whole.select(["part", "segment"]).to_pandas())))

    schema = conversations.select(
        "conv_id", "turn", F.lit(0).cast("long").alias("position"), F.lit("").alias("role"), F.lit("").alias("action"),
        F.lit("").alias("inserted"), F.lit(0).cast("long").alias("cost"), F.lit("").alias("rendered")).schema
    return ready.mapInArrow(run, schema)


def _repaired(rows: pa.Table, edges: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Decode runs of turns, and write out the turns."""
    roles = rows.column("role_number").to_numpy()
    entry = rows.column("entry").fill_null(0).to_numpy()
    leave = rows.column("leave").fill_null(-1).to_numpy()
    edges = sorted(edges, key=lambda e: e[1] - e[0])
    states = np.zeros(rows.num_rows, np.int64)
    at = 0
    while at < len(edges):
        end = at
        while end < len(edges) and (end == at or (edges[end][1] - edges[end][0]) * (end - at + 1) <= BATCH_TURNS):
            end += 1
        some = edges[at:end]
        sizes = np.array([b - a for a, b in some])
        padded = np.zeros((len(some), int(sizes.max())), np.int64)
        for i, (a, b) in enumerate(some):
            padded[i, :b - a] = roles[a:b]
        heads = np.array([a for a, _ in some])
        path = decode(padded, sizes, entry[heads], leave[heads])
        for i, (a, b) in enumerate(some):
            states[a:b] = path[i, :b - a]
        at = end
    before = np.empty_like(states)
    before[1:] = states[:-1]
    for a, _ in edges:
        before[a] = entry[a]
    actions = ACTION[roles, before, states]
    names = [NAMES[k] for k in actions.tolist()]
    rendered = []
    places, ends = rows.column("position").to_numpy(), rows.column("last").to_pylist()
    for (word, inserted), state, place, text, last in zip(names, states.tolist(), places.tolist(), rows.column("text").to_pylist(), ends):
        body = (text or "").replace("<|", "< |")
        if "merge" in word:
            piece = "\n" + body
        else:
            piece = "" if place == 1 else "\n<|end|>\n"
            piece += "".join(f"<|{r}|>\n\n<|end|>\n" for r in inserted.split(",") if r) + f"<|{ROLES[state - 1]}|>\n{body}"
        rendered.append(piece + ("\n<|end|>\n" if last else ""))
    yield from pa.table({
        "conv_id": rows.column("conv_id"), "turn": rows.column("turn"), "position": rows.column("position"),
        "role": pa.array([ROLES[s - 1] for s in states.tolist()]), "action": pa.array([n[0] for n in names]),
        "inserted": pa.array([n[1] for n in names]), "cost": pa.array(COST[roles, before, states]), "rendered": pa.array(rendered, pa.string()),
    }).combine_chunks().to_batches()
