"""Chat formatting: the cheapest repair of a role sequence, then its rendering.

The legal-turn automaton: an optional system turn, then user and assistant in turn, user first, assistant
last. Each turn is kept, merged into the turn before (cost 1), relabelled (2), relabelled and merged (3),
or preceded by an empty turn (3 more). A conversation that would end without an assistant gets empty turns
(3 each). The cheapest sequence of actions is found by dynamic programming over the automaton's states.

A turn's costs are a small matrix between states, and matrices combine by (min, +). So a long conversation
is cut into chunks of ``CHUNK`` turn numbers: each chunk gives one matrix, the matrices of a conversation
(one row per chunk) fix the states at the cuts, and each chunk is then repaired on its own. No task holds
the turns of more than one chunk.

Every turn gives one row; the rendered pieces of a conversation, joined in order, are its text. ``<|`` in a
text is written ``< |``, so that no text can pass for a role mark.

Nulls, ties and odd rows: a null or unknown role fits no state and is relabelled; a null text is empty;
turns without a number come first; equal turn numbers are ordered by role and text, and repeated rows are
turns like others; rows with a null conv_id form one conversation; of equally cheap repairs the one that
keeps the first state in the order user, assistant, system is taken; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.store import keep

MERGE, RELABEL, INSERT = 1, 2, 3
CHUNK = 256
#: Other names of the roles; fixed values.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant"}
ROLES = ["user", "assistant", "system"]
START = 3
NEXT = {START: (0, 2), 2: (0,), 0: (1,), 1: (0,)}
FAR = 1 << 40


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else -1


def moves(state: int, role: int) -> list[tuple[int, int, str, int]]:
    """(next state, cost, action, inserted role or -1) of one turn."""
    found = []
    for to in range(3):
        base, prefix = (0, "keep") if role == to else (RELABEL, "relabel")
        if state == to:
            found.append((to, base + MERGE, "merge" if role == to else "relabel+merge", -1))
        if to in NEXT[state]:
            found.append((to, base, prefix, -1))
        else:
            found += [(to, base + INSERT, f"insert+{prefix}", p) for p in NEXT[state] if to in NEXT[p]]
    return found


MOVES = {(s, r): moves(s, r) for s in range(4) for r in range(-1, 3)}
#: Cost of the empty turns after a last state, and those turns.
CLOSING = {1: (0, []), 0: (INSERT, [1]), 2: (2 * INSERT, [0, 1]), START: (0, [])}


def chunk_matrix(roles: list[int]) -> list[int]:
    """Cheapest costs from each state before to each state after the turns, row by row."""
    out = []
    for start in range(4):
        costs = {start: 0}
        for role in roles:
            after: dict[int, int] = {}
            for state, cost in costs.items():
                for to, more, _, _ in MOVES[state, role]:
                    if cost + more < after.get(to, FAR):
                        after[to] = cost + more
            costs = after
        out += [costs.get(s, FAR) for s in range(4)]
    return out


def boundary_states(matrices: list[list[int]]) -> list[int]:
    """The states before the first, between, and after the last chunk on a cheapest way."""
    costs, back = [FAR, FAR, FAR, 0], []
    for m in matrices:
        best = [min((costs[s] + m[4 * s + t], s) for s in range(4)) for t in range(4)]
        back.append([s for _, s in best])
        costs = [min(c, FAR) for c, _ in best]
    last = min(range(4), key=lambda s: (costs[s] + CLOSING[s][0], s))
    states = [last]
    for step in reversed(back):
        states.append(step[states[-1]])
    return states[::-1]


def repair(roles: list[int], start: int, end: int) -> list[tuple[int, str, int, int]]:
    """(state, action, inserted, cost) per turn on a cheapest way from start to end."""
    costs, back = {start: 0}, []
    for role in roles:
        after: dict[int, int] = {}
        step: dict[int, tuple[int, tuple]] = {}
        for state in sorted(costs):
            for move in MOVES[state, role]:
                total = costs[state] + move[1]
                if total < after.get(move[0], FAR):
                    after[move[0]], step[move[0]] = total, (state, move)
        costs = after
        back.append(step)
    out, state = [], end
    for step in reversed(back):
        before, (to, cost, action, inserted) = step[state]
        out.append((to, action, inserted, cost))
        state = before
    return out[::-1]


def _opening(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


def render(steps: list[tuple[int, str, int, int]], texts: list[str | None], start: int, closing: list[int]) -> list[str]:
    """One piece of text per turn."""
    pieces, state = [], start
    for (to, action, inserted, _), text in zip(steps, texts):
        body = (text or "").replace("<|", "< |")
        if action.endswith("merge"):
            pieces.append("\n\n" + body)
        else:
            opened = "" if state == START else "<|end|>\n"
            extra = "" if inserted < 0 else _opening(inserted) + "<|end|>\n"
            pieces.append(opened + extra + _opening(to) + body)
        state = to
    if closing is not None and pieces:
        pieces[-1] += "<|end|>\n" + "".join(_opening(r) + "<|end|>\n" for r in closing)
    return pieces


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows with equal leading columns, from batches sorted by them."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _sorted_map(df: DataFrame, keys: list[str], order: list, fn: Callable, schema: str) -> DataFrame:
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(fn, schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_MATRIX = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("costs", pa.list_(pa.int64()))])
_STATES = pa.schema(
    [("conv_id", pa.int64()), ("chunk", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("last", pa.bool_())]
)
_OUT = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.int64()), ("role", pa.string())]
    + [("new_role", pa.string()), ("action", pa.string()), ("cost", pa.int64()), ("piece", pa.string())]
)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches(
        ((g[0][0], g[0][1], chunk_matrix([role_number(r[3]) for r in g])) for g in _groups(batches, 2)), _MATRIX
    )


def _boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for chunks in _groups(batches, 1):
            states = boundary_states([c[2] for c in chunks])
            for i, c in enumerate(chunks):
                yield c[0], c[1], states[i], states[i + 1], i == len(chunks) - 1

    return _batches(rows(), _STATES)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for g in _groups(batches, 2):
            start, stop, last = g[0][5:8]
            steps = repair([role_number(r[3]) for r in g], start, stop)
            pieces = render(steps, [r[4] for r in g], start, CLOSING[stop][1] if last else None)
            for place, (row, step, piece) in enumerate(zip(g, steps, pieces)):
                extra = CLOSING[stop][0] if last and place == len(g) - 1 else 0
                yield row[0], row[2], place, row[3], ROLES[step[0]], step[1], step[3] + extra, piece

    return _batches(rows(), _OUT)


def format_chats(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per turn: conv_id, turn, place (in its chunk), role, new_role, action, cost, piece."""
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 62))).cast("long").alias("chunk"),
        F.col("turn").cast("long"),
        F.col("role").cast("string"),
        F.col("text").cast("string"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    keys = ["conv_id", "chunk"]
    matrices = _sorted_map(rows, keys, order, _matrices, "conv_id long, chunk long, costs array<long>")
    states = _sorted_map(
        matrices, ["conv_id"], [F.col("chunk")], _boundaries, "conv_id long, chunk long, start long, stop long, last boolean"
    )
    states = keep(states, "states").withColumnsRenamed({"conv_id": "c", "chunk": "k"})
    placed = rows.join(states, rows.conv_id.eqNullSafe(states.c) & (rows.chunk == states.k)).drop("c", "k")
    return _sorted_map(
        placed,
        keys,
        order,
        _repaired,
        "conv_id long, turn long, place long, role string, new_role string, action string, cost long, piece string",
    )
