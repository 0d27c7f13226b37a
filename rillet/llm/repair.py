"""Conversation structure repair: cheapest edits, the least audit by prefix doubling.

A conversation's rows, by turn, are edited until its roles fit a grammar: Keep, Rerole, Delete,
Insert.  A node is a number of rows done and a state of the grammar.  A cost pass from the
end gives each node the cost of its cheapest rest; arcs that keep to it are optimal.  Nodes are
then ranked by their least audit (the edits' initials) of up to 1, 2, 4, ... edits: the rank
for twice the length is the pair of a node's own rank and the least rank among the nodes where
its least audit may end.  Full ranks choose each node's arc, and doubled pointers along
these arcs list the path.  All conversations of an Arrow batch are ranked together.

Faults of a row, the first counts: blank (no character besides ``\\x20\\x09-\\x0D``), duplicate (an
earlier row has its role and text), truncated (its last such character is none of ``.!?``).
Blank and duplicate rows must go; a truncated row that stays costs extra.

Null roles and texts count as one space.  Rows go by turn, null first, equal turns by role, then text.
A row fits by its role's initial; an empty role has none, so such a row can't be kept as it is.
Repeated rows are duplicates.  Null ids are one conversation.  A conversation without rows
costs nothing and stays empty; an empty table gives no rows.  Further columns play no part.  One conversation is
one result row, so its rows meet in one task; conversations are dealt by a hash of their id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.shared import map_arrow

_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_FAR = np.iinfo(np.int64).max // 4
#: Labels of arcs in ASCII order; 0 is the end of an audit.
_END, _DELETE, _INSERT, _KEEP, _REROLE = range(5)
_INITIALS = np.array(["", "D", "I", "K", "R"])


@dataclass(frozen=True)
class Grammar:
    """Role initials as a deterministic automaton: ``moves[state]`` leads from an initial to a state,
    0 is the start.  ``roles``: what Rerole and Insert may write."""

    moves: tuple[dict[str, int], ...]
    accepting: frozenset[int]
    roles: tuple[str, ...]
    pairs: frozenset[str] = field(init=False)

    def __post_init__(self) -> None:
        pairs = {a + b for m in self.moves for a, q in m.items() for b in self.moves[q]}
        object.__setattr__(self, "pairs", frozenset(pairs))
        ends = set(self.accepting)
        for _ in self.moves:
            ends |= {q for q, m in enumerate(self.moves) if any(m.get(r[:1]) in ends for r in self.roles)}
        if len(ends) < len(self.moves):
            raise ValueError("inserts must lead from every state to an accepting one")


#: ``(s?(ua)+)?``: a system row may lead, then users and assistants take turns.
CHAT = Grammar(({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}), frozenset({0, 3}), ("user", "assistant"))


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5   # of a truncated row that stays


class _Graph:
    """Optimal arcs between the nodes of some conversations."""

    def __init__(self, sizes: np.ndarray, initial: np.ndarray, gone: np.ndarray, extra: np.ndarray, grammar: Grammar, costs: Costs) -> None:
        """``sizes``: rows of each conversation; of each row its initial's code (-1: in no move), whether
        it must go, and what keeping it costs."""
        self.states = states = len(grammar.moves)
        symbols = sorted({a for m in grammar.moves for a in m})
        move = np.full((states, len(symbols) + 1), -1)   # the last column: no move
        for q, m in enumerate(grammar.moves):
            for a, to in m.items():
                move[q, symbols.index(a)] = to
        written = [symbols.index(r[:1]) if r[:1] in symbols else -1 for r in grammar.roles]
        self.base = states * np.concatenate(([0], np.cumsum(sizes + 1)))   # first node of each conversation
        self.end = int(self.base[-1])
        rows_before = np.concatenate(([0], np.cumsum(sizes)))
        cost = np.full(self.end + 1, _FAR)
        cost[self.end] = 0
        accepts = np.isin(np.arange(states), list(grammar.accepting))
        # conversations by falling length: those with j rows or more come first
        longest = np.argsort(-sizes, kind="stable")
        for j in range(int(sizes.max(initial=0)) + 1):
            active = longest[:np.searchsorted(-sizes[longest], -j, side="right")]
            layer = self.base[active] + states * (sizes[active] - j)
            best = np.where(accepts, 0 if j == 0 else _FAR, np.full((len(active), states), _FAR))
            if j:
                row = rows_before[active] + sizes[active] - j
                after = np.concatenate((cost[layer[:, None] + states + np.arange(states)], np.full((len(active), 1), _FAR)), axis=1)
                for q in range(states):
                    kept = np.take_along_axis(after, move[q, initial[row]][:, None], axis=1)[:, 0]
                    others = [after[:, move[q, a]] + costs.rerole for a in written]
                    stays = np.min([kept, *others], axis=0) + extra[row]
                    best[:, q] = np.minimum(after[:, q] + costs.delete, np.where(gone[row], _FAR, stays))
            for _ in range(states):
                for q in range(states):
                    for a in written:
                        if move[q, a] >= 0:
                            best[:, q] = np.minimum(best[:, q], best[:, move[q, a]] + costs.insert)
            cost[layer[:, None] + np.arange(states)] = np.minimum(best, _FAR)
        self.cost = cost
        # arcs: from, label, to
        conversation = np.repeat(np.arange(len(sizes)), states * (sizes + 1))
        node = np.arange(self.end)
        state, done = (node - self.base[conversation]) % states, (node - self.base[conversation]) // states
        final = done == sizes[conversation]
        row = np.minimum(rows_before[conversation] + done, max(len(initial) - 1, 0))
        self.state, self.row = state, row
        found: list[tuple[np.ndarray, int, np.ndarray]] = [(node[final & accepts[state]], _END, np.full((final & accepts[state]).sum(), self.end))]

        def add(label: int, allowed: np.ndarray, to: np.ndarray, price: np.ndarray | int) -> None:
            ok = np.flatnonzero(allowed & (to >= 0))
            price = np.broadcast_to(price, len(node))[ok]
            ok = ok[(cost[ok] < _FAR) & (cost[ok] == cost[to[ok]] + price)]
            found.append((ok, label, to[ok]))

        def into(layer: np.ndarray, symbol) -> np.ndarray:
            target = move[state, symbol]
            return np.where(target >= 0, node - state + layer + target, -1)

        for a in written:
            if a >= 0:
                add(_INSERT, np.ones(len(node), dtype=bool), into(np.zeros_like(node), a), costs.insert)
        if len(initial):
            inner = ~final
            add(_DELETE, inner, np.where(inner, node + states, -1), costs.delete)
            stays = inner & ~gone[row]
            add(_KEEP, stays, np.where(inner, into(np.full_like(node, states), initial[row]), -1), extra[row])
            for a in written:
                if a >= 0:
                    add(_REROLE, stays, np.where(inner, into(np.full_like(node, states), a), -1), extra[row] + costs.rerole)
        self.tail = np.concatenate([f[0] for f in found])
        self.label = np.concatenate([np.full(len(f[0]), f[1]) for f in found])
        self.head = np.concatenate([f[2] for f in found])

    def ranks(self) -> np.ndarray:
        """Ranks of all nodes by the least audit of their optimal paths; the end has the least."""
        n = self.end + 1
        rank = np.full(n, _REROLE + 1)
        np.minimum.at(rank, self.tail, self.label)
        rank[self.end] = _END
        least = self.label == rank[self.tail]
        # pairs (node, where its least audit of the present length may end), sorted
        pairs = np.unique(np.append(self.tail[least] * n + self.head[least], self.end * n + self.end))
        while True:
            start, stop = np.divmod(pairs, n)
            if (stop == self.end).all():
                return rank
            lowest = np.full(n, n)
            np.minimum.at(lowest, start, rank[stop])
            kept = rank[stop] == lowest[start]
            first = np.searchsorted(start, np.arange(n + 1))
            many = (first[1:] - first[:-1])[stop[kept]]
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[stop[kept]], many)
            pairs = np.unique(np.repeat(start[kept], many) * n + stop[place])
            rank = np.unique(rank * (n + 1) + lowest, return_inverse=True)[1]

    def paths(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each conversation, in any order, its number, the nodes of its least path and their labels."""
        rank = self.ranks()
        order = np.lexsort((self.head, rank[self.head], self.label, self.tail))
        first = order[np.unique(self.tail[order], return_index=True)[1]]
        jump, label = np.full(self.end + 1, self.end), np.zeros(self.end + 1, dtype=np.int64)
        jump[self.tail[first]], label[self.tail[first]] = self.head[first], self.label[first]
        self.follower = jump
        open_, walked = np.arange(len(self.base) - 1), self.base[:-1, None]
        while len(open_):
            walked = np.concatenate((walked, jump[walked]), axis=1)
            ended = walked[:, -1] == self.end
            for c, nodes in zip(open_[ended].tolist(), walked[ended], strict=True):
                nodes = nodes[:np.searchsorted(nodes == self.end, True)]
                yield c, nodes, label[nodes]
            open_, walked, jump = open_[~ended], walked[~ended], jump[jump]


def _measured(rows: list[dict], grammar: Grammar, symbols: list[str], costs: Costs) -> tuple[dict[str, int], list[tuple[int, bool, int]]]:
    """Counts of a conversation, and of each row its initial's code, whether it must go, its extra cost."""
    seen: set[tuple[str, str]] = set()
    count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    out = []
    for r in rows:
        role, text = r["role"], r["text"]
        fault = None
        if not _SOLID.search(text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.rstrip(" \t\n\v\f\r")[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            count[fault] += 1
        code = symbols.index(role[:1]) if role[:1] in symbols else -1
        out.append((code, fault in ("blank", "duplicate"), costs.truncated if fault == "truncated" else 0))
    turns = {r["turn"] for r in rows if r["turn"] is not None}
    count["gaps"] = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r["role"][:1] for r in rows]
    count["illegal"] = sum(a + b not in grammar.pairs for a, b in zip(initials, initials[1:], strict=False))
    return count, out


def repair_all(conversations: list[list[dict]], grammar: Grammar = CHAT, costs: Costs = Costs()) -> list[dict]:
    """Counts, cost, audit and repaired rows of conversations, each given as its rows in order."""
    symbols = sorted({a for m in grammar.moves for a in m})
    measured = [_measured(rows, grammar, symbols, costs) for rows in conversations]
    flat = np.array([x for _, rows in measured for x in rows], dtype=np.int64).reshape(-1, 3)
    sizes = np.array([len(rows) for rows in conversations], dtype=np.int64)
    graph = _Graph(sizes, flat[:, 0], flat[:, 1].astype(bool), flat[:, 2], grammar, costs)
    # by state and next state: the first role that leads there
    role_for = {(q, m[r[:1]]): r for r in reversed(grammar.roles) for q, m in enumerate(grammar.moves) if r[:1] in m}
    begins = np.concatenate(([0], np.cumsum(sizes)))
    out: list[dict] = [{}] * len(conversations)
    for c, nodes, labels in graph.paths():
        rows, fixed = conversations[c], []
        heads = graph.follower[nodes]
        for v, label, w in zip(nodes.tolist(), labels.tolist(), heads.tolist(), strict=True):
            if label == _KEEP:
                fixed.append({"role": rows[graph.row[v] - begins[c]]["role"], "text": rows[graph.row[v] - begins[c]]["text"]})
            elif label in (_REROLE, _INSERT):
                fixed.append({"role": role_for[graph.state[v], graph.state[w]],
                              "text": rows[graph.row[v] - begins[c]]["text"] if label == _REROLE else ""})
        out[c] = measured[c][0] | {"cost": int(graph.cost[graph.base[c]]), "audit": "".join(_INITIALS[labels]), "repaired": fixed}
    return out


def repair(turns: DataFrame, *, grammar: Grammar = CHAT, costs: Costs = Costs(), conv_id: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """One row per conversation: its id, gaps (numbers missing between its least and largest turn),
    blank, duplicate, truncated (rows by first fault), illegal (neighbours that the grammar never has),
    cost, audit and repaired (array<struct<role, text>>).

    ``gone``: a boolean column; rows where it holds don't take part, but their conversation is returned.
    """
    row = F.struct(F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                   F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    if gone is not None:
        row = F.when(~F.col(f"`{gone}`"), row)
    held = turns.select(F.col(f"`{conv_id}`").alias("_id"), row.alias("_row")).groupBy("_id").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    kind = held.schema["_id"].dataType.simpleString()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    lines = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = repair_all(b.column(1).to_pylist(), grammar, costs)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([d[x] for d in done], pa.int64()) for x in numbers], pa.array([d["audit"] for d in done], pa.string()),
                 pa.array([d["repaired"] for d in done], lines)], ["_id", *numbers, "audit", "repaired"])

    made = map_arrow(held, work, f"_id {kind}, {', '.join(f'{x} long' for x in numbers)}, audit string, repaired array<struct<role: string, text: string>>")
    return made.withColumnRenamed("_id", conv_id)
