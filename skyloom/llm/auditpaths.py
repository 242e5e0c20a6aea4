"""Cheapest edits of many conversations at once, in numpy: costs by dynamic programming, audits by prefix doubling.

A conversation is a word over sixteen symbols, one for each turn: the class of its role (system, user, assistant,
other) and its fault (none, truncated, blank, duplicate).  A node is a place in the word and a state of the order
that is asked for: 0 nothing yet, 1 after a system turn, 2 after a user's, 3 after an assistant's.  An arc is an edit.
"""

from collections.abc import Sequence

import numpy as np

LETTERS = b"\x00DIKR"  # in the order of their codes; a path that has ended sorts before all
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = np.int64(1) << 40
STATES = 4
NEXT = np.array([2, 2, 3, 2])  # the state after the one role that may come next
AT_ONCE = 1 << 16

_symbol = np.arange(16)[:, None]
_class, _fault = _symbol // 4, _symbol % 4
_extra = np.where(_fault == 1, TRUNCATED, 0)
_fits = _class == np.where(NEXT == 3, 2, 1)
_opens = (_class == 0) & (np.arange(STATES) == 0)
KEEP_COST = np.where((_fault < 2) & (_fits | _opens), KEEP + _extra, FAR)
KEEP_TO = np.where(_opens, 1, NEXT)
REROLE_COST = np.where(_fault < 2, REROLE + _extra, FAR) + np.zeros((1, STATES), np.int64)


def with_inserts(cost: np.ndarray) -> np.ndarray:
    """Costs to go (n x 4) where turns may also be inserted first; two insertions in a row are the most that help."""
    out = cost.copy()
    out[:, 2] = np.minimum(cost[:, 2], INSERT + cost[:, 3])
    out[:, 3] = np.minimum(cost[:, 3], INSERT + cost[:, 2])
    for s in (0, 1):
        out[:, s] = np.minimum(cost[:, s], INSERT + out[:, 2])
    return out


#: Costs to go after the last turn: it is over in states 0 and 3.
AT_END = with_inserts(np.array([[0, FAR, FAR, 0]], np.int64))[0]


def aligned(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the words, aligned at their ends, and the words' first columns."""
    length = max(map(len, words))
    rows = b"".join(w.rjust(length, b"a") for w in words)
    symbols = np.frombuffer(rows, np.uint8).reshape(len(words), length).astype(int) - 97
    return symbols, length - np.array([len(w) for w in words])


def costs_to_go(symbols: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least costs from each node to the end (places + 1, words, 4), given those at the end (words, 4)."""
    words, places = symbols.shape
    out = np.empty((places + 1, words, STATES), np.int64)
    out[places] = end
    for i in range(places - 1, -1, -1):
        after, symbol = out[i + 1], symbols[:, i]
        kept = KEEP_COST[symbol] + np.take_along_axis(after, KEEP_TO[symbol], 1)
        rerolled = REROLE_COST[symbol] + after[:, NEXT]
        out[i] = np.minimum(with_inserts(np.minimum(np.minimum(kept, rerolled), DELETE + after)), FAR)
    return out


def matrices(words: Sequence[bytes]) -> np.ndarray:
    """Least costs from each state before a word to each state after it (words, 4, 4)."""
    out = np.empty((len(words), STATES, STATES), np.int64)
    for part, symbols, first in _parts(words):
        for t in range(STATES):
            end = np.full((len(part), STATES), FAR)
            end[:, t] = 0
            out[part, :, t] = costs_to_go(symbols, end)[first, np.arange(len(part))]
    return out


def _parts(words: Sequence[bytes]):
    """Words of like lengths together, few enough that all their nodes fit in memory."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * lengths[order[stop]] <= AT_ONCE:
            stop += 1
        part = order[start:stop]
        yield part, *aligned([words[i] for i in part])
        start = stop


def audits(words: Sequence[bytes], end: np.ndarray, last: np.ndarray, begin: np.ndarray) -> tuple[list[list[bytes]], np.ndarray]:
    """The least audits among the cheapest, from each state in ``begin`` (words, m), and the states they end in.

    ``end`` has the costs to go after each word (words, 4), and ``last`` says after which words a conversation ends.
    """
    found: list[list[bytes]] = [[] for _ in words]
    states = np.zeros(begin.shape, int)
    for part, symbols, first in _parts(words):
        heads, there = _optimal_arcs(symbols, costs_to_go(symbols, end[part]), last[part])
        letter, head = _selected(heads, there, _ranks(heads, there))
        jumps = [head]
        while (letter[jumps[-1]] > 0).any():
            jumps.append(jumps[-1][jumps[-1]])
        count = len(part)
        nodes = ((first[:, None] * count + np.arange(count)[:, None]) * STATES + begin[part]).reshape(-1, 1)
        states[part] = (jumps[-1][nodes] % STATES).reshape(begin[part].shape)
        for jump in reversed(jumps[:-1]):  # nodes after 0, 2^k, 2 * 2^k ... edits, then those half way between
            nodes = np.stack([nodes, jump[nodes]], axis=2).reshape(len(nodes), -1)
        text = np.frombuffer(LETTERS, np.uint8)[letter[nodes]].reshape(count, begin.shape[1], -1)
        for w, rows in zip(part, text, strict=True):
            found[w] = [r[r > 0].tobytes() for r in rows]
    return found, states


def _optimal_arcs(symbols: np.ndarray, cost: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a node's arcs D, I, K, R lead (4 x nodes), and which of them lie on a cheapest path.

    A state lets one role come next, so the arcs of a node carry distinct letters.  A node at the end has none.
    """
    count, places = symbols.shape
    index = np.arange((places + 1) * count * STATES).reshape(places + 1, count, STATES)
    heads = np.broadcast_to(index, (4, *index.shape)).copy()
    there = np.zeros(heads.shape, bool)
    symbol, after, below, here = symbols.T, cost[1:], index[1:], cost[:-1]
    keep_to = KEEP_TO[symbol]
    arcs = [
        (DELETE + after, below),
        (INSERT + here[:, :, NEXT], index[:-1][:, :, NEXT]),
        (KEEP_COST[symbol] + np.take_along_axis(after, keep_to, 2), np.take_along_axis(below, keep_to, 2)),
        (REROLE_COST[symbol] + after[:, :, NEXT], below[:, :, NEXT]),
    ]
    for k, (price, head) in enumerate(arcs):
        there[k, :-1] = (price == here) & (price < FAR)
        heads[k, :-1] = head
    there[1, places] = last[:, None] & (cost[places] > 0) & (cost[places] == INSERT + cost[places][:, NEXT])
    heads[1, places] = index[places][:, NEXT]
    return heads.reshape(4, -1), there.reshape(4, -1)


def _selected(heads: np.ndarray, there: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letter (0 at an end) and head of each node's least arc, by letter and then by the rank of its head."""
    wide = int(rank.max(initial=0)) + 1
    keys = np.where(there, np.arange(1, 5)[:, None] * wide + rank[heads], 5 * wide)
    arc = keys.argmin(0)
    ended = ~there.any(0)
    nodes = np.arange(heads.shape[1])
    return np.where(ended, 0, arc + 1), np.where(ended, nodes, heads[arc, nodes])


def _ranks(heads: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Ranks of all nodes by their least audits, found for audits of 1, 2, 4 ... edits.

    A rank of twice the length is that of a pair: a node's rank, and the rank of the node as many edits further on.
    """
    letter, jump = _selected(heads, there, np.zeros(heads.shape[1], np.int64))
    rank = letter.astype(np.int64)
    while (letter[jump] > 0).any():
        pairs = rank * (int(rank.max(initial=0)) + 1) + rank[jump]
        rank = np.unique(pairs, return_inverse=True)[1].reshape(-1)
        jump = jump[jump]
    return rank
