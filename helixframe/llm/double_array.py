"""Double-array tries over bytes with tails, built and walked by numpy."""

from __future__ import annotations

import numpy as np

#: Nodes of more children are placed first, while the array is empty.
_CLASSES = (129, 65, 33, 17, 9, 5, 3, 2)
_ROUNDS = 400
#: Below all places that a base can name.
LEAF = -1024


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places of begin .. begin + length - 1, one after the other."""
    upto = np.cumsum(length)
    return np.repeat(begin - upto + length, length) + np.arange(upto[-1] if len(upto) else 0)


def differ(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether a[at:at + length] and b[bt:bt + length] differ, for each."""
    bad = a[spread(at, length)] != b[spread(bt, length)]
    out = np.zeros(len(length), dtype=bool)
    if bad.any():
        out[np.repeat(np.arange(len(length)), length)[bad]] = True
    return out


class DoubleArray:
    """The state reached from state s by byte b is t = base[s] + b, if
    check[t] = s; state 0 is the root.  Where only one key is left, base[t]
    is LEAF - number of the key, and the rest of it lies in ``tails``, cut by
    ``edges``; keys that end where others go on are in ``inner`` (states,
    ascending, and numbers)."""

    def __init__(self, base: np.ndarray, check: np.ndarray, tails: np.ndarray, edges: np.ndarray, inner: np.ndarray) -> None:
        self.parts = base, check, tails, edges, inner
        self.base, self.check, self.tails, self.edges, self.inner = self.parts

    @classmethod
    def build(cls, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> "DoubleArray":
        """Of the distinct non-empty keys data[begin:end] (uint8), which follow one another."""
        kind = np.int32 if len(data) < 1 << 31 else np.int64
        begin, end = begin.astype(kind), end.astype(kind)
        node = np.zeros(len(begin), dtype=np.int32)
        rest = end.copy()  # where each key's tail begins
        alone = np.zeros(len(begin), dtype=bool)
        parents, symbols = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.uint8)]
        nodes, depth, active = 1, 0, np.arange(len(begin), dtype=np.int32)
        while len(active):
            edge, which, held = np.unique(node[active].astype(np.int64) << 8 | data[begin[active] + depth],
                                          return_inverse=True, return_counts=True)
            parents.append((edge >> 8).astype(np.int32))
            symbols.append((edge & 255).astype(np.uint8))
            node[active] = nodes + which
            nodes += len(edge)
            depth += 1
            last = held[which] == 1
            alone[active[last]] = True
            rest[active[last]] = begin[active[last]] + depth
            active = active[~last]
            active = active[end[active] - begin[active] > depth]
        parent, symbol = np.concatenate(parents), np.concatenate(symbols)  # ascending by parent
        size = 256 + nodes + nodes // 4
        while (placed := _place(parent, symbol, nodes, size)) is None:
            size += size // 4
        offset, slot = placed
        base, check = np.zeros(size + 256, np.int32), np.full(size + 256, -1, np.int32)
        base[slot] = offset
        check[slot[1:]] = slot[parent]
        base[slot[node[alone]]] = LEAF - np.flatnonzero(alone)
        inner = np.stack([slot[node[~alone]], np.flatnonzero(~alone)]).astype(np.int32)
        cover = np.zeros(len(data) + 1, dtype=np.int8)
        np.add.at(cover, rest, 1)
        np.subtract.at(cover, end, 1)
        edges = np.concatenate([[0], np.cumsum(end - rest)]).astype(kind)
        return cls(base, check, data[np.cumsum(cover[:-1], dtype=np.int8) > 0], edges, inner[:, np.argsort(inner[0])])

    @classmethod
    def of(cls, keys: list[bytes]) -> "DoubleArray":
        ends = np.cumsum([0, *map(len, keys)], dtype=np.int64)
        return cls.build(np.frombuffer(b"".join(keys), dtype=np.uint8), ends[:-1], ends[1:])

    def find(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of the key that each data[begin:end] is, or -1: all
        advance together, level by level."""
        out = np.full(len(begin), -1, dtype=np.int32)
        item = np.flatnonzero(end > begin)
        at, state = begin[item], np.zeros(len(item), dtype=np.int32)
        while len(item):
            to = self.base[state] + data[at]
            ok = np.flatnonzero(self.check[to] == state)
            item, state, at = item[ok], to[ok], at[ok] + 1
            left = self.base[state]
            leaf, over = left <= LEAF, at >= end[item]
            if leaf.any():
                self._end(out, item[leaf], LEAF - left[leaf], data, at[leaf], end)
            done = np.flatnonzero(over & ~leaf)
            if len(done) and self.inner.shape[1]:
                spot = np.minimum(np.searchsorted(self.inner[0], state[done]), self.inner.shape[1] - 1)
                out[item[done]] = np.where(self.inner[0][spot] == state[done], self.inner[1][spot], -1)
            on = np.flatnonzero(~(leaf | over))
            item, state, at = item[on], state[on], at[on]
        return out

    def _end(self, out: np.ndarray, item: np.ndarray, key: np.ndarray, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> None:
        """Keys whose tails are what is left."""
        length = end[item] - at
        fits = np.flatnonzero(length == self.edges[key + 1] - self.edges[key])
        item, key, at, length = item[fits], key[fits], at[fits], length[fits]
        out[item] = np.where(differ(data, at, self.tails, self.edges[key], length), -1, key)


def _place(parent: np.ndarray, symbol: np.ndarray, nodes: int, size: int) -> tuple[np.ndarray, np.ndarray] | None:
    """base of each node and slot of each node (edge e leads to node e + 1),
    or None where the array is too small.  Nodes with several children try
    random places, all of a class at once; single children fill what is free.
    A base may lie up to 255 below 0; then no other byte meets a slot of its own."""
    rng = np.random.default_rng(nodes)
    children = np.bincount(parent, minlength=nodes).astype(np.int32)
    first = np.searchsorted(parent, np.arange(nodes, dtype=np.int32)).astype(np.int32)
    base, slot = np.zeros(nodes, np.int32), np.zeros(nodes, np.int32)
    used, claim = np.zeros(size + 256, dtype=bool), np.zeros(size + 256, dtype=np.int32)
    used[0] = True
    above = 257
    for least in _CLASSES:
        todo = np.flatnonzero((children >= least) & (children < above))
        above = least
        for _ in range(_ROUNDS):
            if not len(todo):
                break
            n = children[todo]
            owner = np.repeat(np.arange(len(todo), dtype=np.int32), n)
            edge = spread(first[todo], n)
            at = rng.integers(0, size, len(todo), dtype=np.int32)
            spot = at[owner] + symbol[edge]
            claim[spot] = owner
            failed = np.bincount(owner[used[spot] | (claim[spot] != owner)], minlength=len(todo)) > 0
            good = ~failed[owner]
            used[spot[good]] = True
            slot[edge[good] + 1] = spot[good]
            base[todo[~failed]] = at[~failed]
            todo = todo[failed]
        if len(todo):
            return None
    alone = np.flatnonzero(children == 1)
    free = np.flatnonzero(~used)[:len(alone)]
    if len(free) < len(alone):
        return None
    edge = first[alone]
    slot[edge + 1] = free
    base[alone] = free - symbol[edge]
    return base, slot
