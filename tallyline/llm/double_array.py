"""Double-array tries over dense ids: BASE and CHECK in numpy.

The child of slot s by label x is slot t = BASE[s] + x if CHECK[t] = s. Slot 0 is the root; free slots have CHECK -1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Free slots that are tried as the first child's place before a family goes behind all others.
TRIES = 64


def shared_turns(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many leading ids each sequence has in common with the one before it; 0 for the first."""
    sizes = np.diff(starts)
    out = np.zeros(len(sizes), np.int64)
    alive = np.arange(1, len(sizes))
    depth = 0
    while len(alive):
        alive = alive[(sizes[alive - 1] > depth) & (sizes[alive] > depth)]
        alive = alive[ids[starts[alive - 1] + depth] == ids[starts[alive] + depth]]
        depth += 1
        out[alive] = depth
    return out


def nodes_of(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent and label of every node below the root, and the node in which each sequence ends.

    Sequences are distinct and stand in an order in which those with a common beginning are neighbours, the shorter
    first. Nodes are numbered from 1 in that order; the root is 0.
    """
    sizes, known = np.diff(starts), shared_turns(ids, starts)
    new = sizes - known
    first = 1 + np.cumsum(new) - new
    made = np.repeat(np.arange(len(sizes)), new)
    nodes = np.arange(1, int(new.sum()) + 1)
    labels = ids[starts[made] + known[made] + nodes - first[made]]
    parents = nodes - 1
    # The first new node of a sequence hangs on the path of the ones before it.
    path = np.zeros(int(sizes.max(initial=0)) + 1, np.int64)
    for k in range(len(sizes)):
        if new[k]:
            parents[first[k] - 1] = path[known[k]]
            path[known[k] + 1 : sizes[k] + 1] = nodes[first[k] - 1 : first[k] - 1 + new[k]]
    return parents, labels, np.where(new > 0, first + new - 1, 0)


@dataclass
class DoubleArray:
    base: np.ndarray
    check: np.ndarray

    @classmethod
    def packed(cls, parents: np.ndarray, labels: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
        """The arrays of a trie whose nodes from 1 on have the given parents and labels, and the slot of every node."""
        count = len(parents) + 1
        order = np.lexsort((labels, parents))
        family, begins, sizes = np.unique(parents[order], return_index=True, return_counts=True)
        span = int(labels.max(initial=0)) + 1
        used, end = np.zeros(2 * (count + span), bool), 1
        used[0] = True
        slot, base = np.zeros(count, np.int64), np.zeros(count, np.int64)
        lone = sizes == 1
        # Large families first, as they are the hardest to fit in.
        for k in np.flatnonzero(~lone)[np.argsort(-sizes[~lone], kind="stable")]:
            members = order[begins[k] : begins[k] + sizes[k]]
            away = labels[members] - labels[members[0]]
            free = np.flatnonzero(~used[:end])[:TRIES]
            fits = free[~used[free[:, None] + away].any(axis=1)] if len(free) else free
            at = int(fits[0]) if len(fits) else end
            slot[members + 1] = at + away
            base[family[k]] = at - labels[members[0]]
            used[at + away] = True
            end = max(end, at + int(away[-1]) + 1)
            if end + span >= len(used):
                used = np.concatenate([used, np.zeros(len(used), bool)])
        members = order[begins[lone]]
        used = np.concatenate([used, np.zeros(len(members), bool)])
        spots = np.flatnonzero(~used)[: len(members)]
        slot[members + 1] = spots
        base[family[lone]] = spots - labels[members]
        size = int(slot.max(initial=0)) + 1
        bases, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        bases[slot] = base
        check[slot[1:]] = slot[parents]
        return cls(bases, check), slot

    def walk(self, ids: np.ndarray) -> np.ndarray:
        """The slots met by following a sequence from the root on, as far as it goes; the root first."""
        met = [0]
        for x in ids.tolist():
            t = int(self.base[met[-1]]) + x
            if x < 0 or not 0 < t < len(self.check) or self.check[t] != met[-1]:
                break
            met.append(t)
        return np.array(met)

    def levels(self) -> list[np.ndarray]:
        """The slots of each depth, from the root on, found through CHECK alone."""
        order = np.argsort(self.check, kind="stable")
        begins = np.searchsorted(self.check[order], np.arange(len(self.check) + 1))
        out = [np.zeros(1, np.int64)]
        while True:
            first, last = begins[out[-1]], begins[out[-1] + 1]
            sizes = last - first
            if not sizes.any():
                return out
            out.append(order[np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())])

    def labels(self, slots: np.ndarray) -> np.ndarray:
        """The label by which each slot but the root hangs on its parent."""
        return slots - self.base[self.check[slots]]
