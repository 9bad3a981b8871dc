"""Prefix tree over ordered sets, and the similarity join of the sets in one block."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def similar(overlap: int, a: int, b: int, percent: int) -> bool:
    """Jaccard similarity of at least ``percent`` hundredths, in whole numbers."""
    return 100 * overlap >= percent * (a + b - overlap)


@dataclass
class Node:
    """A run of elements shared by all sets below."""

    run: np.ndarray
    sets: range
    least: int = 0
    most: int = 0
    ends: list[int] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)


class Forest:
    """Joined sets: sets in one tree need no comparison."""

    def __init__(self, labels: list[int]):
        first: dict[int, int] = {}
        self.up = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


def global_order(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets as ordered numbers, elements of most sets first.

    Frequent elements first lets similar sets share long paths of the tree.
    """
    everything = np.concatenate(sets)
    values, inverse, counts = np.unique(everything, return_inverse=True, return_counts=True)
    place = np.empty(len(values), np.int64)
    place[np.argsort(-counts, kind="stable")] = np.arange(len(values))
    ordered = place[inverse]
    bounds = np.cumsum([0] + [len(s) for s in sets])
    return [np.sort(ordered[i:j]) for i, j in zip(bounds, bounds[1:])]


def _shared(a: np.ndarray, b: np.ndarray, start: int) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[start:n] != b[start:n])
    return start + int(differ[0]) if len(differ) else n


def build(sets: list[np.ndarray]) -> Node:
    """Tree of sets that are sorted as sequences; ``ends`` are set numbers."""
    sizes = [len(s) for s in sets]
    root = Node(np.zeros(0, np.int64), range(len(sets)))
    stack = [(root, 0, len(sets), 0)]
    while stack:
        node, low, high, depth = stack.pop()
        node.least, node.most = min(sizes[low:high]), max(sizes[low:high])
        while low < high and sizes[low] == depth:  # a prefix of the others sorts first
            node.ends.append(low)
            low += 1
        while low < high:
            head, stop = sets[low][depth], low + 1
            while stop < high and sets[stop][depth] == head:
                stop += 1
            reach = _shared(sets[low], sets[stop - 1], depth)
            child = Node(sets[low][depth:reach], range(low, stop))
            node.children.append(child)
            stack.append((child, low, stop, reach))
            low = stop
    return root


def join_block(
    sets: list[np.ndarray], labels: list[int], percent: int
) -> list[tuple[int, int]]:
    """Links that connect what the similar pairs of a block connect.

    ``labels`` tell which sets are known to be connected.  Each set probes the
    tree of all sets.  Sets below one node share the overlap counted on the way
    to it.  A subtree is left when even full agreement on what remains would
    not reach the threshold for the sizes in it, or when all its sets are
    connected with the probe.  Returns positions ``(i, j)``; as many links as
    it takes, not all pairs.
    """
    ordered = global_order(sets)
    rank = sorted(range(len(sets)), key=lambda i: ordered[i].tolist())
    ordered = [ordered[i] for i in rank]
    forest = Forest([labels[i] for i in rank])
    root = build(ordered)
    has = np.zeros(1 + max((int(s[-1]) for s in ordered if len(s)), default=0), bool)
    links = []
    for probe, own in enumerate(ordered):
        n = len(own)
        has[own] = True
        stack = [(root, 0, 0)]
        while stack:
            node, depth, overlap = stack.pop()
            if (
                node.sets.stop <= probe + 1
                or 100 * n < percent * node.least
                or 100 * node.most < percent * n
            ):
                continue
            mine = forest.find(probe)
            if all(forest.find(i) == mine for i in node.sets):
                continue
            overlap += int(np.count_nonzero(has[node.run]))
            depth += len(node.run)
            # The best size below: all that remains agrees, without outgrowing the probe.
            size = min(node.most, max(node.least, n - overlap + depth))
            if not similar(min(n, overlap + size - depth), n, size, percent):
                continue
            for i in node.ends:
                if i > probe and similar(overlap, n, depth, percent):
                    if forest.find(i) != forest.find(probe):
                        forest.join(i, probe)
                        links.append((rank[probe], rank[i]))
            stack.extend((child, depth, overlap) for child in node.children)
        has[own] = False
    return links
