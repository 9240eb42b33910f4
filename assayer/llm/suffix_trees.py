"""Suffix trees of number sequences, built online, and constant-time longest common extensions on them."""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """Ukkonen's tree of ``text`` (numbers from 1) and an end mark 0 behind it.

    Nodes are numbered; ``start`` and ``stop`` tell a node's label in the text, ``edges`` leads from a node and the
    first number of a label to the node below. A leaf's ``stop`` is the end of the text.
    """

    def __init__(self, text: list[int]):
        self.text = [*text, 0]
        self.size = len(self.text)
        self.width = max(text, default=0) + 1
        self.start, self.stop, self.edges = [0], [0], {}
        self._build()

    def _build(self) -> None:
        text, size, width = self.text, self.size, self.width
        start, stop, edges = self.start, self.stop, self.edges
        link = [0]
        node = 0  # where the next suffix is to be inserted: below ``node``, ``depth`` numbers along the label
        begin = depth = pending = 0  # that begins like ``text[begin:]``
        for place, number in enumerate(text):
            pending += 1
            last = 0  # the inner node made last, which still lacks its suffix link
            while pending:
                if not depth:
                    begin = place
                key = node * width + text[begin]
                below = edges.get(key)
                if below is None:
                    edges[key] = len(start)
                    start.append(place)
                    stop.append(size)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    first, end = start[below], stop[below]
                    if end > place:
                        end = place + 1  # a leaf's label has grown so far only
                    if depth >= end - first:
                        begin += end - first
                        depth -= end - first
                        node = below
                        continue
                    if text[first + depth] == number:
                        depth += 1
                        if last:
                            link[last] = node
                        break
                    split = len(start)
                    start += (first, place)
                    stop += (first + depth, size)
                    link += (0, 0)
                    edges[key] = split
                    edges[split * width + number] = split + 1
                    edges[split * width + text[first + depth]] = below
                    start[below] = first + depth
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if node:
                    node = link[node]
                elif depth:
                    depth -= 1
                    begin = place - pending + 1

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of their leaves, and the depth of the node that each leaf shares with the one before.

        This is the Euler tour without the stretches that only go down or only up. ``reverse`` takes larger
        numbers first; the end mark comes first in both orders.
        """
        width, size = self.width, self.size
        keys = np.fromiter(self.edges.keys(), np.int64, len(self.edges))
        nodes = np.fromiter(self.edges.values(), np.int64, len(self.edges))
        owner, number = keys // width, keys % width
        if reverse:
            number = np.where(number > 0, width - number, 0)
        # children of a node lie together, the last one first, as a stack wants them
        order = np.argsort(owner * width - number + width, kind="stable")
        count = np.bincount(owner, minlength=len(self.start))
        until = np.cumsum(count)
        children = nodes[order].tolist()
        since, until = (until - count).tolist(), until.tolist()
        length = (np.array(self.stop) - np.array(self.start)).tolist()
        suffixes, shared = [], []
        stack, depths, turn = [0], [0], 0  # a node and the depth of its parent
        while stack:
            node, above = stack.pop(), depths.pop()
            if turn:  # a leaf came before, so this node is not its parent's first child
                turn = 0
                shared.append(above)
            low, high = since[node], until[node]
            depth = above + length[node]
            if low == high:
                suffixes.append(size - depth)
                turn = 1
            else:
                stack += children[low:high]
                depths += [depth] * (high - low)
        return np.array(suffixes, np.int64), np.array([0, *shared], np.int64)


def ranks(suffixes: np.ndarray) -> np.ndarray:
    """Place of each suffix in an order of them."""
    out = np.empty(len(suffixes), np.int64)
    out[suffixes] = np.arange(len(suffixes))
    return out


class Extensions:
    """How far two suffixes agree, in constant time: the depth of the lowest common ancestor of their leaves.

    The least depth on the tour between two leaves is looked up in a table of the least values of all stretches whose
    length is a power of two.
    """

    def __init__(self, suffixes: np.ndarray, shared: np.ndarray):
        self.rank = ranks(suffixes)
        self.size = len(suffixes)
        self.least = [shared.astype(np.int32)]
        step = 1
        while 2 * step <= len(shared):
            row = self.least[-1]
            self.least.append(np.minimum(row[:-step], row[step:]))
            step *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b``, which differ."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            row = self.least[k]
            out[here] = np.minimum(row[low[here]], row[high[here] - (1 << int(k)) + 1])
        return out
