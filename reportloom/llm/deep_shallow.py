"""Deep-shallow suffix sorting.

Multikey quicksort, whose characters are words of eight bytes, orders suffixes to a shallow depth. Groups that still
agree there are ordered by blind tries: a trie of branching depths only, in which a new string goes down blindly to any
leaf, is compared with that leaf once, and is put in where the two first differ.
"""

from __future__ import annotations

import numpy as np

#: Depth of the quicksort in bytes; a multiple of eight.
SHALLOW = 40


def common(a: bytes, b: bytes) -> int:
    """How many bytes two strings begin alike with."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Strings by their branching depths. A node is [depth, {byte: node}, strings that end there]; a leaf's depth is its string's length."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings, self.root = strings, None

    def add(self, k: int) -> None:
        s = self.strings[k]
        if self.root is None:
            self.root = [len(s), {}, [k]]
            return
        node = self.root
        while node[1]:
            nxt = node[1].get(s[node[0]]) if node[0] < len(s) else None
            if nxt is None:
                nxt = next(iter(node[1].values()))
            node = nxt
        other = self.strings[node[2][0]]
        same = common(s, other)
        parent, byte, node = None, 0, self.root
        while node[0] < same and node[1]:
            parent, byte = node, s[node[0]]
            node = node[1][byte]
        if node[0] == same:  # a branching or an end at this very depth
            if same == len(s):
                node[2].append(k)
            else:
                node[1][s[same]] = [len(s), {}, [k]]
            return
        fork = [same, {other[same]: node}, []]
        if same == len(s):
            fork[2].append(k)
        else:
            fork[1][s[same]] = [len(s), {}, [k]]
        if parent is None:
            self.root = fork
        else:
            parent[1][byte] = fork

    def walk(self, order: list[int], lcp: list[int]) -> None:
        """Appends the strings in order; lcp gets how far each agrees with the one before (the first: 0)."""
        stack = [(self.root, 0)]
        while stack:
            node, above = stack.pop()
            first = True
            for k in node[2]:
                order.append(k)
                lcp.append(above if first else len(self.strings[k]))
                first = False
            for i, (_, child) in enumerate(sorted(node[1].items(), reverse=True)):
                last = i == len(node[1]) - 1
                stack.append((child, above if last and first else node[0]))


def words(strings: list[bytes]) -> np.ndarray:
    """The first SHALLOW bytes of each string, as big-endian words; an end counts as zero bytes."""
    n = len(strings)
    flat = b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings)
    return np.frombuffer(flat, ">u8").reshape(n, SHALLOW // 8).astype(np.uint64)


def suffix_sort(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings, and how many bytes each has in common with the one before it in that order."""
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = words(strings)
    order, lcp = [], []
    stack = [(np.arange(n), 0)]
    while stack:
        own, depth = stack.pop()
        if depth == SHALLOW // 8 or len(own) == 1:
            trie = BlindTrie(strings)
            for k in own.tolist():
                trie.add(k)
            begin = len(order)
            trie.walk(order, lcp)
            if begin:
                lcp[begin] = common(strings[order[begin - 1]], strings[order[begin]])
            continue
        column = key[own, depth]
        probe = np.sort(column[:: max(1, len(own) // 9)])
        pivot = probe[len(probe) // 2]
        for part, deeper in ((column > pivot, 0), (column == pivot, 1), (column < pivot, 0)):
            if part.any():
                stack.append((own[part], depth + deeper))
    return np.array(order, np.int64), np.array(lcp, np.int64)
