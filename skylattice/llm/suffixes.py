"""Sorting of fixed-length suffixes, deep and shallow.

A multikey quicksort orders the strings by their first characters, where a
character is eight bytes wide: only strings that tie on one character are
compared by the next, down to a shallow depth. Groups that still tie share a long
prefix; they are ordered by blind tries, which look at branching bytes on the way
down and at one whole string at the end.
"""

from __future__ import annotations

import numpy as np


class BlindTrie:
    """A compacted trie of strings of equal length, given as big-endian integers."""

    def __init__(self, length: int):
        self.length = length
        self.root: list | None = None

    def _byte(self, value: int, at: int) -> int:
        return value >> 8 * (self.length - 1 - at) & 255

    def insert(self, value: int, row: int) -> None:
        """Add ``row``; a node is [depth, children] or, with depth -1, [-1, value, rows]."""
        if self.root is None:
            self.root = [-1, value, [row]]
            return
        node = self.root
        while node[0] >= 0:  # blind: bytes between branches are not looked at
            kids = node[1]
            node = kids.get(self._byte(value, node[0])) or next(iter(kids.values()))
        differ = node[1] ^ value
        if differ == 0:
            node[2].append(row)
            return
        depth = self.length - (differ.bit_length() + 7) // 8
        parent, node = None, self.root
        while 0 <= node[0] < depth:
            parent, node = node, node[1][self._byte(value, node[0])]
        leaf = [-1, value, [row]]
        if node[0] == depth:
            node[1][self._byte(value, depth)] = leaf
            return
        some = node
        while some[0] >= 0:
            some = next(iter(some[1].values()))
        branch = [depth, {self._byte(value, depth): leaf, self._byte(some[1], depth): node}]
        if parent is None:
            self.root = branch
        else:
            parent[1][self._byte(value, parent[0])] = branch

    def groups(self) -> list[list[int]]:
        """Rows of equal strings, in string order."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] < 0:
                out.append(node[2])
            else:
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
        return out


def _starts(group: np.ndarray) -> np.ndarray:
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    return new


def sort_suffixes(strings: np.ndarray, shallow: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows of ``strings`` (bytes, one string a row), and a number per distinct string.

    The numbers rise along the order. ``shallow`` is rounded up to whole
    eight-byte characters.
    """
    n, length = strings.shape
    width = -(-length // 8)
    padded = np.zeros((n, 8 * width), np.uint8)
    padded[:, :length] = strings
    chars = padded.view(">u8").astype(np.uint64)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # along the order; ties have one number
    depth = min(width, -(-shallow // 8))
    for d in range(depth):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if len(tied) == 0:
            break
        own = chars[order[tied], d]
        by = np.argsort(own, kind="quicksort") if d == 0 else np.lexsort((own, group[tied]))
        order[tied] = order[tied][by]
        new = _starts(group)
        new[tied[1:]] |= (own[by][1:] != own[by][:-1]) & (np.diff(tied) == 1)
        group = np.cumsum(new) - 1
    # the rest: equal strings need no order, others go through a trie
    if depth < width and n:
        rest = chars[order, depth:]
        new = _starts(group)
        head = np.flatnonzero(new)[group]
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[(rest != rest[head]).any(axis=1)]] = True
        todo = np.flatnonzero(mixed[group])
        if len(todo):
            tail = padded[:, 8 * depth :]
            left = tail.shape[1]
            raw = np.ascontiguousarray(tail[order[todo]]).tobytes()
            cut = np.flatnonzero(_starts(group[todo]))
            for a, b in zip(cut, [*cut[1:], len(todo)]):
                trie = BlindTrie(left)
                insert = trie.insert
                for i in range(a, b):
                    insert(int.from_bytes(raw[i * left : (i + 1) * left], "big"), i)
                place = a
                rows = order[todo[a:b]]
                for equal in trie.groups():
                    order[todo[place : place + len(equal)]] = rows[np.array(equal) - a]
                    new[todo[place]] = True
                    place += len(equal)
            group = np.cumsum(new) - 1
    number = np.empty(n, np.int64)
    number[order] = group
    return order, number
