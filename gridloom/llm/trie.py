"""Compact tries over sorted words of single-byte letters, and their intersection with edit-distance-one automata.

Nodes are numbered in preorder.  A payload keeps a depth and a letter for each node, a bit for each node where
a word ends, and the counts of the words in order; edges are worked out when it is loaded.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

#: nodes, words, bytes of a depth
_HEAD = struct.Struct("<QQB")
#: States worked on at once; the stack holds more of them, but only of one depth-first front.
FRONT = 1 << 18


def _spread(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes end to end, starts and lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths


def build(words: list[bytes], counts: np.ndarray) -> bytes:
    """Payload of a trie of ``words`` (distinct, not empty, in byte order)."""
    data, starts, lengths = _spread(words)
    shared = np.zeros(len(words), np.int64)  # letters in common with the word before
    alive = np.arange(1, len(words))
    depth = 0
    while len(alive):
        alive = alive[(lengths[alive - 1] > depth) & (lengths[alive] > depth)]
        alive = alive[data[starts[alive - 1] + depth] == data[starts[alive] + depth]]
        depth += 1
        shared[alive] = depth
    new = lengths - shared
    first = np.cumsum(new) - new
    at = np.arange(int(new.sum())) - np.repeat(first, new)
    depths = np.repeat(shared, new) + at
    letters = data[np.repeat(starts, new) + depths]
    ends = np.zeros(len(letters), np.uint8)
    ends[first + new - 1] = 1
    size = 1 if int(depths.max(initial=0)) < 256 else 4
    return b"".join(
        (_HEAD.pack(len(letters), len(words), size), depths.astype(f"<u{size}").tobytes(), letters.tobytes(), np.packbits(ends).tobytes(), np.asarray(counts, "<u8").tobytes())
    )


class Trie:
    """A loaded payload.  Node 0 is the root; node k + 1 is the k-th of the payload."""

    def __init__(self, payload: bytes):
        n, self.words, size = _HEAD.unpack_from(payload, 0)
        at = _HEAD.size
        depths = np.frombuffer(payload, f"<u{size}", n, at).astype(np.int64) + 1
        at += n * size
        self.letters = np.concatenate(([0], np.frombuffer(payload, np.uint8, n, at))).astype(np.uint8)
        at += n
        bits = np.unpackbits(np.frombuffer(payload, np.uint8, (n + 7) // 8, at), count=n).astype(np.int64)
        at += (n + 7) // 8
        self.counts = np.frombuffer(payload, "<u8", self.words, at).astype(np.int64)
        #: which word ends at a node, -1 for none
        self.word = np.concatenate(([-1], np.where(bits > 0, np.cumsum(bits) - 1, -1)))
        # the parent of a node is the last one before it that is one level higher
        self.parent = np.zeros(n + 1, np.int64)
        level = np.concatenate(([0], depths))
        order = np.lexsort((np.arange(n + 1), level))
        key = level[order] * (n + 1) + order
        child = np.arange(1, n + 1)
        self.parent[1:] = order[np.searchsorted(key, (level[1:] - 1) * (n + 1) + child) - 1]
        # children side by side, in letter order as in preorder
        self.child = np.argsort(self.parent[1:], kind="stable") + 1
        degree = np.bincount(self.parent[1:], minlength=n + 1)
        self.first = np.concatenate(([0], np.cumsum(degree)))
        self.edges = self.parent[self.child] << 8 | self.letters[self.child]

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The child of each node under a letter, -1 where there is none."""
        if not len(self.edges):
            return np.full(len(nodes), -1)
        wanted = nodes << 8 | letters
        at = np.searchsorted(self.edges, wanted)
        at[at == len(self.edges)] = 0
        return np.where(self.edges[at] == wanted, self.child[at], -1)

    def spell(self, words: np.ndarray) -> list[bytes]:
        """The letters of words by their numbers, read from their last nodes up to the root."""
        last = np.flatnonzero(self.word >= 0)
        nodes, rows = last[words], []
        while nodes.any():
            rows.append(self.letters[nodes])  # the root's letter is 0, which no word holds
            nodes = self.parent[nodes]
        return [bytes(c).rstrip(b"\0")[::-1] for c in np.array(rows, np.uint8).T] if rows else [b""] * len(words)

    def neighbours(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index into ``words``, number of a word here) of all pairs at edit distance one.  Pairs may repeat.

        A state is a word, a place in it, a node and whether the edit is spent.  The automaton of a word
        branches along its own path only: behind the edit both must go on alike.  States wait on a stack,
        those with the edit spent on top, and the top is worked on first.
        """
        data, starts, lengths = _spread(words)
        data = np.append(data, 0).astype(np.int64)
        n = len(words)
        stack = [(np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), False)]
        while stack:
            w, i, v, spent = stack.pop()
            if len(w) > FRONT:
                stack.append((w[FRONT:], i[FRONT:], v[FRONT:], spent))
                w, i, v = w[:FRONT], i[:FRONT], v[:FRONT]
            if spent:
                done = i == lengths[w]
                hit = done & (self.word[v] >= 0)
                if hit.any():
                    yield w[hit], self.word[v[hit]]
                w, i, v = w[~done], i[~done], v[~done]
                u = self.step(v, data[starts[w] + i])
                on = u >= 0
                if on.any():
                    stack.append((w[on], i[on] + 1, u[on], True))
                continue
            inside = i < lengths[w]
            letter = data[starts[w] + np.minimum(i, lengths[w] - 1)]
            u = np.where(inside, self.step(v, letter), -1)
            on = u >= 0
            if on.any():
                stack.append((w[on], i[on] + 1, u[on], False))
            # every child: a letter more here (the word stays), or another letter in place of its own
            degree = self.first[v + 1] - self.first[v]
            total = int(degree.sum())
            of = np.repeat(np.arange(len(w)), degree)
            c = self.child[np.arange(total) - np.repeat(np.cumsum(degree) - degree, degree) + np.repeat(self.first[v], degree)]
            swap = inside[of] & (self.letters[c] != letter[of])
            drop = inside
            spent_w = np.concatenate((w[of], w[of[swap]], w[drop]))
            if len(spent_w):
                spent_i = np.concatenate((i[of], i[of[swap]] + 1, i[drop] + 1))
                stack.append((spent_w, spent_i, np.concatenate((c, c[swap], v[drop])), True))
