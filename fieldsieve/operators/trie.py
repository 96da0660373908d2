"""Longest match of byte tokens in many texts at once, over a double-array trie.

Node ``s`` has a child for byte ``c`` if ``owner[base[s] + c]`` is ``s``; the child's number is that
place. All places of a blob are walked together, one byte deeper a step, so a step is a few array
look-ups; a mark that is no byte stands after each text and ends every walk.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np

#: What stands after each text of a blob; the places of a node's children end before it.
END_OF_TEXT = 256
#: Free places tried for a node with several children before the array is lengthened.
TRIED = 32


class Trie:
    def __init__(self, tokens: Mapping[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ids: list[int] = [-1]
        for token, number in tokens.items():
            node = 0
            for byte in token:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ids.append(-1)
                node = children[node][byte]
            if node:
                ids[node] = number
        self._place(children, ids)

    def _place(self, children: list[dict[int, int]], ids: list[int]) -> None:
        owner: list[int] = [0]  # the root lies at place 0 and is nobody's child
        base, value, free = {}, {0: -1}, 1
        waiting = [(0, 0)]
        while waiting:
            node, place = waiting.pop()
            below = sorted(children[node])
            if not below:
                continue
            start, tried = max(free, below[0] + 1), 0
            while any(start - below[0] + c < len(owner) and owner[start - below[0] + c] >= 0 for c in below):
                tried += 1
                start = start + 1 if tried < TRIED else max(start + 1, len(owner) + below[0])
            first = start - below[0]
            base[place] = first
            owner.extend([-1] * (first + below[-1] + 1 - len(owner)))
            for c in below:
                owner[first + c] = place
                value[first + c] = ids[children[node][c]]
                waiting.append((children[node][c], first + c))
            while free < len(owner) and owner[free] >= 0:
                free += 1
        size = len(owner) + END_OF_TEXT + 1
        self.owner = np.full(size, -1, dtype=np.int32)
        self.owner[: len(owner)] = owner
        self.owner[0] = -1
        self.base = np.full(size, size - END_OF_TEXT - 1, dtype=np.int32)
        self.base[list(base)] = list(base.values())
        self.value = np.full(size, -1, dtype=np.int32)
        self.value[list(value)] = list(value.values())

    def longest(self, blob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length and id of the longest token that begins at each place; length 0 where none does."""
        lengths = np.zeros(len(blob), dtype=np.int32)
        ids = np.full(len(blob), -1, dtype=np.int32)
        places = np.flatnonzero(blob != END_OF_TEXT)
        nodes = np.zeros(len(places), dtype=np.int32)
        depth = 0
        while len(places):
            below = self.base[nodes] + blob[places + depth]
            found = np.flatnonzero(self.owner[below] == nodes)
            places, nodes = places[found], below[found]
            depth += 1
            numbers = self.value[nodes]
            whole = np.flatnonzero(numbers >= 0)
            lengths[places[whole]] = depth
            ids[places[whole]] = numbers[whole]
        return lengths, ids

    def encode(self, texts: list[bytes], tail: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy ids of all texts, each with ``tail``, in one array, and how many each text has."""
        blob = np.full(sum(map(len, texts)) + len(texts), END_OF_TEXT, dtype=np.int32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        inside = np.ones(len(blob), dtype=bool)
        inside[ends] = False
        blob[inside] = np.frombuffer(b"".join(texts), dtype=np.uint8)
        lengths, ids = self.longest(blob)
        # Texts are left at their mark, which is as long as the tail and starts the next text.
        lengths[ends] = 1
        step, starts, place = lengths.tolist(), [], 0
        while place < len(step):
            starts.append(place)
            place += step[place] or _uncovered()
        taken = np.array(starts, dtype=np.int64)
        marks = np.searchsorted(taken, ends)
        sizes = np.diff(marks, prepend=-1) - 1 + len(tail)
        numbers = ids[taken]
        if len(tail) == 1:
            numbers[marks] = tail[0]
            return numbers, sizes
        return np.delete(numbers, marks), sizes


def _uncovered() -> int:
    raise ValueError("the vocabulary does not cover a text")
