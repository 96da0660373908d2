"""Minimal perfect hashing of whole numbers, vectorised.

Keys fall into a bit table; those alone in their cell mark it, the others go on to the next table
with another seed until none is left. A key's slot is the number of marks before its own, over all
tables: n distinct keys have the slots 0 to n - 1. About four bits a key are kept; whoever looks up
keys that may be unknown must compare them with the key stored for the slot.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Cells of a table per key that enters it.
ROOM = 2


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Numbers of 64 bits spread anew on each level."""
    h = keys.astype(np.uint64) + _U((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class PerfectHash:
    def __init__(self, tables: list[np.ndarray]):
        """``tables`` hold one bit per cell in 64-bit words."""
        self._tables = tables
        self._before, marks = [], 0
        for words in tables:
            counts = np.bitwise_count(words).astype(np.int64)
            self._before.append(marks + np.cumsum(counts) - counts)
            marks += int(counts.sum())
        self.size = marks

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        tables: list[np.ndarray] = []
        while len(keys):
            n_words = -(-ROOM * len(keys) // 64)
            cells = (_mixed(keys, len(tables)) % _U(64 * n_words)).astype(np.int64)
            alone = np.bincount(cells, minlength=64 * n_words) == 1
            tables.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            keys = keys[~alone[cells]]
        return cls(tables)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, any slot or -1 for keys that were not built in."""
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self._tables, self._before, strict=True)):
            cells = _mixed(keys[left], level) % _U(64 * len(words))
            word, bit = (cells >> _U(6)).astype(np.int64), cells & _U(63)
            marked = (words[word] >> bit) & _U(1) == 1
            lower = words[word] & ((_U(1) << bit) - _U(1))
            slot = before[word] + np.bitwise_count(lower)
            found[left[marked]] = slot[marked]
            left = left[~marked]
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self._tables), *map(len, self._tables)], dtype="<u8")
        return b"".join([head.tobytes(), *(t.astype("<u8").tobytes() for t in self._tables)])

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        numbers = np.frombuffer(raw, dtype="<u8").astype(np.uint64)
        n = int(numbers[0])
        sizes = numbers[1 : 1 + n].astype(np.int64)
        ends = 1 + n + np.cumsum(sizes)
        return cls([numbers[e - s : e] for s, e in zip(sizes, ends, strict=True)])
