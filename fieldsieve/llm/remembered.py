"""What a worker remembers of its own results."""

from __future__ import annotations

from collections.abc import Callable

_UNKNOWN = object()


class Remembered(dict):
    """Results of ``make`` by text, made when first asked for.

    Two generations of ``size`` results are kept: when the younger is full it becomes the older, and
    what is asked for again comes back from there, so frequent texts stay. Texts longer than
    ``longest`` are made anew each time. All this bounds memory only.
    """

    def __init__(self, make: Callable, size: int, longest: int):
        super().__init__()
        self._make, self._size, self._longest = make, size, longest
        self._older: dict = {}

    def __missing__(self, text: str):
        found = self._older.get(text, _UNKNOWN)
        if found is _UNKNOWN:
            found = self._make(text)
        if len(text) <= self._longest:
            if len(self) >= self._size:
                self._older = dict(self)
                self.clear()
            self[text] = found
        return found
