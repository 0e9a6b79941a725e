"""Numbers for integer keys, many keys a call."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Numbered:
    """Distinct keys, numbered from 1 as they are added; 0 stands for a key that is not there.

    Keys are integers from 0 to 2^63. They are found by open addressing in arrays, since
    a dictionary takes a Python step for each.
    """

    def __init__(self, room: int = 1024):
        self.size = 0
        self._room(room)

    def _room(self, room: int) -> None:
        """Arrays for so many keys, with those that are there."""
        keys = np.zeros(room + 1, np.int64)
        keys[0] = -1
        if self.size:
            keys[1 : self.size + 1] = self.keys[1 : self.size + 1]
        self.keys = keys
        self._bits = max(room * 2 - 1, 1).bit_length()
        self._slots = np.zeros(1 << self._bits, np.int32)
        self._place(np.arange(1, self.size + 1, dtype=np.int32))

    def _first(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * _ODD
        mixed >>= np.uint64(64 - self._bits)
        return mixed.view(np.int64)

    def _place(self, numbers: np.ndarray) -> None:
        last, at = len(self._slots) - 1, self._first(self.keys[numbers])
        while len(numbers):
            free = self._slots[at] == 0
            self._slots[at[free]] = numbers[free]
            # Of several numbers for one slot, one got it.
            left = self._slots[at] != numbers
            numbers, at = numbers[left], (at[left] + 1) & last

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key, 0 for those not there."""
        last, at = len(self._slots) - 1, self._first(keys)
        numbers = self._slots[at]
        left = np.flatnonzero((numbers != 0) & (self.keys[numbers] != keys))
        at = at[left]
        while len(left):
            at = (at + 1) & last
            numbers[left] = found = self._slots[at]
            more = (found != 0) & (self.keys[found] != keys[left])
            left, at = left[more], at[more]
        return numbers

    def add(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of distinct keys that are not there yet."""
        if self.size + len(keys) >= len(self.keys):
            self._room(2 * (self.size + len(keys)))
        numbers = np.arange(self.size + 1, self.size + len(keys) + 1, dtype=np.int32)
        self.keys[numbers] = keys
        self.size += len(keys)
        self._place(numbers)
        return numbers

    def renew(self, keys: np.ndarray) -> None:
        """Other keys in place of all, in the room there is."""
        self._slots[:] = 0
        self.size = 0
        self.add(keys)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts one after another, and the length of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), lengths


def utf8_width(points: np.ndarray) -> np.ndarray:
    """Bytes that code points take."""
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


def alike_long(lengths: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """Indexes in frames, by falling length; length times number stays below ``cells``, but for a single index."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        frame = order[at : at + max(1, cells // (int(lengths[order[at]]) + 1))]
        yield frame
        at += len(frame)
