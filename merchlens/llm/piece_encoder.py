"""Token ids of batches of texts: each different pre-token is encoded once and looked up after that."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from merchlens.llm.pretokens import Points, split_special

#: Pieces kept per Python worker; beyond it the table starts anew.
MAX_PIECES = 2_000_000
#: Longer pieces are not kept.
MAX_KEPT_CHARS = 64


def room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or one of twice its length or more with the same start, so that n values fit."""
    if n <= len(array):
        return array
    out = np.zeros(max(n, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class PieceTable:
    """Ids of pieces by 64-bit key: open addressing over arrays at most half full, looked up for many keys at once.

    ``row`` holds the place of a slot's piece from 1 (0: free slot); piece r's ids are ``ids[ends[r - 1] : ends[r]]``."""

    def __init__(self, most: int):
        self.most, self.bits = most, max(1, (2 * most - 1).bit_length())
        self.clear()

    def clear(self) -> None:
        self.keys, self.row = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.n, self.ends, self.ids = 0, np.zeros(1024, np.int64), np.zeros(1024, np.uint32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys' pieces, 0 where there is none."""
        slot = self._slots(keys)
        row = self.row.take(slot)
        other = np.flatnonzero((self.keys.take(slot) != keys) & (row > 0))
        while len(other):  # another key's slot: on to the next one
            at = slot[other] = (slot[other] + 1) & (len(self.row) - 1)
            row[other] = self.row[at]
            other = other[(self.keys[at] != keys[other]) & (row[other] > 0)]
        return row

    def append(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Puts the ids of more pieces at the end and returns the pieces' places; no key leads there yet."""
        used, n = int(self.ends[self.n]), len(sizes)
        self.ids, self.ends = room(self.ids, used + len(ids)), room(self.ends, self.n + n + 1)
        self.ids[used : used + len(ids)] = ids
        self.ends[self.n + 1 : self.n + n + 1] = used + np.cumsum(sizes)
        return np.arange(self.n + 1, self.n + n + 1)

    def keep(self, keys: np.ndarray) -> None:
        """Lets different new keys lead to the pieces appended last, in their order; those without a key are given up."""
        rows = np.arange(self.n + 1, self.n + len(keys) + 1, dtype=np.int32)
        slot, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            free = self.row[at] == 0
            self.row[at[free]], self.keys[at[free]] = rows[todo[free]], keys[todo[free]]
            todo = todo[self.row[at] != rows[todo]]
            slot[todo] = (slot[todo] + 1) & (len(self.row) - 1)
        self.n += len(keys)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after the other, and how many come before each piece and at the end."""
        begin = self.ends.take(rows - 1)
        size = self.ends.take(rows) - begin
        done = np.concatenate([[0], np.cumsum(size)])
        return self.ids.take(np.repeat(begin - done[:-1], size) + np.arange(done[-1])), done


class PieceEncoder:
    """``cut``: name of the method of Points that cuts; ``encode``: ids of pieces; ``special``: ids of strings that stand for themselves."""

    def __init__(self, cut: str, encode: Callable[[list[str]], list[list[int]]], special: dict[str, int], prepare: Callable[[str], str] | None = None,
                 most: int = MAX_PIECES):
        self.cut, self.encode, self.special, self.prepare, self.most = cut, encode, special, prepare, most
        self.kept = PieceTable(most)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        segments, owner, marks = [], [], []
        for i, text in enumerate(texts):
            for part in split_special(text, self.special):
                if isinstance(part, int):
                    marks.append((len(segments), i, part))
                else:
                    segments.append(self.prepare(part) if self.prepare else part)
                    owner.append(i)
        ids, sizes = self._pieces(segments)
        owner = np.asarray(owner, np.int64)
        if marks:  # special ids go in before their segment
            at = np.concatenate([[0], np.cumsum(sizes)])[[m[0] for m in marks]]
            ids = np.insert(ids, at, [m[2] for m in marks])
            owner, sizes = np.concatenate([owner, [m[1] for m in marks]]), np.concatenate([sizes, np.ones(len(marks), np.int64)])
        return ids, np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)

    def _pieces(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = Points(segments)
        starts, ends = getattr(points, self.cut)()
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(segments), np.int64)
        keys = points.hashes(starts, ends)
        rows = self.kept.find(keys)
        new = np.flatnonzero(rows == 0)
        if len(new):
            different, first, which = np.unique(keys[new], return_index=True, return_inverse=True)
            if self.kept.n + len(different) > self.most:
                self.kept.clear()
                new = np.arange(len(keys))
                different, first, which = np.unique(keys, return_index=True, return_inverse=True)
            at = new[first]
            short = ends[at] - starts[at] <= MAX_KEPT_CHARS
            order = np.argsort(~short, kind="stable")  # those to be kept come first
            found = self.encode(points.strings(starts[at[order]], ends[at[order]]))
            places = np.empty(len(order), np.int64)
            places[order] = self.kept.append(np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)))
            rows[new] = places[which]
            ids, done = self.kept.gather(rows)
            self.kept.keep(different[order[: min(int(short.sum()), self.most)]])
        else:
            ids, done = self.kept.gather(rows)
        per_segment = done[np.searchsorted(starts, points.offset)]
        return ids, np.diff(per_segment)
