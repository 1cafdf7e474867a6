"""A bounded table of encoded units, looked up for a whole column of texts at once with numpy.

A text is cut before every blank and line end that is followed by a character other than white space. Such a cut keeps
the matches of a byte-level splitting pattern: a run of white space before a non-blank always leaves its last
character to what follows. Texts that hold one of the given special strings are encoded whole.

A unit of up to 24 bytes is its own key (three words of eight bytes and the length), so equality is exact; the hash
only finds the slot. Longer units, up to LONGEST bytes, are kept in a dictionary. When the table holds too many units,
ids or bytes, it starts anew before the next column, so between columns it never holds more than the limits and what
one column adds.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loam.llm.textcodes import mix, raw_text

#: Limits of the table: ids in the pool, bytes of long units, bytes of a unit that is remembered at all.
POOL_IDS, LONG_BYTES, LONGEST = 4 << 20, 8 << 20, 1024
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_A, _B, _C = (mix(np.arange(1, 4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)).tolist()


class UnitTable:
    """encode() gives the ids of all texts of a column; plain encodes one text, together many simple units."""

    def __init__(self, plain: Callable[[str], bytes], together: Callable[[list[str]], list[bytes]], width: int, special: tuple[str, ...] = (), bits: int = 21):
        self.plain, self.together, self.kind, self.bits = plain, together, np.dtype(f"<u{width}"), bits
        self.special = "|".join(map(re.escape, special))
        self.limit = (1 << bits) // 2
        self.reset()

    def reset(self) -> None:
        n = 1 << self.bits
        self.size, self.entry = np.zeros(n, np.uint8), np.zeros(n, np.int32)
        self.keys = [np.zeros(n, np.uint64) for _ in range(3)]
        self.begin, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.used, self.entries = np.zeros(1 << 18, self.kind), 0, 0
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0

    def add(self, codes: list[bytes]) -> np.ndarray:
        """Numbers of new entries with these ids (little-endian, 32 bits)."""
        ids = np.frombuffer(b"".join(codes), "<u4")
        counts = np.array([len(c) // 4 for c in codes], np.int64)
        numbers = np.arange(self.entries, self.entries + len(codes))
        while self.entries + len(codes) > len(self.begin):
            self.begin, self.count = np.concatenate([self.begin, self.begin]), np.concatenate([self.count, self.count])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, self.pool])
        self.begin[numbers], self.count[numbers] = self.used + np.cumsum(counts) - counts, counts
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.entries += len(codes)
        return numbers

    def find(self, slot: np.ndarray, size: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        """Entry numbers, -1 where there is none."""
        out, todo, at = np.full(len(slot), -1, np.int64), np.arange(len(slot)), slot.copy()
        while len(todo):
            here = at[todo]
            there = self.size[here]
            same = there == size[todo]
            for mine, own in zip(self.keys, keys, strict=True):
                same &= mine[here] == own[todo]
            out[todo[same]] = self.entry[here[same]]
            todo = todo[(there != 0) & ~same]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return out

    def insert(self, slot: np.ndarray, size: np.ndarray, keys: list[np.ndarray], numbers: np.ndarray) -> None:
        todo, at = np.arange(len(slot)), slot.copy()
        while len(todo):
            here = at[todo]
            free = np.flatnonzero(self.size[here] == 0)
            _, first = np.unique(here[free], return_index=True)
            done = free[first]
            rows, spots = todo[done], here[done]
            self.size[spots], self.entry[spots] = size[rows], numbers[rows]
            for mine, own in zip(self.keys, keys, strict=True):
                mine[spots] = own[rows]
            left = np.ones(len(todo), bool)
            left[done] = False
            todo = todo[left]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids in order."""
        if self.entries > self.limit or self.used > POOL_IDS or self.long_bytes > LONG_BYTES:
            self.reset()
        data, offsets = raw_text(column)
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(n, np.int64), np.zeros(0, self.kind)
        padded = np.concatenate([data, np.zeros(24, np.uint8)])
        gap = (data == 32) | (data == 10)
        one, two = padded[1 : len(data) + 1], padded[2 : len(data) + 2]
        blank = (one <= 32) | (one == 0xC2) & ((two == 0x85) | (two == 0xA0)) | (one == 0xE1) & (two == 0x9A) | (one == 0xE2) & ((two == 0x80) | (two == 0x81)) | (one == 0xE3) & (two == 0x80)
        mark = gap & ~blank
        full = np.diff(offsets) > 0
        mark[offsets[1:][full] - 1] = False
        mark[offsets[:-1][full]] = True
        start = np.flatnonzero(mark)
        size = np.diff(np.append(start, len(data)))
        owner = np.searchsorted(offsets, start, side="right") - 1
        odd = np.zeros(n, bool)
        if self.special:
            odd |= pc.fill_null(pc.match_substring_regex(column, self.special), False).to_numpy(zero_copy_only=False)

        view = np.ndarray((len(padded) - 7,), np.uint64, padded.tobytes(), 0, (1,))
        keys = [view[np.minimum(start + 8 * k, len(view) - 1)] & _MASKS[np.clip(size - 8 * k, 0, 8)] for k in range(3)]
        slot_of = mix(keys[0] * np.uint64(_A) + mix(keys[1] * np.uint64(_B) + mix(keys[2] * np.uint64(_C) + size.astype(np.uint64))))
        slot = (slot_of >> np.uint64(64 - self.bits)).astype(np.int64)
        number = np.full(len(start), -1, np.int64)
        fine = ~odd[owner]
        short = np.flatnonzero(fine & (size <= 24))
        number[short] = self.find(slot[short], size[short], [k[short] for k in keys])

        new = short[number[short] < 0]
        if len(new):
            _, first, back = np.unique(slot_of[new], return_index=True, return_inverse=True)
            head = new[first]
            clash = np.zeros(len(new), bool)
            for k in (*keys, size):
                clash |= k[new] != k[head[back]]
            odd[owner[new[clash]]] = True  # two units of one hash: their texts are encoded whole
            numbers = self.add(self._codes([data[a : a + b].tobytes() for a, b in zip(start[head].tolist(), size[head].tolist(), strict=True)]))
            self.insert(slot[head], size[head], [k[head] for k in keys], numbers)
            number[new] = numbers[back]
        for i in np.flatnonzero(fine & (size > 24)).tolist():
            unit = data[start[i] : start[i] + size[i]].tobytes()
            found = self.long.get(unit)
            if found is None:
                found = int(self.add([self.plain(unit.decode())])[0])
                if len(unit) <= LONGEST:
                    self.long[unit] = found
                    self.long_bytes += len(unit) + 150
            number[i] = found
        if odd.any():
            keep = ~odd[owner]
            whole = np.flatnonzero(odd)
            number, owner = np.concatenate([number[keep], self.add([self.plain(column[i].as_py()) for i in whole.tolist()])]), np.concatenate([owner[keep], whole])
            order = np.argsort(owner, kind="stable")
            number, owner = number[order], owner[order]
        counts = self.count[number]
        total = int(counts.sum())
        place = np.repeat(self.begin[number] - (np.cumsum(counts) - counts), counts) + np.arange(total)
        return np.bincount(owner, counts, minlength=n).astype(np.int64), self.pool[place]

    def _codes(self, units: list[bytes]) -> list[bytes]:
        texts = [u.decode() for u in units]
        simple = [i for i, t in enumerate(texts) if t[0] in " \n" and t[1:].split() == [t[1:]]]
        out: list[bytes | None] = [None] * len(texts)
        for i, code in zip(simple, self.together([texts[i] for i in simple]) if simple else (), strict=True):
            out[i] = code
        return [self.plain(t) if c is None else c for t, c in zip(texts, out, strict=True)]
