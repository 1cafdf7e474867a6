"""Hashed character n-gram counts of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters and documents that are counted at once.
CHARS, DOCS = 1 << 19, 64


def _spread(x: np.ndarray, bits: int) -> np.ndarray:
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x = x * np.uint32(0x85EBCA77)
    return x >> np.uint32(32 - bits)


def letters_only() -> np.ndarray:
    """Code points below 2^16 to themselves, ASCII other than a-z to a blank; 2^16 stands for all others."""
    table = np.arange(1 << 16, dtype=np.uint32)
    table[:128] = 32
    table[97:123] = np.arange(97, 123)
    return table


def shapes() -> np.ndarray:
    """Code points to a class: upper, lower, digit, blank, and each ASCII sign of its own; others are lower."""
    table = np.full(1 << 16, ord("a"), np.uint32)
    table[:128] = np.arange(128)
    table[65:91], table[97:123], table[48:58] = ord("A"), ord("a"), ord("0")
    return table


def gram_counts(texts: list[str], bits: int, orders: tuple[int, ...], table: np.ndarray, lower: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first document, row, bucket, count) of the non-zero buckets of consecutive documents.

    Every character counts; a document longer than CHARS is added up from pieces, whose grams reach over the cuts.
    """
    size, i = 1 << bits, 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and j - i < DOCS and (j == i or chars + len(texts[j]) <= CHARS):
            chars += len(texts[j])
            j += 1
        total = np.zeros((j - i) * size, np.int64)
        for codes, owner, before in _codes(texts[i:j], table, lower, max(orders) - 1):
            for n in orders:
                low = max(0, before - n + 1)
                m = len(codes) - low - n + 1
                if m < 1:
                    continue
                code = np.full(m, np.uint32(n * 0x51ED27), np.uint32)
                for k in range(low, low + n):
                    code = code * np.uint32(0x01000193) + codes[k : k + m]
                keep = owner[low : low + m] == owner[low + n - 1 :]
                total += np.bincount((owner[low : low + m] * size + _spread(code, bits))[keep], minlength=len(total))
        found = np.flatnonzero(total)
        yield i, found // size, found % size, total[found]
        i = j


def _codes(texts: list[str], table: np.ndarray, lower: bool, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Code points, the document of each, and how many of the first ones were in the piece before.

    A blank stands before and after a document, and runs of blanks are one. A text longer than CHARS comes in pieces;
    each begins with the last reach code points of the one before.
    """
    joined = [f" {x.lower() if lower else x} " for x in texts]
    whole = "".join(joined)
    owners = np.repeat(np.arange(len(texts)), [len(x) for x in joined]) if len(texts) > 1 else None
    carry = np.zeros(0, np.uint32)
    step = len(whole) if len(texts) > 1 else CHARS
    for at in range(0, len(whole), step):
        codes = np.frombuffer(whole[at : at + step].encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.concatenate([carry, table[np.minimum(codes, np.uint32(0xFFFF))]])
        owner = np.zeros(len(codes), np.int64) if owners is None else owners
        blank = codes == 32
        keep = ~(blank & np.concatenate([[False], blank[:-1]]) & (owner == np.concatenate([[-1], owner[:-1]])))
        yield codes[keep], owner[keep], len(carry)
        carry = codes[keep][-reach:] if reach else carry
