"""Vectorised word hashing over Arrow string columns.

Words, shingles and n-grams are found with numpy over the UTF-8 bytes of many documents at once.
All working arrays are bounded: a column is walked in pieces of at most PIECE bytes (one word, however
long, is never cut).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at once.
PIECE = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One random 64-bit number for each (position in the word mod 256, byte).
_TERMS = mix((np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) * _GOLD)

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*excluded: tuple[int, int]) -> np.ndarray:
    """True for the bytes that words are made of: all but the inclusive ranges."""
    allowed = np.ones(256, dtype=bool)
    for low, high in excluded:
        allowed[low : high + 1] = False
    return allowed


#: [^\x20\x09-\x0D] and, after lower-casing, [^\x00-\x2F\x3A-\x60\x7B-\x7F].
NOT_BLANK = byte_class((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def raw_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its values; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return body, at - at[0]


def pieces(data: np.ndarray, offsets: np.ndarray, allowed: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(document, start, end) runs covering all bytes: whole documents, long ones cut between words.

    Yields runs of consecutive documents as one piece where they fit; a piece then starts and ends at a
    document's edge, and the first number is the first document that begins at or after its start.
    """
    n, doc, start = len(offsets) - 1, 0, 0
    while doc < n:
        last = int(np.searchsorted(offsets, start + PIECE, side="right")) - 1
        if last > doc and start == offsets[doc]:
            yield doc, start, int(offsets[last])
            doc, start = last, int(offsets[last])
            continue
        end = int(offsets[doc + 1])
        while end - start > PIECE:
            window = data[start : start + PIECE]
            gaps = np.flatnonzero(~allowed[LOWER[window]])
            if len(gaps):
                cut = start + int(gaps[-1]) + 1
            else:  # one word of more than PIECE bytes: up to its end
                cut = start + PIECE
                while cut < end:
                    rest = np.flatnonzero(~allowed[LOWER[data[cut : min(end, cut + PIECE)]]])
                    if len(rest):
                        cut += int(rest[0]) + 1
                        break
                    cut = min(end, cut + PIECE)
            if cut >= end:
                break
            yield doc, start, cut
            start = cut
        yield doc, start, end
        doc, start = doc + 1, end


def word_hashes(column: pa.Array, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased) in order, and the n + 1 word offsets of the documents."""
    hashes, at, _ = word_and_stem_hashes(column, allowed, ())
    return hashes, at


def word_and_stem_hashes(column: pa.Array, allowed: np.ndarray, stems: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """word_hashes(), and for each length in stems the hash of so many first bytes of every word (0 if it has fewer)."""
    data, offsets = raw_text(column)
    n = len(offsets) - 1
    counts, parts, starts = np.zeros(n, np.int64), [], [[] for _ in stems]
    for _, start, end in pieces(data, offsets, allowed):
        if end == start:
            continue
        body = LOWER[data[start:end]]
        ok = allowed[body]
        before, after = np.empty_like(ok), np.empty_like(ok)
        before[0], before[1:] = False, ok[:-1]
        after[-1], after[:-1] = False, ok[1:]
        low, high = np.searchsorted(offsets, [start, end])
        edges = offsets[low : high + 1] - start
        edges = edges[(edges > 0) & (edges < end - start)]
        before[edges], after[edges - 1] = False, False
        first = np.flatnonzero(ok & ~before)
        if not len(first):
            continue
        length = np.flatnonzero(ok & ~after) + 1 - first
        begin = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(begin, length)
        term = _TERMS[((place & 255) << 8) | body[ok]]
        if length.max() > 256:
            far = place > 255
            term[far] = mix(term[far] + (place[far] >> 8).astype(np.uint64) * _GOLD)
        parts.append(mix(np.add.reduceat(term, begin) ^ (length.astype(np.uint64) * _GOLD)))
        for size, found in zip(stems, starts, strict=True):
            code = mix(np.add.reduceat(np.where(place < size, term, np.uint64(0)), begin) ^ np.uint64(size << 32))
            found.append(np.where(length >= size, code, np.uint64(0)))
        owner = np.searchsorted(offsets, first + start, side="right") - 1
        counts += np.bincount(owner, minlength=n)
    joined = lambda x: np.concatenate(x) if x else np.zeros(0, np.uint64)
    return joined(parts), np.concatenate([[0], np.cumsum(counts)]), [joined(x) for x in starts]


_FACTORS = mix(np.arange(1, 65, dtype=np.uint64) * _GOLD) | np.uint64(1)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words; len(words) - k + 1 of them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        total = mix(total * _FACTORS[i % 64] + words[i : i + n])
    return total


def shingle_sets(column: pa.Array, k: int, allowed: np.ndarray = NOT_BLANK) -> Iterator[np.ndarray]:
    """For each document the sorted distinct hashes of its k-word shingles.

    A document of fewer words has its whole sequence as one shingle; without words the set is empty.
    """
    words, at = word_hashes(column, allowed)
    runs = run_hashes(words, k)
    for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if high - low >= k:
            yield np.unique(runs[low : high - k + 1])
        elif high > low:
            yield run_hashes(words[low:high], high - low)
        else:
            yield np.zeros(0, np.uint64)


def small_batches(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of an Arrow batch with at most limit bytes in a string column, one row at least."""
    n, start = batch.num_rows, 0
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(sizes)])
    while start < n:
        end = max(start + 1, int(np.searchsorted(total, total[start] + limit, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end
