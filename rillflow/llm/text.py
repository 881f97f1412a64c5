"""Vectorised handling of words: one numpy pass over many texts at a time.

A word is a longest run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return. Texts are handled as UTF-8 bytes, in
chunks of about 1 MB; longer texts go through as segments that overlap, so
memory is bounded by the chunk, a few bytes for each byte of the longest word,
and what an operator keeps of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES, SLICE_ROWS = 1 << 20, 128
U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_POWERS: dict[int, np.ndarray] = {}
_GAP = re.compile(rb"[\x20\x09-\x0D]")
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C13, 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per process."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 2 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[start:end], by prefix sums modulo 2**64."""
    n = len(values)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.multiply(values, _powers(base, n), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    raw = (sums[ends] - sums[starts]) * _powers(inverse, n + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def spans_of_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of raw[start:end], starts and ends ascending; block by block, so little is held beside the spans."""
    n, block = len(raw), CHUNK_BYTES
    if n <= 2 * block:
        return _spans(_BYTE[raw], starts, ends, BYTE_BASE)
    inverse = pow(BYTE_BASE, -1, 1 << 64)
    left, right, down = (np.empty(len(starts), np.uint64) for _ in range(3))
    carry, at_start, at_end = U(0), 0, 0
    for b in range(0, n + 1, block):
        part = raw[b : b + block]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _powers(BYTE_BASE, len(part)), out=sums[1:], dtype=np.uint64)
        sums = sums * U(pow(BYTE_BASE, b, 1 << 64)) + carry
        i, j = at_start, int(np.searchsorted(starts, b + block))
        left[i:j] = sums[starts[i:j] - b]
        down[i:j] = _powers(inverse, block)[starts[i:j] - b] * U(pow(inverse, b, 1 << 64))
        at_start = j
        i, j = at_end, int(np.searchsorted(ends, b + block))
        right[i:j] = sums[ends[i:j] - b]
        at_end, carry = j, sums[-1]
    return mix((right - left) * down + (ends - starts).astype(np.uint64))


def spans_of_words(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbouring words, whether of one text or not."""
    begin = np.arange(max(len(hashes) - n + 1, 0))
    return _spans(hashes, begin, begin + n, WORD_BASE)


@dataclass
class Words:
    """Words of several texts: bytes, places of the words, first word of each text."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return spans_of_bytes(self.raw, self.starts, self.ends)

    def joined(self, text: int, keep: np.ndarray | None = None) -> bytes:
        """The words of one text (those that ``keep`` marks), joined by one space."""
        a, b = self.first[text], self.first[text + 1]
        s, e = self.starts[a:b], self.ends[a:b]
        if keep is not None:
            s, e = s[keep], e[keep]
        data = self.raw.data
        return b" ".join([bytes(data[i:j]) for i, j in zip(s.tolist(), e.tolist(), strict=True)])


def split(texts: list[bytes | None], lower: bool = False) -> Words:
    """Find all words. A null text has none."""
    texts = [t or b"" for t in texts]
    joined = b"\n".join(texts) + b"\n"
    if lower:
        joined = joined.lower()
    raw = np.frombuffer(joined, np.uint8)
    space = _SPACE[raw]
    edge = np.empty(len(raw), bool)
    edge[0] = not space[0]
    np.not_equal(space[1:], space[:-1], out=edge[1:])
    places = np.flatnonzero(edge)
    starts, ends = places[0::2], places[1::2]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return Words(raw, starts, ends, np.searchsorted(starts, offsets), offsets)


def segments(text: bytes, overlap: int, limit: int = CHUNK_BYTES) -> Iterator[bytes]:
    """Parts of about ``limit`` bytes; each but the first begins with the last ``overlap`` words of the one before.

    So each run of ``overlap`` + 1 words lies in one part, and in no other.
    """
    at, size = 0, limit
    while True:
        gap = _GAP.search(text, at + size) if at + size < len(text) else None
        if gap is None:
            yield text[at:]
            return
        part = text[at : gap.start()]
        head = part.rsplit(None, overlap) if overlap else [part] * 2
        if len(head) <= overlap:  # long words
            size += limit
            continue
        yield part
        at, size = at + len(head[0]), limit


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n consecutive words of one text, and the place of its first word."""
    room = np.maximum(np.diff(first) - n + 1, 0)
    if not room.sum():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    begin = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(room)[:-1])), room) + np.arange(room.sum())
    return _spans(hashes, begin, begin + n, WORD_BASE), begin


def chunked(batches: Iterable[pa.RecordBatch], columns: list[str], limit: int = CHUNK_BYTES) -> Iterator[list[list]]:
    """Regroup Arrow batches to lists of rows with about ``limit`` bytes of text.

    The text is the first of ``columns``, as binary. Yields one list for each column.
    """
    held: list[list] = [[] for _ in columns]
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):  # Python objects of a few rows at a time
            lists = [batch.column(c).slice(at, SLICE_ROWS).to_pylist() for c in columns]
            for row in zip(*lists, strict=True):
                for store, value in zip(held, row, strict=True):
                    store.append(value)
                size += len(row[0] or b"") + 64
                if size >= limit:
                    yield held
                    held, size = [[] for _ in columns], 0
    if held[0]:
        yield held


def cut_up(texts: list[bytes | None], *columns: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[list, ...]]:
    """Rows with long texts in segments that don't overlap, in groups of about ``limit`` bytes; other values repeat."""
    held: tuple[list, ...] = tuple([] for _ in range(1 + len(columns)))
    size = 0
    for text, *values in zip(texts, *columns, strict=True):
        for part in segments(text or b"", 0, limit):
            for store, value in zip(held, (part, *values), strict=True):
                store.append(value)
            size += len(part) + 64
            if size >= limit:
                yield held
                held, size = tuple([] for _ in range(1 + len(columns))), 0
    if held[0]:
        yield held


def packed(values: np.ndarray, dtype: str) -> bytes:
    return np.ascontiguousarray(values, dtype).tobytes()


def pack_rows(values: np.ndarray, first: np.ndarray, dtype: str) -> list[bytes]:
    """Bytes of values[first[i]:first[i+1]] for each i."""
    data, width = memoryview(packed(values, dtype)), np.dtype(dtype).itemsize
    return [bytes(data[a * width : b * width]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
