"""Whole texts as byte and word arrays, and hashes of their windows.

Everything works on the concatenated UTF-8 bytes of many texts with the texts' offsets, so that no
step walks over words or characters in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words are runs of anything else: the blank and the controls 0x09-0x0D.
SPACES = b" \t\n\x0b\x0c\r"

U64 = np.uint64
NULL_ID = np.iinfo(np.int64).min  # a null document number sorts before all others


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64: every input bit moves every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _letters(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


_LETTERS = (_letters(11), _letters(77))
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # odd, so that powers can be undone
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        run = np.full(max(n, 1 << 16), base, dtype=U64)
        run[0] = 1
        kept = _POWERS[base] = np.multiply.accumulate(run)
    return kept[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Rolling:
    """Hashes of any runs of a sequence, from one running sum."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        self.base = _BASES[which]
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * _powers(self.base, n), out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        undo = _powers(_inverse(self.base), len(self.sums))
        return mixed((self.sums[ends] - self.sums[starts]) * undo[starts] + (ends - starts).astype(U64))

    def windows(self, width: int) -> np.ndarray:
        """Of every run of that width, by its start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, dtype=U64)
        return mixed((self.sums[width:] - self.sums[:-width]) * _powers(_inverse(self.base), n))


def column_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their offsets; a null text has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no rows
        column = pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    all_bytes = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return all_bytes[ends[0] : ends[-1]], ends - ends[0]


def numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)


def cut(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with at most so many bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def lots(
    data: np.ndarray, offsets: np.ndarray, most: int, ends: bytes
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts of at most `most` bytes: bytes, offsets and whose each text is. A longer text comes in
    parts that are cut at one of the `ends`; where there is none for long, the part is longer."""
    places = None
    start = 0
    while start < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        if end > start:
            yield data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], np.arange(start, end)
            start = end
            continue
        at, last = int(offsets[start]), int(offsets[start + 1])
        if places is None:
            places = np.flatnonzero(np.isin(data, np.frombuffer(ends, np.uint8)))
        while at < last:
            to = last
            if last - at > most:
                i = int(np.searchsorted(places, at + most))
                if i and places[i - 1] > at:
                    to = int(places[i - 1])
                elif i < len(places):
                    to = min(last, int(places[i]) + 1)
            yield data[at:to], np.array([0, to - at]), np.array([start])
            at = to
        start += 1


_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False


class Words:
    """The words of texts: where they lie, whose they are, and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = _IS_WORD[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True  # a text's first byte never continues a word
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        #: the first word of every text, and one more
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        return Rolling(_LETTERS[which][self.data], which).runs(self.starts, self.ends)


def byte_windows(data: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hashes of all byte runs of one width, by their start."""
    return Rolling(_LETTERS[which][data], which).windows(width)


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of so many places lie in any of the runs."""
    steps = np.bincount(starts, minlength=size + 1)[: size + 1] - np.bincount(ends, minlength=size + 1)[: size + 1]
    return np.cumsum(steps)[:size] > 0
