"""Words of many texts as spans of one byte array, and numbers that stand for them.

Works on the buffers of Arrow's binary arrays, so no text becomes a Python object.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from caseweave.llm.hashing import U64, joined, mix

#: Bytes that are looked at together when spans are hashed; bounds the memory of long texts.
CHUNK = 1 << 20
#: Bytes of text that are looked at together otherwise; a longer text is a piece of its own.
PIECE = 4 << 20
#: A longer span is hashed on its own.
LONG = 1 << 12
_PRIMES = (2147483647, 2147483629)
_BASES = (1540483477, 1332534557)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_tables: list[tuple[int, np.ndarray, np.ndarray]] = []


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each value starts (and the end)."""
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if wide.buffers()[2] is None or not len(wide):
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    data = np.frombuffer(wide.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def in_pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows of batches in pieces with about ``size`` bytes of ``column``, one row at least."""
    for batch in batches:
        ends = buffers(batch[column])[1]
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + size, side="right")) - 1)
            yield batch.slice(low, high - low)
            low = high


def inner(*ranges: tuple[int, int]) -> np.ndarray:
    """For each byte whether it is none of ``ranges`` (both ends belong to them)."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


def runs_within(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of bytes that are ``inside`` start and end."""
    marks = np.zeros(len(data) + 2, bool)
    marks[1:-1] = inside[data]
    turns = np.flatnonzero(marks[1:] != marks[:-1])
    return turns[::2], turns[1::2]


def _powers() -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each prime the powers of its base and of the base's inverse."""
    if not _tables:
        for p, base in zip(_PRIMES, _BASES, strict=True):
            both = []
            for b in (base, pow(base, -1, p)):
                powers = np.ones(CHUNK + LONG + 1, U64)
                done = 1
                while done < len(powers):  # doubling: the next powers are the known ones times the last and one more
                    more = min(done, len(powers) - done)
                    step = U64(int(powers[done - 1]) * b % p)
                    powers[done : done + more] = powers[:more] * step % U64(p)
                    done += more
                both.append(powers)
            _tables.append((p, *both))
    return _tables


def span_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each span, the same wherever the same bytes lie.

    Two polynomials modulo primes near 2 ** 31; spans must be in ascending order.
    """
    out = np.zeros(len(starts), U64)
    sizes = ends - starts
    long = sizes > LONG
    for i in np.flatnonzero(long):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    short = np.flatnonzero(~long)
    low = 0
    while low < len(short):
        first = starts[short[low]]
        high = int(np.searchsorted(starts[short], first + CHUNK, side="left"))
        rows = short[low:high]
        s, e = starts[rows] - first, ends[rows] - first
        piece = data[first : first + e[-1]].astype(U64) + U64(1)
        number = np.zeros(len(rows), U64)
        for shift, (p, powers, inverse) in zip((0, 31), _powers(), strict=True):
            sums = np.zeros(len(piece) + 1, U64)
            np.cumsum(piece * powers[: len(piece)], out=sums[1:])
            number |= ((sums[e] - sums[s]) % U64(p)) * inverse[s] % U64(p) << U64(shift)
        out[rows] = mix(number)
        low = high
    return out


def cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of spans as a binary array."""
    sizes = ends - starts
    bounds = np.append(0, np.cumsum(sizes))
    where = np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])
    return from_bounds(data[where], bounds)


def from_bounds(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array of the pieces of ``data`` between ``bounds``."""
    data = np.ascontiguousarray(data)
    width = data.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(bounds) - 1,
        [None, pa.py_buffer((bounds * width).astype(np.int64)), pa.py_buffer(data)],
    ).cast(pa.binary())


@dataclass(frozen=True)
class WordList:
    """Words that are looked for in texts: their numbers in ascending order and their bytes."""

    numbers: np.ndarray
    spelled: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[WordList, np.ndarray]:
        """The distinct words among spans, and the place in the list of each span."""
        distinct, first, place = np.unique(span_numbers(data, starts, ends), return_index=True, return_inverse=True)
        return cls(distinct, *buffers(cut_out(data, starts[first], ends[first]))), place

    def find(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, numbers: np.ndarray | None = None
    ) -> np.ndarray:
        """The place in the list of each span, or -1; bytes are compared, not only numbers."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.numbers):
            return out
        widths = np.diff(self.bounds)
        possible = np.flatnonzero(ends - starts <= widths.max())
        numbers = span_numbers(data, starts[possible], ends[possible]) if numbers is None else numbers[possible]
        place = np.searchsorted(self.numbers, numbers)
        place[place == len(self.numbers)] = 0
        hit = (self.numbers[place] == numbers) & (widths[place] == ends[possible] - starts[possible])
        possible, place = possible[hit], place[hit]
        sizes = widths[place]
        before = np.append(0, np.cumsum(sizes))
        step = np.arange(before[-1])
        differs = data[np.repeat(starts[possible] - before[:-1], sizes) + step] != self.spelled[
            np.repeat(self.bounds[:-1][place] - before[:-1], sizes) + step
        ]
        wrong = np.append(0, np.cumsum(differs))
        same = wrong[before[1:]] == wrong[before[:-1]]
        out[possible[same]] = place[same]
        return out


#: Words are runs of bytes other than white space (blank, 9 to 13).
WORDS = inner((9, 13), (32, 32))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word of the texts in order, and where each text's words start (and the end)."""
    data, bounds = joined(texts)
    starts, ends = runs_within(data, WORDS)
    return span_numbers(data, starts, ends), np.searchsorted(starts, bounds)
