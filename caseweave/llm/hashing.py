"""Hashes of many spans of bytes at once, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
#: Any odd number has an inverse modulo 2 ** 64, which turns prefix sums into span hashes.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
#: Texts are hashed in batches of about so many characters; a longer text is a batch of its own.
BATCH_CHARS = 1 << 20
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _table(which: int, base: int, size: int) -> np.ndarray:
    if len(_powers[which]) < size:
        steps = np.full(max(size, 1 << 20), U64(base))
        steps[0] = U64(1)
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all of them; one to one."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """``sums[i]`` covers ``symbols[:i]``; for ``span_hashes``."""
    sums = np.zeros(len(symbols) + 1, U64)
    np.cumsum((symbols.astype(U64) + U64(1)) * _table(0, BASE, len(symbols) + 1)[: len(symbols)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``symbols[start:end]`` for each pair, wherever the span lies."""
    shift = _table(1, _INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * shift[starts])


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts, a line feed after each, and where each starts (and the end)."""
    coded = [t.encode("utf-8", "replace") for t in texts]
    bounds = np.cumsum([0, *(len(c) + 1 for c in coded)])
    return np.frombuffer(b"\n".join([*coded, b""]), np.uint8), bounds


def runs_of(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """A hash for every run of ``length`` numbers; the ones that are too short at the end are left out."""
    many = max(0, len(hashes) - length + 1)
    total = np.zeros(many, U64)
    rng = np.random.default_rng([length, salt])
    for j in range(length):
        total += hashes[j : j + many] * U64(int(rng.integers(1 << 63)) * 2 + 1)
    return mix(total)


def in_batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BATCH_CHARS."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
