"""Scoring of a batch of queries against a block of base rows (numpy in tasks).

Spark partitions the queries and ships the base; these helpers only see one
Arrow batch and one bounded block at a time.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Distances closer than this are ties, broken by base id.
DECIMALS = 9
_CELLS = 1 << 21  # scores held at once per task: 16 MB of doubles
_TOKENS = 1 << 19  # tokens counted at once: about those of a batch

CANDIDATE = pa.struct(
    [("base_id", pa.string()), ("base_label", pa.string()), ("distance", pa.float64())]
)
CANDIDATES_DDL = "array<struct<base_id:string,base_label:string,distance:double>>"


class VectorBlock:
    """Base rows with dense vectors, compared by cosine distance."""

    def __init__(self, ids, labels, vectors: pa.Array):
        rows, matrix = unit_rows(vectors)
        order = sorted(range(len(rows)), key=lambda i: ids[rows[i]])
        self.ids = [ids[rows[i]] for i in order]
        self.labels = [labels[rows[i]] for i in order]
        self.unit = matrix[order]

    def queries(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers that can be compared, and their unit vectors."""
        return unit_rows(batch, self.unit.shape[1])

    def distances(self, unit: np.ndarray) -> np.ndarray:
        return _distances(unit, self.unit)


class TokenBlock:
    """Base rows as token counts; cosine over tokens, no vocabulary limit."""

    def __init__(self, ids, labels, tokens: pa.Array):
        rows, coded, vocabulary = _codes(tokens)
        counts = np.zeros((len(tokens), max(len(vocabulary), 1)))
        np.add.at(counts, (rows, coded), 1.0)
        norms = np.linalg.norm(counts, axis=1)
        order = sorted(np.flatnonzero(norms > 0), key=lambda i: ids[i])
        self.ids = [ids[i] for i in order]
        self.labels = [labels[i] for i in order]
        self.vocabulary = vocabulary
        self.unit = counts[order] / norms[order, None]

    def queries(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        rows, coded, vocabulary = _codes(batch)
        pairs, n = np.unique(rows * max(len(vocabulary), 1) + coded, return_counts=True)
        row, code = np.divmod(pairs, max(len(vocabulary), 1))
        squares = np.bincount(row, weights=n.astype(float) ** 2, minlength=len(batch))
        known = pc.index_in(vocabulary, value_set=self.vocabulary).to_numpy(zero_copy_only=False)
        column = known[code] if len(code) else np.zeros(0)
        hit = ~np.isnan(column.astype(float))
        usable = np.flatnonzero(squares > 0)
        place = np.full(len(batch), -1)
        place[usable] = np.arange(len(usable))
        weights = np.zeros((len(usable), self.unit.shape[1]))
        weights[place[row[hit]], column[hit].astype(int)] = n[hit]
        return usable, weights / np.sqrt(squares[usable])[:, None]

    def distances(self, unit: np.ndarray) -> np.ndarray:
        return _distances(unit, self.unit)


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rounded cosine distances of unit vectors, in one array."""
    scores = left @ right.T
    np.subtract(1.0, scores, out=scores)
    np.round(scores, DECIMALS, out=scores)
    scores += 0.0
    return scores


def top_candidates(block, batch: pa.Array, k: int) -> pa.Array:
    """Per query the ``k`` nearest base rows, nearest first; empty if not comparable."""
    batch = _one_array(batch)
    width = max(len(block.ids), 1)
    step = max(_CELLS // max(width, block.unit.shape[1] if block.unit.size else 1), 1)
    ids = pa.array(block.ids, pa.string())
    labels = pa.array(block.labels, pa.string())
    chunks = []
    for start in range(0, len(batch), step):
        part = batch.slice(start, step)
        per_row = np.zeros(len(part), dtype=np.int64)
        index, distance = np.zeros(0, np.int64), np.zeros(0)
        if block.ids:
            rows, unit = block.queries(part)
            at, index, distance = _smallest(block.distances(unit), k)
            np.add.at(per_row, rows[at], 1)
        offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
        values = pa.StructArray.from_arrays(
            [
                ids.take(pa.array(index)),
                labels.take(pa.array(index)),
                pa.array(distance, pa.float64()),
            ],
            fields=list(CANDIDATE),
        )
        chunks.append(pa.ListArray.from_arrays(pa.array(offsets), values))
    if not chunks:
        return pa.array([], pa.list_(CANDIDATE))
    return pa.concat_arrays(chunks)


def hashed_counts(batch: pa.Array, buckets: int) -> pa.Array:
    """Token lists to term counts per md5 bucket; null lists stay null."""
    batch = _one_array(batch)
    sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
    before = np.cumsum(sizes, dtype=np.int64) // _TOKENS
    counts = np.zeros(len(batch) * buckets, np.float32)
    # Some rows at a time: codes and cells take several times the bytes of their tokens.
    edges = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(batch)]
    for start, end in zip(edges, edges[1:]):
        rows, coded, vocabulary = _codes(batch.slice(start, end - start))
        heads = np.fromiter(map(_md5_head, vocabulary.to_pylist()), np.int64, len(vocabulary))
        cells = rows * buckets + (heads % buckets)[coded]
        counts[start * buckets : end * buckets] = np.bincount(cells, minlength=(end - start) * buckets)
    offsets = np.arange(len(batch) + 1, dtype=np.int32) * buckets
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(counts), mask=batch.is_null()
    )


@lru_cache(maxsize=1 << 17)
def _md5_head(token: str) -> int:
    """First 16 bits of the token's md5; frequent tokens are hashed once per worker."""
    return int.from_bytes(hashlib.md5(token.encode()).digest()[:2], "big")


def _one_array(batch) -> pa.Array:
    return batch.combine_chunks() if isinstance(batch, pa.ChunkedArray) else batch


def _dense(batch: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and matrix of the rows that hold a finite vector.

    Vectors of another length are an error: dropping them would lose results.
    """
    batch = _one_array(batch)
    rows = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
    sizes = pc.list_value_length(batch).drop_null().to_numpy(zero_copy_only=False)
    dim = dim if dim is not None else (int(sizes[0]) if len(sizes) else 0)
    if (sizes != dim).any():
        raise ValueError(f"vectors of length {sorted(set(sizes.tolist()))}, expected {dim}")
    values = batch.drop_null().flatten().cast(pa.float64())
    matrix = values.to_numpy(zero_copy_only=False).reshape(len(rows), dim)
    good = np.isfinite(matrix).all(axis=1)
    return (rows, matrix) if good.all() else (rows[good], matrix[good])


def unit_rows(batch: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and unit vectors of the rows that have a direction."""
    rows, matrix = _dense(batch, dim)
    norms = np.linalg.norm(matrix, axis=1)
    some = norms > 0
    if not some.all():
        rows, matrix, norms = rows[some], matrix[some], norms[some]
    return rows, matrix / norms[:, None]


def _codes(batch: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Flattened tokens as (row number, code) pairs plus the distinct tokens."""
    batch = _one_array(batch)
    sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(batch)), sizes)
    coded = batch.flatten().cast(pa.string()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return rows, codes, coded.dictionary


def _smallest(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the k smallest per row; ties by lower column."""
    if scores.size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    k = min(k, scores.shape[1])
    edge = np.partition(scores, k - 1, axis=1)[:, k - 1]
    row, col = np.nonzero(scores <= edge[:, None])
    value = scores[row, col]
    order = np.lexsort((col, value, row))
    row, col, value = row[order], col[order], value[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    keep = np.arange(len(row)) - first[row] < k
    return row[keep], col[keep], value[keep]
