"""Removes byte strings that stand earlier in the corpus, trigger by trigger.

Triggers of a rolling hash cut the corpus into phrases (``anchors``).  Phrases
that are equal, by their hashes, with all the bytes their strings reach repeat as
a whole; the strings of phrases that differ are ranked by their first 100 bytes
by prefix doubling over the phrases of a trigger.  Neighbours of one rank are
equal strings; the earliest stays.  The parse itself is not sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caseweave.llm.anchors import Strings, given_ids, keyed, repeated_strings, unpack
from caseweave.llm.hashing import U64, in_batches
from caseweave.llm.workers import tidy

LENGTH = 100
GRAM = 24


def byte_symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    coded = [t.encode("utf-8", "replace") for t in texts]
    return np.frombuffer(b"".join(coded), np.uint8), np.cumsum([0, *map(len, coded)])


def prefix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """The rank of each suffix by its first ``length`` bytes; equal ones share a rank.

    Doubling as in suffix array construction: ranks by 2n bytes are ranks of
    pairs of ranks by n bytes.  What the end of the data cuts short counts as
    followed by zeros; callers only look at whole strings.
    """
    def pairs(rank: np.ndarray, shift: int) -> np.ndarray:
        follow = np.zeros_like(rank)
        follow[: max(0, len(rank) - shift)] = rank[shift:]
        return np.unique((rank << U64(32)) | follow, return_inverse=True)[1].astype(U64)

    word = np.zeros(len(data) + 8, U64)
    word[: len(data)] = data
    n = 1
    rank = word
    while n < 8 and 2 * n <= length:  # up to eight bytes are their own rank
        follow = np.zeros_like(rank)
        follow[:-n] = rank[n:]
        rank = (rank << U64(8 * n)) | follow
        n *= 2
    rank = np.unique(rank[: len(data)], return_inverse=True)[1].astype(U64)
    while 2 * n <= length:
        rank, n = pairs(rank, n), 2 * n
    return pairs(rank, length - n) if n < length else rank


def repeated_bytes(length: int):
    """For ``compare_contexts``: which strings equal an earlier one."""

    def judge(symbols: bytes, ends: np.ndarray, ids: np.ndarray, start: np.ndarray, many: np.ndarray) -> np.ndarray:
        rank = prefix_ranks(np.frombuffer(symbols, np.uint8), length)
        begins = np.append(0, ends[:-1])
        row = np.repeat(np.arange(len(many)), many)
        step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        own = rank[begins[row] + step]
        order = np.lexsort((start[row] + step, ids[row], own))
        later = np.zeros(len(row), bool)
        later[order[1:]] = own[order[1:]] == own[order[:-1]]
        return later

    return judge


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    with_kept: bool = False,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    A byte goes if a string of ``length`` bytes that covers it also starts at a
    smaller id, or earlier in the same text.  ``spans`` holds the (start, end) of
    removed runs; ``with_kept`` adds the remaining bytes.  Null texts are empty;
    texts shorter than ``length`` stay whole.  A null id counts as the smallest.
    Rows that repeat id and text get one verdict.  Several texts of one id follow
    each other by their hashes, each a document; so do rows without an id, also
    those of one text.
    """
    strings = Strings(byte_symbols, length, gram, across=False)
    marked, given = repeated_strings(keyed(docs, id_col, text_col), strings, repeated_bytes(length))

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, ids = batch["body"].to_pylist(), batch["id"].to_numpy()
            lists = batch["places"]
            for low, high in in_batches(bodies):
                data, bounds = byte_symbols(bodies[low:high])
                part = lists.slice(low, high - low)
                counts = part.value_lengths().fill_null(0).to_numpy()
                begin, many, _ = unpack(part.flatten().to_numpy())
                first = np.repeat(bounds[:-1], counts) + begin
                edges = np.zeros(len(data) + 1, np.int64)
                np.add.at(edges, first, 1)
                np.add.at(edges, first + many - 1 + length, -1)
                gone = np.cumsum(edges[:-1]) > 0
                heads = gone.copy()
                heads[1:] &= ~gone[:-1]
                inner = bounds[:-1][bounds[:-1] < len(data)]
                heads[inner] = gone[inner]
                tails = gone.copy()
                tails[:-1] &= ~gone[1:]
                last = bounds[1:][bounds[1:] > 0] - 1
                tails[last] = gone[last]
                at, to = np.flatnonzero(heads), np.flatnonzero(tails) + 1
                owner = np.searchsorted(bounds, at, side="right") - 1
                spans = np.bincount(owner, minlength=high - low)
                removed = np.bincount(owner, to - at, minlength=high - low).astype(np.int64)
                kept = [
                    data[a:b].tobytes() if not r else data[a:b][~gone[a:b]].tobytes()
                    for a, b, r in zip(bounds, bounds[1:], removed, strict=False)
                ]
                offset = np.repeat(bounds[:-1], spans)
                runs = pa.ListArray.from_arrays(
                    np.append(0, np.cumsum(spans)).astype(np.int32),
                    pa.StructArray.from_arrays([pa.array(at - offset), pa.array(to - offset)], ["start", "end"]),
                )
                arrays = [
                    pa.array(ids[low:high]),
                    pa.array(np.diff(bounds)),
                    pa.array(removed),
                    pa.array(spans.astype(np.int64)),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                    runs,
                ]
                names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
                if with_kept:
                    arrays.append(pa.array(kept, pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (
        "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<start: bigint, end: bigint>>" + (", kept binary" if with_kept else "")
    )
    out = marked.select("id", "body", "places").mapInArrow(cut, schema)
    return given_ids(out, given, id_col)
