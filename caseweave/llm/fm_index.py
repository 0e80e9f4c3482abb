"""Removes word windows that stand in an earlier document, with FM-indexes.

Words are numbered by a 64-bit hash.  Windows that can repeat are found by their
triggers (``anchors``), and the word sequences around each trigger come together
in one shard.  A shard is indexed by the Burrows-Wheeler transform of its
sequences, kept in a wavelet matrix of packed bits.  Sequences are streamed
through it by backward search, all in step; the interval of the suffixes that
start like the rest of the sequence gives, with the shard's matching statistics,
the smallest document that has the window as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caseweave.llm.anchors import Strings, given_ids, keyed, repeated_strings, unpack
from caseweave.llm.hashing import U64, in_batches
from caseweave.llm.spans import words_of
from caseweave.llm.workers import tidy

WINDOW = 13
GRAM = 5


class WaveletMatrix:
    """Numbers below 2 ** levels as packed bits, level by level, with counts per word."""

    def __init__(self, numbers: np.ndarray):
        self.size = len(numbers)
        self.levels = max(1, int(numbers.max(initial=0)).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (numbers >> level) & 1
            padded = np.zeros((self.size // 64 + 1) * 64, np.uint8)
            padded[: self.size] = bits
            words = np.packbits(padded, bitorder="little").view(U64)
            self.words.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int64))
            self.zeros.append(self.size - int(bits.sum()))
            numbers = np.concatenate([numbers[bits == 0], numbers[bits == 1]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(U64)
        mask = (U64(1) << bit) - U64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def ranks(self, number: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``number`` occurs before place ``at``, element by element."""
        low = np.zeros_like(at)
        for level in range(self.levels):
            one = ((number >> (self.levels - 1 - level)) & 1).astype(bool)
            ones_low, ones_at = self._ones(level, low), self._ones(level, at)
            low = np.where(one, self.zeros[level] + ones_low, low - ones_low)
            at = np.where(one, self.zeros[level] + ones_at, at - ones_at)
        return at - low


class FMIndex:
    """An index of sequences of numbers (from 1 on), each ended by its own mark."""

    def __init__(self, numbers: np.ndarray, ends: np.ndarray, owners: np.ndarray, window: int):
        """``ends`` cut ``numbers`` into sequences; ``owners`` has the document of each."""
        sequences = len(ends)
        sizes = np.diff(np.append(0, ends))
        row = np.repeat(np.arange(sequences), sizes)
        text = np.empty(len(numbers) + sequences, np.int64)
        text[np.arange(len(numbers)) + row] = numbers + sequences  # marks are smaller than words
        text[ends + np.arange(sequences)] = np.arange(1, sequences + 1)
        order, classes = _suffix_order(text, window, int(sizes.max(initial=0)) + 1)
        owner_at = np.repeat(owners, sizes + 1)
        last = text[order - 1]  # the first suffix is preceded by the last mark
        self.matrix = WaveletMatrix(np.where(last > sequences, last - sequences, 0))
        firsts = text[order]
        self.first = np.searchsorted(firsts, np.arange(int(numbers.max(initial=0)) + 2) + sequences)
        # Matching statistics: of all suffixes that agree on a window, the smallest document.
        turn = np.ones(len(order), bool)
        turn[1:] = classes[order[1:]] != classes[order[:-1]]
        heads = np.flatnonzero(turn)
        self.least = np.minimum.reduceat(owner_at[order], heads)[np.cumsum(turn) - 1] if len(order) else owners
        self.size = len(order)

    def extend(self, number: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: intervals after putting ``number`` in front."""
        both = self.matrix.ranks(np.concatenate([number, number]), np.concatenate([low, high]))
        base = self.first[number]
        return base + both[: len(low)], base + both[len(low) :]


def _suffix_order(text: np.ndarray, window: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and classes of suffixes that agree on ``window`` numbers.

    Every sequence ends in a mark of its own, so suffixes differ within the
    longest sequence and doubling stops there.
    """
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)

    def pairs(a: np.ndarray, shift: int) -> np.ndarray:
        follow = np.zeros_like(a)
        follow[: max(0, len(a) - shift)] = a[shift:] + 1
        return np.unique((a << 32) | follow, return_inverse=True)[1].astype(np.int64)

    n, classes = 1, rank if window == 1 else None
    while n < longest:
        if classes is None and 2 * n >= window:
            classes = pairs(rank, window - n) if window > n else rank
        rank, n = pairs(rank, n), 2 * n
    if classes is None:
        classes = rank
    order = np.empty(len(rank), np.int64)
    order[rank] = np.arange(len(rank))
    return order, classes


def repeated_words(window: int):
    """For ``compare_contexts``: which windows a document with a smaller id has as well."""

    def judge(symbols: bytes, ends: np.ndarray, ids: np.ndarray, start: np.ndarray, many: np.ndarray) -> np.ndarray:
        hashes = np.frombuffer(symbols, U64)
        ends = ends // 8
        numbers = np.unique(hashes, return_inverse=True)[1].astype(np.int64) + 1
        index = FMIndex(numbers, ends, ids, window)
        out = np.zeros(int(many.sum()), bool)
        base = np.cumsum(many) - many
        order = np.argsort(-many, kind="stable")  # sequences of the same length step together
        at = ends[order] - 1
        low, high = np.zeros(len(order), np.int64), np.full(len(order), index.size, np.int64)
        steps = many[order] + window - 1
        for step in range(int(steps.max(initial=0))):
            n = int(np.searchsorted(-steps, -step, side="left"))
            low[:n], high[:n] = index.extend(numbers[at[:n] - step], low[:n], high[:n])
            if step >= window - 1:
                which = order[:n]
                found = (high[:n] > low[:n]) & (index.least[np.minimum(low[:n], index.size - 1)] < ids[which])
                out[base[which] + many[which] - 1 - (step - window + 1)] = found
        return out

    return judge


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    with_kept: bool = False,
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, spans.

    A word goes if a run of ``window`` words that covers it also stands in a
    document with a smaller id.  Words are the runs of characters other than
    white space, unchanged.  ``spans`` holds the (start, end) of removed runs
    in words; ``with_kept`` adds the kept words joined by blanks.  Null texts
    have no words; shorter texts stay whole.  A null id counts as the smallest.
    Rows that repeat id and text get one verdict.  Several texts of one id follow
    each other by their hashes, each a document; so do rows without an id, also
    those of one text.
    """
    strings = Strings(words_of, window, gram, across=True)
    marked, given = repeated_strings(keyed(docs, id_col, text_col), strings, repeated_words(window))

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, ids = batch["body"].to_pylist(), batch["id"].to_numpy()
            lists = batch["places"]
            for low, high in in_batches(bodies):
                part = lists.slice(low, high - low)
                counts = part.value_lengths().fill_null(0).to_numpy()
                begin, many, _ = unpack(part.flatten().to_numpy())
                cuts = np.append(0, np.cumsum(counts))
                rows = []
                for i, body in enumerate(bodies[low:high]):
                    words = body.encode("utf-8", "replace").split()
                    spans = []
                    if counts[i]:
                        edges = np.zeros(len(words) + 2, np.int64)
                        b, m = begin[cuts[i] : cuts[i + 1]], many[cuts[i] : cuts[i + 1]]
                        np.add.at(edges, b + 1, 1)
                        np.add.at(edges, b + m + window, -1)
                        gone = np.cumsum(edges) > 0
                        turns = np.flatnonzero(gone[1:] != gone[:-1])
                        spans = [{"start": int(a), "end": int(z)} for a, z in zip(turns[::2], turns[1::2], strict=True)]
                        kept, at = [], 0
                        for s in spans:
                            kept += words[at : s["start"]]
                            at = s["end"]
                        kept += words[at:]
                    else:
                        kept = words
                    text = b" ".join(kept)
                    rows.append(
                        (int(ids[low + i]), len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), spans)
                        + ((text.decode("utf-8", "replace"),) if with_kept else ())
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
                )

    names = ["id", "n_words", "n_removed", "kept_sha256", "spans"] + (["kept"] if with_kept else [])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span] + ([pa.string()] if with_kept else [])
    schema = (
        "id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
        "spans array<struct<start: bigint, end: bigint>>" + (", kept string" if with_kept else "")
    )
    out = marked.select("id", "body", "places").mapInArrow(cut, schema)
    return given_ids(out, given, id_col)
