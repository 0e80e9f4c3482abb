"""Word sequences that occur more often than their parts let expect, by set-oriented mining.

The relation of a length holds where frequent phrases of that length start,
sorted by piece and position, and is written to the shared folder.  It is
merge-joined with itself on the next position of the same piece, which gives the
phrases that are one word longer; those are grouped and counted by Spark, and
the occurrences of the frequent ones (a semi-join) are the next relation.

Before a relation is written, a filter of bounded size stands in for the semi-join: it lets
all frequent groups through and a few others, which the next count removes
exactly.  So no list of phrases, however long, has to reach every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.hashing import U64, mix
from caseweave.llm.spans import LOWER, buffers, cut_out, from_bounds, in_pieces, inner, runs_within, span_numbers
from caseweave.llm.workers import prepare, tidy
from caseweave.operators.topn import top_n
from caseweave.sinks.staging import stage

UNKNOWN = "und"
MIN_COUNT, MAX_WORDS, BEST = 10, 3, 2000
#: A phrase goes if a longer candidate around it has this many hundredths of its occurrences.
ABSORBED = 50
#: The filter has 16 bits per frequent group, but never more than this many.
FILTER_BITS = 1 << 27
_HASHES = 3

_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?"] + list(range(10, 14))] = True
_WORDS = inner((9, 13), (32, 32), *((ord(c), ord(c)) for c in ".,;:!?"))
#: In a relation a word that is not frequent is a full stop, and a piece ends with a line feed.
_GONE, _NEXT, _END = ord("."), ord(" "), ord("\n")
_KEPT = inner((_NEXT, _NEXT), (_END, _END))
COUNTS = "lang string, phrase string, f bigint"
RELATION = "lang string, body binary, places binary"


def _language_codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _language_numbers(names: pa.Array) -> np.ndarray:
    data, bounds = buffers(names.cast(pa.binary()))
    return mix(span_numbers(data, bounds[:-1], bounds[1:]) + U64(1))


def _chain(words: np.ndarray, first: np.ndarray, length: int, languages: np.ndarray) -> np.ndarray:
    """Numbers of the phrases of ``length`` words that start at words ``first``."""
    out = languages.copy()
    for j in range(length):
        out = mix(out * U64(0x9E3779B97F4A7C15) + words[first + j])
    return out


def _counted(data, starts, ends, numbers, codes, names) -> pa.RecordBatch:
    """Groups equal phrases of a batch; ``numbers`` belong to the spans."""
    _, first, many = np.unique(numbers, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [
            names.take(pa.array(codes[first])),
            cut_out(data, starts[first], ends[first]).cast(pa.string()),
            pa.array(many.astype(np.int64)),
        ],
        names=["lang", "phrase", "f"],
    )


def _totalled(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def count_words(rows: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words; a row with a null phrase has a language's number of words."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "body"):
            data, bounds = buffers(batch["body"])
            data = LOWER[data]
            starts, ends = runs_within(data, _WORDS)
            codes, names = _language_codes(batch["lang"])
            owner = np.repeat(codes, np.diff(np.searchsorted(starts, bounds)))
            numbers = _chain(span_numbers(data, starts, ends), np.arange(len(starts)), 1, _language_numbers(names)[owner])
            yield _counted(data, starts, ends, numbers, owner, names)
            totals = np.bincount(owner, minlength=len(names))
            yield pa.RecordBatch.from_arrays(
                [names, pa.nulls(len(names), pa.string()), pa.array(totals.astype(np.int64))], names=["lang", "phrase", "f"]
            )

    return _totalled(rows.mapInArrow(count, COUNTS))


class Filter:
    """Which groups are frequent: never wrong about those that are."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def may_hold(self, numbers: np.ndarray) -> np.ndarray:
        hit = np.ones(len(numbers), bool)
        for slot, bit in _slots(numbers, len(self.words)):
            hit &= (self.words[slot] >> bit) & U64(1) == 1
        return hit



def _slots(numbers: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for salt in range(1, _HASHES + 1):
        at = mix(numbers + U64(salt * 0x632BE59BD9B4E019 & (1 << 64) - 1)) & U64(size * 64 - 1)
        yield (at >> U64(6)).astype(np.int64), at & U64(63)


def filter_of(groups: DataFrame, bits: int = FILTER_BITS) -> Filter:
    """The filter of (lang, phrase) rows; its words are or-ed together by Spark."""
    many = groups.count()
    size = max(1, min(bits, 1 << int(many * 16).bit_length()) // 64)

    @tidy
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = buffers(batch["phrase"])
            starts, ends = runs_within(data, _KEPT)
            edges = np.searchsorted(starts, bounds)
            codes, names = _language_codes(batch["lang"])
            words, lengths = span_numbers(data, starts, ends), np.diff(edges)
            languages = _language_numbers(names)[codes]
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                numbers = _chain(words, edges[:-1][rows], int(length), languages[rows])
                for slot, bit in _slots(numbers, size):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot), pa.array((U64(1) << bit).view(np.int64))], names=["slot", "bits"]
                    )

    ended = F.concat("phrase", F.lit("\n")).cast("binary").alias("phrase")  # so that none runs into the next one
    marked = groups.select("lang", ended).mapInArrow(mark, "slot bigint, bits bigint")
    found = marked.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size, U64)
    words[found["slot"].to_numpy()] = found["bits"].to_numpy().astype(np.int64).view(U64)
    return Filter(words)


def word_relation(rows: DataFrame, frequent: Filter) -> DataFrame:
    """(lang, body, places): each text's frequent words with their places kept."""

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "body"):
            data, bounds = buffers(batch["body"])
            data = LOWER[data]
            starts, ends = runs_within(data, _WORDS)
            if not len(starts):
                continue
            edges = np.searchsorted(starts, bounds)
            codes, names = _language_codes(batch["lang"])
            owner = np.repeat(codes, np.diff(edges))
            used = frequent.may_hold(
                _chain(span_numbers(data, starts, ends), np.arange(len(starts)), 1, _language_numbers(names)[owner])
            )
            # A piece ends after a word if a break, or the end of its text, lies before the next one.
            breaks = np.append(0, np.cumsum(_BREAKS[data]))
            last = np.ones(len(starts), bool)
            last[:-1] = breaks[starts[1:]] > breaks[ends[:-1]]
            last[edges[1:][edges[1:] > 0] - 1] = True
            sizes = np.where(used, ends - starts, 1) + 1
            to = np.append(0, np.cumsum(sizes))
            body = np.full(to[-1], _GONE, np.uint8)
            copied = np.where(used, ends - starts, 0)
            before = np.append(0, np.cumsum(copied))
            step = np.arange(before[-1])
            body[np.repeat(to[:-1] - before[:-1], copied) + step] = data[np.repeat(starts - before[:-1], copied) + step]
            body[to[1:] - 1] = np.where(last, _END, _NEXT)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(codes)), from_bounds(body, to[edges]), pa.nulls(len(codes), pa.binary())],
                names=["lang", "body", "places"],
            )

    return rows.mapInArrow(keep, RELATION).where(F.octet_length("body") > 0)


class _Occurrences:
    """The occurrences of a batch of relation rows: for each the word it starts with."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, bounds = buffers(batch["body"])
        self.starts, self.ends = runs_within(self.data, _KEPT)
        self.edges = np.searchsorted(self.starts, bounds)
        codes, self.names = _language_codes(batch["lang"])
        self.codes = np.repeat(codes, np.diff(self.edges))
        self.words = span_numbers(self.data, self.starts, self.ends)
        # Piece and position in one number: neighbours differ by one, the first word of another piece by more.
        steps = np.ones(len(self.starts), np.int64)
        steps[1:] += self.data[self.ends[:-1]] == _END
        self.place = np.cumsum(steps)
        if batch["places"].null_count:
            self.first = np.flatnonzero(~((self.data[self.starts] == _GONE) & (self.ends - self.starts == 1)))
        else:
            self.first = np.frombuffer(b"".join(batch["places"].to_pylist()), np.int32).astype(np.int64)
            counts = pc.binary_length(batch["places"]).to_numpy() // 4
            self.first += np.repeat(self.edges[:-1], counts)

    def joined(self) -> np.ndarray:
        """Merge join with itself: first words of occurrences that are followed by one at the next position."""
        left = self.place[self.first]
        at = np.searchsorted(left, left + 1)
        at[at == len(left)] = 0
        return self.first[left[at] == left + 1] if len(left) else self.first

    def numbers(self, first: np.ndarray, length: int) -> np.ndarray:
        return _chain(self.words, first, length, _language_numbers(self.names)[self.codes[first]])


def count_longer(relation: DataFrame, length: int) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``length`` words; ``relation`` has those of one less."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "body"):
            o = _Occurrences(batch)
            first = o.joined()
            if len(first):
                ends = o.ends[first + length - 1]
                yield _counted(o.data, o.starts[first], ends, o.numbers(first, length), o.codes[first], o.names)

    return _totalled(relation.mapInArrow(count, COUNTS))


def longer_relation(relation: DataFrame, length: int, frequent: Filter) -> DataFrame:
    """The occurrences of the frequent phrases of ``length`` words."""

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "body"):
            o = _Occurrences(batch)
            first = o.joined()
            first = first[frequent.may_hold(o.numbers(first, length))]
            edges = np.searchsorted(first, o.edges)
            places = first - np.repeat(o.edges[:-1], np.diff(edges))
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], batch["body"], from_bounds(places.astype(np.int32), edges)], names=["lang", "body", "places"]
            )

    return relation.mapInArrow(keep, RELATION).where(F.octet_length("places") > 0)


def frequent_phrases(
    rows: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, filter_bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases with ``min_count`` occurrences, and (lang, n).

    ``rows`` has (lang, body), where a body is UTF-8 with a line feed at its end.
    """
    counted = stage(count_words(rows).where(F.col("phrase").isNull() | (F.col("f") >= min_count)), "words")
    totals = counted.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    groups = [counted.where(F.col("phrase").isNotNull())]
    relation = None
    for length in range(2, max_words + 1):
        frequent = filter_of(groups[-1], filter_bits)
        relation = word_relation(rows, frequent) if relation is None else longer_relation(relation, length - 1, frequent)
        relation = stage(relation, f"occurrences-{length - 1}")
        groups.append(stage(count_longer(relation, length).where(F.col("f") >= min_count), f"phrases-{length}"))
    sized = [g.select("lang", "phrase", F.lit(i).alias("words"), "f") for i, g in enumerate(groups, 1)]
    return reduce(DataFrame.unionByName, sized), totals


def _part(low: Column, many: Column) -> Column:
    """Words ``low`` (from 1) and following of the phrase."""
    return F.array_join(F.slice(F.split("phrase", " "), low, many), " ")


def score_phrases(phrases: DataFrame, absorbed: int = ABSORBED) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one absorbs.

    Numbers are exact: products are decimals of 38 digits.
    """
    longer = phrases.where("words > 1").withColumnRenamed("f", "a")
    counts = phrases.select("lang", "phrase", "f")
    cuts = longer.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumn("first", _part(F.lit(1), F.col("k"))).withColumn(
        "rest", _part(F.col("k") + 1, F.col("words") - F.col("k"))
    )
    for side, number in (("first", "l"), ("rest", "r")):
        found = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(number))
        cuts = cuts.join(found, ["lang", side])
    score = F.expr(
        "cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner_ = (
        phrases.where("words > 2")
        .withColumn("many", F.explode(F.expr("sequence(2, words - 1)")))
        .withColumn("low", F.explode(F.expr("sequence(1, words - many + 1)")))
        .select("lang", _part(F.col("low"), F.col("many")).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("around"))
    )
    left = lowest.join(inner_, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < absorbed * F.col("a"))
    )
    return left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    best: int = BEST,
    absorbed: int = ABSORBED,
) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are lower-cased (A-Z), split at blanks and tabs; phrases never cross one of
    ``.,;:!?`` or a line end.  Null languages are ``und``, null and empty texts have no
    words, rows that repeat count again, texts of any length are read whole, other
    columns are not looked at and an empty table gives an empty result.  Equal scores
    are ordered by occurrences and then by the phrase's bytes, so ranks are unique.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.concat(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("\n")).cast("binary").alias("body"),
    )
    phrases, totals = frequent_phrases(rows, min_count, max_words)
    scored = score_phrases(phrases, absorbed)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = top_n(scored, best, order, within=["lang"])
    # At most ``best`` rows of a language are left, so a language is numbered in one task.
    return kept.join(totals, "lang").select(
        "lang", F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)").cast("long").alias("rank"),
        "phrase", "a", "l", "r", "n", "score",
    )
