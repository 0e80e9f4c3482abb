"""Finds where long strings of a corpus can repeat, without comparing everything.

A string of ``length`` symbols is filed under the smallest of the rolling hashes
that start inside it, its trigger.  Triggers cut a text into phrases: a phrase is
a run of string starts with the same trigger, and it is never longer than a
string, which triggers at hashes of a fixed remainder would not promise.  Equal
strings have equal triggers, so all questions about repeats can be asked trigger
by trigger:

* a phrase that, with all the symbols its strings reach, stands earlier in the
  corpus as well repeats as a whole (``WHOLE``);
* a phrase whose trigger also has other phrases may repeat in part (``PARTLY``),
  and only then are its symbols sent to the task that owns the trigger;
* all other phrases have no repeat, and their symbols stay where they are.

Triggers found in many documents of a sample are hot: their phrases are dealt out
by content, so that a passage in a third of all documents is no single task's
work.  Of equal phrases one goes on, in two halves: a string reaches at least half
of its free length beyond its trigger on one side or the other, so strings that reach
far to the right are filed under the trigger and what follows it there, all
others under the trigger and what precedes it.  So a hot phrase is sent twice at most,
and as a whole.  What is hot only decides where rows go, never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.hashing import U64, in_batches, mix, prefix_sums, span_hashes
from caseweave.llm.native import most_frequent, whole_text
from caseweave.llm.runs import by_runs
from caseweave.llm.spans import from_bounds
from caseweave.llm.workers import prepare, tidy
from caseweave.sinks.staging import stage

WHOLE, PARTLY = 1, 2
SAMPLE = 64
#: A trigger is hot from this many occurrences in the sample on; so many triggers can be hot.
HOT_COUNT, HOT_LISTED = 20, 1 << 16
NULL_ID = -(1 << 63)
_SPREAD = 64


@dataclass(frozen=True)
class Strings:
    """What a symbol is and how long a string: ``symbols`` maps texts to the numbers of
    all symbols and where each text starts (and the end)."""

    symbols: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
    length: int
    gram: int
    #: Whether a string only repeats if it stands in another document.
    across: bool


@dataclass
class Phrases:
    """Phrases of a batch in text order: text number, first string start in its text,
    strings in it, trigger hash and content hash."""

    text: np.ndarray
    start: np.ndarray
    many: np.ndarray
    trigger: np.ndarray
    content: np.ndarray


def phrases_of(symbols: np.ndarray, bounds: np.ndarray, strings: Strings) -> Phrases:
    length, gram = strings.length, strings.gram
    n = len(symbols)
    ends = bounds[1:]
    if n < length:
        none = np.zeros(0, np.int64)
        return Phrases(none, none, none, none.astype(U64), none.astype(U64))
    sums = prefix_sums(symbols)
    at = np.arange(n - gram + 1)
    hashes = span_hashes(sums, at, at + gram)
    # Low bits hold the place: a tie goes to the leftmost, wherever the text lies in the batch.
    bits = U64(max(1, int(n).bit_length()))
    keys = (hashes >> bits << bits) | at.astype(U64)
    span, reach = 1, length - gram + 1
    while 2 * span <= reach:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    if span < reach:
        keys = np.minimum(keys[: len(keys) - (reach - span)], keys[reach - span :])
    trigger = (keys & ((U64(1) << bits) - U64(1))).astype(np.int64)  # of the string that starts here
    sizes = np.diff(bounds)
    valid = np.zeros(n + 1, np.int8)
    long = sizes >= length
    np.add.at(valid, bounds[:-1][long], 1)
    np.add.at(valid, ends[long] - length + 1, -1)
    inside = np.cumsum(valid[: len(trigger)]).astype(bool)
    turn = np.ones(len(trigger), bool)
    turn[1:] = (trigger[1:] != trigger[:-1]) | (inside[1:] != inside[:-1])
    turn[bounds[:-1][bounds[:-1] < len(turn)]] = True
    first = np.flatnonzero(turn)
    last = np.append(first[1:], len(trigger))
    used = inside[first]
    first, last = first[used], last[used]
    text = np.searchsorted(bounds, first, side="right") - 1
    return Phrases(
        text,
        first - bounds[text],
        last - first,
        hashes[trigger[first]],
        span_hashes(sums, first, last - 1 + length),
    )


def pack(start: np.ndarray, many: np.ndarray, flags: np.ndarray | int = 0) -> np.ndarray:
    """A phrase's place in one number: start, strings, and two bits."""
    return (start.astype(np.int64) << 16) | (many.astype(np.int64) << 2) | flags


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 16, (packed >> 2) & 0x3FFF, packed & 3


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, body): a null id is the smallest one, a null text is empty."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), whole_text(text_col).alias("body")
    )


def one_text_per_id(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with an id of its own for each id and text and for each row without an
    id, in the order of ids and then of text hashes; and the given id of each (id, given).

    Where each id has one text already, rows stay as they are and there is no second table.
    """
    turn, digest, nobody = F.xxhash64("body"), F.sha2("body", 256), F.col("id") == NULL_ID
    several = (
        rows.groupBy("id")
        .agg(F.min(turn).alias("least"), F.max(turn).alias("most"), F.count_if(nobody).alias("nobody"))
        .where("least < most or nobody > 1")
    )
    if several.isEmpty():
        return rows, None
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.withColumn("turn", turn).withColumn("digest", digest)
    dealt = marked.repartitionByRange(parts, "id", "turn", "digest").sortWithinPartitions("id", "turn", "digest")
    # Partitions follow each other as the ids do, so the numbers rise with (id, turn, digest).
    numbered = stage(dealt.withColumn("row", F.monotonically_increasing_id()), "own-ids")
    again = (
        numbered.where(~nobody)
        .groupBy("id", "turn", "digest")
        .agg(F.min("row").alias("first"), F.count("*").alias("many"))
        .where("many > 1")
        .drop("many")
    )
    owned = numbered.join(again, ["id", "turn", "digest"], "left").withColumn("own", F.coalesce("first", "row"))
    given = F.when(~nobody, F.col("id"))
    names = stage(owned.select(F.col("own").alias("id"), given.alias("given")).distinct(), "own-names")
    return owned.select(F.col("own").alias("id"), "body"), names


def given_ids(out: DataFrame, names: DataFrame | None, id_col: str) -> DataFrame:
    """``out`` with the given id as ``id_col`` in place of ``id``."""
    rest = [c for c in out.columns if c != "id"]
    if names is None:
        return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col), *rest)
    return out.join(names, "id").select(F.col("given").alias(id_col), *rest)


def find_phrases(rows: DataFrame, strings: Strings, hot: np.ndarray | None = None) -> DataFrame:
    """(task, content, id, place) of every phrase; ``place`` is packed and says if it is hot
    or, found in the same batch already, repeats as a whole."""
    prepare(rows.sparkSession)
    hot = np.zeros(0, U64) if hot is None else np.sort(hot)

    @tidy
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = batch["body"].tolist(), batch["id"].to_numpy()
            for low, high in in_batches(texts):
                symbols, bounds = strings.symbols(texts[low:high])
                p = phrases_of(symbols, bounds, strings)
                if not len(p.start):
                    continue
                owner = ids[low:high][p.text]
                is_hot = np.isin(p.trigger, hot)
                task = np.where(is_hot, mix(p.trigger ^ (p.content % U64(_SPREAD))), p.trigger)
                order = np.lexsort((p.start, owner, p.content, p.trigger))
                full, _ = _repeats(
                    p.trigger[order], p.content[order], owner[order], p.start[order], strings.across
                )
                known = np.zeros(len(order), np.int64)
                known[order] = full
                yield pd.DataFrame(
                    {
                        # What is decided needs no owner; it goes anywhere.
                        "task": np.where(known == 1, mix(p.trigger ^ mix(p.start.astype(U64) + owner.astype(U64))), task).view(np.int64),
                        "content": p.content.view(np.int64),
                        "id": owner,
                        "place": pack(p.start, p.many, known | (is_hot.astype(np.int64) << 1)),
                    }
                )

    return rows.select("id", "body").mapInPandas(scan, "task bigint, content bigint, id bigint, place bigint")


def _repeats(trigger, content, owner, start, across) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by trigger, content, id and start: which stand earlier as a whole,
    and the number of each row's (trigger, content) group."""
    turn = np.ones(len(trigger), bool)
    turn[1:] = (trigger[1:] != trigger[:-1]) | (content[1:] != content[:-1])
    group = np.cumsum(turn) - 1
    first = np.flatnonzero(turn)[group]
    full = owner > owner[first]
    if not across:
        full |= start > start[first]
    return full, group


def hot_triggers(rows: DataFrame, strings: Strings) -> np.ndarray:
    """The most frequent triggers of one document of SAMPLE; at most HOT_LISTED of them."""
    sample = find_phrases(rows.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0), strings)
    counts = stage(
        sample.where(F.col("place").bitwiseAND(1) == 0).groupBy("task").agg(F.count("*").alias("many")).where(F.col("many") > HOT_COUNT),
        "sample-triggers",
    )
    found = most_frequent(counts, "many", HOT_LISTED).select("task").collect()
    return np.array([r[0] for r in found], np.int64).view(U64)


def classify(phrases: DataFrame, strings: Strings) -> DataFrame:
    """(id, place, task, kind) of phrases that repeat as a whole or may repeat in part."""
    across = strings.across

    @tidy
    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_runs(batches, "task"):
            task, content = batch["task"].to_numpy(), batch["content"].to_numpy()
            owner, place = batch["id"].to_numpy(), batch["place"].to_numpy()
            start, _, flags = unpack(place)
            known = (flags & 1).astype(bool)
            open_ = ~known
            kind = np.where(known, WHOLE, 0)
            o = np.flatnonzero(open_)
            full, group = _repeats(task[o], content[o], owner[o], start[o], across)
            # A trigger is of interest if it has two phrases (in two documents, if that is asked).
            turn = np.ones(len(o), bool)
            turn[1:] = task[o][1:] != task[o][:-1]
            number = np.cumsum(turn) - 1
            heads = np.flatnonzero(turn)
            if len(heads):
                phrases_in = np.maximum.reduceat(group, heads) - np.minimum.reduceat(group, heads) + 1
                several = phrases_in > 1
                if across:
                    several &= np.maximum.reduceat(owner[o], heads) > np.minimum.reduceat(owner[o], heads)
                hot = (flags[o] & 2).astype(bool)
                kind[o] = np.where(full, WHOLE, np.where(several[number] | hot, PARTLY, 0))
            used = kind > 0
            yield pd.DataFrame({"id": owner[used], "place": place[used], "task": task[used], "kind": kind[used]})

    parts = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = phrases.repartition(parts, "task").sortWithinPartitions("task", "content", "id", "place")
    return dealt.mapInPandas(decide, "id bigint, place bigint, task bigint, kind int")


def _halves(
    sums: np.ndarray, first: np.ndarray, many: np.ndarray, strings: Strings
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which row, first string, number of strings and task of the halves of hot phrases."""
    gram, free = strings.gram, strings.length - strings.gram
    half = (free + 1) // 2
    # The trigger lies in all strings of the phrase: from the last one's start on, to the first one's end.
    low, width = first + many - 1, free - many + 2
    before = np.append(0, np.cumsum(width))
    at = np.repeat(low - before[:-1], width) + np.arange(before[-1])
    hashes = span_hashes(sums, at, at + gram)
    least = np.repeat(np.minimum.reduceat(hashes, before[:-1]), width)
    place = np.where(hashes == least, at, np.iinfo(np.int64).max)
    trigger = np.minimum.reduceat(place, before[:-1])
    # Strings that start at most ``free - half`` before the trigger reach half beyond its end.
    turn = np.clip(trigger - (free - half), first, first + many)
    ends = first + many
    row = np.arange(len(first))
    left, right = turn > first, ends > turn
    t, u = trigger[left], trigger[right]
    keys = np.concatenate([span_hashes(sums, t - half, t + gram), mix(span_hashes(sums, u, u + gram + half) + U64(1))])
    return (
        np.concatenate([row[left], row[right]]),
        np.concatenate([first[left], turn[right]]),
        np.concatenate([(turn - first)[left], (ends - turn)[right]]),
        keys.view(np.int64),
    )


def send_contexts(texts: DataFrame, strings: Strings) -> DataFrame:
    """From (id, body, parts: array of (place, task)) to (task, id, start, many, symbols):
    the symbols of each phrase that may repeat in part; a hot one goes in two halves."""
    length = strings.length

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch["body"].to_pylist()
            ids = batch["id"].to_numpy()
            lists = batch["parts"]
            offsets = lists.offsets.to_numpy()
            places = lists.values.field("place").to_numpy()
            tasks = lists.values.field("task").to_numpy()
            for low, high in in_batches(bodies):
                symbols, bounds = strings.symbols(bodies[low:high])
                part = slice(offsets[low], offsets[high])
                text = np.repeat(np.arange(high - low), np.diff(offsets[low : high + 1]))
                start, many, flags = unpack(places[part])
                task = tasks[part]
                first = bounds[:-1][text] + start
                hot = np.flatnonzero(flags & 2)
                if len(hot):
                    cool = np.flatnonzero((flags & 2) == 0)
                    row, begin, count, key = _halves(prefix_sums(symbols), first[hot], many[hot], strings)
                    text = np.concatenate([text[cool], text[hot][row]])
                    first, many = np.concatenate([first[cool], begin]), np.concatenate([many[cool], count])
                    task = np.concatenate([task[cool], key])
                    start = first - bounds[:-1][text]
                sizes = many + length - 1
                ends = np.cumsum(sizes)
                where = np.repeat(first - (ends - sizes), sizes) + np.arange(sizes.sum())
                data = np.ascontiguousarray(symbols[where])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(task),
                        pa.array(ids[low:high][text]),
                        pa.array(start.astype(np.int32)),
                        pa.array(many.astype(np.int32)),
                        from_bounds(data, np.append(0, ends)),
                    ],
                    names=["task", "id", "start", "many", "symbols"],
                )

    return texts.mapInArrow(cut, "task bigint, id bigint, start int, many int, symbols binary")


def compare_contexts(contexts: DataFrame, repeated: Callable[..., np.ndarray]) -> DataFrame:
    """(id, place) of runs of repeated strings.  ``repeated`` gets the symbols of whole
    triggers, the ends of each context in them, ids, starts and numbers of strings, and
    says for each string, in order, whether it repeats."""

    @tidy
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_runs(batches, "task"):
            batch = batch.drop_duplicates(["id", "start", "many"])  # rows that the table repeats
            ids, start, many = (batch[c].to_numpy() for c in ("id", "start", "many"))
            sizes = np.array([len(s) for s in batch["symbols"]])
            hits = repeated(b"".join(batch["symbols"]), np.cumsum(sizes), ids, start, many)
            row = np.repeat(np.arange(len(many)), many)
            at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            head = hits.copy()
            head[1:] &= ~(hits[:-1] & (row[1:] == row[:-1]))
            heads = np.flatnonzero(head)
            if len(heads):
                lengths = np.add.reduceat(hits.astype(np.int64), heads)
                yield pd.DataFrame({"id": ids[row[heads]], "place": pack(start[row[heads]] + at[heads], lengths)})

    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contexts.repartition(parts, "task").sortWithinPartitions("task", "id", "start")
    return dealt.mapInPandas(judge, "id bigint, place bigint")


def repeated_strings(
    rows: DataFrame, strings: Strings, repeated: Callable[..., np.ndarray]
) -> tuple[DataFrame, DataFrame | None]:
    """(id, body, places): every row of ``rows`` (id, body) with the packed runs of string
    starts that repeat (null if none); and what ``given_ids`` needs."""
    rows, names = one_text_per_id(rows)
    found = stage(classify(find_phrases(rows, strings, hot_triggers(rows, strings)), strings), "phrases")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Used twice, shuffled once: both joins below need the same exchange.
    texts = rows.repartition(parts, "id")
    partly = (
        found.where(F.col("kind") == PARTLY)
        .groupBy("id")
        .agg(F.collect_list(F.struct("place", "task")).alias("parts"))
    )
    contexts = send_contexts(texts.join(partly, "id").select("id", "body", "parts"), strings)
    runs = found.where(F.col("kind") == WHOLE).select("id", "place").unionByName(compare_contexts(contexts, repeated))
    places = runs.groupBy("id").agg(F.collect_list("place").alias("places"))
    return texts.join(places, "id", "left"), names
