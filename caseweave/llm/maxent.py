"""A hashed maximum-entropy language model over words.

The probability of a word is that of its class times that of the word in its class.
Classes 0 to HEADS - 1 hold the most frequent words, MEMBERS of them each, and the end
of a text.  All other words are in one of TAILS classes by their last two bytes, where a word's
share follows its count, with a share for all words that were never seen.  Class
and member are softmaxes over hashed features of the words before: the last word,
the last two together, and the last but one alone (a skip).  Weights start at zero beside the
logarithms of the counts, so the untrained model is the unigram model.

Training goes over all training texts once, in ROUNDS rounds.  In each, tasks start
from the same weights and make gradient steps on batches of their texts; what they
changed is averaged, by the number of tokens that touched a row of weights.  The model has
a fixed size whatever the corpus has; counts of words are joined, never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.hashing import U64
from caseweave.llm.native import most_frequent
from caseweave.llm.spans import LOWER, WORDS, WordList, buffers, cut_out, from_bounds, in_pieces, runs_within, span_numbers
from caseweave.llm.workers import prepare, tidy
from caseweave.sinks.staging import stage

HEADS, MEMBERS, TAILS = 16, 32, 16
CLASSES = HEADS + TAILS
#: Words that are counted where the texts are; the counts of all others are joined to them.
LISTED = 1 << 16
CLASS_ROWS, MEMBER_ROWS = 1 << 13, 1 << 14
ROUNDS, STEP, BATCH = 4, 0.15, 8192
#: Rows of weights that travel together.
BLOCK = 256
_HEAD_CODES = HEADS * MEMBERS
_TAIL_CODES = (65536 - _HEAD_CODES) // TAILS
COUNTS = "token string, f bigint"
CODED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, tail_logs double, "
    "codes binary, rare array<binary>, times array<int>"
)
CHANGES = "block int, changes binary, touched binary"


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 7 == 2, F.lit(False))


def tail_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """By the last two bytes of each word."""
    last = data[ends - 1].astype(np.int64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    return (last * 31 + before * 7) % TAILS


def count_tokens(rows: DataFrame) -> DataFrame:
    """(token, f) of all words of (body) rows; the end of a text is a null token."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "body"):
            data, _ = buffers(batch["body"])
            data = LOWER[data]
            starts, ends = runs_within(data, WORDS)
            _, first, many = np.unique(span_numbers(data, starts, ends), return_index=True, return_counts=True)
            words = cut_out(data, starts[first], ends[first]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([words, pa.array(many.astype(np.int64))], names=["token", "f"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.string()), pa.array([batch.num_rows], pa.int64())], names=["token", "f"]
            )

    return rows.select("body").mapInArrow(count, COUNTS).groupBy("token").agg(F.sum("f").alias("f"))


@dataclass
class Vocabulary:
    """The listed words with their counts and codes, and the sums of all tokens."""

    words: WordList
    counts: np.ndarray
    #: Code of a listed word in the head, -1 in the tail.
    head: np.ndarray
    ends: int
    tokens: int
    distinct: int
    class_logs: np.ndarray
    member_logs: np.ndarray
    #: Per tail class the logarithm of what a word's count is divided by.
    tail_totals: np.ndarray

    @property
    def bottom(self) -> float:
        """Base logarithm of what a count, and one, is divided by."""
        return float(np.log10(self.tokens + self.distinct + 1))


def learn_vocabulary(counts: DataFrame, listed: int = LISTED) -> Vocabulary:
    """From (token, f).  The words of the highest counts are listed, at most ``listed``;
    they, a row per step of counts and one per tail class come to the driver."""
    tokens, distinct = counts.agg(F.sum("f"), F.count("*")).first()
    words = counts.where(F.col("token").isNotNull())
    ends = counts.where(F.col("token").isNull()).first()
    ends = ends["f"] if ends else 0
    best = most_frequent(words, "f", listed).collect()
    best.sort(key=lambda r: (-r["f"], r["token"]))
    data, bounds = buffers(pa.array([r["token"].encode() for r in best], pa.binary()))
    word_list, place = WordList.of(data, bounds[:-1], bounds[1:])
    listed_counts = np.zeros(len(best), np.int64)
    listed_counts[place] = [r["f"] for r in best]
    head = np.full(len(best), -1, np.int64)
    in_head = place[: _HEAD_CODES - 1]
    head[in_head] = np.arange(1, len(in_head) + 1)
    slots = np.zeros(_HEAD_CODES)
    slots[0] = max(1, ends)
    slots[1 : len(in_head) + 1] = listed_counts[in_head]

    @tidy
    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = buffers(batch["token"])
            own = tail_class(data, bounds[:-1], bounds[1:])
            f = batch["f"].to_numpy()
            sums = np.bincount(own, minlength=TAILS).astype(np.int64), np.zeros(TAILS, np.int64)
            np.add.at(sums[1], own, f)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(TAILS, dtype=np.int32)), *map(pa.array, sums)], names=["tail", "words", "f"]
            )

    sums = np.ones(TAILS)
    tails = words.select(F.col("token").cast("binary").alias("token"), "f").mapInArrow(classes, "tail int, words bigint, f bigint")
    for r in tails.groupBy("tail").agg(F.sum("words").alias("words"), F.sum("f").alias("f")).collect():
        sums[r["tail"]] += r["words"] + r["f"]
    # The head's words are no part of the tail.
    np.subtract.at(
        sums,
        tail_class(word_list.spelled, word_list.bounds[:-1][in_head], word_list.bounds[1:][in_head]),
        listed_counts[in_head] + 1,
    )
    with np.errstate(divide="ignore"):
        slots = slots.reshape(HEADS, MEMBERS)
        class_logs = np.log(np.concatenate([slots.sum(1), sums]))
        member_logs = np.log(slots)
    floor = -1e9  # a place without a word
    return Vocabulary(
        word_list, listed_counts, head, ends, tokens or 0, distinct,
        np.maximum(class_logs, floor).astype(np.float32), np.maximum(member_logs, floor).astype(np.float32), np.log(sums),
    )


def encode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Of (id, held_out, body): the codes of each text's tokens, the sums over its
    listed words, and its words that are not listed."""

    @tidy
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary
        logs = np.log10(v.counts + 1.0)
        for batch in in_pieces(batches, "body"):
            data, bounds = buffers(batch["body"])
            data = LOWER[data]
            starts, ends = runs_within(data, WORDS)
            edges = np.searchsorted(starts, bounds)
            owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            numbers = span_numbers(data, starts, ends)
            place = v.words.find(data, starts, ends, numbers)
            listed = place >= 0
            codes = np.where(listed, v.head[place] if len(v.head) else -1, -1)
            tail = np.flatnonzero(codes < 0)
            # A number that tells words of the tail apart as features, and their class.
            spread = (numbers[tail] >> U64(20)) % U64(_TAIL_CODES)
            codes[tail] = _HEAD_CODES + spread.astype(np.int64) * TAILS + tail_class(data, starts[tail], ends[tail])
            many = len(edges) - 1
            out = np.zeros(len(codes) + many, np.uint16)  # every text has an end, code 0
            out[np.arange(len(codes)) + owner] = codes
            in_list, in_tail = np.flatnonzero(listed), np.flatnonzero(listed & (codes >= _HEAD_CODES))
            rare = np.flatnonzero(~listed)
            # Equal words of a text together; the batch's numbers of words do for that.
            _, first, number = np.unique(numbers[rare], return_index=True, return_inverse=True)
            pairs, times = np.unique(owner[rare] * max(1, len(first)) + number, return_counts=True)
            which = rare[first[pairs % max(1, len(first))]] if len(rare) else rare
            lists = np.searchsorted(pairs, np.arange(many + 1) * max(1, len(first))).astype(np.int32)
            end_known = int(v.ends > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["held_out"],
                    pa.array(np.diff(edges) + 1),
                    pa.array(np.bincount(owner[in_list], minlength=many) + end_known),
                    pa.array(np.bincount(owner[in_list], logs[place[in_list]], many) + float(np.log10(v.ends + 1))),
                    pa.array(np.bincount(owner[in_tail], logs[place[in_tail]], many).astype(np.float64)),
                    from_bounds(out, edges + np.arange(many + 1)),
                    pa.ListArray.from_arrays(lists, cut_out(data, starts[which], ends[which])),
                    pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int32))),
                ],
                names=[c.split()[0] for c in CODED.split(", ")],
            )

    return rows.mapInArrow(code, CODED)


@dataclass
class Model:
    class_logs: np.ndarray
    member_logs: np.ndarray
    tail_totals: np.ndarray
    classes: np.ndarray = field(default_factory=lambda: np.zeros((CLASS_ROWS, CLASSES), np.float32))
    members: np.ndarray = field(default_factory=lambda: np.zeros((MEMBER_ROWS, MEMBERS), np.float32))


def contexts(codes: np.ndarray) -> np.ndarray:
    """Numbers of the features of every position, for texts one after the other that each end with code 0."""
    back = np.zeros((2, len(codes)), np.uint32)
    back[0, 1:] = codes[:-1]
    back[1, 2:] = codes[:-2]
    back[1, back[0] == 0] = 0  # before the first word there is nothing
    one, two = back
    mixed = np.stack([one * np.uint32(2654435761), (one * np.uint32(2246822519)) ^ (two * np.uint32(3266489917)), two * np.uint32(668265263)])
    mixed ^= np.array([[0x9E3779B9], [0x85EBCA6B], [0xC2B2AE35]], np.uint32)
    mixed ^= mixed >> np.uint32(15)
    return mixed * np.uint32(2246822519)


def rows_of(features: np.ndarray, rows: int, class_: np.ndarray | None = None) -> np.ndarray:
    if class_ is not None:
        features = (features ^ (class_.astype(np.uint32) + np.uint32(1)) * np.uint32(2654435761)) * np.uint32(3266489917)
    return (features >> np.uint32(32 - (rows.bit_length() - 1))).astype(np.uint16)


def _classes_of_codes() -> np.ndarray:
    codes = np.arange(1 << 16)
    return np.where(codes < _HEAD_CODES, codes // MEMBERS, HEADS + (codes - _HEAD_CODES) % TAILS).astype(np.uint8)


CLASS_OF = _classes_of_codes()


def exponentials(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in proportion to the probabilities, and their sums; ``rows`` has a row
    of weights per feature and position."""
    out = np.take(weights, rows[0], axis=0)
    for r in rows[1:]:
        out += np.take(weights, r, axis=0)
    out += bias
    out -= out.max(axis=1, keepdims=True)
    np.exp(out, out=out)
    return out, out @ np.ones(out.shape[1], np.float32)


def log_chosen(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities of the chosen columns."""
    total = np.take(weights, rows[0], axis=0)
    for r in rows[1:]:
        total += np.take(weights, r, axis=0)
    total += bias
    total -= total.max(axis=1, keepdims=True)
    own = total[np.arange(len(chosen)), chosen].astype(np.float64)
    np.exp(total, out=total)
    return own - np.log(total @ np.ones(total.shape[1], np.float32))


def log_probabilities(model: Model, codes: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Of each position; of a tail word without its count."""
    out = np.zeros(len(codes))
    for low in range(0, len(codes), BATCH):
        part = slice(low, low + BATCH)
        code, seen = codes[part], features[:, part]
        own = CLASS_OF[code]
        value = log_chosen(model.classes, rows_of(seen, CLASS_ROWS), model.class_logs, own)
        head = np.flatnonzero(code < _HEAD_CODES)
        rows = rows_of(seen[:, head], MEMBER_ROWS, own[head])
        value[head] += log_chosen(model.members, rows, model.member_logs[own[head]], code[head] % MEMBERS)
        tail = np.flatnonzero(code >= _HEAD_CODES)
        value[tail] -= model.tail_totals[own[tail] - HEADS]
        out[part] = value
    return out


def segment_sums(values: np.ndarray, heads: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The sum of ``many`` rows from each head on; most segments have a row or two."""
    out = np.take(values, heads, axis=0)
    longer = np.flatnonzero(many > 1)
    for k in range(1, 6):
        longer = longer[many[longer] > k]
        out[longer] += np.take(values, heads[longer] + k, axis=0)
    for i in longer[many[longer] > 6]:
        out[i] += values[heads[i] + 6 : heads[i] + many[i]].sum(axis=0)
    return out


class Descent:
    """Gradient steps on one table of weights, each as long as the row's gradients so far allow."""

    def __init__(self, weights: np.ndarray):
        self.start, self.weights = weights, weights.copy()
        self.squares = np.full(weights.shape, 1.0, np.float32)
        self.touched = np.zeros(len(weights))

    def step(self, rows: np.ndarray, bias: np.ndarray, target: np.ndarray) -> None:
        """One batch: ``rows`` per feature and position, ``target`` the right column."""
        slope, sums = exponentials(self.weights, rows, bias)
        slope *= (1 / sums)[:, None]
        slope[np.arange(len(target)), target] -= 1
        for r in rows:
            order = np.argsort(r, kind="stable")
            sorted_ = r[order]
            heads = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(r) else np.zeros(0, np.int64)
            if not len(heads):
                continue
            many = np.diff(np.append(heads, len(r)))
            sums = segment_sums(np.take(slope, order, axis=0), heads, many)
            at = sorted_[heads]
            squares = np.take(self.squares, at, axis=0)
            squares += sums * sums
            self.squares[at] = squares
            np.sqrt(squares, out=squares)
            sums /= squares
            sums *= STEP
            self.weights[at] -= sums
            self.touched[at] += many

    def changes(self, first_block: int) -> pa.RecordBatch:
        # Changes are small numbers, for which 16 bits do.
        change = (self.weights - self.start).astype(np.float16)
        blocks = len(change) // BLOCK
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(first_block, first_block + blocks, dtype=np.int32)),
                pa.array([change[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in range(blocks)], pa.binary()),
                pa.array([self.touched[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in range(blocks)], pa.binary()),
            ],
            names=["block", "changes", "touched"],
        )


def train_round(texts: DataFrame, model: Model) -> None:
    """One pass over (codes): the model's weights become the mean of what the tasks made of them."""

    @tidy
    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, members = Descent(model.classes), Descent(model.members)
        any_ = False
        for batch in batches:
            codes = buffers(batch["codes"])[0].view(np.uint16)
            features = contexts(codes)
            for low in range(0, len(codes), BATCH):
                part = slice(low, low + BATCH)
                code, seen, any_ = codes[part], features[:, part], True
                own = CLASS_OF[code]
                classes.step(rows_of(seen, CLASS_ROWS), model.class_logs, own)
                head = np.flatnonzero(code < _HEAD_CODES)
                members.step(
                    rows_of(seen[:, head], MEMBER_ROWS, own[head]), model.member_logs[own[head]], code[head] % MEMBERS
                )
        if any_:
            yield classes.changes(0)
            yield members.changes(CLASS_ROWS // BLOCK)

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for block, change, touched in zip(*(batch[c].to_pylist() for c in ("block", "changes", "touched")), strict=True):
                many = np.frombuffer(touched, np.float64)
                change = np.frombuffer(change, np.float16).reshape(BLOCK, -1).astype(np.float64) * many[:, None]
                if block in sums:
                    sums[block][0] += change
                    sums[block][1] += many
                else:
                    sums[block] = [change, many.copy()]
        for block, (change, many) in sums.items():
            mean = (change / np.maximum(many, 1)[:, None]).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([mean.tobytes()], pa.binary()), pa.array([many.tobytes()], pa.binary())],
                names=["block", "changes", "touched"],
            )

    blocks = (CLASS_ROWS + MEMBER_ROWS) // BLOCK
    changed = texts.select("codes").mapInArrow(descend, CHANGES).repartition(blocks, "block").mapInArrow(add, CHANGES)
    for r in changed.collect():  # as many rows as the model has blocks
        mean = np.frombuffer(r["changes"], np.float32).reshape(BLOCK, -1)
        first = CLASS_ROWS // BLOCK
        table, block = (model.classes, r["block"]) if r["block"] < first else (model.members, r["block"] - first)
        table[block * BLOCK : (block + 1) * BLOCK] += mean


def train(coded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Model:
    """From (row, held_out, codes); each round takes its share of the training texts."""
    model = Model(vocabulary.class_logs, vocabulary.member_logs, vocabulary.tail_totals)
    for number in range(rounds):
        share = F.pmod(F.xxhash64("row"), F.lit(rounds)) == number
        train_round(coded.where(~F.col("held_out") & share), model)
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words are lower-cased (A-Z) runs without ASCII white space; the end of a text
    is a token.  A null text is empty and has this one.  Whole texts are read, a
    null id is not held out, repeated rows are rows like others and count again,
    other columns are not looked at, an empty table gives an empty result.  Without
    a training text nothing is known.  Scores are base-10 logarithms.
    """
    prepare(docs.sparkSession)
    body = F.concat(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("\n")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"), body.alias("body")
    )
    counts = stage(count_tokens(rows.where(~F.col("held_out"))), "token-counts")
    vocabulary = learn_vocabulary(counts)
    coded = stage(encode(rows, vocabulary).withColumn("row", F.monotonically_increasing_id()), "coded")
    model = train(coded, vocabulary, rounds)

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = buffers(batch["codes"])
            codes = data.view(np.uint16)
            logs = log_probabilities(model, codes, contexts(codes))
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds) // 2)
            sums = np.bincount(owner, logs, len(bounds) - 1) / np.log(10)
            kept = batch.drop_columns(["codes"])
            yield kept.append_column("model_logs", pa.array(sums))

    # Words that are not listed: at most one in LISTED tokens is the same one of them.
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").cast("string").alias("token"), F.col("w.times").alias("times")
    )
    found = (
        rare.join(counts, "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("f", F.lit(0)) + 1.0)).alias("rare_logs"),
            F.sum(F.when(F.col("f").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    plain = ["doc_id", "held_out", "n_tokens", "n_known", "logs", "tail_logs", "row"]
    schema = ", ".join(f"{c} {t}" for c, t in coded.select(*plain).dtypes) + ", model_logs double"
    return (
        coded.select(*plain, "codes").mapInArrow(score, schema)
        .join(found, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
            (F.col("logs") + rare_logs - F.col("n_tokens") * vocabulary.bottom).alias("base_score"),
            (F.col("model_logs") + F.col("tail_logs") + rare_logs).alias("score"),
        )
    )
