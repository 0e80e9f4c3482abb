"""Ranked search for words: the best documents of each item, best intervals of documents first.

The documents are cut into shards.  A shard has a posting list per term (documents in
ascending order, occurrences) and over each list a sparse table, which names the
posting of the largest impact in any range of the list at once.

An item's search of a shard starts with the interval of all documents.  An interval's
bound is the sum of its terms' largest impacts inside.  The intervals of the
highest bounds are taken first; each is split at the document that has the
largest of these impacts, which is scored and leaves an interval on either side.  An
interval whose bound is below the k-th best score so far holds nothing of use.
Every document is either scored or lies in such an interval, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from caseweave.llm.spans import LOWER, WordList, buffers, from_bounds, inner, runs_within
from caseweave.llm.workers import give_back, prepare, tidy
from caseweave.operators.topn import top_n
from caseweave.sinks.staging import stage

BEST = 20
#: Documents and bytes of text of a shard.
SHARD_DOCS, SHARD_BYTES = 1 << 14, 1 << 26
#: Bytes of item text that are searched for in one pass over the documents.
BLOCK_BYTES = 8 << 20
#: Intervals taken at once, and the number of documents from which one is scored as it is.
TAKEN, LEAF = 256, 16
NULL_ID = -(1 << 63)
_TERMS = inner((0, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
POSTINGS = "shard bigint, term int, many bigint, words bigint, docs binary, times binary, ids binary, lengths binary"
FOUND = "query int, doc_id bigint, score bigint"


@dataclass
class Query:
    """The terms of the items of one pass, and per item (term, repeats)."""

    terms: WordList
    items: list[tuple[np.ndarray, np.ndarray]]


def body_of(text_col: str) -> Column:
    return F.concat(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("\n")).cast("binary")


def read_query(texts: list[bytes]) -> Query:
    """Texts end with a byte that belongs to no term."""
    data, bounds = buffers(pa.array(texts, pa.binary()))
    data = LOWER[data]
    starts, ends = runs_within(data, _TERMS)
    terms, place = WordList.of(data, starts, ends)
    edges = np.searchsorted(starts, bounds)
    return Query(terms, [np.unique(place[a:b], return_counts=True) for a, b in zip(edges, edges[1:], strict=False)])


def build_shards(docs: DataFrame, query: Query, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of (id, body): a row per shard and posting list, and one with a null term
    per shard with the ids and lengths of its documents (those that have a term).

    ``many`` documents are in the list or shard, ``words`` terms in the shard.
    """

    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, pairs, times = [], [], [], []
        docs_in = size = number = part = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, lengths, pairs, times, docs_in, size, number
            own, many = np.concatenate(ids), np.concatenate(lengths)
            used = np.flatnonzero(many > 0)
            order = used[np.argsort(own[used], kind="stable")]
            place = np.zeros(len(own), np.int64)
            place[order] = np.arange(len(order))
            pair, tf = np.concatenate(pairs), np.concatenate(times)
            pair = pair >> 32 << 32 | place[pair & 0xFFFFFFFF]
            turn = np.argsort(pair)
            pair, tf = pair[turn], tf[turn]
            term, first = np.unique(pair >> 32, return_index=True)
            edges = np.concatenate([first, [len(pair)] * 2])
            whole = np.zeros(len(term) + 2, np.int64)
            whole[-1] = len(order)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(term) + 1, (part << 32) + number)),
                    pa.array([*term.tolist(), None], pa.int32()),
                    pa.array(np.append(np.diff(edges)[:-1], len(order))),
                    pa.array([None] * len(term) + [int(many.sum())], pa.int64()),
                    from_bounds((pair & 0xFFFFFFFF).astype(np.int32), edges),
                    from_bounds(tf.astype(np.int32), edges),
                    from_bounds(own[order], whole),
                    from_bounds(many[order], whole),
                ],
                names=["shard", "term", "many", "words", "docs", "times", "ids", "lengths"],
            )
            ids, lengths, pairs, times, docs_in, size, number = [], [], [], [], 0, 0, number + 1
            return out

        for batch in batches:
            part = batch["part"][0].as_py()
            data, bounds = buffers(batch["body"])
            own = batch["id"].to_numpy()
            low = 0
            while low < len(own):
                # As many texts as belong together, one at least; a part of a batch is a batch.
                room = max(1, min(shard_docs - docs_in, int(np.searchsorted(bounds, bounds[low] + (1 << 22)) - low)))
                high = min(len(own), low + room)
                text = LOWER[data[bounds[low] : bounds[high]]]
                starts, ends = runs_within(text, _TERMS)
                edges = np.searchsorted(starts, bounds[low : high + 1] - bounds[low])
                ids.append(own[low:high])
                lengths.append(np.diff(edges))
                term = query.terms.find(text, starts, ends)
                hit = np.flatnonzero(term >= 0)
                owner = np.searchsorted(edges, hit, side="right") - 1
                pair, tf = np.unique(term[hit] << 32 | (docs_in + owner), return_counts=True)
                pairs.append(pair)
                times.append(tf)
                docs_in += high - low
                size += int(bounds[high] - bounds[low])
                low = high
                if docs_in >= shard_docs or size >= shard_bytes:
                    yield flush()
        if docs_in:
            yield flush()

    return docs.select("id", "body", F.spark_partition_id().cast("long").alias("part")).mapInArrow(build, POSTINGS)


def weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * frequencies + 1))).astype(np.int64)


def _quotient(dividend: list[int], largest: int, lengths: np.ndarray, divisor: int) -> np.ndarray:
    """``product(dividend) * lengths // divisor``, in Python's numbers where 64 bits are too few."""
    factor = int(np.prod([1, *dividend], dtype=object))
    if factor * largest < 1 << 63:
        return lengths * factor // divisor
    return (lengths.astype(object) * factor // divisor).astype(np.int64)


class Shard:
    """Posting lists one after the other, with the impacts of a term of weight one."""

    def __init__(self, terms, docs, times, ids, lengths, documents: int, words: int):
        order = np.argsort(terms)
        self.ids, self.many = ids, len(ids)
        self.terms = terms[order]
        self.edges = np.append(0, np.cumsum([len(docs[i]) for i in order])).astype(np.int64)
        self.docs = np.concatenate([docs[i] for i in order]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
        tf = np.concatenate([times[i] for i in order]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
        longest = int(lengths.max()) if len(lengths) else 0
        m = 100 - 25 + _quotient([25, documents], longest, lengths, max(1, words))
        self.impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[self.docs])
        list_of = np.repeat(np.arange(len(order)), np.diff(self.edges))
        self.keys = list_of * self.many + self.docs
        # Level j: the posting of the largest impact (the first of several) among 2 ** j from here on.
        level = np.arange(len(self.docs), dtype=np.int32)
        self.levels, width = [level], 1
        longest = int(np.diff(self.edges).max()) if len(order) else 0
        while 2 * width <= longest:
            left, right = level[:-width], level[width:]
            level = np.where(self.impact[left] >= self.impact[right], left, right)
            self.levels.append(level)
            width *= 2
        self.offsets = np.append(0, np.cumsum([len(x) for x in self.levels]))
        self.table = np.concatenate(self.levels)
        self.levels = None

    def strongest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posting of the largest impact in each range of a list and this impact (0 if it is empty)."""
        size = high - low
        empty = size <= 0
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        base = self.offsets[level]
        left = self.table[np.where(empty, 0, base + low)]
        right = self.table[np.where(empty, 0, base + high - (1 << level))]
        best = np.where(self.impact[left] >= self.impact[right], left, right)
        return best, np.where(empty, 0, self.impact[best])

    def search(self, terms: np.ndarray, weight: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the ``best`` documents, and how many were scored."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        there = (self.terms[at] == terms) & (weight > 0) if len(self.terms) else np.zeros(len(terms), bool)
        at, weight = at[there], weight[there]
        places, scores, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        if not len(at):
            return places, scores, seen
        # An interval: its first document and the one after its last, and the same in each list.
        begin, end = np.zeros(1, np.int64), np.full(1, self.many)
        low, high = self.edges[at][None], self.edges[at + 1][None]
        post, value = self.strongest(low, high)
        bound = value @ weight
        top = np.take_along_axis(post, (value * weight).argmax(1)[:, None], 1)[:, 0]
        least, last = 0, self.many
        taken = 8
        while len(bound):
            if len(bound) > taken:
                order = np.argpartition(-bound, taken)
                now, rest = order[:taken], order[taken:]
            else:
                now, rest = np.arange(len(bound)), np.zeros(0, np.int64)
            small = end[now] - begin[now] <= LEAF
            found_at, found = [], []
            for i in now[small]:
                width = end[i] - begin[i]
                many = high[i] - low[i]
                before = np.append(0, np.cumsum(many))
                where = np.repeat(low[i] - before[:-1], many) + np.arange(before[-1])
                score = np.zeros(width, np.int64)
                np.add.at(score, self.docs[where] - begin[i], self.impact[where] * np.repeat(weight, many))
                found_at.append(begin[i] + np.arange(width))
                found.append(score)
            now = now[~small]
            d = self.docs[top[now]]
            wanted = at[None] * self.many + d[:, None]
            cut = np.searchsorted(self.keys, wanted)
            held = cut < len(self.keys)
            held[held] = self.keys[cut[held]] == wanted[held]
            found_at.append(d)
            found.append(np.where(held, self.impact[np.where(held, cut, 0)], 0) @ weight)
            places = np.concatenate([places, *found_at])
            scores = np.concatenate([scores, *found])
            seen += sum(map(len, found))
            used = scores > 0
            places, scores = places[used], scores[used]
            if len(scores) >= best:
                order = np.lexsort((places, -scores))[:best]
                places, scores = places[order], scores[order]
                least, last = int(scores[-1]), int(places[-1])
            new = [
                (np.concatenate([begin[now], d + 1]), np.concatenate([d, end[now]])),
                (np.concatenate([low[now], cut + held]), np.concatenate([cut, high[now]])),
            ]
            post, value = self.strongest(*new[1])
            reach = value * weight
            pick = np.take_along_axis(post, reach.argmax(1)[:, None], 1)[:, 0]
            begin, end = np.concatenate([begin[rest], new[0][0]]), np.concatenate([end[rest], new[0][1]])
            low, high = np.concatenate([low[rest], new[1][0]]), np.concatenate([high[rest], new[1][1]])
            bound = np.concatenate([bound[rest], reach.sum(1)])
            top = np.concatenate([top[rest], pick])
            # An equal score counts only for a document before the last of the best ones.
            open_ = (bound > max(least, 0)) | ((bound == least) & (bound > 0) & (begin < last))
            begin, end, low, high, bound, top = (x[open_] for x in (begin, end, low, high, bound, top))
            taken = min(TAKEN, 2 * taken)
        order = np.lexsort((places, -scores))[:best]
        return places[order], scores[order], seen


def shard_of(rows: pa.Table, documents: int, words: int) -> Shard:
    term = rows["term"].to_pylist()
    head = term.index(None)
    lists = [i for i in range(len(term)) if i != head]
    docs, times = ([np.frombuffer(b, np.int32) for b in rows[c].to_pylist()] for c in ("docs", "times"))
    ids, lengths = (np.frombuffer(rows[c][head].as_py(), np.int64) for c in ("ids", "lengths"))
    return Shard(
        np.array([term[i] for i in lists], np.int64), [docs[i] for i in lists], [times[i] for i in lists], ids, lengths, documents, words
    )


def search_block(docs: DataFrame, query: Query, best: int = BEST, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(query, doc_id, score): of each shard the best documents of each item of the block."""
    index = stage(build_shards(docs, query, shard_docs), "postings")
    # As many rows as the block has terms.
    counts = index.groupBy("term").agg(F.sum("many").alias("many"), F.sum("words").alias("words")).collect()
    documents, words = next(((r["many"], r["words"]) for r in counts if r["term"] is None), (0, 0))
    held = np.zeros(len(query.terms.numbers), np.int64)
    for r in counts:
        if r["term"] is not None:
            held[r["term"]] = r["many"]
    weight = weights(documents, held)
    items = [(terms, weight[terms] * times) for terms, times in query.items]

    def find(table: pa.Table) -> pa.Table:
        shard = shard_of(table, documents, words)
        out = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for number, (terms, weight_) in enumerate(items):
            places, scores, _ = shard.search(terms, weight_, best)
            out.append((np.full(len(places), number, np.int32), shard.ids[places], scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        give_back()
        return pa.table([pa.array(c) for c in columns], names=["query", "doc_id", "score"])

    return index.groupBy("shard").applyInArrow(find, FOUND)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """The ``best`` documents of each item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case.
    Null and empty texts have no terms: such a document is in no result and in no
    count, such an item has no rows.  Texts are read whole.  Equal scores go by
    ascending id, a null id first; each row is a document of its own, also one that
    repeats an id.  Items that repeat id and text count once; texts that share an id are
    ranked each.  Other columns are not looked at, and an empty table gives an empty
    result.  Items are answered in blocks of about ``block_bytes`` of their text.
    """
    spark = docs.sparkSession
    prepare(spark)
    asked = stage(
        items.select(F.col(item_col).alias("item_id"), body_of(item_text_col).alias("body")).distinct(), "items"
    )
    size = asked.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), body_of(text_col).alias("body"))
    results = []
    for block in range(blocks):
        block_of = F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks))
        picked = asked.where(block_of == block).collect()
        query = read_query([bytes(r["body"]) for r in picked])
        found = search_block(rows, query, best, shard_docs)
        names = spark.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(picked)],
            StructType([StructField("query", IntegerType()), asked.schema["item_id"]]),
        )
        order = [F.desc("score"), F.asc("doc_id")]
        kept = top_n(found, best, order, within=["query"])
        rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
        results.append(kept.withColumn("rank", rank).join(F.broadcast(names), "query"))
    return reduce(DataFrame.unionAll, results).select(
        "item_id", "rank", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "score"
    )
