import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from caseweave.llm.ranked_search import Shard, _quotient, rank_documents

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id bigint, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items, best):
    used = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    df = Counter(t for _, c, _ in used for t in c)
    many, words = len(used), sum(n for _, _, n in used)
    out = []
    for item, text in set(items):
        scored = []
        for doc, c, n in used:
            m = 100 - 25 + 25 * n * many // words
            score = sum(
                math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if c[t]
            )
            if score:
                scored.append((-score, -math.inf if doc is None else doc, doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scored, key=lambda x: x[:2])[:best], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("best", "shard_docs", "block_bytes"), [(3, 7, 1 << 20), (20, 1000, 1 << 20), (5, 40, 200)])
def test_against_brute_force(spark, table, prose, rows, best, shard_docs, block_bytes):
    texts = list(enumerate(prose(160, 8)))
    items = [(i, t[: 50 + 20 * (i % 8)]) for i, t in texts[::9]] + [(900, texts[0][1] * 2)]
    found = rank_documents(
        table(texts), spark.createDataFrame(items, ITEMS), best, shard_docs=shard_docs, block_bytes=block_bytes
    )
    assert rows(found) == brute(texts, items, best)


def test_equal_scores_go_by_id(spark, table, rows):
    texts = [(i, "same words here") for i in random.Random(3).sample(range(500), 300)] + [(600, "here"), (None, "same words here")]
    items = [(1, "words"), (2, "here HERE"), (3, "absent"), (4, "")]
    found = rank_documents(table(texts, 2), spark.createDataFrame(items, ITEMS), 20, shard_docs=50)
    assert rows(found) == brute(texts, items, 20)


def test_odd_rows(spark, clashing, oddities, rows):
    texts = [(i // 2 or None, t) for i, t in enumerate(oddities * 2)]
    items = [(None, "Größe naïve 中文字符"), (1, None), (2, "ab ab x"), (2, "ab ab x"), (2, "one"), (3, "a" * 5000)]
    wide = clashing(texts).selectExpr("*", "1 AS item_id", "2 AS score", "3 AS query", "4 AS _rank", "5 AS _id", "6 AS shard")
    found = rank_documents(wide, spark.createDataFrame(items, ITEMS), 4)
    assert rows(found) == brute(texts, items, 4)


def test_empty_tables(spark, table):
    none, some = table([(1, "a b")]).limit(0), table([(1, "a b")])
    items = spark.createDataFrame([(1, "a")], ITEMS)
    assert rank_documents(none, items).count() == 0
    assert rank_documents(some, items.limit(0)).count() == 0
    assert rank_documents(table([(1, None), (2, "..")]), items).count() == 0


def test_most_documents_are_never_scored():
    rng = np.random.default_rng(4)
    many = 4000
    lists = [np.sort(rng.choice(many, size, replace=False)).astype(np.int32) for size in (4000, 3000, 60, 25)]
    times = [rng.integers(1, 9, len(x)).astype(np.int32) for x in lists]
    lengths = rng.integers(50, 400, many)
    shard = Shard(np.arange(4), lists, times, np.arange(many), lengths, many, int(lengths.sum()))
    weight = np.array([5, 40, 5000, 6000])
    places, scores, seen = shard.search(np.arange(4), weight, 20)
    whole = np.zeros(many, np.int64)
    m = 75 + 25 * lengths * many // lengths.sum()
    for w, at, tf in zip(weight, lists, times, strict=True):
        whole[at] += w * (10**9 * tf.astype(np.int64) // (1000 * tf + 12 * m[at]))
    order = np.lexsort((np.arange(many), -whole))[:20]
    assert places.tolist() == order.tolist() and scores.tolist() == whole[order].tolist()
    assert seen < many / 4


def test_lengths_beyond_64_bits():
    lengths = np.array([10**7, 3])
    assert _quotient([25, 10**12], 10**7, lengths, 10**15).tolist() == [25 * 10**12 * 10**7 // 10**15, 25 * 10**12 * 3 // 10**15]
