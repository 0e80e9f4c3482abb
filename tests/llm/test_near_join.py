import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from caseweave.llm.components import components
from caseweave.llm.near_join import drop_near_copies, least_matches, near_classes, surviving, verify


def shingle_set(text):
    words = [w for w in re.split("[ \t-\r]+", (text or "").lower()) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(given):
    """class, copy, links to rows and to texts of each row, from all pairs."""
    sets = {i: shingle_set(t) for i, t in given}
    order = {i: tuple((t or "").lower().split()) for i, t in given}
    linked = defaultdict(set)
    for a, b in combinations(sets, 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                linked[a].add(b)
                linked[b].add(a)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        copies = [j for j in sets if order[j] == order[i] and (order[i] or j == i)]
        texts = {order[j] for j in linked[i]} - {order[i]}
        out[i] = (min(seen), min(copies), len(linked[i]), len(texts))
    return sorted((i, *v) for i, v in out.items())


@pytest.mark.parametrize("block", [1024, 4])
def test_against_all_pairs(table, rows, prose, oddities, block):
    texts = prose(160, seed=8) + oddities
    base = [f"n{i}" for i in range(150)]
    texts += [" ".join(base[:k] + ["edit"] + base[k + 1 :]) for k in range(5, 145, 7)]  # a group of near copies
    texts += ["Hot  copy of five words"] * 30 + ["hot copy of five words"] * 3
    given = list(enumerate(texts))
    assert sorted(rows(near_classes(table(given), block=block))) == [*expected(given)] or rows(
        near_classes(table(given), block=block)
    ) == sorted(expected(given), key=str)


def test_odd_rows(table, clashing, rows):
    assert rows(near_classes(table([]))) == []
    text = "a b c d e f g h"
    given = [(None, text), (5, text), (5, text), (6, None), (7, ""), (8, "short"), (9, "short"), (9, "other words")]
    got = rows(near_classes(clashing(given)), "doc_id", "class_id", "n_links")
    assert got[:2] == [(5, 5, 1), (5, 5, 1)]
    assert (6, 6, 0) in got and (7, 7, 0) in got and (8, 8, 1) in got
    assert (None, None, 0) in got and len(got) == len(given)
    assert rows(drop_near_copies(table(given[:1] + given[3:7])), "doc_id") == [(6,), (7,), (8,), (None,)]


def test_pruning_keeps_what_can_reach_the_threshold():
    needed = least_matches(0.8, 1e-7)
    assert (np.diff(needed) > 0).all() and needed[-1] < 0.8 * 128 - 15
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 16, 128).astype(np.uint16)
    other = rng.integers(0, 1 << 16, 128).astype(np.uint16)
    near = base.copy()
    near[np.arange(3, 128, 6)] = 0  # five in six agree
    far = base.copy()
    far[8:] = other[8:]  # the same first band and little else
    sigs = np.stack([base, near, far])
    bands, groups, sides = np.zeros(3, int), np.zeros(3, int), np.full(3, 2)
    sigs[1, :4] = base[:4]
    left, right = surviving(sigs, bands, groups, sides, needed)
    assert list(zip(left, right, strict=True)) == [(0, 1)]


def test_verification_counts_exactly():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(12)]
    pairs = np.array(list(combinations(range(12), 2)))
    want = [len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) >= 0.5 for a, b in pairs]
    assert verify(sets, pairs[:, 0], pairs[:, 1], 0.5).tolist() == want
    few = pairs[::9]
    assert verify(sets, few[:, 0], few[:, 1], 0.5).tolist() == want[::9]


def test_components_of_chains_and_stars(spark, rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(rows(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


def test_one_of_each_class_stays(table, rows, prose):
    given = list(enumerate(prose(80, seed=3)))
    want = expected(given)
    kept = {r[0] for r in rows(drop_near_copies(table(given)), "doc_id")}
    assert kept == {i for i, c, *_ in want if i == c}
    assert Counter(c for _, c, *_ in want).keys() == kept


def test_rows_without_an_id_of_their_own_go_as_well(table, rows):
    text = " ".join(f"w{i}" for i in range(60))
    near = text.replace("w30", "x")
    far = " ".join(f"v{i}" for i in range(60))
    given = [(5, text), (7, far), (7, near), (None, near + " end"), (None, far), (8, "alone here")]
    assert rows(drop_near_copies(table(given)), "doc_id", "text") == sorted([(5, text), (7, far), (8, "alone here")], key=str)


def test_columns_with_our_names(table, rows):
    text = " ".join(f"w{i}" for i in range(60))
    wide = table([(5, text), (6, text + " end"), (7, "other")]).selectExpr(
        "*", "'x' AS _gone", "1 AS key", "2 AS body", "3 AS row", "4 AS _id", "5 AS class_id"
    )
    kept = drop_near_copies(wide)
    assert kept.columns == wide.columns and rows(kept, "doc_id", "key", "_gone") == [(5, 1, "x"), (7, 1, "x")]
