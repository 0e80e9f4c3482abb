import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from caseweave.llm import maxent
from caseweave.llm.maxent import CLASS_OF, Descent, Model, contexts, log_probabilities, score_texts, segment_sums

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), None]


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base(docs):
    c = Counter(t for i, x in docs if not is_held_out(i) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return [
        (i, is_held_out(i), len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), n,
         sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(x)))
        for i, x in docs
    ]


def same(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    found, expected = sorted(found, key=key), sorted(expected, key=key)
    assert [tuple(r)[:5] for r in found] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in found], [r[5] for r in expected])
    assert all(r[6] <= 0 for r in found)


@pytest.mark.parametrize("listed", [40, 1 << 16])
def test_base_scores(table, prose, monkeypatch, listed):
    monkeypatch.setattr(maxent.learn_vocabulary, "__defaults__", (listed,))
    docs = list(enumerate(prose(90, 9)))
    same(score_texts(table(docs), rounds=1).collect(), base(docs))


def test_odd_rows(clashing, oddities, table):
    docs = [(i // 2 or None, t) for i, t in enumerate(oddities * 2)]
    wide = clashing(docs).selectExpr("*", "1 AS row", "2 AS token", "3 AS f", "4 AS logs", "5 AS codes", "6 AS held_out")
    same(score_texts(wide, rounds=1).collect(), base(docs))
    assert score_texts(table(docs).limit(0), rounds=1).count() == 0


def test_nothing_to_learn_from(table):
    docs = [(i, "some text") for i in range(40) if is_held_out(i)]
    found = score_texts(table(docs), rounds=1).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in found} == {(0, 0, 0.0)}


def test_probabilities_of_all_words_sum_to_one(spark, table, prose):
    docs = list(enumerate(prose(60, 10)))
    rows = table(docs).selectExpr("doc_id AS id", "false AS held_out", "cast(concat(text, '\n') AS binary) AS body")
    counts = maxent.count_tokens(rows).cache()
    known = {r["token"]: r["f"] for r in counts.collect()}
    v = maxent.learn_vocabulary(counts)
    rng = np.random.default_rng(2)
    model = Model(
        v.class_logs, v.member_logs, v.tail_totals,
        rng.normal(0, 1, (maxent.CLASS_ROWS, maxent.CLASSES)).astype(np.float32),
        rng.normal(0, 1, (maxent.MEMBER_ROWS, maxent.MEMBERS)).astype(np.float32),
    )
    words = [w for w in known if w]
    # Every word, the end, and for each tail class a word that was never seen.
    unseen = {}
    for a in range(33, 127):
        data = np.array([1, a], np.uint8)
        unseen.setdefault(int(maxent.tail_class(data, np.array([0]), np.array([2]))[0]), bytes([1, a]).decode())
    assert len(unseen) == maxent.TAILS
    texts = [*words, "", *unseen.values()]
    frame = spark.createDataFrame([(i, False, (w + "\n").encode()) for i, w in enumerate(texts)], "id long, held_out boolean, body binary")
    codes = {r["doc_id"]: np.frombuffer(r["codes"], np.uint16)[0] for r in maxent.encode(frame, v).collect()}
    for before in ([], [5], [300, 7], [40000, 2]):
        total = 0.0
        for i, w in enumerate(texts):
            # The text before always starts anew: code 0 ends the one before it.
            line = np.array([0, *before, codes[i]], np.uint16)
            log = log_probabilities(model, line, contexts(line))[-1]
            if codes[i] >= 512:
                log += math.log(known.get(w, 0) + 1)
            total += math.exp(log)
        assert total == pytest.approx(1, abs=1e-3)


def test_held_out_texts_get_likelier(table):
    # Two languages in alternation of words that follow each other: the features tell which comes next.
    rng = np.random.default_rng(3)
    pairs = {f"w{i}": f"v{(i * 7) % 60}" for i in range(60)}
    text = lambda: " ".join(f"{w} {pairs[w]}" for w in (f"w{i}" for i in rng.integers(0, 60, 80)))
    docs = [(i, text()) for i in range(300)]
    found = [r for r in score_texts(table(docs)).collect() if r["held_out"]]
    gained = sum(r["score"] - r["base_score"] for r in found) / sum(r["n_tokens"] for r in found)
    assert len(found) > 20 and gained > 0.2


def test_gradient_against_differences():
    rng = np.random.default_rng(5)
    weights = rng.normal(0, 0.3, (16, 4)).astype(np.float32)
    rows = rng.integers(0, 16, (3, 50)).astype(np.uint16)
    target, bias = rng.integers(0, 4, 50), rng.normal(0, 1, 4).astype(np.float32)
    loss = lambda w: -maxent.log_chosen(w.astype(np.float32), rows, bias, target).sum()
    descent = Descent(weights)
    descent.step(rows, bias, target)
    first = rows[0]  # the step goes feature by feature with one gradient
    total = np.zeros((16, 4))
    for i in range(16):
        for j in range(4):
            up, down = weights.astype(np.float64), weights.astype(np.float64)
            up[i, j] += 1e-2
            down[i, j] -= 1e-2
            total[i, j] = (loss(up) - loss(down)) / 2e-2
    moved = weights - descent.weights
    assert (np.sign(moved[np.abs(total) > 0.5]) == np.sign(total[np.abs(total) > 0.5])).mean() > 0.9
    assert descent.touched.sum() == 150 and first.dtype == np.uint16


def test_segment_sums():
    rng = np.random.default_rng(6)
    many = rng.integers(1, 20, 50)
    heads = np.append(0, np.cumsum(many)[:-1])
    values = rng.normal(0, 1, (many.sum(), 3)).astype(np.float32)
    assert np.allclose(segment_sums(values, heads, many), np.add.reduceat(values, heads, axis=0), atol=1e-4)


def test_contexts_stay_in_their_text():
    first, second = np.array([4, 9, 0], np.uint16), np.array([7, 700, 8, 0], np.uint16)
    alone = np.concatenate([contexts(first), contexts(second)], axis=1)
    assert (contexts(np.concatenate([first, second])) == alone).all()
    assert CLASS_OF[0] == 0 and CLASS_OF[511] == 15 and CLASS_OF[512] == 16
