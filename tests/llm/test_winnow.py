import hashlib

import xxhash
from pyspark.sql import functions as F

from caseweave.llm.winnow import compare_with_next, fingerprints, grams, winnow


def brute(hashes, window):
    """Rightmost smallest of each window, by the low 33 bits; positions in order."""
    low = [h & ((1 << 33) - 1) for h in hashes]
    last = max(1, len(hashes) - window + 1)
    picked = []
    for s in range(last if hashes else 0):
        part = range(s, min(s + window, len(hashes)))
        at = min(part, key=lambda i: (low[i], -i))
        if at not in picked:
            picked.append(at)
    return [(hashes[i], i) for i in picked]


def test_windows_and_ties_against_brute_force(table, prose, oddities):
    df = table(list(enumerate(prose(40) + oddities)))
    body = F.coalesce("text", F.lit(""))
    for row in df.select("text", grams(body, 3).alias("g"), winnow(body, 3, 4).alias("w")).collect():
        assert [tuple(p) for p in row["w"]] == brute(row["g"], 4)


def test_short_texts_keep_what_an_edit_leaves(table, rows):
    words = [f"w{i}" for i in range(200)]
    given = [(n, " ".join(words[:n])) for n in (9, 12, 16, 20, 24, 36, 80)]
    given += [(1000 + n, " ".join(words[: n - n // 4] + [f"new{i}" for i in range(n // 4)])) for n, _ in given]
    kept = fingerprints(table(given)).groupBy("hash").agg(F.collect_set("doc_id").alias("ids")).where("size(ids) > 1")
    shared = {i for r in kept.collect() for i in r["ids"] if i < 1000 and i + 1000 in r["ids"]}
    assert shared == {n for n, _ in given if n < 1000}
    near = dict(rows(compare_with_next(table([(1, given[3][1]), (2, "other words stand here " * 3)])), "doc_id", "near_edited"))
    assert 0 < near[1] < 1


def test_own_windows_nest(table):
    text = " ".join(f"w{i * i % 97}" for i in range(300))
    df = table([(1, text)])
    body, kept = F.col("text"), {}
    for window in (None, 1, 2, 4, 8, 16):
        kept[window] = {tuple(p) for p in df.select(winnow(body, window=window).alias("w")).first()["w"]}
    assert kept[None] == kept[16] and kept[16] < kept[8] < kept[4] < kept[2] < kept[1]


def test_word_hashes_are_plain_ones(table):
    word = lambda w: xxhash.xxh64_intdigest(w.encode(), seed=42)
    got = table([(1, "Ab, cd!")]).select(grams(F.col("text"), 1).alias("g")).first()["g"]
    chained = [xxhash.xxh64_intdigest(word(w).to_bytes(8, "little"), seed=42) for w in ("ab", "cd")]
    assert [h % (1 << 64) for h in got] == chained


def test_shared_passage_is_found(table, prose):
    passage = " ".join(f"p{i}" for i in range(20))  # gram + window - 1 words
    a, b = (" ".join(prose(1, seed)) for seed in (3, 4))
    df = table([(1, f"{a} {passage} {b}"), (2, f"{b} q {passage} {a}")])
    kept = fingerprints(df).groupBy("hash").agg(F.collect_set("doc_id").alias("ids")).where("size(ids) = 2")
    assert kept.count() >= 1


def likeness(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_edit_and_next(table, rows, prose, oddities):
    texts = prose(60) + oddities
    given = [(3 * i - 20, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in compare_with_next(table(given), range_bytes=2000).collect()}
    prints = {r["doc_id"]: r["fingerprint"] for r in got.values()}
    cut = lambda s: {s[i : i + 16] for i in range(0, len(s), 16)}
    assert len(got) == len(given)
    for (i, t), (j, following) in zip(given, given[1:] + given[:1], strict=True):
        t, following, r = t or "", following or "", got[i]
        m = len(t) // 4
        edited = t[: len(t) - m] + following[:m]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_next"] == likeness(cut(prints[i]), cut(prints[j]))
        assert r["near_edited"] == likeness(cut(r["fingerprint"]), cut(r["edited_fingerprint"]))
    again = compare_with_next(table([(1, e) for e in (t or "" for _, t in given)][:1])).first()
    assert again["near_next"] == 1.0


def test_equal_texts_have_equal_fingerprints_and_odd_ids(clashing, table, rows):
    text = "The same words in the same order, again and again " * 9
    given = [(None, text), (1, text), (1, text), (1, "other"), (2, None)]
    got = compare_with_next(clashing(given))
    assert got.count() == 5
    assert len({r["fingerprint"] for r in got.where("n_chars > 100").collect()}) == 1
    assert rows(got.where("n_chars = 0"), "fingerprint", "edited_fingerprint", "near_edited") == [("", "", 1.0)]
    assert rows(compare_with_next(table([]))) == []


def test_native(table):
    plan = compare_with_next(table([(1, "a"), (2, "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
