import re
from collections import Counter, defaultdict

import pytest

from caseweave.llm import phrases
from caseweave.llm.phrases import filter_of, frequent_phrases, mine_phrases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, max_words, best, absorbed=50):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                counts[lang].update(words[i : i + size] for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        around = Counter()
        for p, a in f.items():
            if a >= min_count:
                for size in range(2, len(p)):
                    for i in range(len(p) - size + 1):
                        around[p[i : i + size]] = max(around[p[i : i + size]], a)
        found = []
        for p, a in f.items():
            if len(p) > 1 and a >= min_count and 100 * around[p] < absorbed * a or len(p) > 1 and a >= min_count and not around[p]:
                score, _, left, right = min(
                    (1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
                )
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_against_brute_force(table, prose, rows, max_words):
    texts = [(i, t.replace("a ", "A, ", i % 3).replace("e ", "e\t ", i % 2), [None, "de", "en"][i % 3]) for i, t in enumerate(prose(150, 5))]
    found = mine_phrases(table(texts), min_count=3, max_words=max_words, best=300)
    expected = brute([(t, lang) for _, t, lang in texts], 3, max_words, 300)
    assert rows(found) == expected and len(expected) > 100


def test_a_full_filter_changes_nothing(spark, table, prose, rows):
    texts = [(i, t + "\n") for i, t in enumerate(prose(60, 6))]
    base = table(texts).selectExpr("'x' AS lang", "cast(text AS binary) AS body")
    assert rows(frequent_phrases(base, 3, 3, filter_bits=64)[0]) == rows(frequent_phrases(base, 3, 3)[0])


def test_filter_holds_all_and_little_else(spark, prose):
    words = sorted({w for t in prose(80, 7) for w in t.split()})
    kept = filter_of(spark.createDataFrame([("x", w) for w in words[::2]], "lang string, phrase string"))
    numbers = phrases._language_numbers(phrases.pa.array(["x"]))

    def hits(some):
        data, bounds = phrases.buffers(phrases.pa.array([w.encode() for w in some]))
        own = phrases.span_numbers(data, bounds[:-1], bounds[1:])
        return kept.may_hold(phrases._chain(own, phrases.np.arange(len(own)), 1, numbers.repeat(len(own))))

    assert hits(words[::2]).all() and hits(words[1::2]).mean() < 0.05


def test_odd_rows(table, oddities, rows):
    texts = [(None, t) for t in oddities] * 2 + [(1, "\x00 . \x00 \x00 b"), (2, "x. y" * 6), (3, "Ä ä Ä " * 4)]
    expected = brute([(t, None) for _, t in texts], 2, 3, 50)
    assert rows(mine_phrases(table(texts), min_count=2, best=50)) == expected


def test_exact_products_beyond_64_bits(spark, rows):
    many = 3 * 10**9
    counted = spark.createDataFrame(
        [("x", "a b", 2, many), ("x", "a", 1, many + 1), ("x", "b", 1, many + 2)], "lang string, phrase string, words int, f long"
    )
    assert rows(phrases.score_phrases(counted), "score") == [(1000000 * many**2 // ((many + 1) * (many + 2)),)]


def test_clashing_columns_and_empty_table(clashing, table, rows):
    texts = [(i, "one two three. one two") for i in range(4)]
    wide = clashing(texts).selectExpr("*", "1 AS phrase", "2 AS f", "3 AS words", "4 AS _rank", "5 AS n", "6 AS score")
    assert rows(mine_phrases(wide, min_count=2)) == brute([(t, None) for _, t in texts], 2, 3, 2000)
    assert mine_phrases(table(texts).limit(0)).count() == 0


def test_one_very_long_text(table, rows):
    text = "ab cd " * 500_000 + "x" * 3_000_000
    assert rows(mine_phrases(table([(1, text)], 1)), "phrase", "a") == brute_long()


def brute_long():
    # "ab cd ab" and "cd ab cd" hold nearly all occurrences of both pairs, which go.
    return [("ab cd ab", 499_999), ("cd ab cd", 499_999)]
