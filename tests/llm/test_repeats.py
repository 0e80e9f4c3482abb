"""Byte and word repeats against brute force."""

import hashlib

import numpy as np
import pytest

from caseweave.llm import anchors, fm_index, prefix_free
from caseweave.llm.prefix_free import prefix_ranks


def bytes_removed(given, length):
    seen, out = set(), {}
    for i, t in sorted(given, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                gone[s : s + length] = True
            seen.add(data[s : s + length])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted((i, *v) for i, v in out.items())


def words_removed(given, window):
    seen, out = set(), {}
    for i, t in sorted(given, key=lambda r: r[0]):
        words = (t or "").encode().split()
        gone, new = [False] * len(words), set()
        for s in range(len(words) - window + 1):
            run = tuple(words[s : s + window])
            new.add(run)
            if run in seen:
                gone[s : s + window] = [True] * window
        seen |= new
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return sorted((i, *v) for i, v in out.items())


@pytest.fixture
def corpus(prose, oddities):
    texts = prose(120, seed=5) + oddities + oddities[:9] + ["ab" * 300, "xab" * 200]
    return [(7 * i - 100, t) for i, t in enumerate(texts)]


@pytest.fixture(params=["plain", "hot"])
def heat(request, monkeypatch):
    """Once with every trigger of a sample of all documents taken for hot."""
    if request.param == "hot":
        monkeypatch.setattr(anchors, "SAMPLE", 1)
        monkeypatch.setattr(anchors, "HOT_COUNT", 0)


@pytest.mark.parametrize(("length", "gram"), [(100, 24), (20, 5)])
def test_bytes_against_brute_force(table, rows, corpus, heat, length, gram):
    got = prefix_free.remove_repeats(table(corpus), length=length, gram=gram).drop("spans")
    assert rows(got) == sorted(bytes_removed(corpus, length), key=str)


@pytest.mark.parametrize(("window", "gram"), [(13, 5), (4, 2)])
def test_words_against_brute_force(table, rows, corpus, heat, window, gram):
    got = fm_index.remove_repeats(table(corpus), window=window, gram=gram).drop("spans")
    assert rows(got) == sorted(words_removed(corpus, window), key=str)


def test_spans_and_kept(table):
    passage = " ".join(f"word{i}" for i in range(30))
    df = table([(1, "a " + passage + " b"), (2, "c d " + passage + " e f")])
    row = fm_index.remove_repeats(df, with_kept=True).where("doc_id = 2").first()
    assert [tuple(s) for s in row["spans"]] == [(2, 32)] and row["kept"] == "c d e f"
    row = prefix_free.remove_repeats(df, with_kept=True).where("doc_id = 2").first()
    assert [tuple(s) for s in row["spans"]] == [(3, 3 + len(passage) + 2)]  # the blanks repeat as well
    assert bytes(row["kept"]) == b"c de f"


@pytest.mark.parametrize("module", [prefix_free, fm_index])
def test_odd_rows(table, clashing, rows, module):
    assert rows(module.remove_repeats(table([])), "doc_id") == []
    text = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"else{i}" for i in range(40))
    given = [(None, text), (3, text), (3, text), (4, other), (4, text), (9, None)]
    got = rows(module.remove_repeats(clashing(given)), "doc_id", "n_removed")
    assert len(got) == len(given)
    assert (None, 0) in got and (9, 0) in got
    assert len({r for r in got if r[0] == 3}) == 1 and min(r[1] for r in got if r[0] == 3) > 0


@pytest.mark.parametrize("module", [prefix_free, fm_index])
def test_rows_without_an_id_of_their_own_are_documents(table, rows, module):
    text = " ".join(f"word{i}" for i in range(40))
    other, third = (" ".join(f"{w}{i}" for i in range(40)) for w in ("else", "more"))
    given = [(None, text), (None, text), (None, third), (4, other), (4, third), (5, other), (5, other), (6, third)]
    got = rows(module.remove_repeats(table(given)), "doc_id", "n_removed")
    whole = {t: len(t) if module is prefix_free else 40 for t in (text, other, third)}
    want = [(None, 0), (None, 0), (None, whole[text]), (4, 0), (4, whole[third])]
    want += [(5, whole[other])] * 2 + [(6, whole[third])]
    assert got == sorted(want, key=str)


def test_ranks_by_prefix():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 300).astype(np.uint8)
    for length in (1, 3, 8, 13, 20):
        rank = prefix_ranks(data, length)
        whole = range(len(data) - length + 1)
        text = [bytes(data[i : i + length]) for i in whole]
        for i in range(0, len(whole), 7):
            same = {j for j in whole if rank[j] == rank[i]}
            assert same == {j for j in whole if text[j] == text[i]}
            assert all((rank[j] < rank[i]) == (text[j] < text[i]) for j in whole if text[j] != text[i])


def test_wavelet_ranks_and_backward_search():
    rng = np.random.default_rng(4)
    numbers = rng.integers(1, 6, 400)
    matrix = fm_index.WaveletMatrix(numbers)
    at, what = rng.integers(0, 401, 200), rng.integers(1, 6, 200)
    want = [int((numbers[:a] == w).sum()) for a, w in zip(at, what, strict=True)]
    assert matrix.ranks(what, at).tolist() == want
    ends = np.array([90, 91, 250, 400])
    index = fm_index.FMIndex(numbers, ends, np.array([5, 2, 9, 4]), 3)
    pieces = np.split(numbers, ends[:-1])
    for pattern in ([1], [2, 3], [1, 4, 2], [5, 5, 1, 2]):
        low, high = np.zeros(1, np.int64), np.full(1, index.size)
        for w in reversed(pattern):
            low, high = index.extend(np.array([w]), low, high)
        count = sum(
            sum(list(p[i : i + len(pattern)]) == pattern for i in range(len(p))) for p in pieces
        )
        assert high[0] - low[0] == count


def contexts_of(table, texts, monkeypatch):
    """Rows and bytes of the contexts that are compared, and of the runs that come out."""
    sizes = {}
    monkeypatch.setattr(anchors, "compare_contexts", lambda c, f, real=anchors.compare_contexts: count(c, f, real))

    def count(contexts, repeated, real):
        contexts = contexts.cache()
        sizes["rows"], sizes["bytes"] = (int(x or 0) for x in contexts.selectExpr("count(*)", "sum(octet_length(symbols))").first())
        runs = real(contexts, repeated).cache()
        sizes["runs"] = runs.count()
        return runs

    prefix_free.remove_repeats(table(list(enumerate(texts)))).count()
    return sizes


def test_contexts_of_a_large_group_of_near_copies_stay_small(table, monkeypatch):
    rng = np.random.default_rng(8)
    words = np.array(["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(500)])
    base = rng.choice(words, 80)
    texts = []
    for _ in range(1600):
        near = base.copy()
        near[rng.integers(0, 80, 2)] = rng.choice(words, 2)
        texts.append(" ".join(near))
    monkeypatch.setattr(anchors, "SAMPLE", 8)
    sizes = contexts_of(table, texts, monkeypatch)
    total = sum(map(len, texts))
    assert sizes["bytes"] < 3 * total and sizes["rows"] < 10 * len(texts) and sizes["runs"] < 10 * len(texts), sizes


def test_long_words_that_differ_are_no_repeat(table, rows):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    given = [(1, " ".join([word] * 13)), (2, " ".join([other] * 13))]
    assert rows(fm_index.remove_repeats(table(given)), "doc_id", "n_removed") == [(1, 0), (2, 0)]
