import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.llm import language
from caseweave.llm.language import SEGMENT, Profile, build, count_phrases, fit, held_out, identify, predict_languages

ENGLISH = "the quick brown fox jumps over the lazy dog and then it goes on with what it was doing before that "
GERMAN = "der schnelle braune fuchs springt über den faulen hund und dann macht er weiter mit dem was er vorher tat "
SAMPLES = Profile((("de", GERMAN * 5), ("en", ENGLISH * 5)))


def normal(text):
    out = []
    for c in text.lower():
        if c.isalpha() or not out or out[-1] != " ":
            out.append(c if c.isalpha() else " ")
    return "".join(out)


def phrases(text, sample):
    """Greedy longest matches, by searching the sample."""
    text, sample, count = normal(text), normal(sample), 0
    for start in range(0, max(len(text), 1), SEGMENT):
        part = text[start : start + SEGMENT]
        if not part:
            return 0
        count, begin = count + 1, 0
        for i in range(len(part)):
            if part[begin : i + 1] not in sample:
                count, begin = count + 1, i
                if part[i] not in sample:
                    begin = i + 1
    return count


def test_parse_against_search():
    automata = build(SAMPLES)
    texts = [ENGLISH[3:50], GERMAN[9:80], "quick fuchs 123 xyz", "", "...", "ÜBER den HUND", "zzz the", (ENGLISH + GERMAN) * 12]
    got, sizes, letters = count_phrases(automata, texts)
    for text, row, size in zip(texts, got, sizes, strict=True):
        assert size == len(normal(text))
        assert row.tolist() == [phrases(text, s) for _, s in SAMPLES.samples], text
    assert letters[3] == 0 and letters[4] == 0


def test_predictions_and_batches():
    automata = build(SAMPLES)
    texts = [None, "", "123 !?", ENGLISH, GERMAN, "Hund und Fuchs", "what the dog was doing"]
    found = identify(automata, texts)
    assert found["lang"].tolist() == ["und", "und", "und", "en", "de", "de", "en"]
    assert found["score"].between(0, 1).all() and (found["score"][:3] == 0).all()
    whole = identify(automata, texts * 3)
    old, language.BATCH_CHARS = language.BATCH_CHARS, 50
    try:
        assert identify(automata, texts * 3).equals(whole)
    finally:
        language.BATCH_CHARS = old


def test_held_out_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profile = fit(docs.where(~held_out(F.col("doc_id"))))
    assert all(len(text) <= language.CHARS_PER_LANGUAGE for _, text in profile.samples)
    got = predict_languages(docs, profile).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200
    assert np.mean(got["lang_pred"] == got["lang"]) > 0.98


def test_odd_rows(table, clashing, rows, oddities):
    nothing = fit(table([(1, "abc", None), (2, None, "en")]))
    assert nothing.samples == ()
    assert rows(predict_languages(table([(1, "abc")]), nothing), "lang_pred", "score") == [("und", 0.0)]
    one = fit(table([(1, "some words here", "en")]))
    given = list(enumerate(oddities)) + [(None, "some words"), (1, ""), (1, "")]
    got = rows(predict_languages(clashing(given), one), "doc_id", "lang_pred")
    assert len(got) == len(given) and (None, "en") in got
    assert rows(predict_languages(table([]), one)) == []


def test_many_labels_share_the_sample(table):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = np.random.default_rng(7)
    # A language has words of its own.
    lexicons = [["".join(rng.choice(list(letters), 5)) for _ in range(200)] for _ in range(40)]
    text = lambda k, n: " ".join(rng.choice(lexicons[k], n))
    docs = [(i, text(i % 40, 300), f"l{i % 40:02}") for i in range(800)]
    profile = fit(table(docs))
    assert len(profile.samples) == 40 and sum(len(t) for _, t in profile.samples) <= language.CHARS_IN_ALL
    automata = build(profile)
    assert automata.table.nbytes < 200 << 20
    found = identify(automata, [text(k, 40) for k in range(40)])
    assert found["lang"].tolist() == [f"l{k:02}" for k in range(40)]


def test_too_many_labels_are_an_error(table, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        fit(table([(i, "text", f"l{i}") for i in range(4)]))


def test_many_texts_take_bounded_memory():
    automata = build(SAMPLES)
    texts = [ENGLISH * 20] * 2000  # as many as a batch has; 4 million characters
    tracemalloc.start()
    found = identify(automata, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(found["lang"]) == {"en"} and peak < 32 << 20
