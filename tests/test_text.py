import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions import text as tx
from caseweave.operators import clean, media

CASES = "service_request_id string, request_type string, request_details string, media_url string"


def cleaned(spark, *pairs):
    df = spark.createDataFrame([(str(i), t, d, None) for i, (t, d) in enumerate(pairs)], CASES)
    found = {r[0]: r[1] for r in clean.clean_text(df).collect()}
    return [found.get(str(i)) for i in range(len(pairs))]


def test_clean_text_branches(spark):
    assert cleaned(
        spark,
        ("noise", "dog barks Case   Transferred to x"),
        ("noise", "dog barks CASE IS A\tDUPLICATE of 9"),
        ("noise", "dog barks. customer may follow up later"),
        ("noise", "dog case transferred to x\nstill barking"),
        ("noise", "showcase transferred"),
        ("noise", "a_b-c"),
        ("noise", "abcd"),
        ("noise", "abcde"),
        ("loud noise", "n/a"),
        ("noise", "case transferred to x"),
        (None, None),
        ("noise", None),
        ("noise", "what now? "),
        ("noise", "stop!"),
        (None, "none"),
        ("noise/party-late", "OPEN"),
    ) == [
        "Dog Barks.",
        "Dog Barks.",
        "Dog Barks.",
        "Dog Case Transferred To X Still Barking.",
        "Showcase Transferred.",
        "A B C.",
        "(Noise) No detailed text provided.",
        "Abcde.",
        "(Loud Noise) No detailed text provided.",
        "(Noise) No detailed text provided.",
        None,
        "Noise.",
        "What Now?",
        "Stop!",
        "(Issue) No detailed text provided.",
        "(Noise/Party-Late) No detailed text provided.",
    ]


def test_boilerplate_only_text_is_good_but_gets_the_placeholder(spark):
    df = spark.createDataFrame([("1", "noise", "Case transferred to x", None)], CASES)
    row = clean.prepare(df).first()
    assert not row.is_bad_text
    assert row.complaint_text == "(Noise) No detailed text provided."


def test_boilerplate_folds_like_the_plain_letters(spark):
    assert cleaned(spark, ("x", "abcdef caſe tranſferred to z"))[0] == "Abcdef."


def test_text_quality_branches(spark):
    texts = [None, "", "abcd", "abcde", "OPEN", "_-_", "  open 　", "unKnown"]
    media_urls = [None, "", "  ", "u", " ", "u", "u", "u"]
    df = spark.createDataFrame(
        [(str(i), None, t, m) for i, (t, m) in enumerate(zip(texts, media_urls))], CASES
    )
    got = sorted(clean.text_quality(df).collect(), key=lambda r: int(r[0]))
    assert [r.is_bad_text for r in got] == [True, True, True, False, True, True, True, True]
    assert [r.has_media for r in got] == [False, False, False, True, False, True, True, True]
    assert [r.text_norm for r in got][3:6] == ["abcde", "OPEN", ""]


def flattened(text):
    text = re.sub("[\t\n\f\r ]+", " ", text.replace("_", " ").replace("-", " "))
    return text.strip(fv.UNICODE_SPACES)


def test_weak_pattern_equals_flatten_then_compare(spark):
    pieces = st.sampled_from(
        ["a", "é", "open", "N/A", "na", "none", "other", " ", "_", "-", "\n", " ", "\x0b", "\U0001f600"]
    )
    texts = []

    @settings(max_examples=400, database=None)
    @given(st.lists(pieces, max_size=9).map("".join))
    def gather(text):
        texts.append(text)

    gather()
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", tx.is_weak(F.col("t")), tx.flatten_spaces(F.col("t"))).collect()
    for text, weak, flat in got:
        want = flattened(text)
        assert flat == want
        assert weak == (len(want) < 5 or want.lower() in fv.STOP_TEXTS), repr(text)


def test_title_case_after_every_delimiter(spark):
    df = spark.createDataFrame([("it's (FIRE) a/b-c.d é,école 1st [x]^y\\z",)], "t string")
    assert df.select(tx.title_case(F.col("t"))).first()[0] == (
        "It's (Fire) A/B-C.D É,École 1st [X]^Y\\Z"
    )


def test_image_candidates(spark):
    urls = ["x.JPG", "x.png?x=1", "x.gif#a", "x.jpgx", "x.jpg/", " ", None, "x.jpeg\n"]
    df = spark.createDataFrame([(str(i), u) for i, u in enumerate(urls)],
                               "service_request_id string, media_url string")
    got = {r[0] for r in media.image_candidates(df).collect()}
    assert got == {"0", "1", "2"}


def test_fill_keeps_braces_and_passes_null_on(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    row = df.select(
        tx.fill("{{k}} {x}.", x=F.col("x")), tx.fill("{x}{y}", x=F.col("x"), y=F.col("y"))
    ).first()
    assert tuple(row) == ("{k} a.", None)
