import hashlib

import pytest
from pyspark.sql import functions as F

from caseweave.operators import cohort, media, summaries, worklist
from caseweave.operators.topn import top_n
from caseweave.sources.requests import list_objects, normalise_requests, with_object_id

QUALITY = "service_request_id string, media_url string, has_media boolean, is_bad_text boolean"


@pytest.fixture
def quality(spark):
    rows = [(str(i), None, False, False) for i in range(50)]
    rows += [(str(100 + i), "u.jpg", True, True) for i in range(3)]
    rows += [("200", "u.txt", True, True), ("201", None, False, True)]
    return spark.createDataFrame(rows, QUALITY).repartition(5)


def test_stratified_cohort_is_the_seeded_order(quality, rows):
    drawn = rows(cohort.stratified_cohort(quality, 10, seed=7))
    order = sorted(range(50), key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), str(i)))
    want = [(str(i), "text") for i in order[:10]] + [(str(100 + i), "image") for i in range(3)]
    assert drawn == sorted(want, key=str)
    assert rows(cohort.stratified_cohort(quality, 10, seed=7)) == drawn
    assert rows(cohort.stratified_cohort(quality, 10, seed=8)) != drawn


def test_fallback_ids_need_cohort_weak_text_and_media(spark, quality, rows):
    ids = spark.createDataFrame([("1",), ("100",), ("200",), ("201",)], "service_request_id string")
    assert rows(cohort.fallback_ids(quality, ids)) == [("100",), ("200",)]


@pytest.mark.parametrize("within", [(), ("g",)])
def test_top_n_with_one_hot_group(spark, rows, within):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("g"),
        F.pmod(F.col("id") * 7919, F.lit(5003)).alias("v"),
        "id",
    ).repartition(9)
    got = rows(top_n(df, 20, [F.asc("v"), F.asc("id")], within, lanes=4))
    everything = df.collect()
    want = []
    for group in {r.g for r in everything} if within else {None}:
        members = [r for r in everything if group is None or r.g == group]
        want += sorted(members, key=lambda r: (r.v, r.id))[:20]
    assert got == sorted((tuple(r) for r in want), key=str)


def test_normalise_requests(spark, rows):
    raw = spark.createDataFrame(
        [(1, None, None, "cat", None, "notes", "a", None), (2, None, "type", "cat", None, None, "a", "u")],
        "unique_key long, created_date timestamp, complaint_type string, category string, "
        "descriptor string, status_notes string, agency_name string, media_url string",
    )
    assert rows(normalise_requests(raw)) == [
        ("1", None, "cat", "notes", "a", None), ("2", None, "type", "type", "a", "u")
    ]


def test_list_objects_reads_names_only(spark, tmp_path, rows):
    for name in ("7.jpg", "x8.jpg", "note.txt", "sub/9.jpg", "nodigits.jpg"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    objects = list_objects(spark, str(tmp_path))
    ids = {r.service_request_id for r in with_object_id(objects).collect()}
    assert objects.count() == 4 and ids == {"7", "8", "9", None}


def frame(spark, ids, column="service_request_id"):
    return spark.createDataFrame([(i,) for i in ids], f"{column} string")


def test_photo_todo_from_objects_dedupes_and_skips_done(spark, rows):
    objects = frame(spark, ["a/1.jpg", "b/1.jpg", "2.jpg", "3.jpg", "4.png"], "uri")
    todo = media.todo_from_objects(objects, frame(spark, ["1", "2", "4"]), frame(spark, ["2"]))
    assert rows(todo) == [("1", "a/1.jpg")]


def test_photo_todo_from_urls(spark, rows):
    cases = spark.createDataFrame(
        [("1", "a.jpg"), ("2", "b.png?x"), ("3", "c.txt"), ("4", "d.jpg"), ("5", " ")],
        "service_request_id string, media_url string",
    )
    fallback = frame(spark, ["1", "2", "3", "5"])
    assert rows(media.todo_from_urls(cases, fallback, frame(spark, ["2"]))) == [("1", "a.jpg")]
    assert rows(media.download_manifest(cases, fallback, "p/")) == [
        ("1", "a.jpg", "p/1.jpg"), ("2", "b.png?x", "p/2.jpg")
    ]


def test_case_summaries_branches(spark, rows):
    from caseweave.operators import clean

    good, weak = "some good text", "open"
    cases = spark.createDataFrame(
        [("1", "t", good, None), ("2", "x", weak, "u"), ("3", "x", weak, "u"),
         ("4", None, None, "u"), ("5", "t", good, None), ("9", "t", good, None)],
        "service_request_id string, request_type string, request_details string, "
        "media_url string",
    )
    photos = spark.createDataFrame(
        [("2", "photo"), ("4", "photo"), ("5", "photo"), ("3", None)],
        "service_request_id string, summary_text string",
    )
    ids = frame(spark, ["1", "2", "3", "4", "5"])
    expected = [
        ("1", "Some Good Text.", "text"), ("2", "photo", "image"), ("3", None, "none"),
        ("5", "Some Good Text.", "text"),
    ]
    texts = summaries.text_source_of_cases(cases, ids)
    assert rows(summaries.case_summaries(texts, photos)) == expected
    joined = summaries.text_source(ids, clean.clean_text(cases), clean.text_quality(cases))
    assert rows(summaries.case_summaries(joined, photos)) == expected
    kept = summaries.text_source_of_cases(cases, ids, keep_null_text=True)
    assert ("4", "photo", "image") in rows(summaries.case_summaries(kept, photos))


def test_pending_states(spark, rows):
    todo = frame(spark, ["1", "2", "3"])
    assert len(rows(worklist.pending(todo, frame(spark, [])))) == 3
    assert rows(worklist.pending(todo, frame(spark, ["2"]))) == [("1",), ("3",)]
    assert rows(worklist.pending(todo, todo)) == []


def test_absent_refuses_null_keys(spark, rows):
    todo = frame(spark, ["1", "2"])
    assert rows(worklist.absent(todo, frame(spark, ["2"]))) == [("1",)]
    with pytest.raises(Exception, match="null service_request_id"):
        worklist.absent(todo, frame(spark, ["2", None])).collect()


def test_work_batch_is_repeatable(spark, rows):
    assert rows(worklist.work_batch(frame(spark, ["3", "10", "2"]), 2)) == [("10",), ("2",)]


def test_text_is_only_cleaned_for_the_cohort(spark, tmp_path):
    cases = spark.createDataFrame(
        [("1", "t", "some text", None)],
        "service_request_id string, request_type string, request_details string, "
        "media_url string",
    )
    cases.write.parquet(str(tmp_path / "cases"))
    texts = summaries.text_source_of_cases(
        spark.read.parquet(str(tmp_path / "cases")), frame(spark, ["1"])
    )
    lines = texts._jdf.queryExecution().executedPlan().toString().split("\n")
    cleaning = max(i for i, line in enumerate(lines) if "initcap" in line)
    picking = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    assert len(picking) == 1 and picking[0] > cleaning
