import json

import pytest
from pyspark.sql import functions as F

from caseweave.operators import reports
from caseweave.operators.infer import answered
from caseweave.operators.worklist import current_answers, pending_prompts
from caseweave.plans.job import Job, Models, Settings
from caseweave.sinks import staging, tables


def names(spark, rows):
    return spark.createDataFrame(rows, "summary_text string, service_request_id string, extra int")


def test_state_table_lifecycle(spark, rows):
    tables.reset(spark, ["t_state", "t_copy"])
    assert tables.ensure_table(spark, "t_state", tables.PHOTO_SUMMARIES).count() == 0
    # columns in another order, one of them unknown to the table
    tables.append(names(spark, [("words", "1", 5)]), "t_state")
    tables.ensure_table(spark, "t_state", tables.PHOTO_SUMMARIES)
    tables.append(names(spark, [("more", "2", 5)]), "t_state")
    assert rows(spark.table("t_state")) == [("1", "words"), ("2", "more")]
    with pytest.raises(Exception, match="summary_text"):
        tables.append(spark.createDataFrame([("3",)], "service_request_id string"), "t_state")
    assert rows(tables.copy_table(spark, "t_state", "t_copy")) == rows(spark.table("t_state"))
    tables.replace_view(spark.table("t_copy").filter("service_request_id = '1'"), "t_view")
    assert spark.table("t_view").count() == 1
    tables.reset(spark, ["t_state", "t_copy", "t_view", "t_never"])
    assert not any(spark.catalog.tableExists(n) for n in ("t_state", "t_copy", "t_view"))


def test_bucketed_snapshots_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("t_left", "t_right"):
            df = spark.range(100).select(F.col("id").cast("string").alias("service_request_id"))
            tables.replace_table(df, name, bucket_by=(4, "service_request_id"))
        joined = spark.table("t_left").join(spark.table("t_right"), "service_request_id")
        assert joined.count() == 100
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.reset(spark, ["t_left", "t_right"])


def test_staging_uses_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(5).toDF("x"), "numbers")
    assert all(folder in f for f in staged.inputFiles()) and staged.count() == 5
    assert "Range" not in staged._jdf.queryExecution().executedPlan().toString()


RAW = (
    "unique_key long, created_date timestamp, complaint_type string, category string, "
    "descriptor string, status_notes string, agency_name string, media_url string"
)


def photo(prompts):
    return [(f"Photo of illegal dumping at {p.split()[-1]}", "") for p in prompts]


def triage(prompts):
    out = []
    for p in (prompt.split(" | ")[0] for prompt in prompts):
        theme = "Illegal Dumping" if "dumping" in p.lower() else "Noise Complaint"
        if "garbled" in p.lower():
            out.append(('{"theme":"', "truncated"))
        else:
            out.append((json.dumps(
                {"theme": theme, "severity": "HIGH", "suggested_action": "Send someone."}), ""))
    return out


def rewrite(prompts):
    return [
        ("Stop the illegal act." if "Illegal" in p.split("\n")[0] else "Go there.", "")
        for p in prompts
    ]


@pytest.fixture
def job(spark):
    raw = [
        (1, None, "noise", None, "Noise limits at night, residential interior nighttime noise", None, "a", None),
        (2, None, "dump", None, "illegal dumping in the public right of way", None, "a", None),
        (3, None, "dump", None, "open", None, "a", "http://x/3.jpg"),
        (4, None, "dump", None, "n/a", None, "a", "http://x/4.PNG?y"),
        (5, None, "dump", None, "n/a", None, "a", "http://x/5.txt"),
        (6, None, None, None, None, None, "a", "http://x/6.jpg"),
        (7, None, "x", None, "garbled words all over this text", None, "a", None),
    ]
    built = Job(
        spark, spark.createDataFrame(raw, RAW), Models(photo, triage, rewrite),
        database="default", settings=Settings(per_stratum=10, max_distance=0.9),
    )
    built.reset_state()
    yield built
    built.reset_state()


def test_job_end_to_end_and_rerun(job, spark, rows):
    job.run()
    summaries = rows(spark.table("batch_case_summaries"), "service_request_id", "summary_source")
    # 6 has no text at all: it is in the cohort but lost at the join; 5 has no image
    assert summaries == [("1", "text"), ("2", "text"), ("3", "image"), ("4", "image"), ("7", "text")]
    assert job.table("batch_ids").count() == 6
    refined = rows(
        job.table("batch_triage_policy_refined"),
        "service_request_id", "theme", "severity", "policy_title", "alignment",
    )
    by_id = {r[0]: r[1:] for r in refined}
    assert by_id["2"] == ("Illegal Dumping", "high", "Illegal Dumping", "aligned")
    assert by_id["1"] == ("Noise Complaint", "high", "Noise Limits (Police Code Art. 29)", "review")
    assert by_id["7"][:2] == (None, None)
    assert len(refined) == 5
    assert rows(spark.table("v_validate_json")) == [(0, 1, 5)]
    shares = {r.alignment: r.ct for r in spark.table("v_alignment_share").collect()}
    assert sum(shares.values()) == 5
    rates = {r.cohort: (r.total, r.matched) for r in spark.table("v_match_rates").collect()}
    assert rates["With AI (Text+Image)"][0] == 5 and rates["No-AI (Text-only)"][0] == 3

    before = {t: rows(job.table(t)) for t in Job.STATE}
    job.run()
    assert {t: rows(job.table(t)) for t in Job.STATE} == before


def test_job_with_stored_objects(job, spark, rows):
    job.objects = spark.createDataFrame([("o/3.jpg",), ("o/9.jpg",)], "uri string")
    job.reset_summaries()
    job.run()
    sources = dict(rows(spark.table("batch_case_summaries"), "service_request_id", "summary_source"))
    assert sources == {"1": "text", "2": "text", "3": "image", "4": "none", "7": "text"}


def test_null_text_photo_cases_can_be_kept(job, spark, rows):
    job.settings = Settings(per_stratum=10, max_distance=0.9, keep_null_text=True)
    job.run()
    sources = dict(rows(spark.table("batch_case_summaries"), "service_request_id", "summary_source"))
    assert sources["6"] == "image"


def test_refinement_can_be_drained_in_batches(job, rows):
    job.settings = Settings(per_stratum=10, max_distance=0.9, refine_batch=2)
    job.run()
    sizes = [job.table("batch_triage_policy_refined").count()]
    for _ in range(3):
        job.refine()
        sizes.append(job.table("batch_triage_policy_refined").count())
    assert sizes == [2, 4, 5, 5]


def test_a_failed_write_leaves_the_old_snapshot(spark, rows):
    tables.replace_table(spark.range(3).toDF("x"), "t_snap")
    broken = spark.range(8).select(F.when(F.col("id") > 5, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_table(broken, "t_snap")
    assert rows(spark.table("t_snap")) == [(0,), (1,), (2,)]
    # A snapshot may be made from itself, and one that began to read the old version goes on.
    old = spark.table("t_snap")
    tables.replace_table(spark.table("t_snap").filter("x > 0"), "t_snap")
    assert rows(spark.table("t_snap")) == [(1,), (2,)] and rows(old) == [(0,), (1,), (2,)]
    for i in range(4):
        tables.replace_table(spark.range(i).toDF("y"), "t_snap")
    assert spark.table("t_snap").columns == ["y"] and len(tables._versions(spark, "t_snap")) == tables.KEPT_VERSIONS
    tables.reset(spark, ["t_snap"])
    assert not spark.catalog.tableExists("t_snap") and not tables._versions(spark, "t_snap")


def test_a_plain_table_becomes_a_snapshot(spark, rows):
    spark.range(2).toDF("x").write.saveAsTable("t_plain")
    tables.replace_table(spark.range(1).toDF("x"), "t_plain")
    assert rows(spark.table("t_plain")) == [(0,)]
    tables.reset(spark, ["t_plain"])


@pytest.mark.parametrize("partly", [False, True])
def test_what_was_written_before_a_crash_is_appended_once(spark, rows, monkeypatch, partly):
    tables.reset(spark, ["t_once"])
    tables.ensure_table(spark, "t_once", tables.PHOTO_SUMMARIES)
    tables.append(names(spark, [("first", "1", 0)]), "t_once")
    new = names(spark, [("second", "2", 0), ("third", "3", 0), (None, "4", 0)])

    def die(spark, name, path, rows):
        if partly:  # some rows got there, the mark did not
            rows.filter("service_request_id = '3'").write.insertInto(name)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tables, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            tables.append(new, "t_once")
    assert tables.recover(spark, "t_once") == 1
    want = [("1", "first"), ("2", "second"), ("3", "third"), ("4", None)]
    assert rows(spark.table("t_once")) == want
    assert tables.recover(spark, "t_once") == 0 and rows(spark.table("t_once")) == want
    tables.reset(spark, ["t_once"])


def test_a_write_that_did_not_end_is_no_answer(spark, monkeypatch):
    tables.reset(spark, ["t_half"])
    tables.ensure_table(spark, "t_half", tables.PHOTO_SUMMARIES)
    broken = names(spark, [("a", "1", 0)]).withColumn("summary_text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.append(broken, "t_half")
    assert tables.recover(spark, "t_half") == 0 and spark.table("t_half").count() == 0
    tables.reset(spark, ["t_half"])


def test_snapshots_know_their_rows(spark):
    df = spark.range(7).toDF("x")
    tables.replace_table(df, "t_counted", odd=F.count_if(F.col("x") % 2 == 1))
    tables.replace_table(spark.table("t_counted").where("x > 1"), "t_fewer", bucket_by=(3, "x"))
    tables.replace_table(df.limit(0), "t_none")
    assert tables.written_rows(spark, "t_counted") == 7 and tables.written_rows(spark, "t_counted", "odd") == 3
    assert tables.written_rows(spark, "t_fewer") == spark.table("t_fewer").count() == 5
    assert tables.written_rows(spark, "t_none") == 0
    tables.reset(spark, ["t_counted", "t_fewer", "t_none"])
    staged, counted = staging.stage_counted(df, "counted", top=F.max("x"))
    assert counted == {"rows": 7, "top": 6} and staged.count() == 7


def test_job_tables_meet_by_case_without_a_shuffle(job, spark, rows):
    job.run()
    plain = {t: rows(job.table(t)) for t in Job.STATE}
    audit = rows(spark.table("v_validate_counts"))
    job.reset_state()
    job.settings = Settings(per_stratum=10, max_distance=0.9, buckets=3)
    job.run()
    job.run()  # the second run appends nothing
    assert {t: rows(job.table(t)) for t in Job.STATE} == plain
    assert rows(spark.table("v_validate_counts")) == audit
    assert dict(audit)["05_batch_case_summaries"] == spark.table("batch_case_summaries").count()
    assert dict(audit)["10_batch_policy_matches"] == spark.table("batch_policy_matches").count()
    # Appended in pieces, a state table still is in its buckets.
    answers = job.table("batch_triage_raw")
    tables.append(answers.withColumn("prompt_hash", F.lit("old")), job.name("batch_triage_raw"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed, state = job.table("triage_wanted"), answered(job.table("batch_triage_raw"))
        for joined, many in (
            (reports.pool_of_matched(spark.table("batch_case_summaries"), job.table("triage_matched")), 5),
            (pending_prompts(keyed, state), 0),
            (current_answers(state, keyed), 5),
        ):
            assert joined.count() == many
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
