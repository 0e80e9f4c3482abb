import pytest
from pyspark.sql import functions as F

from caseweave.operators import reports
from caseweave.operators.infer import triage_prompt
from caseweave.sinks import tables
from caseweave.streaming.arrivals import answer_arrivals, answer_batch

CASES = "service_request_id string, summary string, summary_source string"


def model(prompts):
    return [(None, "error: busy") if "busy" in p else (f"seen {len(p)}", "") for p in prompts]


@pytest.fixture
def state(spark):
    tables.reset(spark, ["t_arrived", "t_batch"])
    yield "t_arrived"
    tables.reset(spark, ["t_arrived", "t_batch"])


def batch_of(spark, ids, text="words"):
    return spark.createDataFrame([(str(i), f"{text} {i}", "text") for i in ids], CASES)


def test_increments_equal_one_batch_and_replays_add_nothing(spark, rows, state, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "at")

    def drain():
        stream = spark.readStream.schema(CASES).parquet(folder)
        answer_arrivals(stream, triage_prompt(), model, state, checkpoint).awaitTermination()
        return rows(spark.table(state))

    batch_of(spark, range(6)).coalesce(1).write.parquet(folder)
    assert len(drain()) == 6
    # Two cases of the next file have been there, one comes twice, one has a new text.
    more = batch_of(spark, [4, 5, 6, 7, 7, 8]).union(batch_of(spark, [0], "other"))
    more.coalesce(1).write.mode("append").parquet(folder)
    both = drain()
    assert len(both) == 10 and drain() == both
    tables.ensure_table(spark, "t_batch", tables.with_outcome(tables.TRIAGE_RESULTS))
    answer_batch(spark.read.schema(CASES).parquet(folder), triage_prompt(), model, "t_batch", "triage_result")
    assert rows(spark.table("t_batch")) == both
    answer_batch(more, triage_prompt(), model, state, "triage_result")  # a replay
    assert rows(spark.table(state)) == both


def test_odd_arrivals(spark, rows, state):
    tables.ensure_table(spark, state, tables.with_outcome(tables.TRIAGE_RESULTS))
    odd = spark.createDataFrame([(None, "a", "text"), ("1", None, "none"), ("1", None, "none"), ("2", "", "text")], CASES)
    for _ in range(2):
        answer_batch(odd, F.col("summary"), model, state, "triage_result")
        answer_batch(odd.limit(0), F.col("summary"), model, state, "triage_result")
    assert rows(spark.table(state), "service_request_id", "triage_result") == [("1", None), ("2", "seen 0")]


def test_reports_of_increments_equal_the_whole(spark, rows):
    tables.reset(spark, ["t_shares", "t_rates"])
    labels = [None, "aligned", "review", "other"]
    df = spark.createDataFrame(
        [(labels[i * i % 4 if i < 80 else 3], "text" if i % 3 else "image", i % 5 == 0, i % 3) for i in range(100)],
        "alignment string, summary_source string, policy_matched boolean, part int",
    )
    for part in (0, 1, 1, 2, 0):  # two runs are repeated
        new = df.where(F.col("part") == part)
        first = tables.append_run(reports.label_counts(new), "t_shares", f"r{part}")
        assert tables.append_run(reports.match_counts(new), "t_rates", f"r{part}") == first
    shares, rates = spark.table("t_shares"), spark.table("t_rates")
    assert reports.merged_share(shares).collect() == reports.share_of_total(df).collect()
    assert rows(reports.merged_match_rate(rates)) == rows(reports.cohort_match_rate(df))
    assert rates.count() == 3
    nothing = reports.merged_match_rate(rates.limit(0))
    assert rows(nothing) == rows(reports.cohort_match_rate(df.limit(0)))
    tables.reset(spark, ["t_shares", "t_rates"])
