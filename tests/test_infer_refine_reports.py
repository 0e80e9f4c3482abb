import json
import re

from pyspark.sql import functions as F

from caseweave.functions.jsonfields import normal_severity, with_triage_fields
from caseweave.operators import catalog, infer, refine, reports
from caseweave.operators.lookup import lookup
from caseweave.sources import reference_rows


def test_json_fields(spark):
    answers = [
        '{"theme":" A ","severity":" HIGH ","suggested_action":"go"}',
        '{"severity":"low"}',
        '{"theme":{"a":1},"severity":["low"],"suggested_action":"{x}"}',
        '{"theme":"{\\"a\\":1}"}',
        '{"theme":"A","severity":"low"',
        '```json {"theme":"A"}```',
        None,
        '{"theme":null,"severity":3}',
    ]
    df = spark.createDataFrame(list(enumerate(answers)), "i int, triage_result string")
    got = with_triage_fields(df).orderBy("i").select("theme", "severity", "action").collect()
    assert [tuple(r) for r in got] == [
        ("A", "high", "go"), (None, "low", None), (None, None, "{x}"), ('{"a":1}', None, None),
        (None, None, None), (None, None, None), (None, None, None), (None, "3", None),
    ]
    health = reports.validate_json(df).first()
    assert tuple(health) == (1, 2, 8)


def test_severity_normalise(spark):
    df = spark.createDataFrame([("high",), ("urgent",), (None,), ("low",)], "s string")
    assert [r[0] for r in df.select(normal_severity(F.col("s"))).collect()] == [
        "high", "medium", "medium", "low"
    ]


def echo(prompts):
    return [(p.upper(), "") for p in prompts]


def test_batch_infer_asks_each_prompt_once_and_answers_every_row(spark, tmp_path, rows):
    log = str(tmp_path / "asked")

    def model(prompts):
        with open(log, "a") as out:
            out.writelines(p + "\n" for p in prompts)
        return echo(prompts)

    # one prompt holds two thirds of the rows, some rows have none
    todo = spark.range(3000).select(
        F.col("id").cast("string").alias("service_request_id"),
        F.when(F.col("id") % 100 == 1, F.lit(None))
        .when(F.col("id") % 3 > 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("p"), (F.col("id") % 40).cast("string"))).alias("text"),
    ).repartition(6)
    done = infer.batch_infer(todo, F.col("text"), model)
    got = {r.service_request_id: (r.text, r.result) for r in done.collect()}
    assert len(got) == 3000
    assert all(result == (text.upper() if text else None) for text, result in got.values())
    asked = open(log).read().split()
    assert len(asked) == len(set(asked)) == len({t for t, _ in got.values() if t})


def test_batch_infer_reuses_the_cache(spark, rows):
    todo = spark.createDataFrame([("1", "a"), ("2", "b")], "service_request_id string, text string")
    cache = spark.createDataFrame([("a", "known", "ok")], "p string, result string, status string")
    cache = cache.select(infer.prompt_hash(F.col("p")).alias("prompt_hash"), "result", "status")
    done = infer.batch_infer(todo, F.col("text"), echo, cache=cache)
    assert rows(done, "service_request_id", "result", "status") == [("1", "known", "ok"), ("2", "B", "")]


def test_prompts_that_differ_are_answered_in_place(spark, rows):
    todo = spark.createDataFrame(
        [("1", "a"), ("2", None), ("3", "b")], "service_request_id string, text string"
    )
    done = infer.batch_infer(todo, F.col("text"), echo, shared_prompts=False)
    assert rows(done, "service_request_id", "result") == [("1", "A"), ("2", None), ("3", "B")]
    answered = infer.ask(todo, "text", echo)
    assert "Exchange" not in answered._jdf.queryExecution().executedPlan().toString()


def test_a_failing_model_is_reported_not_hidden(spark, rows):
    def broken(prompts):
        raise TimeoutError("no answer")

    todo = spark.createDataFrame([("1", "a")], "service_request_id string, text string")
    done = infer.batch_infer(todo, F.col("text"), broken)
    assert rows(done, "result", "status") == [(None, "error: TimeoutError")]
    assert rows(infer.outcome_counts(done)) == [("error: TimeoutError", 1)]


def test_lookup_hot_and_cold_keys(spark, rows):
    table = spark.createDataFrame(
        [("h", 100000, "H", 1)] + [(f"c{i}", 1, f"C{i}", None) for i in range(50)],
        "key string, uses long, value string, other int",
    )
    left = spark.createDataFrame(
        [(i, "h" if i % 2 else f"c{i % 60}") for i in range(200)], "id long, key string"
    )
    got = {r.id: r.value for r in lookup(left, table, "key", "uses", "id").collect()}
    want = {i: "H" if i % 2 else f"C{i % 60}" for i in range(200) if i % 2 or i % 60 < 50}
    assert got == want


def test_triage_rules_default_themes(spark):
    df = spark.createDataFrame(
        [("1", "Loud NOISE at night", "text"), ("2", "nothing here", "text"), ("3", None, "none"),
         ("4", "x flooding " * 20, "image")],
        "service_request_id string, summary string, summary_source string",
    )
    got = {r.service_request_id: json.loads(r.triage_result) for r in infer.triage_rules(df).collect()}
    assert got["1"]["theme"] == "Noise Complaint" and got["2"]["theme"] == ""
    assert got["4"] == {
        "theme": "Flooding", "severity": "high", "suggested_action": "Check image case now."
    }
    assert "3" not in got


def test_alignment_flag(spark):
    pairs = [
        ("Clear the hydrant", "Hydrant rules"), ("Go", "Hydrant rules"), ("Go", None),
        (None, "Hydrant"), ("call c++ team", "C++ policy"), ("a.b", "A.B x"), ("axb", "A.B x"),
    ]
    df = spark.createDataFrame(pairs, "a string, t string")
    literal = [r[0] for r in df.select(refine.alignment_flag(F.col("a"), F.col("t"))).collect()]
    assert literal == ["aligned", "review", "review", "review", "aligned", "aligned", "review"]
    pattern = df.filter("t not like 'C%' or t is null").select(
        refine.alignment_flag(F.col("a"), F.col("t"), regex=True)
    )
    assert [r[0] for r in pattern.collect()] == [
        "aligned", "review", "review", "review", "aligned", "aligned"
    ]


def test_theme_validation_and_reference_rows(spark, rows):
    policies = reference_rows.policy_chunks(spark)
    labels = reference_rows.label_taxonomy(spark)
    assert (policies.count(), labels.count()) == (12, 21)
    checked = catalog.theme_validation(policies, labels.select(F.upper("label_value").alias("label_value")))
    assert {r.theme_status for r in checked.collect()} == {"ok"}
    some = catalog.theme_validation(policies, labels.filter("label_value <> 'Vandalism'"))
    assert rows(some.filter("theme_status <> 'ok'"), "policy_id") == [("GRAFFITI_30D",)]


def test_policy_catalog(spark):
    policies = reference_rows.policy_chunks(spark)
    built = catalog.policy_catalog(policies, catalog.embed_normalised(policies))
    assert built.columns == [
        "policy_id", "title", "source_url", "target_theme", "content", "embedding"
    ]
    row = built.filter("policy_id = 'PARK_72HR'").first()
    assert row.content.startswith("a vehicle may not")
    assert sum(row.embedding) == len(re.findall(r"\w+", row.content))


REFINED = "service_request_id string, alignment string"


def test_share_of_total(spark, rows):
    df = spark.createDataFrame([(str(i), "aligned" if i < 2 else "review") for i in range(3)], REFINED)
    assert [tuple(r) for r in reports.share_of_total(df).collect()] == [
        ("aligned", 2, 66.7), ("review", 1, 33.3)
    ]
    assert rows(reports.share_of_total(df.filter("alignment = 'review'"))) == [("review", 1, 100.0)]


def test_match_rate_of_nothing_is_null(spark, rows):
    empty = spark.createDataFrame([], "summary_source string, policy_matched boolean")
    assert rows(reports.cohort_match_rate(empty)) == [
        ("No-AI (Text-only)", 0, 0, None), ("With AI (Text+Image)", 0, 0, None)
    ]
    some = spark.createDataFrame(
        [("text", True), ("text", False), ("image", True), ("image", True)],
        "summary_source string, policy_matched boolean",
    )
    assert rows(reports.cohort_match_rate(some)) == [
        ("No-AI (Text-only)", 2, 1, 0.5), ("With AI (Text+Image)", 4, 3, 0.75)
    ]


def test_best_pool_order(spark):
    df = spark.createDataFrame(
        [("10", "s", True, 0.3), ("2", "s", True, 0.3), ("1", "s", False, None),
         ("0", None, True, 0.1), ("3", "s", True, 0.2), ("4", "s", True, None)],
        "service_request_id string, summary string, policy_matched boolean, cosine_distance double",
    )
    got = [r.service_request_id for r in reports.best_pool(df, 5).collect()]
    assert got == ["3", "10", "2", "4", "1"]


def test_incremental_worklist_is_an_anti_join(spark):
    from caseweave.operators.worklist import pending

    df = spark.range(5).select(F.col("id").cast("string").alias("service_request_id"))
    plan = pending(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
