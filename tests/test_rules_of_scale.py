"""What must not depend on batch, catalog or pool size."""

import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions import text as tx
from caseweave.operators import infer, refine, search
from caseweave.operators.lookup import lookup
from caseweave.operators.worklist import work_batch
from caseweave.plans.job import Job, Models, Settings
from test_tables_job import RAW, photo, rewrite, triage


@pytest.mark.parametrize("blank", ["-", "_", " ", "\n", "\u00a0"])
@pytest.mark.parametrize("where", ["start", "middle", "end", "only"])
def test_weak_text_gate_reads_separators_once(spark, blank, where):
    run = blank * 10_000
    text = {"start": run + "pothole", "middle": "pot" + run + "hole", "end": "pothole" + run, "only": run}[where]
    judge = lambda t: spark.createDataFrame([(t,)], "t string").select(tx.is_weak(F.col("t"))).first()[0]
    judge("warm-up")
    began = time.perf_counter()
    weak = judge(text)
    assert time.perf_counter() - began < 3  # of which the job itself takes nearly all
    assert weak == (where == "only")


def test_weak_text_gate_equals_flattening(spark):
    rng = random.Random(3)
    pieces = ["open", "Other", "N", "/", "A", "a", "ok", "K\u212a", "_", "-", " ", "\t", "\n", "\u00a0", "\u2003"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    flat = tx.flatten_spaces(F.col("t"))
    plain = (F.length(flat) < fv.MIN_TEXT_LENGTH) | F.lower(flat).isin(*fv.STOP_TEXTS)
    assert df.filter(tx.is_weak(F.col("t")) != plain).count() == 0


def fussy(prompts):
    if any("bad" in p for p in prompts):
        raise RuntimeError("no")
    return [(p.upper(), "") for p in prompts]


def short(prompts):
    return [("x", "")] * (len(prompts) if len(prompts) == 1 and "bad" not in prompts[0] else 0)


@pytest.mark.parametrize("shared", [True, False])
@pytest.mark.parametrize("batch", ["7", "10000"])
def test_one_bad_prompt_fails_alone(spark, shared, batch):
    todo = spark.createDataFrame([(str(i), "bad" if i == 500 else f"p{i}") for i in range(1000)], "service_request_id string, p string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = infer.batch_infer(todo, F.col("p"), fussy, shared_prompts=shared).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    failed = [(r.service_request_id, r.status) for r in got if r.status]
    assert failed == [("500", "error: RuntimeError")] and len(got) == 1000


def test_a_short_answer_fails_item_by_item():
    assert infer._answers(short, ["a", None, "bad"]) == [("x", ""), (None, None), (None, "error: ValueError")]


def test_prompts_are_counted_by_hash(spark):
    rows = spark.createDataFrame([("h", "p")], "prompt_hash string, prompt string")
    plan = infer.distinct_prompts(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_hot_keys_are_bounded_by_the_number_of_tasks(spark, rows):
    table = spark.createDataFrame([("a", 900, "x"), ("b", 1, "y")], "k string, uses long, v string")
    left = spark.createDataFrame([("a", i) for i in range(900)] + [("b", -1), ("c", -2)], "k string, i long")
    got = lookup(left, table, "k", "uses", "i")
    assert got.count() == 901 and rows(got.filter("k = 'b'")) == [("b", -1, "y")]


def queries_and_catalog(spark):
    rng = random.Random(1)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    ids = ["a", None, "d", "d", None, "e", "f"]
    queries = spark.createDataFrame([(i, vector()) for i in ids], "service_request_id string, embedding array<double>")
    catalog = spark.createDataFrame([(f"P{i:02}", vector()) for i in range(40)], "policy_id string, embedding array<double>")
    return queries, catalog


def test_one_answer_at_every_catalog_size(spark):
    queries, catalog = queries_and_catalog(spark)
    read = lambda df: sorted(
        (str(r[0]), tuple(r[1]), tuple((c.base_id, c.distance) for c in r[2])) for r in df.collect()
    )
    whole = read(search.nearest(queries, catalog, 3))
    for bound, chunk in ((200, 1 << 20), (64, 64)):
        cells = search.nearest(queries, catalog, 3, max_broadcast_bytes=bound, chunk_bytes=chunk)
        assert read(cells) == whole


def test_token_cells_of_mixed_lengths(spark):
    rng = random.Random(2)
    text = lambda n: [f"t{rng.randint(0, 30)}" for _ in range(n)]
    queries = spark.createDataFrame([(i, text(n)) for i, n in enumerate((1, 400, 3, 0, 50))], "q long, t array<string>")
    items = spark.createDataFrame([(str(i), text(rng.randint(0, 12))) for i in range(30)], "p string, t array<string>")
    options = dict(query_id="q", query_on="t", base_id="p", base_on="t", compare="tokens")
    read = lambda df: sorted((r[0], tuple((c.base_id, c.distance) for c in r[2])) for r in df.collect())
    whole = read(search.nearest(queries, items, 4, **options))
    assert read(search.nearest(queries, items, 4, **options, max_broadcast_bytes=300, chunk_bytes=500)) == whole


def test_blocks_grow_with_the_catalog_not_with_its_square():
    bound = 64 << 20
    size = 8 * 200 * 7480  # rows x tokens of a small catalog
    assert search.block_count(size, bound, "tokens") == 1
    assert search.block_count(size * 100**2, bound, "tokens") == 43
    assert search.block_count(bound * 10 + 1, bound, "vector") == 11


def test_rows_without_a_policy_are_kept_above_the_bound(spark, rows):
    left = spark.createDataFrame([("1", "P1"), ("2", None)], "id string, policy_id string")
    catalog = spark.createDataFrame([("P1", "t", "c", "m", "u")], "policy_id string, title string, chunk_text string, target_theme string, source_url string")
    small = search.with_policy(left, catalog, "left")
    assert rows(search.with_policy(left, catalog, "left", max_broadcast_bytes=0)) == rows(small)


def test_work_batch_has_no_single_task_of_wide_rows(spark, rows):
    df = spark.range(5000).select(F.format_string("%05d", "id").alias("service_request_id"), F.lit("wide").alias("w"))
    got = work_batch(df.repartition(40), 3)
    assert rows(got, "service_request_id") == [("00000",), ("00001",), ("00002",)]


def test_pattern_words(spark, rows):
    given = [("Call C++ now", "C++ x"), ("call abc", "a.c"), ("call", "(draft"), (None, "a"), ("a", None), ("ab", "Ab")]
    df = spark.createDataFrame(given, "a string, t string")
    flag = refine.alignment_flag(F.col("a"), F.col("t"), regex=True)

    def want(action, title):
        try:
            return bool(action and title and re.search(title.lower().split(" ")[0], action.lower()))
        except re.error:
            return False

    assert [r[0] for r in df.select(flag).collect()] == ["aligned" if want(*g) else "review" for g in given]


asked: list[str] = []


class Moody:
    """Fails on some prompts while ``moody`` is in the file that it is given."""

    def __init__(self, path):
        self.path = path

    def __call__(self, prompts):
        with open(self.path) as f:
            bad = f.read().split()
        if any(b in p for p in prompts for b in bad):
            raise TimeoutError
        with open(self.path + ".asked", "a") as f:
            f.writelines(p.split(" | ")[0] + "\n" for p in prompts)
        return triage(prompts)


@pytest.fixture
def cases(spark):
    return lambda texts: spark.createDataFrame(
        [(i, None, "t", None, t, None, "a", None) for i, t in enumerate(texts)], RAW
    )


def test_a_second_run_asks_only_what_failed_or_changed(spark, rows, cases, tmp_path):
    mood = tmp_path / "mood"
    mood.write_text("Flooded")
    texts = ["illegal dumping here", "flooded street again", "noise all night long"]
    job = Job(spark, cases(texts), Models(photo, Moody(str(mood)), rewrite), settings=Settings(per_stratum=None, max_distance=0.9))
    job.reset_state()
    try:
        job.run()
        state = job.table("batch_triage_raw")
        assert rows(state.filter("status <> ''"), "service_request_id", "status") == [("1", "error: TimeoutError")]
        assert rows(job.table("batch_triage_policy_refined"), "service_request_id") == [("0",), ("2",)]
        mood.write_text("")
        (tmp_path / "mood.asked").write_text("")
        texts[2] = "noise in the morning"
        job.raw = cases(texts)
        job.run()
        again = (tmp_path / "mood.asked").read_text().splitlines()
        assert sorted(again) == ["Complaint Summary: Flooded Street Again.", "Complaint Summary: Noise In The Morning."]
        current = rows(spark.table("current_refined"), "service_request_id", "summary")
        assert [r[0] for r in current] == ["0", "1", "2"] and "Morning" in current[2][1]
        before = job.table("batch_triage_raw").count(), job.table("batch_triage_policy_refined").count()
        job.run()
        assert (job.table("batch_triage_raw").count(), job.table("batch_triage_policy_refined").count()) == before
    finally:
        job.reset_state()


def tagged(prompts, temperature=None, max_output_tokens=None):
    theme = json.dumps({"theme": "Illegal Dumping", "severity": "low", "suggested_action": f"t{temperature}"})
    return [(theme, "") for _ in prompts]


def said(prompts, **generation):
    return [(f"{len(generation)} settings", "") for _ in prompts]


def test_rates_are_those_of_all_cases_and_generation_is_passed_on(spark, cases):
    texts = [f"illegal dumping in the public right of way number {i}" for i in range(12)]
    texts += [f"qqq www eee rrr {i} zzz" for i in range(12)]
    job = Job(
        spark, cases(texts), Models(photo, tagged, said),
        settings=Settings(per_stratum=None, max_distance=0.6, analysis_pool=5, generation=fv.GENERATION),
    )
    job.reset_state()
    try:
        job.run()
        total = {r.cohort: (r.total, r.matched) for r in spark.table("v_match_rates").collect()}[fv.ALL_COHORT]
        assert total[0] == 24 and total[1] == job.table("triage_matched").filter("policy_matched").count()
        assert job.table("analysis_pool").count() == 5
        refined = job.table("batch_triage_policy_refined").select("original_action", "refined_action").first()
        assert refined.original_action == "t0.0" and refined.refined_action in (None, "2 settings")
    finally:
        job.reset_state()


def test_audit_counts_the_tables_it_names(spark, monkeypatch):
    from caseweave.operators import clean, embed
    from caseweave.plans.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    whole = dict(map(tuple, QUERIES["row_count_audit"](spark, folder).collect()))
    for module, name in ((clean, "quality_of"), (embed, "embed_cases"), (refine, "refined_rows")):
        made = getattr(module, name)
        lossy = lambda *given, made=made, **options: made(*given, **options).where("service_request_id != '1'").limit(7)
        monkeypatch.setattr(module, name, lossy)
        counted = dict(map(tuple, QUERIES["row_count_audit"](spark, folder).collect()))
        monkeypatch.undo()
        table = {
            "quality_of": "03_cases_text_quality",
            "embed_cases": "09_case_query_embeddings",
            "refined_rows": "11_batch_triage_policy_refined",
        }[name]
        assert counted[table] == 7 < whole[table]


def test_no_pattern_ends_or_stalls_the_job(spark):
    words = ["a{1", "x{,3}", "[[]", "[a&&[b", "**", "(?<n>", "(?=a)", "\\1", "a{1001}", "(", "[", "(a+)+$", "d.g", "c++"]
    text = "a dog and c " + "a" * 40_000 + "!"
    df = spark.createDataFrame([(text, f"{w} policy") for w in words] * 3, "a string, t string").repartition(2)
    started = time.monotonic()
    flags = {r["t"].split(" ")[0]: r["flag"] for r in df.select("t", refine.alignment_flag(F.col("a"), F.col("t"), regex=True).alias("flag")).collect()}
    assert time.monotonic() - started < 20
    assert {w for w, f in flags.items() if f == "aligned"} == {"d.g", "c++"}


def test_many_patterns_in_one_batch_keep_their_rows(spark):
    given = [(f"item {i % 50} here", f"i.em\\s{i % 7}\\b") for i in range(500)] + [(None, "a.b"), ("a", None)]
    df = spark.createDataFrame(given, "a string, t string")
    got = [r[0] for r in df.select(refine.alignment_flag(F.col("a"), F.col("t"), regex=True)).collect()]
    want = ["aligned" if a and t and re.search(t, a) else "review" for a, t in given]
    assert got == want


def test_audit_embeds_each_text_once(spark, monkeypatch):
    from caseweave.operators import embed
    from caseweave.plans import bindings
    from caseweave.plans.queries import QUERIES

    made, searched = [], []
    real, found = embed.hashed_vector, bindings.match.matched_rows
    monkeypatch.setattr(embed.embed_cases, "__defaults__", (lambda text: made.append(text) or real(text),))
    monkeypatch.setattr(bindings.match, "matched_rows", lambda *a, **k: searched.append(a) or found(*a, **k))
    QUERIES["row_count_audit"](spark, "/root/testdata/sf0.001").collect()
    assert len(made) == 1 and len(searched) == 1


def test_open_rows_of_matched_are_those_that_are_matched_open(spark, rows):
    from caseweave.plans.bindings import Bindings

    t = Bindings(spark, "/root/testdata/sf0.001")
    one, other = (rows(df.select(sorted(df.columns))) for df in (t.refine_todo, t.todo_of_matched))
    assert one == other and len(one) > 100
