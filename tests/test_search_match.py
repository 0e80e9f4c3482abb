import math
import random

import pytest
from pyspark.sql import functions as F

from caseweave.functions.text import tokens
from caseweave.operators import embed, match, search

VECTORS = "service_request_id string, theme string, summary string, embedding array<float>"
POLICIES = (
    "policy_id string, title string, chunk_text string, source_url string, target_theme string, "
    "embedding array<float>"
)


def cosine(a, b):
    dot = sum(x * y for x, y in zip(a, b))
    return 1 - dot / (math.hypot(*a) * math.hypot(*b))


def brute_force(queries, base, k):
    out = {}
    for qid, vector in queries:
        if vector is None or not any(vector):
            out[qid] = []
            continue
        ranked = sorted(
            (round(cosine(vector, v), 9), bid) for bid, v in base if v is not None and any(v)
        )
        out[qid] = [(bid, d) for d, bid in ranked[:k]]
    return out


@pytest.fixture(scope="module")
def data():
    draw = random.Random(5)
    vector = lambda: [draw.randint(-4, 4) / 4 for _ in range(6)]
    base = [(f"P{i}", vector()) for i in range(40)]
    base += [(f"Q{i}", base[i][1]) for i in range(10)]  # exact ties
    base += [("Z", [0.0] * 6), ("N", None)]
    queries = [(str(i), vector()) for i in range(300)]
    queries += [("zero", [0.0] * 6), ("null", None)]
    return queries, base


def frames(spark, data):
    queries, base = data
    q = spark.createDataFrame([(i, "t", "s", v) for i, v in queries], VECTORS).repartition(5)
    b = spark.createDataFrame([(i, i, "c", "u", "T", v) for i, v in base], POLICIES)
    return q, b


@pytest.mark.parametrize("limit", [search.MAX_BROADCAST_BYTES, 600])
def test_nearest_equals_brute_force(spark, data, limit):
    queries, base = frames(spark, data)
    found = search.nearest(
        queries, base, 5, base_label="target_theme", max_broadcast_bytes=limit, chunk_bytes=3500
    )
    got = {
        r.service_request_id: [(c.base_id, c.distance) for c in r.candidates]
        for r in found.collect()
    }
    want = brute_force(*data, 5)
    assert got.keys() == want.keys()
    for key, candidates in want.items():
        assert [c[0] for c in got[key]] == [c[0] for c in candidates]
        assert [c[1] for c in got[key]] == pytest.approx([c[1] for c in candidates], abs=1e-8)


def test_large_catalog_is_cut_into_cells_and_nothing_is_broadcast(spark, data):
    queries, base = frames(spark, data)
    found = search.nearest(queries, base, 5, max_broadcast_bytes=600, chunk_bytes=3500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_small_catalog_needs_no_shuffle(spark, data, tmp_path):
    queries, base = frames(spark, data)
    queries.write.parquet(str(tmp_path / "q"))
    found = search.nearest(spark.read.parquet(str(tmp_path / "q")), base, 5)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_vectors_of_another_length_are_an_error(spark, data):
    queries, base = frames(spark, data)
    short = queries.withColumn("embedding", F.slice("embedding", 1, 3))
    with pytest.raises(Exception, match="expected 6"):
        search.nearest(short, base).collect()


@pytest.mark.parametrize("limit", [search.MAX_BROADCAST_BYTES, 4000])
def test_token_search_equals_brute_force(spark, limit):
    draw = random.Random(3)
    words = ["a", "b", "c", "dé", "e1", "f", "g"]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    docs = [(str(i), text(draw.randint(0, 8))) for i in range(60)] + [("n", None)]
    items = [(f"I{i:02}", text(draw.randint(0, 5))) for i in range(20)]
    vector = lambda t: [(t or "").split().count(w) for w in words]
    as_df = lambda rows: spark.createDataFrame(rows, "id string, t string").select(
        "id", tokens(F.col("t")).alias("tokens")
    )
    found = search.nearest(
        as_df(docs), as_df(items), 4, query_id="id", query_on="tokens", base_id="id",
        base_on="tokens", compare="tokens", max_broadcast_bytes=limit, chunk_bytes=400,
    )
    got = {r.id: [c.base_id for c in r.candidates] for r in found.collect()}
    want = brute_force(
        [(i, vector(t)) for i, t in docs], [(i, vector(t)) for i, t in items], 4
    )
    assert got == {k: [c[0] for c in v] for k, v in want.items()}


def test_hashed_vector_counts_whole_text(spark):
    import hashlib

    text = "Élan vital 42 élan " + "word " * 5000
    row = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(
        embed.hashed_vector(F.col("t"), 16).alias("embedding")
    ).collect()
    want = [0] * 16
    for token in text.lower().split():
        want[int(hashlib.md5(token.encode()).hexdigest()[:4], 16) % 16] += 1
    assert row[0].embedding == want
    assert row[1].embedding is None and row[2].embedding == [0] * 16


def test_outside_embedder(spark, rows):
    df = spark.createDataFrame([("ab",), (None,)], "t string")
    lengths = embed.model_vector(lambda texts: [[len(t), 1.0] for t in texts])
    assert rows(embed.embed_text(df, "t", embedder=lengths), "embedding") == [(None,), ([2.0, 1.0],)]


CANDIDATES = (
    "service_request_id string, case_theme string, policy_id string, target_theme string, "
    "cosine_distance double"
)


def test_tier_tables_and_fused_tiers_agree(spark, rows):
    candidates = [
        # same label at rank 3 beats other labels
        ("1", "A", "P1", "b", 0.1), ("1", "A", "P2", "c", 0.2), ("1", "A", "P3", "a", 0.3),
        # same label above the cutoff falls to the global tier
        ("2", "A", "P1", "b", 0.4), ("2", "A", "P3", "a", 0.6),
        # distance equal to the cutoff counts
        ("3", "A", "P3", "a", 0.5),
        # tie goes to the lower id
        ("4", "x", "P9", "b", 0.2), ("4", "x", "P10", "b", 0.2),
        # nothing within the cutoff
        ("5", "A", "P3", "a", 0.7),
        # no theme
        ("6", "", "P1", "b", 0.2),
    ]
    table = spark.createDataFrame(candidates, CANDIDATES)
    precise = match.best_same_label(table, 0.5)
    overall = match.best_overall(table, precise, 0.5)
    assert rows(precise, "service_request_id", "policy_id") == [("1", "P3"), ("3", "P3")]
    assert rows(overall, "service_request_id", "policy_id") == [
        ("2", "P1"), ("4", "P10"), ("6", "P1")
    ]
    found = (
        table.groupBy("service_request_id", F.col("case_theme").alias("theme"))
        .agg(F.sort_array(F.collect_list(F.struct("cosine_distance", "policy_id", "target_theme"))).alias("c"))
        .select(
            "service_request_id", "theme",
            F.transform("c", lambda c: F.struct(
                c["policy_id"].alias("base_id"), c["target_theme"].alias("base_label"),
                c["cosine_distance"].alias("distance"))).alias("candidates"),
        )
    )
    fused = match.with_match(found, 0.5).filter("match is not null")
    assert rows(fused, "service_request_id", "match.policy_id", "match.tier") == [
        ("1", "P3", "precise"), ("2", "P1", "global"), ("3", "P3", "precise"),
        ("4", "P10", "global"), ("6", "P1", "global"),
    ]


def test_rank_one_is_cut_before_the_shuffle(spark):
    table = spark.createDataFrame([("1", "A", "P1", "a", 0.1)], CANDIDATES)
    plan = match.best_same_label(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_model_call_is_not_copied_into_filters(spark, data, tmp_path):
    queries, base = frames(spark, data)
    matched = match.tiered_match(queries, base)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
