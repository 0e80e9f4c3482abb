"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.functions.jsonfields import normal_severity, with_triage_fields
from caseweave.functions.text import tokens
from caseweave.operators import (
    catalog,
    cohort,
    embed,
    infer,
    match,
    media,
    refine,
    reports,
    search,
    summaries,
    worklist,
)
from caseweave.plans import bindings as b
from caseweave.plans.bindings import Bindings
from caseweave.sinks.staging import stage
from caseweave.sources import reference_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Bindings], DataFrame]) -> Callable[[Bindings], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Bindings(spark, folder))
    return build


# --- requests, text, cohort -------------------------------------------------


@query
def cases_norm(t):
    return t.cases


@query
def clean_text(t):
    return t.cleaned


@query
def text_quality(t):
    return t.quality


@query
def image_candidates(t):
    return media.image_candidates(t.cases)


@query
def stratified_cohort(t):
    return cohort.stratified_cohort(t.quality, b.COHORT_SIZE, b.SEED)


@query
def fallback_ids(t):
    return t.fallback


@query
def text_source(t):
    """From the three separate tables, all read from one cleaning pass."""
    t = t.staged("prepared")
    return summaries.text_source(t.cohort, t.cleaned, t.quality)


@query
def download_manifest(t):
    return media.download_manifest(t.cases, t.cohort)


# --- media and work lists ---------------------------------------------------


@query
def media_object_lookup(t):
    return media.object_lookup(t.objects, t.fallback)


@query
def media_todo_url(t):
    return media.todo_from_urls(t.cases, t.fallback, t.photo_summaries)


@query
def media_todo_objects(t):
    return media.todo_from_objects(t.objects, t.fallback, t.photo_summaries)


@query
def incremental_todo(t):
    open_rows = t.summaries.filter(F.col("summary").isNotNull())
    return worklist.pending(open_rows, t.refined_before)


# --- summaries, prompts, inference ------------------------------------------


@query
def case_summaries(t):
    return t.summaries


@query
def build_prompt(t):
    rows = t.refine_todo.filter(F.col("summary").isNotNull())
    return rows.select(
        "service_request_id",
        infer.triage_prompt().alias("triage_prompt"),
        infer.embed_content().alias("embed_content"),
        infer.refine_prompt().alias("refine_prompt"),
    )


@query
def triage_rules(t):
    return infer.triage_rules(t.summaries, b.THEME_RULES)


def _measure(prompts: list[str]) -> list[tuple[str, str]]:
    """A model whose answers SQL can repeat."""
    return [(f"{len(p)} characters", "long" if len(p) > 200 else "short") for p in prompts]


@query
def prompt_dedup(t):
    """Every turn of every conversation answered; equal prompts are asked once."""
    turns = t.table("conversations")
    return infer.batch_infer(turns, F.col("text"), _measure, key="conv_id").drop("text", "role")


@query
def prompt_dedup_hot(t):
    """A handful of prompts shared by all events."""
    prompt = F.concat(F.lit("Event: "), F.col("event_type"))
    events = t.table("events").select("event_id", "event_type")
    return infer.batch_infer(events, prompt, _measure, key="event_id")


@query
def outcome_counts(t):
    return infer.outcome_counts(t.triage)


@query
def json_extract(t):
    return with_triage_fields(t.event_answers).drop("triage_result")


@query
def severity_normalise(t):
    fields = with_triage_fields(t.event_answers)
    return fields.select("event_id", normal_severity(F.col("severity")).alias("severity"))


@query
def validate_json(t):
    return reports.validate_json(t.event_answers)


# --- policies ---------------------------------------------------------------


def _nearest_reference(t: Bindings) -> DataFrame:
    """Each document's nearest hand-written policy, with the number of documents."""
    documents = embed.embed_text(t.table("documents"), "text").select("doc_id", "embedding")
    policies = catalog.embed_chunks(reference_rows.policy_chunks(t.spark))
    found = search.nearest(documents, policies, k=1, query_id="doc_id")
    return (
        found.select(F.get("candidates", F.lit(0))["base_id"].alias("policy_id"))
        .groupBy("policy_id")
        .agg(F.count(F.lit(1)).alias("n_documents"))
    )


@query
def policy_chunks(t):
    """The hand-written policies with the number of documents nearest to each."""
    rows = reference_rows.policy_chunks(t.spark).join(_nearest_reference(t), "policy_id", "left")
    return rows.fillna(0, ["n_documents"])


@query
def label_taxonomy(t):
    """The labels with the number of documents nearest to a policy of that label."""
    by_theme = (
        reference_rows.policy_chunks(t.spark)
        .join(_nearest_reference(t), "policy_id")
        .groupBy("target_theme")
        .agg(F.sum("n_documents").alias("n_documents"))
    )
    labels = reference_rows.label_taxonomy(t.spark)
    rows = labels.join(by_theme, F.col("label_value") == F.col("target_theme"), "left")
    return rows.drop("target_theme").fillna(0, ["n_documents"])


@query
def theme_validation(t):
    """Document sources against those of the toxic low-quality documents."""
    documents, labels = t.table("documents"), t.table("labels")
    policies = documents.select(
        F.col("doc_id").cast("string").alias("policy_id"),
        F.col("lang").alias("title"),
        F.col("source").alias("target_theme"),
    )
    flagged = labels.filter((F.col("quality") == 0) & (F.col("toxic") == 1))
    taxonomy = (
        documents.join(flagged, "doc_id")
        .select(F.upper("source").alias("label_value"))
        .distinct()
    )
    return catalog.theme_validation(policies, taxonomy)


@query
def normalise_chunks(t):
    return catalog.normalise_chunks(t.policies)


@query
def policy_catalog(t):
    built = catalog.policy_catalog(t.policies, catalog.embed_normalised(t.policies))
    as_text = F.array_join(F.col("embedding").cast("array<int>").cast("array<string>"), ",")
    return built.withColumn("embedding", as_text)


# --- vectors and matching ---------------------------------------------------


@query
def embed_hashed(t):
    return embed.nonzero_buckets(embed.embed_text(t.table("documents"), "text"), "doc_id")


@query
def vector_topk(t):
    return t.given_candidates


@query
def vector_topk_indexed(t):
    """The same through the index, which a catalog of this size would not need."""
    return search.vector_topk(t.given_queries, t.given_catalog, max_broadcast_bytes=1 << 16)


@query
def sparse_topk(t):
    documents = t.table("documents").select("doc_id", tokens(F.col("text")).alias("tokens"))
    items = t.table("benchmark").select("item_id", tokens(F.col("text")).alias("tokens"))
    found = search.nearest(
        documents, items, query_id="doc_id", query_on="tokens",
        base_id="item_id", base_on="tokens", compare="tokens",
    )
    return search.as_rows(found, ["doc_id"]).select(
        "doc_id", F.col("base_id").alias("item_id"), "distance"
    )


@query
def best_match_precise(t):
    return match.best_same_label(t.given_candidates, b.VECTOR_MAX_DISTANCE)


@query
def unmatched_cases(t):
    t = t.staged("given_candidates")  # read by both tiers
    precise = match.best_same_label(t.given_candidates, b.VECTOR_MAX_DISTANCE)
    return match.unmatched(t.given_candidates, precise).select(
        "service_request_id", "policy_id", "cosine_distance"
    )


@query
def best_match_global(t):
    t = t.staged("given_candidates")
    precise = match.best_same_label(t.given_candidates, b.VECTOR_MAX_DISTANCE)
    return match.best_overall(t.given_candidates, precise, b.VECTOR_MAX_DISTANCE)


@query
def tiered_match(t):
    return match.tiered_match(t.given_queries, t.given_catalog, b.VECTOR_MAX_DISTANCE)


@query
def case_matches(t):
    """The whole chain: raw requests to the matched policy of every case."""
    return t.matches


# --- refinement -------------------------------------------------------------


@query
def refine_prep(t):
    """From the separate triage, summary, match and done tables."""
    t = t.staged("summaries", "triage")
    return refine.refine_prep(
        t.triage, t.summaries, t.matches, t.refined_before, batch_size=None
    )


@query
def refine_prep_fused(t):
    """The same rows when triage rows are matched in place."""
    return t.refine_todo


@query
def work_batch(t):
    """The batch is picked before the search, so only its rows are matched."""
    batch = worklist.work_batch(t.staged("triage").open_triage, 200)
    return refine.refine_matched(t.match(batch), batch_size=None)


@query
def alignment_flag(t):
    """Does the first word of the page's title occur in the document's text?"""
    return _aligned(t, F.col("page_title"))


@query
def alignment_regex(t):
    """The same with the first word as a pattern; what is no pattern is for review."""
    title = F.col("page_title")
    kind = F.col("doc_id") % 4
    pattern = (
        F.when(kind == 0, F.concat(F.lit("("), title))
        .when(kind == 1, F.regexp_replace(title, "[aeiou]", "."))
        .otherwise(title)
    )
    return _aligned(t, pattern, regex=True)


def _aligned(t: Bindings, title, regex: bool = False) -> DataFrame:
    pages = t.table("pages").select("page_id", b.page_title(F.col("html")).alias("page_title"))
    rows = t.table("documents").join(pages, F.col("doc_id") == F.col("page_id"), "left")
    titled = rows.select("doc_id", "text", title.alias("title"))
    return titled.select(
        "doc_id", "title", refine.alignment_flag(F.col("text"), F.col("title"), regex).alias("alignment")
    )


@query
def review_examples(t):
    # The filter on a computed flag would have the answers parsed once per use.
    return reports.review_examples(t.staged("refined").refined)


@query
def share_of_total(t):
    return reports.share_of_total(t.refined)


RUNS = 3


def _by_runs(rows, counts):
    """The counts of each of ``RUNS`` parts of the cases, as runs would leave them."""
    rows = stage(rows, "runs")
    run = F.pmod(F.xxhash64("service_request_id"), F.lit(RUNS))
    return reduce(DataFrame.unionByName, [counts(rows.where(run == r)) for r in range(RUNS)])


@query
def share_of_total_of_runs(t):
    """Shares of all rows from the counts of each run."""
    return reports.merged_share(_by_runs(t.refined, reports.label_counts))


@query
def match_rate_of_runs(t):
    """Rates of all rows from the counts of each run."""
    return reports.merged_match_rate(_by_runs(reports.full_cohort(t.pool), reports.match_counts))


# --- analysis ---------------------------------------------------------------


@query
def proto_pool(t):
    """From the three separate tables."""
    t = t.staged("summaries", "triage")
    return reports.proto_pool(t.summaries, t.triage, t.matches)


@query
def proto_pool_parsed(t):
    return t.pool


@query
def best_pool_topk(t):
    return reports.best_pool(t.pool, 1000)


@query
def full_cohort(t):
    return reports.full_cohort(t.pool)


@query
def cohort_match_rate(t):
    return reports.cohort_match_rate(reports.full_cohort(t.pool))


@query
def row_count_audit(t):
    """Counts the tables themselves, each written once, not what they are made from;
    the tasks that write a table count it.  Each builds on the one before, so that texts
    are embedded once and searched once."""
    t = t.staged("prepared")
    datasets = {
        "01_cases_norm": t.cases,
        "02_cases_for_classify": t.cleaned,
        "03_cases_text_quality": t.written("quality"),
        "04_batch_ids": t.cohort,
        "05_batch_case_summaries": t.written("summaries"),
        "06_batch_triage_raw": t.written("triage"),
        "07_policy_chunks": t.policies,
        "08_policy_embeddings": t.written("policy_vectors"),
        "09_case_query_embeddings": t.written(
            "embedded", "queries", queries=F.count_if(F.col("summary").isNotNull())
        ),
        "10_batch_policy_matches": t.written("matched", "hits", hits=F.count_if("policy_matched")),
    }
    t.refine_todo = t.todo_of_matched
    datasets["11_batch_triage_policy_refined"] = t.written("refined")
    return reports.row_count_audit(t.spark, datasets)
