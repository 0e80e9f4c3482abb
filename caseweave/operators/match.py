"""From candidates to at most one policy per case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.text import same_ignoring_case
from caseweave.operators.embed import Embedder, embed_cases, hashed_vector, search_theme
from caseweave.operators.search import nearest, with_policy
from caseweave.operators.worklist import absent


def _best(candidates: DataFrame, max_distance: float) -> DataFrame:
    order = Window.partitionBy("service_request_id").orderBy("cosine_distance", "policy_id")
    return (
        candidates.withColumn("_rank", F.row_number().over(order))
        .filter((F.col("_rank") == 1) & (F.col("cosine_distance") <= max_distance))
        .drop("_rank")
    )


def best_same_label(candidates: DataFrame, max_distance: float = fv.MAX_DISTANCE) -> DataFrame:
    """Nearest candidate whose label equals the case theme, case ignored."""
    same = same_ignoring_case(F.col("case_theme"), F.col("target_theme"))
    return _best(candidates.filter(same), max_distance)


def unmatched(candidates: DataFrame, matched: DataFrame) -> DataFrame:
    """Candidates of the cases that have no match yet."""
    return absent(candidates, matched)


def best_overall(
    candidates: DataFrame, matched: DataFrame, max_distance: float = fv.MAX_DISTANCE
) -> DataFrame:
    """Nearest candidate of any label for the cases without a match."""
    return _best(unmatched(candidates, matched), max_distance)


def with_match(
    found: DataFrame, max_distance: float = fv.MAX_DISTANCE, into: str = "match"
) -> DataFrame:
    """Both tiers as expressions over the sorted candidate array: no shuffle."""
    theme, near = F.col("theme"), F.col("candidates")
    same = F.filter(near, lambda c: same_ignoring_case(c["base_label"], theme))
    staged = found.withColumn("_same", F.get(same, F.lit(0))).withColumn(
        "_any", F.get(near, F.lit(0))
    )

    def tier(candidate: str, name: str) -> Column:
        c = F.col(candidate)
        return F.when(
            c["distance"] <= max_distance,
            F.struct(
                c["base_id"].alias("policy_id"),
                c["distance"].alias("cosine_distance"),
                F.lit(name).alias("tier"),
            ),
        )

    return staged.withColumn(
        into, F.coalesce(tier("_same", "precise"), tier("_any", "global"))
    ).drop("_same", "_any")


def tiered_match(
    queries: DataFrame,
    catalog: DataFrame,
    max_distance: float = fv.MAX_DISTANCE,
    k: int = fv.NEIGHBOURS,
    **settings,
) -> DataFrame:
    """Search and match in one pass over the queries, at most one row each.

    The label tier only sees the ``k`` nearest; policy text is fetched for the
    chosen row alone.
    """
    found = nearest(queries, catalog, k, base_label="target_theme", **settings)
    chosen = (
        with_match(found, max_distance)
        .filter(F.col("match").isNotNull())
        .select(
            "service_request_id", F.col("theme").alias("case_theme"), "summary",
            "match.policy_id", "match.cosine_distance", "match.tier",
        )
    )
    return with_policy(chosen, catalog).select(
        "service_request_id", "case_theme", "summary", "policy_id", "policy_title",
        "policy_snippet", "target_theme", "source_url", "cosine_distance", "tier",
    )


def matched_rows(
    embedded: DataFrame,
    catalog: DataFrame,
    max_distance: float = fv.MAX_DISTANCE,
    k: int = fv.NEIGHBOURS,
    **settings,
) -> DataFrame:
    """Every embedded triage row with its policy, if it has one.

    Search and both tiers happen in the row, and a catalog within the broadcast
    bound is looked up there too, so rows need no shuffle to meet their match.
    """
    found = nearest(embedded, catalog, k, base_label="target_theme", **settings)
    rows = with_match(found, max_distance).select(
        *[c for c in embedded.columns if c not in ("theme", "embedding")],
        "match.policy_id", "match.cosine_distance",
        F.col("match").isNotNull().alias("policy_matched"),
    )
    return with_policy(rows, catalog, how="left")


def matched_triage(
    triage: DataFrame,
    catalog: DataFrame,
    max_distance: float = fv.MAX_DISTANCE,
    k: int = fv.NEIGHBOURS,
    trim_theme: bool = False,
    embedder: Embedder = hashed_vector,
    **settings,
) -> DataFrame:
    """Embed triage rows and match them, all in place."""
    embedded = embed_cases(search_theme(triage, trim_theme), embedder)
    return matched_rows(embedded, catalog, max_distance, k, **settings)
