"""Policy texts, their vectors and the check of their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.functions.text import same_ignoring_case, trim_unicode
from caseweave.operators.embed import Embedder, embed_text, hashed_vector
from caseweave.operators.lookup import broadcast_if_small


def normalise_chunks(policies: DataFrame) -> DataFrame:
    return policies.select(
        "policy_id", trim_unicode(F.lower("chunk_text")).alias("content")
    )


def embed_chunks(policies: DataFrame, embedder: Embedder = hashed_vector) -> DataFrame:
    """Policies with the vector of their text as written (used for search)."""
    return embed_text(policies, "chunk_text", embedder=embedder)


def embed_normalised(policies: DataFrame, embedder: Embedder = hashed_vector) -> DataFrame:
    """Id, normalised text and its vector (used for the catalog)."""
    return embed_text(normalise_chunks(policies), "content", embedder=embedder)


def policy_catalog(policies: DataFrame, vectors: DataFrame) -> DataFrame:
    """Policy columns without the text, with normalised text and vector."""
    return policies.drop("chunk_text").join(
        vectors.select("policy_id", "content", "embedding"), "policy_id", "left"
    )


def theme_validation(policies: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Is each policy's theme a known label, case ignored?"""
    known = broadcast_if_small(taxonomy.select("label_value"))
    return policies.join(
        known, same_ignoring_case(F.col("target_theme"), F.col("label_value")), "left"
    ).select(
        "policy_id",
        "title",
        "target_theme",
        F.when(F.col("label_value").isNull(), F.lit("missing_in_taxonomy"))
        .otherwise(F.lit("ok"))
        .alias("theme_status"),
    )
