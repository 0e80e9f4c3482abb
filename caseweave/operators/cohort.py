"""Reproducible cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions import text as tx
from caseweave.operators.topn import top_n
from caseweave.operators.worklist import only


def stratum() -> Column:
    """``text`` for usable text, ``image`` for weak text with an image, else null."""
    weak = F.col("is_bad_text")
    return F.when(~weak, F.lit("text")).when(
        weak & F.col("has_media") & tx.is_image_url(F.col("media_url")), F.lit("image")
    )


def eligible(quality: DataFrame) -> DataFrame:
    """Every case that belongs to a stratum."""
    return quality.select("service_request_id", stratum().alias("stratum")).filter(
        F.col("stratum").isNotNull()
    )


def sample_order(seed: int, key: str = "service_request_id") -> list[Column]:
    """A random but repeatable order: the same seed always draws the same rows."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))), F.col(key)]


def stratified_cohort(
    quality: DataFrame, per_stratum: int | None = fv.COHORT_PER_STRATUM, seed: int = 42
) -> DataFrame:
    """At most ``per_stratum`` random cases of each stratum, in one scan; all for ``None``."""
    if per_stratum is None:
        return eligible(quality)
    return top_n(eligible(quality), per_stratum, sample_order(seed), within=["stratum"])


def fallback_ids(quality: DataFrame, cohort: DataFrame) -> DataFrame:
    """Cohort cases that need media because their text is unusable."""
    weak = quality.filter(F.col("is_bad_text") & F.col("has_media"))
    return only(weak.select("service_request_id"), cohort)
