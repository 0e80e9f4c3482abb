"""One summary per case: its text, its photo summary, or none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.operators.clean import prepare
from caseweave.operators.worklist import only


def text_source(cohort: DataFrame, cleaned: DataFrame, quality: DataFrame) -> DataFrame:
    """Cohort ids with cleaned text and quality flag, from separate tables."""
    return (
        cohort.select("service_request_id")
        .join(cleaned.select("service_request_id", "complaint_text"), "service_request_id")
        .join(quality.select("service_request_id", "is_bad_text"), "service_request_id")
    )


def text_source_of_prepared(prepared: DataFrame, keep_null_text: bool = False) -> DataFrame:
    """The same from one prepared table: no text is shuffled to meet its own flag.

    Cases without any text drop out even when a photo could speak for them;
    ``keep_null_text`` keeps them.
    """
    rows = prepared if keep_null_text else prepared.filter("has_text")
    return rows.select("service_request_id", "complaint_text", "is_bad_text")


def text_source_of_cases(
    cases: DataFrame, cohort: DataFrame, keep_null_text: bool = False, **settings
) -> DataFrame:
    """The same from normalised cases: the cohort is picked before any text is cleaned."""
    return text_source_of_prepared(prepare(only(cases, cohort), **settings), keep_null_text)


def case_summaries(texts: DataFrame, photo_summaries: DataFrame) -> DataFrame:
    photos = photo_summaries.select(
        "service_request_id", F.col("summary_text").alias("_photo")
    )
    weak, photo = F.col("is_bad_text"), F.col("_photo")
    return texts.join(photos, "service_request_id", "left").select(
        "service_request_id",
        F.when(~weak, F.col("complaint_text")).when(weak, photo).alias("summary"),
        F.when(~weak, F.lit("text"))
        .when(weak & photo.isNotNull(), F.lit("image"))
        .otherwise(F.lit("none"))
        .alias("summary_source"),
    )
