"""Text cleaning and the quality gate.  Map-only: one scan, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions import text as tx


def prepare(
    cases: DataFrame,
    phrases=fv.BOILERPLATE_PHRASES,
    min_length: int = fv.MIN_TEXT_LENGTH,
    stop=fv.STOP_TEXTS,
) -> DataFrame:
    """Cleaned text and quality flags of every case, side by side.

    The quality gate judges the raw text; boilerplate is only removed for the
    cleaned text.  A text that is all boilerplate therefore passes the gate and
    still gets the placeholder.
    """
    raw = F.coalesce("request_details", "request_type")
    flagged = cases.select(
        "service_request_id",
        "request_type",
        "media_url",
        raw.alias("_raw"),
        tx.flatten_spaces(raw).alias("text_norm"),
    )
    # Few texts hold boilerplate; the others are flattened once for both uses.
    raw = F.col("_raw")
    stripped = tx.flatten_spaces(tx.strip_boilerplate(raw, phrases))
    staged = flagged.withColumn(
        "_body",
        F.when(tx.may_have_boilerplate(raw, phrases), stripped).otherwise(F.col("text_norm")),
    )
    note = F.concat(
        F.lit("("),
        tx.title_case(F.coalesce("request_type", F.lit(fv.DEFAULT_REQUEST_TYPE))),
        F.lit(") " + fv.NO_TEXT_NOTE),
    )
    body = F.col("_body")
    readable = F.when(tx.is_weak(body, min_length, stop), note).otherwise(tx.as_sentence(body))
    return staged.select(
        "service_request_id",
        "request_type",
        "media_url",
        "text_norm",
        tx.is_present(F.col("media_url")).alias("has_media"),
        tx.is_weak(raw, min_length, stop).alias("is_bad_text"),
        raw.isNotNull().alias("has_text"),
        F.when(raw.isNotNull(), readable).alias("complaint_text"),
    )


def clean_text(cases: DataFrame, **settings) -> DataFrame:
    """Readable complaint text per case; cases without any text are dropped."""
    return cleaned_of(prepare(cases, **settings))


def text_quality(cases: DataFrame, **settings) -> DataFrame:
    """Flattened text, whether media is at hand and whether the text is unusable."""
    return quality_of(prepare(cases, **settings))


def cleaned_of(prepared: DataFrame) -> DataFrame:
    return prepared.filter("has_text").select("service_request_id", "complaint_text")


def quality_of(prepared: DataFrame) -> DataFrame:
    return prepared.drop("complaint_text", "has_text")
