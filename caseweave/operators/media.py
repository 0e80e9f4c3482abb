"""Which photos still have to be summarised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.functions import text as tx
from caseweave.operators.worklist import only, pending
from caseweave.sources.requests import with_object_id


def image_candidates(cases: DataFrame) -> DataFrame:
    url = F.col("media_url")
    return cases.select("service_request_id", "media_url").filter(
        tx.is_present(url) & tx.is_image_url(url)
    )


def todo_from_urls(cases: DataFrame, fallback: DataFrame, done: DataFrame) -> DataFrame:
    """Fallback cases with an image URL and no summary yet."""
    wanted = only(image_candidates(cases), fallback)
    return pending(wanted, done).select("service_request_id", F.col("media_url").alias("url"))


def object_lookup(objects: DataFrame, fallback: DataFrame) -> DataFrame:
    """Stored objects that belong to a fallback case."""
    return only(with_object_id(objects), fallback)


def todo_from_objects(objects: DataFrame, fallback: DataFrame, done: DataFrame) -> DataFrame:
    """As ``todo_from_urls`` for stored objects; one object per case.

    Two paths may end in the same digits; the first by name is taken.
    """
    waiting = pending(object_lookup(objects, fallback), done)
    return waiting.groupBy("service_request_id").agg(F.min("uri").alias("uri"))


def download_manifest(
    cases: DataFrame, cohort: DataFrame, prefix: str = "images/"
) -> DataFrame:
    """Images to fetch for the cohort and the object key each goes to."""
    return only(image_candidates(cases), cohort).withColumn(
        "object_key", F.concat(F.lit(prefix), F.col("service_request_id"), F.lit(".jpg"))
    )
