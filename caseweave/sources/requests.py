"""Raw service requests and media objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.functions.text import first_group

OBJECT_ID = r"(\d+)\.jpg\z"


def normalise_requests(raw: DataFrame) -> DataFrame:
    """Eight raw columns to the six the job uses; only those are read."""
    return raw.select(
        F.col("unique_key").cast("string").alias("service_request_id"),
        F.col("created_date").alias("requested_datetime"),
        F.coalesce("complaint_type", "category").alias("request_type"),
        F.coalesce("descriptor", "status_notes", "complaint_type").alias("request_details"),
        F.col("agency_name").alias("agency_responsible"),
        "media_url",
    )


def list_objects(spark: SparkSession, folder: str, glob: str = "*.jpg") -> DataFrame:
    """One row per stored file; only the path is kept, so no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.col("path").alias("uri"))
    )


def with_object_id(objects: DataFrame, pattern: str = OBJECT_ID) -> DataFrame:
    """Case id taken from the object name; null when the name holds none."""
    return objects.select("uri", first_group(F.col("uri"), pattern).alias("service_request_id"))
