"""The small hand-written reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caseweave import fixed_values as fv

POLICY_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("policy_id", "title", "chunk_text", "source_url", "target_theme")
    ]
)


def policy_chunks(spark: SparkSession, rows=fv.POLICIES) -> DataFrame:
    return spark.createDataFrame(list(rows), POLICY_SCHEMA)


def label_taxonomy(spark: SparkSession, labels=fv.LABELS) -> DataFrame:
    return spark.createDataFrame([(label,) for label in labels], "label_value string")
