"""Reading columnar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, path: str, schema: str | None = None, pieces: int | None = None
) -> DataFrame:
    """A parquet table.  A given schema saves the job that would infer it.

    One row group is one task.  ``pieces`` deals the rows out to so many tasks by
    a shuffle, for callers who know that a table has fewer row groups than cores.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    table = reader.parquet(path)
    return table if pieces is None else table.repartition(pieces)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; for a bare scan the size of the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
