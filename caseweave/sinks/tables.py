"""Table lifecycle: snapshots, views and append-only state.

A snapshot is a view on the newest of its version tables, so it is replaced by
one change of the catalog after all rows are written; whoever reads it meanwhile
reads the old version, also when the write fails.  The tasks that write it count its
rows, and the view keeps that number (``written_rows``), so nobody has to read it for that.

Rows for append-only state are written to the shared folder first.  What was
written there and not appended because a job died is appended by the next one
(``recover``), each row once.  A state table has one writer at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave.sinks.staging import shared_folder

#: Versions of a snapshot that are kept: the current one, and the one that readers may still be at.
KEPT_VERSIONS = 2
_VERSION = "__v"
_DONE, _APPENDED = "_SUCCESS", "_APPENDED"
_COUNTED = "caseweave.counted."


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PHOTO_SUMMARIES = _strings("service_request_id", "summary_text")
TRIAGE_RESULTS = _strings(
    "service_request_id", "summary", "summary_source", "triage_result", "status"
)
REFINED_ACTIONS = _strings(
    "service_request_id", "summary", "summary_source", "theme", "severity",
    "original_action", "policy_title", "policy_snippet", "source_url", "refined_action",
    "alignment",
)


def with_outcome(schema: T.StructType) -> T.StructType:
    """A state schema with what tells an answered prompt from a failed or an outdated one."""
    extra = [c for c in ("status", "prompt_hash") if c not in schema.fieldNames()]
    return T.StructType([*schema.fields, *_strings(*extra).fields])


def replace_table(
    df: DataFrame, name: str, bucket_by: tuple[int, str] | None = None, **counts: Column
) -> DataFrame:
    """Create or replace a snapshot; its schema is that of the DataFrame, which may
    itself read the snapshot.

    Bucketing by the case id lets later joins on it skip their shuffle.  ``counts``
    are further aggregates to take while rows are written; see ``written_rows``.
    """
    spark = df.sparkSession
    version = f"{name}{_VERSION}{time.time_ns():020d}"
    if bucket_by:
        # Dealt out like the buckets, so that each is one file.
        df = df.repartition(*bucket_by)
    # On top of the plan: a task that is run again counts once.
    seen = Observation()
    taken = {"rows": F.count(F.lit(1)), **counts}
    writer = _bucketed(df.observe(seen, *(c.alias(n) for n, c in taken.items())), bucket_by)
    try:
        writer.saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a table of an earlier layout
    numbers = ", ".join(f"'{_COUNTED}{n}' = '{v}'" for n, v in seen.get.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({numbers}) AS SELECT * FROM {version}")
    for old in _versions(spark, name)[:-KEPT_VERSIONS]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)


def _bucketed(df: DataFrame, bucket_by: tuple[int, str] | None):
    writer = df.write.format("parquet")
    return writer.bucketBy(*bucket_by).sortBy(bucket_by[1]) if bucket_by else writer


def written_rows(spark: SparkSession, name: str, which: str = "rows") -> int:
    """How many rows a snapshot has, as counted by the tasks that wrote it."""
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return int(held[_COUNTED + which])


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Version tables of a snapshot, the oldest first."""
    database, _, table = name.rpartition(".")
    try:
        found = spark.catalog.listTables(database or None, f"{table}{_VERSION}*")
    except AnalysisException:  # no such database
        return []
    names = sorted(t.name for t in found if t.name[len(table) + len(_VERSION) :].isdigit())
    return [f"{database}.{n}" if database else n for n in names]


def replace_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, bucket_by: tuple[int, str] | None = None
) -> DataFrame:
    """Create an empty table with the declared schema unless it is there.

    State that is bucketed by the case id is never shuffled to meet new work,
    however much it has grown.  A table that is there keeps the layout it has.
    """
    if not spark.catalog.tableExists(name):
        _bucketed(spark.createDataFrame([], schema), bucket_by).mode("ignore").saveAsTable(name)
    return spark.table(name)


def _bucket_by(spark: SparkSession, name: str) -> tuple[int, str] | None:
    """Number of buckets and column of a table that was made by ``ensure_table``."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in said:
        return None
    return int(said["Num Buckets"]), said["Bucket Columns"].strip("[]`")


def append(df: DataFrame, name: str) -> None:
    """Append by column name: order in ``df`` does not matter, extras are left out.

    ``insertInto`` alone goes by position and would mix columns up silently.  Rows are
    kept in the shared folder until they are in the table; see ``recover``.
    """
    spark = df.sparkSession
    path = f"{_waiting(spark, name)}/{uuid.uuid4().hex}"
    df.select(*spark.table(name).columns).write.parquet(path)
    _publish(spark, name, path, spark.read.schema(spark.table(name).schema).parquet(path))


def append_run(df: DataFrame, name: str, run: str) -> bool:
    """Append what a run found, for instance its counts, to a table with a column ``run``,
    unless the table has that run already; tells whether it had not.

    Reports then add up the few rows of all runs and never read old cases again.
    A run is in the table as a whole or not at all, also after a crash.
    """
    spark = df.sparkSession
    tagged = df.withColumn("run", F.lit(run))
    ensure_table(spark, name, tagged.schema)
    recover(spark, name)
    if not spark.table(name).where(F.col("run") == run).isEmpty():
        return False
    append(tagged, name)
    return True


def recover(spark: SparkSession, name: str) -> int:
    """Append what an earlier job had written and not yet appended, without the rows
    that got there; returns how many such writes there were.

    A write that did not end is no answer: its rows are asked for again.
    """
    found = 0
    for path in _children(spark, _waiting(spark, name)):
        marks = {p.rpartition("/")[2] for p in _children(spark, path)}
        if _DONE not in marks or _APPENDED in marks:
            continue
        found += 1
        table = spark.table(name)
        rows = spark.read.schema(table.schema).parquet(path)
        digest = _digest(table.columns)
        there = table.select(digest.alias("_digest"))
        new = rows.withColumn("_digest", digest).join(there, "_digest", "left_anti").drop("_digest")
        _publish(spark, name, path, new)
    return found


def _digest(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _publish(spark: SparkSession, name: str, path: str, rows: DataFrame) -> None:
    rows, bucket_by = rows.select(*spark.table(name).columns), _bucket_by(spark, name)
    (rows.repartition(*bucket_by) if bucket_by else rows).write.insertInto(name)
    _files(spark, path)[0].create(_path(spark, f"{path}/{_APPENDED}")).close()
    spark.catalog.refreshTable(name)


def _waiting(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/appends/{name}"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, whatever store it is in, and the path there."""
    there = _path(spark, path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def _children(spark: SparkSession, path: str) -> list[str]:
    system, there = _files(spark, path)
    return sorted(str(f.getPath()) for f in system.listStatus(there)) if system.exists(there) else []


def copy_table(spark: SparkSession, source: str, target: str) -> DataFrame:
    return replace_table(spark.table(source), target)


def reset(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop snapshots, state tables and views before a rerun, and what waits to be appended."""
    for name in names:
        if spark.catalog.tableExists(name):
            kind = spark.catalog.getTable(name).tableType
            if kind == "TEMPORARY":
                spark.catalog.dropTempView(name)
            elif kind == "VIEW":
                spark.sql(f"DROP VIEW IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        for version in _versions(spark, name):
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        system, there = _files(spark, _waiting(spark, name))
        system.delete(there, True)
