"""Where intermediate results are kept so that lost executors cost little."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="caseweave-")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends at the files,
    and what was costly or not repeatable is never computed a second time."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """As ``stage``, with the number of ``rows`` and further aggregates, taken by the tasks
    that write them: nothing is read again, and a task that is run again counts once."""
    seen = Observation()
    taken = {"rows": F.count(F.lit(1)), **counts}
    staged = stage(df.observe(seen, *(c.alias(n) for n, c in taken.items())), name)
    return staged, seen.get
