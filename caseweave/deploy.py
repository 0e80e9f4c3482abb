"""Makes the package importable in Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: Bytes sent to Python at once.  A worker holds a batch several times over, and the texts
#: of as many rows can have any length.
BATCH_BYTES = 4 << 20
_SETTING, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the bytes of a batch in a session that left them at their default."""
    if spark.conf.get(_SETTING) in (str(_DEFAULT), f"{_DEFAULT}b"):
        spark.conf.set(_SETTING, str(BATCH_BYTES))


def ensure_on_workers(spark: SparkSession | None = None) -> None:
    """Bound what workers get at once, and send the package along with the job, once per application.

    Workers need it for the vectorised functions; a job submitted with the
    package in ``--py-files`` has it already and loses nothing.
    """
    spark = spark or SparkSession.active()
    bound_batches(spark)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="caseweave-")) / "caseweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
