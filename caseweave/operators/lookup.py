"""Join to a table with unique keys when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000
MAX_BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values as text, by a pass over the rows."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint for a table that measures below the bound; the rows are the same."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def lookup(
    rows: DataFrame, table: DataFrame, key: str, uses: str, spread_by: str
) -> DataFrame:
    """Inner join of ``rows`` to ``table`` on ``key``, safe for hot keys.

    ``uses`` counts the rows per key.  Keys used by more rows than a tenth of a
    task's share are hot, so there are fewer than ten per task whatever the data:
    that part is broadcast if it is small, else adaptive execution splits their
    partitions.  The other keys are joined by a shuffle,
    in which rows already answered are spread over all tasks by ``spread_by``.
    ``table`` is read three times and should be staged.
    """
    total = table.agg(F.sum(uses)).first()[0] or 0
    values = [c for c in table.columns if c not in (key, uses)]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(uses) > F.lit(total / max(HOT_KEYS, 10 * tasks))
    packed = F.struct(*values)
    hot = table.filter(is_hot).select(key, packed.alias("_hot"))
    cold = table.filter(~is_hot).select(F.col(key).alias("_cold_key"), packed.alias("_cold"))
    with_hot = rows.join(broadcast_if_small(hot), key, "left").withColumn(
        "_join",
        F.when(
            F.col("_hot").isNotNull(),
            F.concat(F.lit("answered:"), F.xxhash64(spread_by).cast("string")),
        ).otherwise(F.col(key)),
    )
    joined = with_hot.join(cold, F.col("_join") == F.col("_cold_key"), "left")
    return (
        joined.withColumn("_found", F.coalesce("_hot", "_cold"))
        .filter(F.col("_found").isNotNull())
        .select(*rows.columns, *[F.col(f"_found.{v}").alias(v) for v in values])
    )
