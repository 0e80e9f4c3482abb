"""Small helpers for expressions that stay inside Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.sources.tables import estimated_bytes


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it as often as ``body`` likes.

    Catalyst inlines a projected column into a lambda that mentions it once,
    and a lambda runs once per element, so a costly array would be built again
    for each of its elements.  A lambda variable is a value and can't be inlined.
    """
    return F.transform(F.array(value), body)[0]


def whole_text(name: str) -> Column:
    """The whole text of a row; a null counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


UNKNOWN_SIZE = 1 << 60


def text_bytes(rows: DataFrame, column: str) -> int:
    """About how large a table is: its files, or where Spark has no idea, its texts."""
    size = estimated_bytes(rows)
    if size < UNKNOWN_SIZE:
        return size
    return rows.agg(F.sum(F.octet_length(column))).first()[0] or 0


def _step_of(count: Column) -> Column:
    """Counts in a few thousand ascending steps, each count up to 4096 in one of its own."""
    return F.when(count <= 4096, count).otherwise(4096 + F.floor(256 * F.log2(count / 4096.0))).cast("long")


def most_frequent(rows: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the highest counts, at most ``most`` of them: all from some count on.

    No order of rows is needed, and a row per step of counts comes to the driver.
    """
    least, room = 1 << 62, most
    for r in rows.groupBy(_step_of(F.col(count)).alias("step")).count().orderBy(F.desc("step")).collect():
        if r["count"] > room:
            break
        least, room = r["step"], room - r["count"]
    return rows.where(_step_of(F.col(count)) >= least)


HOT_SHARE = 1024


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, found: str) -> DataFrame:
    """Left join of rows with the groups they belong to, however large one group is.

    ``groups`` has one row per key with the number of rows it has (``size``) and a
    struct ``found``.  Groups over one row in HOT_SHARE are fewer than HOT_SHARE,
    so they are broadcast; their rows then look for nothing in the shuffled join
    and are dealt out at random by it.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.where(F.col(size) * HOT_SHARE > total).select(*keys, F.col(found).alias("_hot"))
    cold = groups.where(F.col(size) * HOT_SHARE <= total).select(*keys, F.col(found).alias("_cold"))
    first, *others = keys
    probed = rows.join(F.broadcast(hot), keys, "left")
    answered = F.col("_hot").isNotNull()
    spread = probed.withColumns(
        {
            f"_{first}": F.when(answered, F.xxhash64(*rows.columns, F.monotonically_increasing_id())).otherwise(F.col(first)),
            **{f"_{k}": F.when(~answered, F.col(k)) for k in others},
        }
    )
    cold = cold.withColumnsRenamed({k: f"_{k}" for k in keys})
    joined = spread.join(cold, [f"_{k}" for k in keys], "left")
    return joined.select(*rows.columns, F.coalesce("_hot", "_cold").alias(found))
