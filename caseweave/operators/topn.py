"""Top-n without one task seeing every task's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(
    df: DataFrame,
    n: int,
    order: Sequence[Column],
    within: Sequence[str] = (),
    lanes: int = 256,
) -> DataFrame:
    """First ``n`` rows by ``order``, per group of ``within`` or overall.

    A task keeps at most ``n`` rows per group before the shuffle.  Those go to
    ``lanes`` lanes, each of which keeps ``n`` again, so the last step gets
    ``lanes * n`` rows per group however many tasks there are and however
    large one group is.  ``order`` must be a total order.
    """
    laned = df.withColumn("_lane", F.spark_partition_id() % lanes)
    by_lane = Window.partitionBy(*within, "_lane").orderBy(*order)
    kept = (
        laned.withColumn("_rank", F.row_number().over(by_lane))
        .filter(F.col("_rank") <= n)
        .drop("_lane", "_rank")
    )
    if not within:
        return kept.orderBy(*order).limit(n)
    by_group = Window.partitionBy(*within).orderBy(*order)
    return (
        kept.withColumn("_rank", F.row_number().over(by_group))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )
