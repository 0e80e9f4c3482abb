"""Exact nearest-neighbour search of many queries in a catalog.

A catalog below a checked byte size goes to every executor once and each query
is answered in place: no shuffle, and only the query vector crosses to Python.
A larger catalog of vectors is indexed (``vector_index``), and a query only meets
the cells that can hold one of its nearest rows.  A larger catalog of token lists is
cut into blocks and the queries into chunks; every (chunk, block) cell is one
bounded group, cells keep ``k`` rows per query, and a last step merges them.  All ways
give the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.deploy import ensure_on_workers
from caseweave.operators import vector_index
from caseweave.operators.lookup import measured_bytes
from caseweave.sinks.staging import stage
from caseweave.functions.nearest import (
    CANDIDATE,
    CANDIDATES_DDL,
    TokenBlock,
    VectorBlock,
    top_candidates,
)

MAX_BROADCAST_BYTES = 64 << 20
CHUNK_BYTES = 32 << 20

_ROW = "_query_row"
_BLOCKS = {"vector": VectorBlock, "tokens": TokenBlock}


def nearest(
    queries: DataFrame,
    catalog: DataFrame,
    k: int = fv.NEIGHBOURS,
    *,
    query_id: str = "service_request_id",
    query_on: str = "embedding",
    base_id: str = "policy_id",
    base_on: str = "embedding",
    base_label: str | None = None,
    compare: str = "vector",
    into: str = "candidates",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    probes: int | None = None,
) -> DataFrame:
    """Add an array of the ``k`` nearest catalog rows, nearest first.

    ``compare`` is ``vector`` for numeric arrays or ``tokens`` for token arrays.
    Rows without a usable vector get an empty array.  Above the bound rows are
    told apart by a number of their own, so null and repeated query ids get the
    same answers as below it; ``query_id`` is not needed for the search.  ``probes``
    limits the cells of the index that a query looks into, at the price of missed rows.
    """
    label = F.col(base_label) if base_label else F.lit(None)
    base = catalog.select(
        F.col(base_id).cast("string").alias("base_id"),
        label.cast("string").alias("base_label"),
        F.col(base_on).alias("base_on"),
    )
    ensure_on_workers(queries.sparkSession)
    size = _extent(base, compare)
    if size <= max_broadcast_bytes:
        return _in_place(queries, base, k, query_on, compare, into)
    if compare == "vector":
        index = vector_index.build(base, cell_bytes=max_broadcast_bytes // 8 + 1)
        # Staged once: what made the query vectors is not asked again, and a row keeps its number.
        queries = stage(queries.withColumn(_ROW, F.monotonically_increasing_id()), "queries")
        asked = queries.select(F.col(_ROW).alias("row"), F.col(query_on).alias("vector"))
        found = vector_index.search(index, asked, k, probes, chunk_bytes)
        return _answered(queries, found, "row", into)
    return _by_cells(
        queries, base, k, query_on, compare, into,
        block_count(size, max_broadcast_bytes, compare), chunk_bytes,
    )


def block_count(size: int, bound: int, compare: str) -> int:
    """Blocks that keep each below the bound.

    A block with one row in B holds a share of 1 / B of the vectors, but of
    1 / B ** 2 of a matrix of rows and tokens.
    """
    needed = -(-size // bound)
    return needed if compare == "vector" else isqrt(needed - 1) + 1


def _extent(base: DataFrame, compare: str) -> int:
    """Bytes the catalog would take as a matrix on an executor."""
    seen = base.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.size("base_on")), F.lit(0)).alias("cells"),
        F.coalesce(
            F.sum(F.octet_length("base_id") + F.coalesce(F.octet_length("base_label"), F.lit(0))),
            F.lit(0),
        ).alias("names"),
    ).first()
    # A token block is rows x distinct tokens; its token total bounds the latter.
    cells = seen.cells if compare == "vector" else seen.rows * max(seen.cells, 1)
    return 8 * cells + seen.names


def _block(compare: str, base: pa.Table):
    base = base.combine_chunks()
    return _BLOCKS[compare](
        base["base_id"].to_pylist(), base["base_label"].to_pylist(), base["base_on"].combine_chunks()
    )


def _in_place(queries, base, k, query_on, compare, into) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(_block(compare, base.toArrow()))

    @F.arrow_udf(CANDIDATES_DDL)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = shared.value
        for batch in batches:
            yield top_candidates(block, batch, k)

    # Declared non-deterministic only so that filters above do not copy the call.
    return queries.withColumn(into, find.asNondeterministic()(F.col(query_on)))


def _by_cells(
    queries, base, k, query_on, compare, into, blocks: int, chunk_bytes: int
) -> DataFrame:
    # Staged once: what made the query vectors is not asked again, and a row keeps its number.
    queries = stage(queries.withColumn(_ROW, F.monotonically_increasing_id()), "queries")
    # Every query goes to each block and every base row to each chunk, so chunks
    # are as large as a task can hold.
    sent = queries.agg(F.sum(F.size(query_on)) * (8 if compare == "vector" else 16)).first()[0] or 0
    chunks = max(-(-sent // chunk_bytes), 1)
    query_id = _ROW

    def spread(df, own, own_n, other, other_n):
        return df.withColumn(own, F.pmod(F.xxhash64(df.columns[0]), F.lit(own_n))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)).cast("array<bigint>"))
        )

    left = spread(
        queries.select(F.col(query_id).alias("query_id"), F.col(query_on).alias("query_on")),
        "chunk", chunks, "block", blocks,
    )
    right = spread(base, "block", blocks, "chunk", chunks)

    def cell(wanted: pa.Table, held: pa.Table) -> pa.Table:
        found = pa.array([], pa.list_(CANDIDATE))
        if wanted.num_rows and held.num_rows:
            found = top_candidates(
                _block(compare, held), wanted["query_on"].combine_chunks(), k
            )
            ids = wanted["query_id"].combine_chunks()
        else:
            ids = wanted["query_id"].slice(0, 0).combine_chunks()
        return pa.table({"query_id": ids, "found": found})

    parts = (
        left.groupBy("chunk", "block")
        .cogroup(right.groupBy("chunk", "block"))
        .applyInArrow(cell, f"query_id bigint, found {CANDIDATES_DDL}")
        .select("query_id", F.inline("found"))
    )
    order = Window.partitionBy("query_id").orderBy("distance", "base_id")
    best = parts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    return _answered(queries, best, "query_id", into)


def _answered(queries: DataFrame, found: DataFrame, number: str, into: str) -> DataFrame:
    """``queries`` with the found rows of each as an array, nearest first."""
    merged = (
        found.groupBy(number)
        .agg(F.sort_array(F.collect_list(F.struct("distance", "base_id", "base_label"))).alias("_c"))
        .select(
            F.col(number).alias(_ROW),
            F.transform(
                "_c",
                lambda c: F.struct(
                    c["base_id"].alias("base_id"),
                    c["base_label"].alias("base_label"),
                    c["distance"].alias("distance"),
                ),
            ).alias(into),
        )
    )
    return (
        queries.join(merged, _ROW, "left")
        .withColumn(into, F.coalesce(F.col(into), F.array().cast(CANDIDATES_DDL)))
        .drop(_ROW)
    )


def as_rows(with_candidates: DataFrame, keep: list[str], into: str = "candidates") -> DataFrame:
    """One row per query and candidate."""
    return with_candidates.select(*keep, F.inline(into))


def vector_topk(
    queries: DataFrame,
    catalog: DataFrame,
    k: int = fv.NEIGHBOURS,
    **settings,
) -> DataFrame:
    """Candidate table: case, its theme and summary, policy, its text and the distance."""
    found = nearest(queries, catalog, k, base_label="target_theme", **settings)
    rows = as_rows(found, ["service_request_id", F.col("theme").alias("case_theme"), "summary"])
    return with_policy(rows.withColumnRenamed("base_id", "policy_id"), catalog).select(
        "service_request_id", "case_theme", "summary", "policy_id", "policy_title",
        "policy_snippet", "target_theme", "source_url",
        F.col("distance").alias("cosine_distance"),
    )


def with_policy(
    rows: DataFrame,
    catalog: DataFrame,
    how: str = "inner",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Policy text by id.

    One policy may win a large share of all rows, so a catalog whose texts
    measure below the bound is broadcast and the rows stay where they are.  A
    larger one is joined by a shuffle in which adaptive execution splits the
    partitions of hot ids.
    """
    texts = catalog.select(
        F.col("policy_id").cast("string").alias("policy_id"),
        F.col("title").alias("policy_title"),
        F.col("chunk_text").alias("policy_snippet"),
        "target_theme",
        "source_url",
    )
    if measured_bytes(texts) <= max_broadcast_bytes:
        return rows.join(F.broadcast(texts), "policy_id", how)
    joined = rows.filter(F.col("policy_id").isNotNull()).join(texts, "policy_id", how)
    if how == "inner":
        return joined
    # Rows without a policy have nothing to look up and would all meet in one task.
    without = rows.filter(F.col("policy_id").isNull())
    return joined.unionByName(without, allowMissingColumns=True)
