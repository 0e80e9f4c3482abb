"""An inverted-file index of vectors, for catalogs that are too large to send to every executor.

Catalog rows are filed under the nearest of a set of centroids, and a cell keeps
the largest distance of its rows from the centroid.  Between unit vectors the
triangle inequality holds: a row of a cell is at least as far from a query as the
centroid is, less that radius.  So a query first looks into its nearest cells, which gives
it ``k`` rows, and then only into the cells that can hold a nearer one.  The answer
is that of a search of all rows.  With ``probes`` a query looks into so many
cells, which is quicker and can miss rows; ``recall`` measures how many.

Small cells share a block, and a query is sent to a block once and meets all of its rows.
So where nothing can be skipped, as among vectors without clusters, a query is sent as
often as there are blocks, not cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseweave.deploy import ensure_on_workers
from caseweave.functions.nearest import CANDIDATE, CANDIDATES_DDL, VectorBlock, top_candidates, unit_rows
from caseweave.sinks.staging import stage

#: Bytes of vectors of a cell on average, cells at most, and rows per cell that centroids are learned from.
CELL_BYTES, MAX_CELLS, SAMPLE_PER_CELL = 8 << 20, 4096, 32
ROUNDS = 8
#: Bytes of the vectors that centroids are learned from, at most; the driver holds them a few times over.
SAMPLE_BYTES = 32 << 20
#: Bytes of a block's rows, and of its queries, that meet in one group, and of the cells that share a block.
BLOCK_BYTES, SHARED_BYTES = 32 << 20, 16 << 20
#: Distances from centroids held at once: 8 MB of doubles.
DISTANCES = 1 << 20
#: Far above what rounding can do to a distance, far below what tells distances apart.
MARGIN = 1e-8


@dataclass(frozen=True)
class Index:
    """Staged rows (base_id, base_label, base_on, cell) and what is known of each cell."""

    rows: DataFrame
    centroids: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray


def _away(unit: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors from centroids."""
    squares = 1.0 + (centroids**2).sum(axis=1)[None] - 2.0 * unit @ centroids.T
    return np.sqrt(np.maximum(squares, 0.0))


def _steps(rows: int, centroids: int) -> Iterator[slice]:
    """So many rows at a time that their distances from all centroids take bounded memory."""
    step = max(1, DISTANCES // max(centroids, 1))
    return (slice(start, start + step) for start in range(0, rows, step))


def _nearest(unit: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest centroid and the distance from it."""
    cell, least = np.zeros(len(unit), np.int64), np.zeros(len(unit))
    for part in _steps(len(unit), len(centroids)):
        away = _away(unit[part], centroids)
        cell[part], least[part] = away.argmin(axis=1), away.min(axis=1)
    return cell, least


def learn_centroids(unit: np.ndarray, cells: int, seed: int = 42) -> np.ndarray:
    """k-means on a bounded sample."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(unit, axis=0)
    centroids = distinct[rng.permutation(len(distinct))[:cells]]
    for _ in range(ROUNDS):
        nearest = _nearest(unit, centroids)[0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, unit)
        many = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(many[:, None] > 0, sums / np.maximum(many, 1)[:, None], centroids)
    return centroids


def build(
    base: DataFrame, cells: int | None = None, sample_per_cell: int = SAMPLE_PER_CELL, cell_bytes: int = CELL_BYTES
) -> Index:
    """The index of (base_id, base_label, base_on).  Centroids are learned from a sample
    of about ``sample_per_cell`` rows per cell and SAMPLE_BYTES at most; every row is filed.

    Rows without a usable vector are nowhere near anything and left out.
    """
    ensure_on_workers(base.sparkSession)
    seen = base.agg(F.count("base_on").alias("rows"), F.sum(F.size("base_on")).alias("numbers")).first()
    if cells is None:
        cells = min(MAX_CELLS, max(1, 8 * (seen.numbers or 0) // cell_bytes))
    bytes_per_row = 8 * max(1, (seen.numbers or 0) // max(seen.rows, 1))
    wanted = max(1, min(cells * sample_per_cell, SAMPLE_BYTES // bytes_per_row))
    place = F.pmod(F.xxhash64("base_id", "base_on"), F.lit(max(seen.rows, 1)))
    sample = base.where(F.col("base_on").isNotNull() & (place < 2 * wanted)).orderBy(place, "base_id").limit(wanted)
    picked = sample.select("base_on").toArrow()["base_on"].combine_chunks()
    if not len(picked) and seen.rows:  # few rows, all of which the hash left out
        picked = base.where("base_on IS NOT NULL").limit(wanted).select("base_on").toArrow()["base_on"].combine_chunks()
    unit = unit_rows(picked)[1] if len(picked) else np.zeros((0, 1))
    if not len(unit):
        # Nothing has a direction in the sample: one cell around the origin, which is never skipped.
        dim = int(seen.numbers / seen.rows) if seen.rows else 1
        centroids = np.zeros((1, dim))
    else:
        centroids = learn_centroids(unit, cells)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, unit = unit_rows(batch["base_on"], centroids.shape[1])
            cell, away = _nearest(unit, centroids)
            kept = batch.take(pa.array(rows))
            yield kept.append_column("cell", pa.array(cell.astype(np.int32))).append_column("away", pa.array(away))

    schema = ", ".join(f"{c} {t}" for c, t in base.dtypes) + ", cell int, away double"
    rows = stage(base.mapInArrow(file, schema), "vector-index")
    radius, sizes = np.zeros(len(centroids)), np.zeros(len(centroids), np.int64)
    for r in rows.groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("rows")).collect():
        radius[r["cell"]], sizes[r["cell"]] = r["radius"], r["rows"]
    return Index(rows.drop("away"), centroids, radius, sizes)


def _blocks(index: Index, block_bytes: int) -> np.ndarray:
    """For each cell the first cell of its block.  Cells share a block as long as their rows fit."""
    room = min(block_bytes, SHARED_BYTES) // (8 * index.centroids.shape[1])
    first, held = np.arange(len(index.sizes)), 0
    for cell, size in enumerate(index.sizes):
        if cell and held + size <= room:
            first[cell] = first[cell - 1]
            held += size
        else:
            held = size
    return first


def _first_cells(index: Index, k: int, probes: int | None, blocks: np.ndarray):
    """For each query the blocks of its nearest cells: as many cells as hold ``k`` rows, or ``probes``."""
    used = np.flatnonzero(index.sizes > 0)
    sizes, centroids, block = index.sizes[used], index.centroids[used], blocks[used]

    @F.arrow_udf("array<int>")
    def choose(vectors: pa.Array) -> pa.Array:
        out: list = [[]] * len(vectors)
        if len(used):
            rows, unit = unit_rows(vectors, centroids.shape[1])
            for part in _steps(len(rows), len(used)):
                order = _away(unit[part], centroids).argsort(axis=1, kind="stable")
                held = np.cumsum(sizes[order], axis=1)
                enough = (held < k).sum(axis=1) + 1 if probes is None else np.full(len(order), probes)
                for row, near, many in zip(rows[part], order, enough, strict=True):
                    out[row] = np.unique(block[near[:many]]).tolist()
        return pa.array(out, pa.list_(pa.int32()))

    return choose


def _other_cells(index: Index, blocks: np.ndarray):
    """For each query the blocks it has not seen with a cell that can hold a row within ``reach``."""
    used = np.flatnonzero(index.sizes > 0)
    radius, centroids = index.radius[used], index.centroids[used]
    block, starts = np.unique(blocks[used], return_index=True)

    @F.arrow_udf("array<int>")
    def choose(vectors: pa.Array, seen: pa.Array, reach: pa.Array) -> pa.Array:
        out: list = [[]] * len(vectors)
        if len(used):
            rows, unit = unit_rows(vectors, centroids.shape[1])
            limit = reach.fill_null(np.inf).to_numpy(zero_copy_only=False) + MARGIN
            before = seen.to_pylist()
            for part in _steps(len(rows), len(used)):
                least = np.maximum(_away(unit[part], centroids) - radius, 0.0) ** 2 / 2
                # A block is as near as its nearest cell.
                least = np.minimum.reduceat(least, starts, axis=1)
                for row, bounds in zip(rows[part], least, strict=True):
                    out[row] = sorted(set(block[bounds <= limit[row]].tolist()) - set(before[row]))
        return pa.array(out, pa.list_(pa.int32()))

    return choose


def _look(index: Index, asked: DataFrame, k: int, block_bytes: int) -> DataFrame:
    """(row, base_id, base_label, distance): ``k`` rows at most of each block part that a query looks into.

    ``asked`` has (row, vector, cells), one cell for each block: its first.  A block's rows
    are dealt out to parts and its queries to chunks, so no group grows with either.
    """
    spark = asked.sparkSession
    dim = 8 * index.centroids.shape[1]
    blocks = _blocks(index, block_bytes)
    sizes = np.bincount(blocks, index.sizes, len(blocks)).astype(np.int64)
    pairs = asked.select("row", "vector", F.explode("cells").alias("cell"))
    many = {r["cell"]: r["count"] for r in asked.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()}
    plan = [
        (own, first, int(-(-sizes[first] * dim // block_bytes)), int(-(-many[first] * dim // block_bytes)))
        for own, first in enumerate(blocks.tolist())
        if first in many
    ]
    # A row per cell.
    plan = F.broadcast(spark.createDataFrame(plan, "own int, cell int, parts int, chunks int"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        pairs.join(plan.where("own = cell"), "cell")
        .withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"))
        .withColumn("part", numbers("parts"))
        .select("cell", "part", "chunk", "row", "vector")
    )
    # Blocks that nobody looks into have no row in the plan, so their rows go nowhere.
    right = (
        index.rows.withColumnRenamed("cell", "own").join(plan, "own")
        .withColumn("part", F.pmod(F.xxhash64("base_id", "base_on"), F.col("parts")).cast("int"))
        .withColumn("chunk", numbers("chunks"))
        .select("cell", "part", "chunk", "base_id", "base_label", "base_on")
    )

    def meet(wanted: pa.Table, held: pa.Table) -> pa.Table:
        rows, found = pa.array([], pa.int64()), pa.array([], pa.list_(CANDIDATE))
        if wanted.num_rows and held.num_rows:
            block = VectorBlock(
                held["base_id"].to_pylist(), held["base_label"].to_pylist(), held["base_on"].combine_chunks()
            )
            rows, found = wanted["row"].combine_chunks(), top_candidates(block, wanted["vector"].combine_chunks(), k)
        return pa.table({"row": rows, "found": found})

    key = ["cell", "part", "chunk"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, f"row bigint, found {CANDIDATES_DDL}")
    return met.select("row", F.inline("found"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy("distance", "base_id")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def search(
    index: Index, queries: DataFrame, k: int, probes: int | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(row, base_id, base_label, distance) of the ``k`` nearest rows of each (row, vector)."""
    blocks = _blocks(index, block_bytes)
    first = stage(queries.withColumn("cells", _first_cells(index, k, probes, blocks)(F.col("vector"))), "first-cells")
    found = _best(_look(index, first, k, block_bytes), k)
    if probes is not None:
        return found
    found = stage(found, "first-found")
    # With fewer than k rows found there is no limit yet.
    reach = found.groupBy("row").agg(
        F.when(F.count("*") >= k, F.max("distance")).alias("reach")
    )
    limited = first.join(reach, "row", "left")
    others = stage(
        limited.select("row", "vector", _other_cells(index, blocks)("vector", "cells", "reach").alias("cells")).where(
            F.size("cells") > 0
        ),
        "other-cells",
    )
    return _best(found.unionByName(_look(index, others, k, block_bytes)), k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of ``exact``'s (row, base_id) pairs that ``found`` has."""
    both = exact.select("row", "base_id").join(found.select("row", "base_id", F.lit(1).alias("hit")), ["row", "base_id"], "left")
    return both.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
