"""Documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

1. Every text gets a MinHash signature; texts of the same words collapse to one.
2. Signatures are cut into bands; texts that agree on a band are candidates.  A band
   value that many texts share is cut into blocks, and each pair of blocks is one
   cell, so that no task gets a whole group and no pair ever becomes a row.
3. In a cell, pairs are compared some MinHash values at a time and dropped as soon as
   the posterior probability of reaching the threshold is below a tolerance.
4. What is left is verified on the whole shingle sets, again cell by cell, with one
   output row per text: its number of links and the smallest text it hangs on.
5. Links are joined to classes by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from caseweave.llm.components import components
from caseweave.llm.hashing import U64, in_batches, mix, runs_of
from caseweave.llm.native import join_groups, whole_text
from caseweave.llm.runs import by_runs
from caseweave.llm.spans import words_of
from caseweave.llm.workers import prepare, tidy
from caseweave.sinks.staging import stage
from caseweave.sources.tables import estimated_bytes

GRAM = 5
THRESHOLD = 0.8
#: A pair at the threshold agrees on no band once in twenty million.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
#: A pair is dropped when the chance that it reaches the threshold is below this.
TOLERANCE = 1e-7
BLOCK = 1024
PIECE = 1 << 17
SMALL_LIST = 64 << 20


@cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    odd = rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


@cache
def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For n = STEP, 2 STEP, ... compared values: how many must agree to go on.

    The prior is uniform on 0 to 1, so the posterior after m of n agreements is
    a beta distribution, integrated here on a fine grid.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    above = s >= threshold
    needed = []
    for n in range(STEP, HASHES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        logs = m * np.log(s) + (n - m) * np.log1p(-s)
        density = np.exp(logs - logs.max(axis=1, keepdims=True))
        chance = density[:, above].sum(axis=1) / density.sum(axis=1)
        needed.append(int(np.argmax(chance >= tolerance)))
    return np.array(needed)


def shingles(texts: list[str], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in text order, and where each text's start (and the end).

    Words are lower-cased runs without white space; a text of fewer words than
    ``gram`` is one shingle, and one without words has none.
    """
    words, bounds = words_of([t.lower() for t in texts])
    sizes = np.diff(bounds)
    many = np.where(sizes >= gram, sizes - gram + 1, (sizes > 0).astype(np.int64))
    ends = np.cumsum(many)
    starts = ends - many
    out = np.empty(int(ends[-1]) if len(ends) else 0, U64)
    runs = runs_of(words, gram)
    full = sizes >= gram
    of = np.repeat(np.arange(len(texts)), np.where(full, many, 0))
    at = np.arange(len(of)) - np.repeat(np.cumsum(np.where(full, many, 0)) - np.where(full, many, 0), np.where(full, many, 0))
    out[starts[of] + at] = runs[bounds[:-1][of] + at]
    for i in np.flatnonzero((sizes > 0) & ~full):
        piece = words[bounds[i] : bounds[i + 1]]
        out[starts[i]] = runs_of(piece, len(piece))[0]
    return out, np.append(starts, len(out))


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HASHES 16-bit MinHash values for each text that has shingles, as rows."""
    odd, flips = _multipliers()
    owners = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(owners), HASHES), np.uint16)
    base = (hashes >> U64(32)).astype(np.uint32)
    first = 0
    while first < len(owners):  # pieces that stay in the processor's cache
        last = max(first + 1, int(np.searchsorted(bounds[owners], bounds[owners[first]] + PIECE)))
        last = min(last, len(owners))
        low, high = bounds[owners[first]], bounds[owners[last - 1] + 1]
        x, cuts = base[low:high], bounds[owners[first:last]] - low
        y = np.empty_like(x)
        for j in range(HASHES):
            np.bitwise_xor(x, flips[j], out=y)
            np.multiply(y, odd[j], out=y)
            least = np.minimum.reduceat(y, cuts)
            out[first:last, j] = (least ^ (least >> np.uint32(16))).astype(np.uint16)
        first = last
    return out


def _sum_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _signed(texts: list[str]) -> pd.DataFrame:
    hashes, bounds = shingles(texts)
    many = np.diff(bounds)
    # The order counts: each shingle is mixed with its place.
    place = np.arange(len(hashes), dtype=U64) - np.repeat(bounds[:-1], many).astype(U64)
    k1 = _sum_by_text(mix(hashes + place * U64(0x9E3779B97F4A7C15)), bounds)
    k2 = _sum_by_text(mix((hashes ^ U64(0x5851F42D4C957F2D)) + place * U64(0xD1342543DE82EF95)), bounds)
    blobs: list[bytes | None] = [None] * len(texts)
    for row, i in zip(signatures(hashes, bounds), np.flatnonzero(many), strict=True):
        blobs[i] = row.tobytes()
    return pd.DataFrame(
        {"many": many.astype(np.int32), "k1": k1.view(np.int64), "k2": k2.view(np.int64), "sig": blobs}
    )


def signature_of(text: Column) -> Column:
    """A struct (many, k1, k2, sig) per text; k1 and k2 tell apart texts with different words."""
    prepare()

    @pandas_udf("many int, k1 bigint, k2 bigint, sig binary")
    @tidy
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            yield pd.concat([_signed(texts[a:b]) for a, b in in_batches(texts)], ignore_index=True)

    return sign(text)


def shingle_set(text: Column) -> Column:
    """The distinct shingle hashes of a text, sorted, as 64-bit numbers in a binary."""
    prepare()

    @pandas_udf("binary")
    @tidy
    def collect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, sets = batch.tolist(), []
            for low, high in in_batches(texts):
                hashes, bounds = shingles(texts[low:high])
                sets += [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pd.Series(sets)

    return collect(text)


def band_keys(sig: Column) -> Column:
    """One number per band of a signature."""
    width = 2 * ROWS
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(b.cast("int").alias("band"), F.xxhash64(b, F.substring(sig, b * width + 1, F.lit(width))).alias("key")),
    )


def _pairs(groups: np.ndarray, sides: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) inside runs of equal groups, except pairs that another cell has.

    A cell of two different blocks only pairs across them (sides 0 and 1); in a
    cell of one block (side 2) all are paired.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    alive = np.arange(len(groups))
    for step in range(1, len(groups)):
        alive = alive[alive + step < len(groups)]
        alive = alive[groups[alive] == groups[alive + step]]
        if not len(alive):
            break
        cross = alive[(sides[alive] == 2) | (sides[alive] != sides[alive + step])]
        held.append((cross, cross + step))
        size += len(cross)
        if size > 50_000:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def surviving(
    sigs: np.ndarray, bands: np.ndarray, groups: np.ndarray, sides: np.ndarray, needed: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that the incremental comparison keeps; each in the first band it agrees on."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j in _pairs(groups, sides):
        matches = np.zeros(len(i), np.int32)
        for step, least in enumerate(needed):
            part = slice(step * STEP, (step + 1) * STEP)
            matches += (sigs[i, part] == sigs[j, part]).sum(axis=1)
            go_on = matches >= least
            i, j, matches = i[go_on], j[go_on], matches[go_on]
        agree = (sigs[i] == sigs[j]).reshape(len(i), BANDS, ROWS).all(axis=2)
        here = agree.argmax(axis=1) == bands[i]
        left.append(i[here])
        right.append(j[here])
    return np.concatenate(left), np.concatenate(right)


def verify(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each pair of sets reaches the threshold, by counting common elements."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, often = np.unique(every, return_inverse=True, return_counts=True)
    shared = often[column] > 1  # what only one set has is in no intersection
    renumber = np.cumsum(often > 1) - 1
    owner, column = owner[shared], renumber[column[shared]]
    common = np.zeros(len(left), np.int64)
    width = max(1, min(4096, (8 << 20) // len(sets)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int((often > 1).sum()), width):
        part = slice(*np.searchsorted(column, [low, low + width]))
        has = np.zeros((len(sets), width), np.float32)
        has[owner[part], column[part] - low] = 1
        if len(left) > len(sets):
            common += (has @ has.T)[left, right].astype(np.int64)
        else:
            common += np.einsum("ij,ij->i", has[left], has[right]).astype(np.int64)
    sizes = np.array([len(s) for s in sets])
    union = sizes[left] + sizes[right] - common
    return common >= threshold * union - 1e-9


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index in each index's component."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if np.array_equal(root, before):
            return root


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: id, class_id, copy_id, n_links, n_text_links.

    ``copy_id`` is the smallest id of the rows with the same words in the same
    order (case and white space aside), ``class_id`` the smallest id reached over
    links of ``threshold`` or more.  ``n_text_links`` counts the other texts that
    a row is linked with, ``n_links`` the other rows, copies included.

    Null and empty texts and texts without words are alone: their ids are their
    own and their counts 0.  Repeated rows are copies of each other; an id that
    stands for several texts has the links of one of them.  Rows with a null id
    are linked to nothing and get null ids and counts 0.  An empty table
    gives an empty result; other columns play no part.
    """
    needed = least_matches(threshold, tolerance)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("body"))
    signed = stage(
        rows.where("id is not null").select("id", signature_of(F.col("body")).alias("s")).select("id", "s.*"),
        "near-signatures",
    )
    worded = signed.where("many > 0")
    copies = stage(
        worded.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "near-copies"
    )
    chosen = copies.select(F.col("rep").alias("id"), F.col("k1").alias("r1"), F.col("k2").alias("r2"), "copies")
    one = chosen.groupBy("id").agg(F.min(F.struct("r1", "r2", "copies")).alias("one")).select("id", "one.*")
    reps = worded.join(one, "id").where("k1 = r1 and k2 = r2").dropDuplicates(["id"])
    reps = stage(reps.select("id", "copies", "sig"), "near-reps")
    banded = reps.select("id", F.inline(band_keys(F.col("sig"))))
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    cells = (
        banded.join(shared, "key")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
            "band",
            "id",
        )
        .join(reps.select("id", "copies", "sig"), "id")
    )

    @tidy
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_runs(batches, "cell"):
            sigs = np.frombuffer(b"".join(batch["sig"]), np.uint16).reshape(len(batch), HASHES)
            cell, ids = batch["cell"].to_numpy(), batch["id"].to_numpy()
            left, right = surviving(sigs, batch["band"].to_numpy(), cell, batch["side"].to_numpy(), needed)
            if not len(left):
                continue
            order = np.argsort(left, kind="stable")
            left, right = left[order], right[order]
            used = np.union1d(left, right)
            cuts = np.searchsorted(left, [used, used + 1])
            yield pd.DataFrame(
                {
                    "cell": cell[used],
                    "id": ids[used],
                    "copies": batch["copies"].to_numpy()[used],
                    "partners": [ids[right[a:b]] for a, b in cuts.T],
                }
            )

    parts = cells.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = cells.repartition(int(parts), "cell").sortWithinPartitions("cell", "id")
    kept = stage(
        dealt.select("cell", "side", "band", "id", "copies", "sig").mapInPandas(
            compare, "cell bigint, id bigint, copies bigint, partners array<bigint>"
        ),
        "near-candidates",
    )

    @tidy
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_runs(batches, "cell"):
            batch = batch.drop_duplicates(["cell", "id"])  # rows that the table repeats
            cuts = np.flatnonzero(np.diff(batch["cell"].to_numpy())) + 1
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                ids = batch["id"].to_numpy()[a:b]
                copies = batch["copies"].to_numpy()[a:b]
                partners = batch["partners"].iloc[a:b]
                left = np.repeat(np.arange(b - a), [len(p) for p in partners])
                right = np.searchsorted(ids, np.concatenate(list(partners)).astype(np.int64))
                sets = [np.frombuffer(s, U64) for s in batch["shingles"].iloc[a:b]]
                true = verify(sets, left, right, threshold)
                left, right = left[true], right[true]
                if not len(left):
                    continue
                both, other = np.concatenate([left, right]), np.concatenate([right, left])
                links = np.bincount(both, minlength=b - a)
                linked = np.bincount(both, copies[other], minlength=b - a).astype(np.int64)
                roots = _roots(b - a, left, right)
                used = np.flatnonzero(links)
                out.append((ids[used], links[used], linked[used], ids[roots[used]]))
            if out:
                yield pd.DataFrame(
                    {k: np.concatenate(v) for k, v in zip(("id", "texts", "rows", "root"), zip(*out, strict=True), strict=True)}
                )

    bound = kept if estimated_bytes(kept) > SMALL_LIST else F.broadcast(kept)
    filled = rows.join(bound, "id").select(
        "cell", "id", "copies", "partners", shingle_set(F.col("body")).alias("shingles")
    )
    filled = filled.repartition(int(parts), "cell").sortWithinPartitions("cell", "id")
    linked = stage(
        filled.mapInPandas(confirm, "id bigint, texts bigint, rows bigint, root bigint"), "near-links"
    )
    roots = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("id").agg(F.sum("texts").alias("texts"), F.sum("rows").alias("linked"))
    groups = (
        copies.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counts.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "k1",
            "k2",
            F.col("copies").alias("size"),
            F.struct(
                F.coalesce("root", "rep").alias("class_id"),
                F.col("rep").alias("copy_id"),
                (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("texts", F.lit(0)).alias("n_text_links"),
            ).alias("found"),
        )
    )
    keyed = signed.withColumn("k1", F.when(F.col("many") > 0, F.col("k1")).otherwise(F.col("id")))
    answered = join_groups(keyed.select("id", "many", "k1", "k2"), groups, ["k1", "k2"], "size", "found")
    nobody = rows.where("id is null").select("id", F.lit(0).alias("many"), F.lit(None).alias("found"))
    every = answered.select("id", "many", F.when(F.col("many") > 0, F.col("found")).alias("found")).unionByName(
        nobody.withColumn("found", F.lit(None).cast(answered.schema["found"].dataType))
    )
    return every.select(
        F.col("id").alias(id_col),
        F.coalesce("found.class_id", "id").alias("class_id"),
        F.coalesce("found.copy_id", "id").alias("copy_id"),
        F.coalesce("found.n_links", F.lit(0)).alias("n_links"),
        F.coalesce("found.n_text_links", F.lit(0)).alias("n_text_links"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names: of
    each class the row with the smallest id.

    Where ids are null or repeat, rows are ordered by id, null ones last, and then by a hash
    of the text, and each is a document of its own.  Null and empty texts and
    texts without words stay.  An empty table gives an empty result.
    """
    packed = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        F.col(id_col).cast("long").alias("key"),
        F.col(text_col).alias("body"),
    )
    if not packed.groupBy("key").count().where("count > 1 or key is null").isEmpty():
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        order = [F.col("key").asc_nulls_last(), F.xxhash64("body")]
        dealt = packed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        # Partitions follow each other as the ids do, so the numbers rise with them.
        packed = stage(dealt.withColumn("key", F.monotonically_increasing_id()), "near-rows")
    gone = (
        near_classes(packed, "key", "body", **options)
        .where(F.col("class_id") != F.col("key"))
        .select("key")
        .distinct()
    )
    gone = stage(gone, "near-gone")
    small = F.broadcast(gone) if estimated_bytes(gone) < SMALL_LIST else gone
    return packed.join(small, "key", "left_anti").select("row.*")
