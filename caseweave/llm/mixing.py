"""Temperature mixing: sources drawn to the weights share ** exponent.

The exponent is the flattest one in [0, 1] that keeps every source within a
repetition limit, or the one that meets a target entropy; it is bisected over
the source totals.  Weights become documents by block permutations: the
documents of a source are dealt to blocks by a hash, every epoch orders the
blocks anew, whole epochs take all blocks, and the last one takes blocks in its
order until the token budget is spent, then documents of the block at the edge.
A document finds its draws from two thresholds of its source, so neither sorting
nor shuffling of texts is needed and a source of any size is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.native import whole_text
from caseweave.sinks.staging import stage
from caseweave.sources.tables import estimated_bytes

MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 20
SECTIONS = 16
ROUNDS = 8
SMALL_SOURCES = 8 << 20
SEED = 42


def word_count(text: Column) -> Column:
    """Words between white space; the token count where no tokenizer is at hand."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null: rows without a source are a source of their own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def find_exponent(
    totals: DataFrame,
    max_repeats: float | None = MAX_REPEATS,
    entropy_bits: float | None = None,
    budget: float | None = None,
) -> float:
    """The smallest exponent whose weights respect the limit or the target.

    ``totals`` has one row per source with its positive ``tokens``.  Both
    repetition and the excess over the entropy target fall as the exponent
    grows, so each round keeps one of SECTIONS intervals.  Without sources, or
    with nothing asked for, the answer is 1 (natural shares).
    """
    whole = totals.agg(F.sum("tokens").cast("double")).first()[0]
    if not whole or (max_repeats is None and entropy_bits is None):
        return 1.0
    share = F.col("tokens") / F.lit(whole)

    def fits(grid: list[float]) -> list[bool]:
        asked = []
        for a in grid:
            raised = F.pow(share, F.lit(a))
            asked += [
                F.sum(raised),
                F.max(raised / F.col("tokens")),
                F.max(F.col("tokens") / raised),
                F.sum(raised * F.log2(share) * a),
            ]
        got = totals.agg(*asked).first()
        answers = []
        for i in range(len(grid)):
            z, most, least, weighted = got[4 * i : 4 * i + 4]
            repeats = most / z * budget if budget is not None else most * least
            entropy = _log2(z) - weighted / z
            limit = max_repeats is None or repeats <= max_repeats * (1 + 1e-12)
            answers.append(limit and (entropy_bits is None or entropy <= entropy_bits))
        return answers

    low, high = 0.0, 1.0
    if fits([0.0])[0]:
        return 0.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / SECTIONS for i in range(1, SECTIONS)]
        first = next((a for a, ok in zip(grid, fits(grid), strict=True) if ok), high)
        low, high = first - (high - low) / SECTIONS, first
    return high


def _log2(x: float) -> float:
    from math import log2

    return log2(x)


def plan_sources(
    rows: DataFrame,
    max_repeats: float | None = MAX_REPEATS,
    entropy_bits: float | None = None,
    budget: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """From (key, id, tokens) rows to one row per source:

    weight, exponent, epochs (whole ones), blocks, edge (the last epoch takes
    blocks ordered before it) and edge_doc (of the block at the edge it takes
    documents ordered up to it; null takes none).
    """
    totals = stage(
        rows.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "mix-totals"
    )
    worded = totals.where("tokens > 0")
    exponent = find_exponent(worded, max_repeats, entropy_bits, budget)
    raised = F.pow(F.col("tokens").cast("double"), F.lit(exponent))
    z, least = worded.agg(F.sum(raised), F.max(F.col("tokens") / raised)).first()
    spent = budget if budget is not None else (z or 0.0) * (least or 0.0)
    quota = F.when(F.col("tokens") > 0, raised / F.lit(z or 1.0) * F.lit(float(spent))).otherwise(0.0)
    sources = (
        totals.withColumn("weight", F.when(F.col("tokens") > 0, raised / F.lit(z or 1.0)).otherwise(0.0))
        # The largest source fills its quota exactly; a rounding error must not cost it an epoch.
        .withColumn("turns", F.when(F.col("tokens") > 0, quota / F.col("tokens") + 1e-9).otherwise(1.0))
        .withColumn("epochs", F.floor("turns").cast("int"))
        .withColumn("rest", F.floor((F.col("turns") - F.col("epochs")) * F.col("tokens")).cast("long"))
        .withColumn("blocks", F.ceil(F.col("tokens") / F.lit(block_tokens)).cast("int") + 1)
        .withColumn("exponent", F.lit(exponent))
    )
    small = _broadcast_if_small(sources.select("key", "blocks", "epochs", "rest"))
    dealt = rows.join(small, "key").withColumn("block", block_of(F.col("id"), F.col("blocks"), seed))
    per_block = dealt.groupBy("key", "epochs", "rest", "block").agg(F.sum("tokens").alias("tokens"))
    by_turn = _running("key", "turn")
    reached = (
        per_block.withColumn("turn", block_turn(F.col("key"), F.col("block"), F.col("epochs"), seed))
        .withColumn("sum", F.sum("tokens").over(by_turn))
        .where(F.col("sum") > F.col("rest"))
        .groupBy("key")
        .agg(F.min(F.struct("turn", "block", (F.col("rest") - F.col("sum") + F.col("tokens")).alias("left"))).alias("at"))
        .select("key", F.col("at.turn").alias("edge"), F.col("at.block").alias("block"), F.col("at.left").alias("left"))
    )
    edges = stage(reached, "mix-edges")
    inside = (
        dealt.join(_broadcast_if_small(edges), ["key", "block"])
        .withColumn("turn", doc_turn(F.col("id"), F.col("epochs"), seed))
        .withColumn("sum", F.sum("tokens").over(_running("key", "turn")))
        .where(F.col("sum") <= F.col("left"))
        .groupBy("key")
        .agg(F.max("turn").alias("edge_doc"))
    )
    return stage(
        sources.join(edges.select("key", "edge"), "key", "left").join(inside, "key", "left"), "mix-sources"
    )


def _running(key: str, order: str):
    from pyspark.sql import Window

    # Rows that tie in the order are taken together.
    return Window.partitionBy(key).orderBy(order).rangeBetween(Window.unboundedPreceding, 0)


def _broadcast_if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if estimated_bytes(df) < SMALL_SOURCES else df


def block_of(id_: Column, blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(id_, F.lit(seed)), blocks.cast("long")).cast("int")


def block_turn(key: Column, block: Column, epoch: Column, seed: int) -> Column:
    """The place of a block in the permutation of an epoch."""
    return F.xxhash64(key, block.cast("int"), epoch.cast("int"), F.lit(seed))


def doc_turn(id_: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(id_, epoch.cast("int"), F.lit(seed + 1))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    tokens_col: str | None = None,
    max_repeats: float | None = MAX_REPEATS,
    entropy_bits: float | None = None,
    budget: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
    columns: list[str] | None = None,
) -> DataFrame:
    """The draws: one row for each time a document is used.

    Returns ``columns`` of the input (its id and source by default) and
    ``mix_epoch`` (from 0), ``mix_tokens``, ``mix_weight``, ``mix_exponent`` and
    ``mix_order`` (0 to 1; reading draws by it interleaves the sources at their
    weights).  ``tokens_col`` gives token counts, otherwise words are counted.

    Without a ``budget`` in tokens it is the smallest at which each document is
    used at least once, so nothing is lost; with one, sources over their quota
    lose what a permutation puts last.  A source's tokens never exceed its quota.
    Documents without words take no budget: they follow the blocks of their
    source, and a source of only such documents is used once.  A null source is
    a source of its own; null and repeated ids are rows like others.  An empty
    table gives an empty result.
    """
    source, id_ = F.col(source_col), F.col(id_col)
    count = F.coalesce(F.col(tokens_col), F.lit(0)).cast("long") if tokens_col else word_count(whole_text(text_col))
    rows = stage(
        docs.select(source_key(source).alias("key"), id_.alias("id"), count.alias("tokens")), "mix-rows"
    )
    plan = plan_sources(rows, max_repeats, entropy_bits, budget, block_tokens, seed).select(
        F.struct("key", "weight", "exponent", "turns", "epochs", "blocks", "edge", "edge_doc").alias("mix_plan")
    )
    kept = [F.col(c) for c in (columns or [id_col, source_col])]
    wide = docs.select(F.struct(*kept).alias("mix_row"), id_.alias("mix_id"), source_key(source).alias("mix_key"), count.alias("mix_tokens"))
    joined = wide.join(_broadcast_if_small(plan), F.col("mix_key") == F.col("mix_plan.key"))
    p = {c: F.col(f"mix_plan.{c}") for c in ("epochs", "blocks", "edge", "edge_doc", "turns", "key")}
    block = block_of(F.col("mix_id"), p["blocks"], seed)
    turn = block_turn(p["key"], block, p["epochs"], seed)
    last = (p["turns"] > p["epochs"]) & (
        p["edge"].isNull()
        | (turn < p["edge"])
        | ((turn == p["edge"]) & F.coalesce(doc_turn(F.col("mix_id"), p["epochs"], seed) <= p["edge_doc"], F.lit(False)))
    )
    uses = p["epochs"] + F.when(last & (p["turns"] - p["epochs"] > 2e-9), 1).otherwise(0)
    drawn = joined.withColumn("mix_uses", uses).where("mix_uses > 0").withColumn(
        "mix_epoch", F.explode(F.sequence(F.lit(0), F.col("mix_uses") - 1))
    )
    within = block_turn(p["key"], block, F.col("mix_epoch"), seed) / F.lit(2.0**64) + 0.5
    return drawn.select(
        "mix_row.*",
        "mix_epoch",
        "mix_tokens",
        F.col("mix_plan.weight").alias("mix_weight"),
        F.col("mix_plan.exponent").alias("mix_exponent"),
        ((F.col("mix_epoch") + within) / F.greatest(p["turns"], F.col("mix_uses").cast("double"))).alias("mix_order"),
    )
