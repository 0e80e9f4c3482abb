"""Best-fit packing of token sequences, planned on the histogram of lengths.

Best fit only looks at lengths, so it is planned over counts: at most ``capacity``
lengths, longest first, each into the fullest sequences that still hold it, and
sequences in the same state are one group.  The plan is a short list of ranges
(the k-th piece of this length goes there); pieces find their place by joining on
their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from caseweave.llm.native import whole_text
from caseweave.llm.tokens import encoder
from caseweave.llm.workers import prepare, tidy
from caseweave.sinks.staging import stage

CAPACITY = 2048
END_ID = 0
RANKED_TOGETHER = 1 << 12


@dataclass(frozen=True)
class Slots:
    """Pieces ``low <= rank < high`` of a length: ``each`` of them per sequence from
    ``sequence`` on, the first at ``offset``."""

    length: int
    low: int
    high: int
    sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Where the pieces of each length go; lengths are 1 to ``capacity``."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: (first sequence, how many)
    slots, opened = [], 0
    for length in range(capacity, 0, -1):
        left, rank = counts.get(length, 0), 0

        def fill(first: int, many: int, space: int, length: int = length) -> None:
            """Put what is left into these sequences, as many in each as go in."""
            nonlocal left, rank
            each = space // length
            whole = min(many, left // each)
            rest = left - whole * each if whole < many else 0
            for at, n, e in ((first, whole, each), (first + whole, min(rest, 1), rest)):
                if n:
                    slots.append(Slots(length, rank, rank + n * e, at, e, capacity - space))
                    room[space - e * length].append((at, n))
                    rank, left = rank + n * e, left - n * e
            used = whole + min(rest, 1)
            if used < many:
                room[space].append((first + used, many - used))

        for space in range(length, capacity):
            while left and room[space]:
                fill(*room[space].pop(), space)
        if left:
            many = -(-left // (capacity // length))
            fill(opened, many, capacity)
            opened += many
    return slots


def token_pieces(
    text: Column, tokenizer: str, capacity: int, end_id: int | None, remembered: int | None = None
) -> Column:
    """A struct for each text: its number of ids and the crc32 of each piece."""
    prepare()

    @pandas_udf("ids bigint, crcs array<bigint>")
    @tidy
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, remembered).encode
        end = b"" if end_id is None else end_id.to_bytes(4, "little")
        for batch in batches:
            coded = [encode(t) + end for t in batch]
            width = 4 * capacity
            yield pd.DataFrame(
                {
                    "ids": [len(c) // 4 for c in coded],
                    "crcs": [[zlib.crc32(c[i : i + width]) for i in range(0, len(c), width)] for c in coded],
                }
            )

    return cut(text)


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int | None = END_ID,
    remembered: int | None = None,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: id, piece, start, length, ids_crc32.

    A null text is empty; without an end id an empty text has no piece.
    """
    cut = docs.select(
        F.col(id_col).alias(id_col),
        token_pieces(whole_text(text_col), tokenizer, capacity, end_id, remembered).alias("cut"),
    )
    return cut.select(id_col, "cut.ids", F.posexplode("cut.crcs").alias("piece", "ids_crc32")).select(
        id_col,
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        F.least(F.lit(capacity), F.col("ids") - F.col("piece").cast("long") * capacity).cast("long").alias("length"),
        "ids_crc32",
    )


def pack(pieces: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``.

    Every row gets a place, also repeated ones.  Which piece of a length goes to
    which of its slots follows a hash of id and piece.  The histogram has at
    most ``capacity`` numbers and the plan a few ranges per length, so both are
    bounded whatever the table holds.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = plan(counts, capacity)
    table = spark.createDataFrame(
        [astuple(s) for s in slots],
        "slot_length bigint, low bigint, high bigint, first_sequence bigint, each bigint, first_offset bigint",
    )
    # A frequent length is ranked in shares, so that no task sorts all of it.
    shares = max(1, sum(counts.values()) // RANKED_TOGETHER)
    mixed = pieces.withColumn("share", F.pmod(F.xxhash64(id_col, "piece"), F.lit(shares)))
    before = mixed.groupBy("share", "length").agg(F.count("*").alias("many")).select(
        "share",
        "length",
        (F.sum("many").over(Window.partitionBy("length").orderBy("share")) - F.col("many")).alias("before"),
    )
    ranked = (
        mixed.withColumn(
            "place", F.row_number().over(Window.partitionBy("share", "length").orderBy(id_col, "piece")) - 1
        )
        .join(before, ["share", "length"])
        .withColumn("rank", F.col("place") + F.col("before"))
    )
    nth = F.col("rank") - F.col("low")
    return ranked.join(
        F.broadcast(table),
        (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    ).select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int | None = END_ID,
    remembered: int | None = None,
) -> DataFrame:
    """Documents to packed pieces; the tokenizer runs once, its pieces are staged.

    Columns: id, piece, start, length, ids_crc32, sequence_id, offset.  Rows with
    null or repeated ids are documents of their own, an empty table gives an
    empty result, and other columns of ``docs`` play no part.  A worker remembers the ids
    of so many pieces (twice that at times): fewer take less memory and more time.
    """
    cut = cut_documents(docs, tokenizer, id_col, text_col, capacity, end_id, remembered)
    return pack(stage(cut, "pieces"), id_col, capacity)
