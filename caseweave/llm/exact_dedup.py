"""Exact copies through an extendible-hash index kept in shared files.

A directory over the leading bits of the hash addresses buckets: one with too many
entries is split, and the directory doubles when a split needs more bits.  Each bucket is
a range of keys and has one owner task, which gets every text of the range, chains those
that share a hash and compares them byte for byte; it writes one entry per distinct text,
bucket by bucket.  Texts that are a large share of the table are counted before they are
sent, so their owner gets them once per task.  Rows then probe the files by
(bucket, hash, digest); the index alone says which row stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.native import whole_text
from caseweave.sinks.staging import stage
from caseweave.sources.tables import estimated_bytes

#: Entries of a bucket before it splits, and the bits that a directory may grow to (65,536 buckets).
BUCKET_ENTRIES, DIRECTORY_BITS = 512, 16
HOT_SHARE = 1024
SMALL_VERDICTS = 64 << 20


@dataclass(frozen=True)
class Directory:
    """``depth`` leading bits address a slot; slots of an unsplit bucket share its number."""

    depth: int
    slots: tuple[int, ...]

    def owner(self, key: Column) -> Column:
        if self.depth == 0:
            return F.lit(0)
        # One constant, however long the directory is.
        slots = F.split(F.lit(",".join(map(str, self.slots))), ",").cast("array<int>")
        return F.get(slots, _leading(key, self.depth))


def _leading(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0)


def directory_bits(keys: int, capacity: int, most: int = DIRECTORY_BITS) -> int:
    """Bits to count keys by: enough for even buckets, and two more for uneven ones."""
    return min(most, max(-(-keys // capacity) - 1, 0).bit_length() + 2) if keys > capacity else 0


def build_directory(counts: dict[int, int], bits: int, capacity: int) -> Directory:
    """Split overfull buckets until each holds ``capacity`` entries or has no bits left.

    ``counts`` holds the number of entries for each value of the ``bits`` leading
    bits, so it is never longer than ``2 ** bits``.
    """
    below = [counts.get(i, 0) for i in range(1 << bits)]
    totals = [below]  # totals[d]: entries under each prefix of bits - d bits
    for _ in range(bits):
        last = totals[-1]
        totals.append([last[i] + last[i + 1] for i in range(0, len(last), 2)])
    totals.reverse()
    buckets, open_ = [], [(0, 0)]
    while open_:
        depth, prefix = open_.pop()
        if totals[depth][prefix] > capacity and depth < bits:
            open_ += [(depth + 1, 2 * prefix), (depth + 1, 2 * prefix + 1)]
        else:
            buckets.append((depth, prefix))
    depth = max(d for d, _ in buckets)
    slots = [0] * (1 << depth)
    for number, (d, prefix) in enumerate(sorted(buckets, key=lambda b: b[1] << (bits - b[0]))):
        width = 1 << (depth - d)
        slots[prefix * width : (prefix + 1) * width] = [number] * width
    return Directory(depth, tuple(slots))


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_entries: int = BUCKET_ENTRIES,
    hash_bits: int = 64,
) -> tuple[DataFrame, Directory]:
    """The index (owner, key, sha256, keep_id, group_size), staged, and its directory.

    Entries with one key are a chain.  ``hash_bits`` below 64 only serves tests,
    which need such collisions.
    """
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("body")).select(
        _key(F.col("body"), hash_bits).alias("key"),
        "body",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
    )
    keys = stage(rows.groupBy("key").agg(F.count("*").alias("rows")), "exact-keys")
    seen = keys.agg(F.count("*").alias("keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    bits = directory_bits(seen["keys"], bucket_entries)
    prefix = _leading(F.col("key"), bits).alias("prefix")
    counts = {r[0]: r[1] for r in keys.groupBy(prefix).count().collect()}  # at most 2 ** DIRECTORY_BITS
    directory = build_directory(counts, bits, bucket_entries)
    # Keys over one row in HOT_SHARE number less than HOT_SHARE.
    hot = F.broadcast(keys.where(F.col("rows") * HOT_SHARE > seen["rows"]).select("key"))
    counted = (F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    sent = rows.join(hot, "key", "left_anti").unionByName(
        rows.join(hot, "key", "left_semi").groupBy("key", "body").agg(*counted)
    )
    entries = (
        sent.withColumn("owner", directory.owner(F.col("key")))
        .repartition("owner")
        .groupBy("owner", "key", "body")  # where the rows are: their owner's task compares the bytes
        .agg(*counted)
        .select("owner", "key", F.sha2("body", 256).alias("sha256"), "keep_id", "group_size")
        .sortWithinPartitions("owner", "key")
    )
    index = stage(entries, "exact-index")
    # Links of a chain are told apart by their digest; that it does so was compared byte for byte above.
    if not index.groupBy("owner", "key", "sha256").count().where("count > 1").isEmpty():
        raise ValueError("different texts share both their hash and their SHA-256")
    return index, directory


def _key(body: Column, bits: int) -> Column:
    key = F.xxhash64(body)
    return key if bits == 64 else F.shiftleft(key, 64 - bits)


def exact_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_entries: int = BUCKET_ENTRIES,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Nulls and empty texts are one group.  A row with a null id has a null
    ``keep_id`` only if its whole group has none; it is kept only then.  A row
    given twice (same id, same text) is one document with one verdict, and both
    count in ``group_size``.  An empty table gives an empty result.  Other
    columns of the input play no part, whatever their names.
    """
    index, directory = build_index(docs, id_col, text_col, bucket_entries, hash_bits)
    probes = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("body")).select(
        "id", _key(F.col("body"), hash_bits).alias("key"), F.sha2("body", 256).alias("sha256")
    )
    total = index.agg(F.sum("group_size")).first()[0] or 0
    # Groups over one row in HOT_SHARE number less than HOT_SHARE: their rows are answered in place.
    hot = index.where(F.col("group_size") * HOT_SHARE > total).select(
        "key", "sha256", F.struct("keep_id", "group_size").alias("hot")
    )
    cold = index.where(F.col("group_size") * HOT_SHARE <= total).select(
        "owner", "key", "sha256", F.struct("keep_id", "group_size").alias("cold")
    )
    # An answered row looks for nothing; its random key keeps it from meeting the others in one task.
    answered = F.col("hot").isNotNull()
    found = (
        probes.join(F.broadcast(hot), ["key", "sha256"], "left")
        .withColumn("owner", directory.owner(F.col("key")))
        .withColumn("at", F.when(answered, F.xxhash64("id")).otherwise(F.col("key")))
        .withColumn("digest", F.when(~answered, F.col("sha256")))
        .join(
            cold.withColumnsRenamed({"key": "at", "sha256": "digest"}), ["owner", "at", "digest"], "left"
        )
        .withColumn("entry", F.coalesce("hot", "cold"))
    )
    return found.select(
        F.col("id").alias(id_col),
        F.col("entry.keep_id").alias("keep_id"),
        F.col("entry.group_size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("entry.keep_id")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names; one of
    each text, also where the table repeats a row with its id.

    Null and empty texts are one text.  A row with a null id stays only if no
    row of its text has an id.  An empty table gives an empty result.
    """
    verdicts = stage(exact_copies(docs, id_col, text_col).select(F.col(id_col).alias("id"), "text_sha256", "kept"), "exact-verdicts")
    gone = verdicts.where(~F.col("kept")).select("id", "text_sha256").distinct()
    twice = verdicts.where("kept").groupBy("id", "text_sha256").count().where("count > 1").drop("count")
    # The row travels as one column, so that none of its names meets ours.
    packed = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        F.col(id_col).alias("own"),
        F.sha2(whole_text(text_col), 256).alias("digest"),
    )

    def same(other: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        small = F.broadcast(other) if estimated_bytes(verdicts) < SMALL_VERDICTS else other
        return rows.join(small, F.col("own").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("text_sha256")), how)

    stay = same(gone, "left_anti", packed)
    if not twice.isEmpty():
        stay = same(twice, "left_anti", stay).unionByName(
            same(twice, "left_semi", stay).dropDuplicates(["own", "digest"])
        )
    return stay.select("row.*")
