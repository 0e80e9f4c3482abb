"""Winnowed document fingerprints.

Words are hashed, each run of ``gram`` words gets a hash, and of every window of
``window`` such hashes the smallest is kept, the rightmost one on a tie, together
with its position.  Two texts that share ``gram + window - 1`` consecutive words
share a kept hash, whatever stands around them.

Unless a window is given, it is WINDOW for long texts and an eighth of the number
of hashes for shorter ones, down to 1, so that a short text keeps more than one
hash.  What a wide window keeps, narrower ones keep too: texts of different
windows still share a hash if they share ``gram + window - 1`` words of the wider.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm.native import let, text_bytes, whole_text

GRAM = 5
WINDOW = 16
#: A text keeps about twice as many hashes as it has windows side by side.
WINDOWS = 8
#: A letter of a script without blanks is a word of its own.
WORDS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]|[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]]+"
POSITION_BITS = 30
RANGE_BYTES = 4 << 20
FANOUT = 256


def grams(text: Column, gram: int = GRAM) -> Column:
    """Hashes of all runs of ``gram`` words, in order; a shorter text is one run,
    a text of other characters only is one run too, and the empty text has none."""
    words = F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0)), lambda w: F.xxhash64(w))

    def runs(hashes: Column) -> Column:
        size = F.size(hashes)
        full = F.transform(
            F.slice(hashes, 1, F.greatest(size - gram + 1, F.lit(0))),
            lambda first, i: F.xxhash64(first, *[F.get(hashes, i + j) for j in range(1, gram)]),
        )
        return (
            F.when(size >= gram, full)
            .when(size > 0, F.array(F.xxhash64(hashes)))
            .when(text != "", F.array(F.xxhash64(text)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(words, runs)


def own_window(size: Column) -> Column:
    """The window of a text of ``size`` hashes."""
    return F.greatest(F.lit(1), F.least(F.lit(WINDOW), F.floor(size / WINDOWS).cast("int")))


def winnow(text: Column, gram: int = GRAM, window: int | None = None) -> Column:
    """The kept (hash, position) pairs of a text by position, as an array of structs.

    A window compares the low 33 bits of the hash, packed above the reversed
    position so that the smallest number is the rightmost smallest hash.
    """
    last = (1 << POSITION_BITS) - 1

    def pick(hashes: Column) -> Column:
        packed = F.transform(
            hashes,
            lambda h, i: F.shiftleft(h.bitwiseAND(F.lit((1 << 33) - 1)), POSITION_BITS).bitwiseOR((F.lit(last) - i).cast("long")),
        )

        def minima(keys: Column) -> Column:
            size = F.size(keys)
            width = own_window(size) if window is None else F.lit(window)
            moving = let(
                width,
                lambda wide: F.transform(
                    F.slice(keys, 1, F.greatest(size - wide + 1, F.lit(0))),
                    lambda _, i: F.array_min(F.slice(keys, i + 1, wide)),
                ),
            )
            return F.when(size > width, moving).when(size > 0, F.array(F.array_min(keys))).otherwise(keys)

        position = lambda key: (F.lit(last) - key.bitwiseAND(F.lit(last))).cast("int")
        return F.transform(
            F.array_distinct(let(packed, minima)),
            lambda key: F.struct(F.get(hashes, position(key)).alias("hash"), position(key).alias("position")),
        )

    return let(grams(text, gram), pick)


def hashes_of(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda p: p["hash"])


def as_string(hashes: Column) -> Column:
    """Kept hashes in text order, sixteen hex digits each; the empty text gives ''."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Shared kept hashes over all kept hashes; two empty fingerprints are alike."""
    def share(both: Column) -> Column:
        ours, theirs = both["ours"], both["theirs"]
        common = F.size(F.array_intersect(ours, theirs))
        return F.when((F.size(ours) == 0) & (F.size(theirs) == 0), F.lit(1.0)).otherwise(
            common / (F.size(ours) + F.size(theirs) - common)
        )

    return let(F.struct(F.array_distinct(a).alias("ours"), F.array_distinct(b).alias("theirs")), share)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int | None = None
) -> DataFrame:
    """One row per kept hash: id, hash, position (of its first word, counted in words).

    Null and empty texts have none.  Repeated rows and ids are told apart by
    nothing but their id.  Other columns play no part.
    """
    kept = F.inline(winnow(whole_text(text_col), gram, window))
    return docs.select(F.col(id_col).alias(id_col), kept)


def in_order(docs: DataFrame, id_col: str, text_col: str, range_bytes: int = RANGE_BYTES) -> tuple[Column, list]:
    """Cuts the id order into ranges of about ``range_bytes``: the number of a row's
    range, and the smallest id of each range (null if it only has null ids).

    Boundaries are approximate quantiles in two levels of FANOUT, so they are at
    most FANOUT ** 2 numbers however large the table.
    """
    wanted = max(1, min(FANOUT**2, text_bytes(docs, text_col) // range_bytes))
    fractions = [i / wanted for i in range(1, wanted)]
    cuts = docs.select(F.percentile_approx(id_col, fractions, max(10_000, 4 * wanted))).first()[0] if fractions else []
    cuts = sorted(set(cuts or []))
    outer = cuts[FANOUT - 1 :: FANOUT]
    inner = [cuts[i : i + FANOUT] for i in range(0, max(len(cuts), 1), FANOUT)]
    below = lambda bounds: F.size(F.filter(bounds, lambda c: c < F.col(id_col)))
    if not cuts:
        number = F.lit(0)
    elif not outer:
        number = below(F.lit(cuts))
    else:
        number = let(below(F.lit(outer)), lambda o: o * FANOUT + below(F.get(F.array(*map(F.lit, inner)), o)))
    number = F.coalesce(number, F.lit(0))
    firsts = docs.groupBy(number.alias("range")).agg(F.min(id_col).alias("first")).orderBy("range").collect()
    return number, [(r["range"], r["first"]) for r in firsts]


def compare_with_next(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    gram: int = GRAM,
    window: int | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Each text, its edit, and the next document by ascending id.

    The edit replaces the last ``floor(n / 4)`` code points by the first as many
    of the next text, or all of it if that is shorter; the last document is
    followed by the first.  Returns id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.  Null texts are empty, null
    ids come first, rows with one id are ordered by the hash of their text, and
    a table of one row is followed by itself.
    """
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("body"))
    number, firsts = in_order(rows, "id", "body", range_bytes)
    main = rows.withColumn("range", number).withColumn("tail", F.lit(False))
    if firsts:
        # The first rows of a range also close the one before, as what its last row is followed by.
        follows = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts) if first is not None]
        closing = docs.sparkSession.createDataFrame(
            follows, f"id {rows.schema['id'].dataType.simpleString()}, range int"
        )
        tails = rows.join(F.broadcast(closing), "id").unionByName(
            rows.where("id is null").withColumn("range", F.lit(firsts[-1][0]))
        )
        main = main.unionByName(tails.withColumn("tail", F.lit(True)))
    order = Window.partitionBy("range").orderBy("tail", F.col("id").asc_nulls_first(), F.xxhash64("body"))
    marked = main.withColumn("kept", hashes_of(winnow(F.col("body"), gram, window))).withColumn(
        "next", F.lead(F.struct("body", "kept")).over(order)
    )
    cut = F.floor(F.char_length("body") / 4).cast("int")
    edited = F.concat(
        F.substring("body", F.lit(1), F.char_length("body") - cut), F.substring(F.col("next.body"), F.lit(1), cut)
    )
    both = (
        marked.where(~F.col("tail"))
        .withColumn("edited", edited)
        .select(
            "id",
            F.char_length("body").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            "kept",
            F.col("next.kept").alias("next_kept"),
            hashes_of(winnow(F.col("edited"), gram, window)).alias("edited_kept"),
        )
    )
    return both.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        as_string(F.col("kept")).alias("fingerprint"),
        as_string(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("kept"), F.col("edited_kept")).alias("near_edited"),
        likeness(F.col("kept"), F.col("next_kept")).alias("near_next"),
    )
