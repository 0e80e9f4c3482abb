"""Text vectors: hashed term counts computed where the text is."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.deploy import ensure_on_workers
from caseweave.functions.jsonfields import with_scalars
from caseweave.functions.nearest import hashed_counts
from caseweave.functions.text import tokens, trim_unicode
from caseweave.operators.infer import embed_content, one_by_one

BUCKETS = 64

# A text column to a vector column.
Embedder = Callable[[Column], Column]


def hashed_vector(text: Column, buckets: int = BUCKETS) -> Column:
    """Term counts per md5 bucket of the whole text.

    Tokens are split in the JVM; counting is vectorised per Arrow batch.  There
    is no (id, bucket) shuffle and the other columns never leave the JVM.
    """

    @F.arrow_udf("array<float>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield hashed_counts(batch, buckets)

    ensure_on_workers()
    # Declared non-deterministic only so that filters above do not copy the call.
    return count.asNondeterministic()(tokens(text))


def model_vector(
    model: Callable[[list[str]], Sequence[Sequence[float] | None]],
) -> Embedder:
    """Vectors from an outside model: a callable that embeds a list of texts.

    A text that the model fails on gets no vector, the others of its batch do.
    """

    @F.arrow_udf("array<float>")
    def call(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            sent = [t for t in texts if t is not None]
            vectors = iter(one_by_one(model, sent, lambda error: None))
            yield pa.array(
                [None if t is None else next(vectors) for t in texts], pa.list_(pa.float32())
            )

    def vector(text: Column) -> Column:
        ensure_on_workers()
        return call.asNondeterministic()(text)

    return vector


def embed_text(
    df: DataFrame, text_col: str, into: str = "embedding", embedder: Embedder = hashed_vector
) -> DataFrame:
    return df.withColumn(into, embedder(F.col(text_col)))


def nonzero_buckets(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """One row per key and bucket that occurs."""
    return (
        df.select(key, F.posexplode(vector).alias("bucket", "weight"))
        .filter(F.col("weight") > 0)
        .select(key, "bucket", F.col("weight").cast("long").alias("n"))
    )


def query_texts(
    triage: DataFrame, summaries: DataFrame | None = None, trim_theme: bool = False
) -> DataFrame:
    """Cases to search for: theme from the triage answer ('' if none) and summary.

    With ``summaries`` the current summary is taken, otherwise the one the
    triage row carries.
    """
    rows = search_theme(triage, trim_theme)
    if summaries is not None:
        rows = rows.select("service_request_id", "theme").join(
            summaries.select("service_request_id", "summary"), "service_request_id"
        )
    return rows.filter(F.col("summary").isNotNull()).select(
        "service_request_id", "theme", "summary"
    )


def search_theme(triage: DataFrame, trim: bool = False) -> DataFrame:
    """Add the theme of the triage answer, empty when there is none."""
    rows = with_scalars(triage, "triage_result", {"theme": "theme"})
    theme = F.coalesce("theme", F.lit(""))
    return rows.withColumn("theme", trim_unicode(theme) if trim else theme)


def embed_cases(queries: DataFrame, embedder: Embedder = hashed_vector) -> DataFrame:
    """Vector of theme and summary together."""
    return queries.withColumn("embedding", embedder(embed_content()))
