"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept.  All but the last return the columns
of ``documents``; the last one returns where each piece of each document lies in
which training sequence.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.llm import exact_dedup, language, mixing, near_join, packing
from caseweave.sinks.staging import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The found language needs a quarter fewer phrases than the next one to overrule a label.
CLEAR_SCORE = 0.25
#: A shorter text can be a name or a quotation.
CLEAR_CHARS = 100
#: Pieces a worker remembers while packing: fewer than usual, as earlier stages have filled the JVM beside it.
REMEMBERED = 100_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and null ones, go; a missing language is filled in, and a
    label is replaced where the text clearly is in another language.

    That is judged only if the label is one of the learned languages (in any case);
    other labels stay, as nothing is known about how their texts look.
    """
    profile = language.fit(docs.where(~language.held_out(F.col("doc_id"))), doubt_labels=True)
    found = docs.withColumn("_found", language.language_of(F.col("text").cast("string"), profile))
    label = F.lower(F.trim("lang"))
    learned = sorted({lang for lang, _ in profile.samples})
    wrong = label.isin([lang.lower() for lang in learned]) & (label != F.lower("_found.lang"))
    clear = wrong & (F.col("_found.score") >= CLEAR_SCORE) & (F.char_length("text") >= CLEAR_CHARS)
    return (
        found.where(F.col("_found.lang") != language.UNDETERMINED)
        .withColumn("lang", F.when(clear, F.col("_found.lang")).otherwise(F.coalesce("lang", "_found.lang")))
        .select(*COLUMNS)
    )


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the largest id stays."""
    return exact_dedup.drop_copies(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a class of near copies the document with the smallest id stays."""
    return near_join.drop_near_copies(docs).select(*COLUMNS)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources come several times, so that sources reach their weights."""
    return mixing.mix_sources(docs, columns=COLUMNS).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; a document that was drawn twice is packed twice."""
    return packing.pack_documents(
        docs, public_tokenizers.path("word_bpe_49k.json"), remembered=REMEMBERED
    )


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_to_weights),
    ("best-fit packing", pack_sequences),
]
#: No SQL says what a suffix automaton or a token id is; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
