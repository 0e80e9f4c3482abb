"""Work list and result rows of the refinement step."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.jsonfields import with_triage_fields
from caseweave.functions.text import first_word
from caseweave.operators.infer import Model, batch_infer, refine_prompt
from caseweave.operators.worklist import pending, work_batch
from caseweave.sinks import tables


def refine_prep(
    triage: DataFrame,
    summaries: DataFrame | None,
    matches: DataFrame,
    done: DataFrame,
    batch_size: int | None = fv.REFINE_BATCH,
) -> DataFrame:
    """Triage fields and matched policy of the cases not refined yet.

    Done cases leave first, so they are not parsed or joined at all.  With
    ``summaries`` the current summary is taken, with ``None`` the one the triage
    row carries, which saves shuffling all texts once more.
    ``batch_size=None`` takes everything that is open in one run.
    """
    open_rows = pending(triage, done)
    if summaries is not None:
        open_rows = open_rows.select("service_request_id", "triage_result").join(
            summaries.select("service_request_id", "summary", "summary_source"),
            "service_request_id",
        )
    todo = (
        with_triage_fields(open_rows)
        .select(
            "service_request_id", "summary", "summary_source", "theme", "severity",
            F.col("action").alias("original_action"),
        )
        .join(
            matches.select("service_request_id", "policy_title", "policy_snippet", "source_url"),
            "service_request_id",
            "left",
        )
    )
    return todo if batch_size is None else work_batch(todo, batch_size)


def refine_matched(
    matched: DataFrame, batch_size: int | None = fv.REFINE_BATCH
) -> DataFrame:
    """As ``refine_prep`` for open triage rows that carry their summary and policy."""
    todo = with_triage_fields(matched).select(
        "service_request_id", "summary", "summary_source", "theme", "severity",
        F.col("action").alias("original_action"),
        "policy_title", "policy_snippet", "source_url",
    )
    return todo if batch_size is None else work_batch(todo, batch_size)


POSSESSIVE = re.compile(r"([*+?}])\+")


def _matches(text: Column, pattern: Column) -> Column:
    """Whether a pattern that may differ in every row occurs; null if it is no pattern.

    Plain words never leave the JVM.  Other patterns are tried and run by one
    engine, RE2, whose time is linear in the text, so no pattern can end the
    job or stall a task.  A batch compiles each of its patterns once.
    """

    @F.arrow_udf("boolean")
    def occurs(texts: pa.Array, patterns: pa.Array) -> pa.Array:
        coded = patterns.dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        edges = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
        found = np.full(len(texts), None, object)
        for code, one in enumerate(coded.dictionary.to_pylist()):
            rows = order[edges[code] : edges[code + 1]]
            for spelled in (one, POSSESSIVE.sub(r"\1", one)):
                try:
                    hits = pc.match_substring_regex(texts.take(pa.array(rows)), spelled)
                except pa.ArrowInvalid:  # no pattern
                    continue
                found[rows] = hits.to_numpy(zero_copy_only=False)
                break
        return pa.array(found, pa.bool_())

    plain = F.regexp_like(pattern, F.lit(r"\A[\p{L}\p{N}_ ]*\z"))
    other = F.coalesce(~plain, F.lit(False))
    return F.when(plain, F.contains(text, pattern)).otherwise(
        occurs(F.when(other, text), F.when(other, pattern))
    )


def alignment_flag(action: Column, title: Column, regex: bool = False) -> Column:
    """``aligned`` when the first title word occurs in the action, else ``review``.

    The word is taken literally; ``regex`` reads it as a pattern instead, and a
    word that is no pattern is ``review`` as well.  A null on either side means
    ``review``.
    """
    word, text = F.lower(first_word(title)), F.lower(action)
    found = _matches(text, word) if regex else F.contains(text, word)
    return F.when(found, F.lit("aligned")).otherwise(F.lit("review"))


def refined_rows(
    todo: DataFrame, refined_action: Column, regex: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of the refined table from a column that holds the rewritten action, and
    the columns to ``keep``."""
    return todo.withColumn("refined_action", refined_action).select(
        "*",
        alignment_flag(F.col("refined_action"), F.col("policy_title"), regex).alias("alignment"),
    ).select(*tables.REFINED_ACTIONS.fieldNames(), *keep)


def refine(todo: DataFrame, model: Model, regex: bool = False) -> DataFrame:
    answered = batch_infer(todo, refine_prompt(), model)
    return refined_rows(answered, F.col("result"), regex, keep=("status", "prompt_hash"))
