"""Batch inference with a pluggable model.

The model itself is not part of the library: it is a callable that answers a
list of prompts.  Spark does the data work around it: key prompts by hash, ask
each distinct prompt once, skip what a cache already holds, run partitions in
parallel, stage the answers and bring them back to every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.deploy import ensure_on_workers
from caseweave.functions.text import fill, tokens
from caseweave.operators.lookup import lookup
from caseweave.operators.worklist import pending
from caseweave.sinks.staging import stage

Answer = tuple[str | None, str | None]
Model = Callable[[list[str]], Sequence[Answer]]

#: What the status of a prompt starts with that has no answer.
FAILED = "error: "


# --- prompts ----------------------------------------------------------------


def triage_prompt(template: str = fv.TRIAGE_PROMPT, themes=fv.PROMPT_THEMES) -> Column:
    return fill(
        template,
        summary=F.col("summary"),
        themes=F.lit(" | ".join(themes)),
        id=F.col("service_request_id"),
    )


def embed_content(template: str = fv.EMBED_TEXT) -> Column:
    return fill(template, theme=F.col("theme"), summary=F.col("summary"))


def refine_prompt(template: str = fv.REFINE_PROMPT) -> Column:
    return fill(
        template,
        title=F.col("policy_title"),
        snippet=F.col("policy_snippet"),
        summary=F.col("summary"),
        action=F.col("original_action"),
    )


# --- running a model --------------------------------------------------------


def prompt_hash(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def distinct_prompts(keyed: DataFrame) -> DataFrame:
    """Each prompt once with its number of uses; counted before the shuffle."""
    return keyed.groupBy("prompt_hash", "prompt").agg(F.count(F.lit(1)).alias("uses"))


def _answers(model: Model, prompts: list[str | None]) -> list[Answer]:
    """One answer per prompt, none for a null; an error becomes the status."""
    sent = [p for p in prompts if p is not None]
    answered = iter(one_by_one(model, sent, lambda error: (None, f"{FAILED}{error}")))
    return [(None, None) if p is None else next(answered) for p in prompts]


def one_by_one(model: Callable, sent: list, failed: Callable[[str], object]) -> list:
    """Answers of a model, with ``failed`` for exactly the items it fails on.

    A call that raises, or that does not answer each item, is repeated on both
    halves, so which items fail does not depend on the size of the batch.
    """
    if not sent:
        return []
    try:
        answers = list(model(sent))
        if len(answers) != len(sent):
            raise ValueError("a model must return one answer per item")
        return answers
    except Exception as error:  # reported item by item; the job goes on
        if len(sent) == 1:
            return [failed(type(error).__name__)]
    half = len(sent) // 2
    return one_by_one(model, sent[:half], failed) + one_by_one(model, sent[half:], failed)


def ask(rows: DataFrame, prompt_col: str, model: Model) -> DataFrame:
    """Replace the prompt by ``result`` and ``status``, row by row and in place.

    Only the prompts cross to Python.
    """

    @F.arrow_udf("struct<result:string,status:string>")
    def call(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            answers = _answers(model, batch.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array([a[i] for a in answers], pa.string()) for i in (0, 1)],
                names=["result", "status"],
            )

    ensure_on_workers(rows.sparkSession)
    # A model may answer differently each time: never copy or repeat the call.
    answered = rows.withColumn("_answer", call.asNondeterministic()(F.col(prompt_col)))
    return answered.select(
        *[c for c in rows.columns if c != prompt_col], "_answer.result", "_answer.status"
    )


def batch_infer(
    todo: DataFrame,
    prompt: Column,
    model: Model,
    key: str = "service_request_id",
    cache: DataFrame | None = None,
    shared_prompts: bool = True,
) -> DataFrame:
    """Add ``prompt_hash``, ``result`` and ``status`` to every row.

    Rows with a null prompt are not sent and get a null result.  ``cache`` holds
    earlier answers (``prompt_hash, result, status``).  Answers are staged
    before they are used, so a lost executor never asks the model again.

    ``shared_prompts=False`` is for prompts that differ in every row, say by an
    id they contain: nothing is shuffled, each row is answered where it is.
    """
    keyed = todo.withColumn("_prompt", prompt).withColumn(
        "prompt_hash", prompt_hash(F.col("_prompt"))
    )
    if not shared_prompts:
        if cache is not None:
            raise ValueError("a cache needs shared_prompts")
        return stage(ask(keyed, "_prompt", model), "answers")
    asked = keyed.filter(F.col("_prompt").isNotNull())
    prompts = distinct_prompts(asked.select("prompt_hash", F.col("_prompt").alias("prompt")))
    if cache is None:
        answers = stage(ask(prompts, "prompt", model), "answers")
    else:
        known = cache.select("prompt_hash", "result", "status")
        fresh = ask(pending(prompts, known, "prompt_hash"), "prompt", model)
        reused = prompts.select("prompt_hash", "uses").join(known, "prompt_hash")
        answers = stage(fresh.unionByName(reused), "answers")
    back = lookup(asked.drop("_prompt"), answers, "prompt_hash", "uses", key)
    silent = keyed.filter(F.col("_prompt").isNull()).drop("_prompt")
    return back.unionByName(silent, allowMissingColumns=True)


def answered(results: DataFrame) -> DataFrame:
    """Rows that need not be asked again."""
    return results.filter(~F.startswith(F.coalesce("status", F.lit("")), F.lit(FAILED)))


def outcome_counts(results: DataFrame) -> DataFrame:
    """How many rows ended in which status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# --- a model made of column expressions -------------------------------------


def with_keyword_theme(
    df: DataFrame,
    text_col: str,
    rules: Sequence[tuple[str, Sequence[str]]],
    default: str = "",
    into: str = "theme",
) -> DataFrame:
    """Add the theme of the first rule one of whose words occurs in the text.

    The text is split once; the rules share its words.
    """
    words = F.col("_words")
    theme: Column | None = None
    for label, keywords in rules:
        hit = F.arrays_overlap(words, F.array(*[F.lit(w) for w in keywords]))
        theme = F.when(hit, F.lit(label)) if theme is None else theme.when(hit, F.lit(label))
    theme = F.lit(default) if theme is None else theme.otherwise(F.lit(default))
    return (
        df.withColumn("_words", tokens(F.col(text_col))).withColumn(into, theme).drop("_words")
    )


def theme_rules(themes=fv.PROMPT_THEMES) -> list[tuple[str, list[str]]]:
    """One rule per theme from the words of its own name."""
    return [(t, t.lower().replace("/", " ").split(" ")) for t in themes]


def triage_rules(
    summaries: DataFrame,
    rules: Sequence[tuple[str, Sequence[str]]] | None = None,
    default: str = "",
    urgent_length: int = 150,
    normal_length: int = 60,
) -> DataFrame:
    """Deterministic stand-in for the triage model, wholly inside the JVM."""
    summary = F.col("summary")
    labelled = with_keyword_theme(
        summaries.filter(summary.isNotNull()),
        "summary",
        theme_rules() if rules is None else rules,
        default,
    )
    severity = (
        F.when(F.length(summary) > urgent_length, F.lit("high"))
        .when(F.length(summary) > normal_length, F.lit("medium"))
        .otherwise(F.lit("low"))
    )
    action = F.concat(F.lit("Check "), F.col("summary_source"), F.lit(" case now."))
    answer = F.to_json(
        F.struct(
            F.col("theme"), severity.alias("severity"), action.alias("suggested_action")
        )
    )
    return labelled.select(
        "service_request_id", "summary", "summary_source",
        answer.alias("triage_result"), F.lit("").alias("status"),
    )
