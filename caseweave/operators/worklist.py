"""What is still to do, given what is done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.operators.topn import top_n

BROADCAST_KEYS = 100_000


def pending(
    todo: DataFrame, done: DataFrame, on: str | Sequence[str] = "service_request_id"
) -> DataFrame:
    """Rows of ``todo`` whose key is not in ``done``."""
    keys = [on] if isinstance(on, str) else list(on)
    return todo.join(done.select(*keys), keys, "left_anti")


def pending_prompts(keyed: DataFrame, done: DataFrame, key: str = "service_request_id") -> DataFrame:
    """Rows whose case has no answer yet to the prompt it has now.

    Both sides have a ``prompt_hash``; a null one (nothing to ask) equals itself.
    """
    answers = done.select(F.col(key).alias("_key"), "prompt_hash")
    same = _same_prompt(keyed["prompt_hash"], answers["prompt_hash"])
    return keyed.join(answers, (keyed[key] == F.col("_key")) & same, "left_anti")


def _same_prompt(left: Column, right: Column) -> Column:
    """Equality that is no join key: rows meet by case alone, so tables that are
    bucketed by case need no shuffle.  A case has few prompts."""
    held = F.array(F.coalesce(right, F.lit("")))
    return F.array_contains(held, F.coalesce(left, F.lit("")))


def current_answers(state: DataFrame, keyed: DataFrame, key: str = "service_request_id") -> DataFrame:
    """Rows of ``state`` that answer the prompt their case has now, one per case."""
    now = keyed.select(F.col(key).alias("_key"), "prompt_hash")
    same = _same_prompt(state["prompt_hash"], now["prompt_hash"])
    return state.join(now, (state[key] == F.col("_key")) & same, "left_semi")


def only(
    rows: DataFrame, wanted: DataFrame, on: str = "service_request_id"
) -> DataFrame:
    """Rows whose key is in ``wanted``.

    Catalyst does not move a semi join below computed columns: apply it to the
    bare rows, before their text is worked on.
    """
    return rows.join(wanted.select(on), on, "left_semi")


def absent(todo: DataFrame, listed: DataFrame, on: str = "service_request_id") -> DataFrame:
    """``NOT IN`` for a key that is never null: null keys on either side are an error.

    The check rides along in the scan, so it costs no extra pass.
    """
    def required(df: DataFrame, side: str) -> DataFrame:
        message = F.lit(f"null {on} on the {side} side")
        key = F.coalesce(F.col(on), F.raise_error(message).cast(df.schema[on].dataType))
        return df.withColumn(on, key)

    return required(todo, "todo").join(
        required(listed.select(on), "listed"), on, "left_anti"
    )


def work_batch(todo: DataFrame, size: int, key: str = "service_request_id") -> DataFrame:
    """The next ``size`` rows by key, so a rerun picks the same ones.

    Tasks and lanes keep ``size`` keys each, and only the chosen rows are read
    again: apply it to bare rows, before any costly column.
    """
    chosen = top_n(todo.select(key), size, [F.asc(key)])
    return todo.join(F.broadcast(chosen), key, "left_semi") if size <= BROADCAST_KEYS else (
        todo.join(chosen, key, "left_semi")
    )
