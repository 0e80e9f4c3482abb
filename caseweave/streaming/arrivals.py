"""Model answers for cases as they arrive.

A stream of cases is answered in micro-batches that append to the same state tables
as the batch job.  The state decides what is asked: a prompt it holds an answer to is
not sent again, so a micro-batch that is replayed after a crash, a case that arrives
twice and a batch run over the same cases all add nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caseweave.operators.infer import Model, answered, batch_infer, prompt_hash
from caseweave.operators.worklist import pending_prompts
from caseweave.sinks import tables


def answer_batch(
    cases: DataFrame,
    prompt: Column,
    model: Model,
    state: str,
    into: str = "result",
    key: str = "service_request_id",
    shared_prompts: bool = True,
) -> None:
    """Append an answer for each case of a batch that the state has none for.

    A case that is in the batch several times with one prompt is asked once; with
    several prompts it gets an answer to each.  Failed prompts stay open and are asked again
    when their case arrives again.  A case without an id has no place in the state
    and is asked in no batch.
    """
    tables.recover(cases.sparkSession, state)
    keyed = cases.where(cases[key].isNotNull()).withColumn("prompt_hash", prompt_hash(prompt))
    once = keyed.dropDuplicates([key, "prompt_hash"])
    todo = pending_prompts(once, answered(cases.sparkSession.table(state)), key)
    answers = batch_infer(
        todo.drop("prompt_hash"), prompt, model, key, shared_prompts=shared_prompts
    )
    tables.append(answers.withColumnRenamed("result", into), state)


def answer_arrivals(
    arrivals: DataFrame,
    prompt: Column,
    model: Model,
    state: str,
    checkpoint: str,
    schema: T.StructType = tables.TRIAGE_RESULTS,
    into: str = "triage_result",
    key: str = "service_request_id",
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Start answering a stream of cases.

    Without ``every`` (an interval such as ``1 minute``) the query ends when all that is
    there has been answered; the next one goes on behind it.  ``checkpoint`` is a
    folder that every run of this stream shares.  A state table has one writer at a time.
    """
    tables.ensure_table(arrivals.sparkSession, state, tables.with_outcome(schema))

    def answer(batch: DataFrame, number: int) -> None:
        answer_batch(batch, prompt, model, state, into, key, **options)
        # A batch has a session of its own, so the one that reads the state has to be told.
        arrivals.sparkSession.catalog.refreshTable(state)

    writer = arrivals.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    timed = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return timed.start()
