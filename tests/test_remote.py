import threading
import time

import pytest
from pyspark.sql import functions as F

from caseweave.operators.infer import batch_infer
from caseweave.operators.remote import Overlapped


def slow(prompt):
    time.sleep(0.1)
    return prompt.upper(), ""


def test_calls_overlap_and_keep_their_order():
    prompts = [f"p{i}" for i in range(100)]
    started = time.monotonic()
    assert Overlapped(slow)(prompts) == [(p.upper(), "") for p in prompts]
    assert time.monotonic() - started < 2
    assert Overlapped(slow)([]) == []


def test_a_hanging_prompt_gets_an_error_status_and_holds_up_none():
    never = threading.Event()

    def call(prompt):
        if prompt.startswith("hang"):
            never.wait(60)
        return prompt, ""

    started = time.monotonic()
    found = Overlapped(call, workers=2, timeout=0.2, tries=2, pause=0.01)(["hang1", "a", "hang2", "b", "hang3", "c"])
    never.set()
    assert time.monotonic() - started < 5
    assert found == [
        (None, "error: TimeoutError"), ("a", ""), (None, "error: TimeoutError"), ("b", ""), (None, "error: TimeoutError"), ("c", ""),
    ]


def test_failures_are_tried_again_after_longer_pauses():
    at = []

    def call(prompt, tone="calm"):
        at.append(time.monotonic())
        if len(at) < 4:
            raise ConnectionError
        return f"{prompt} {tone}", "ok"

    assert Overlapped(call, tries=4, pause=0.05)(["x"], tone="kind") == [("x kind", "ok")]
    pauses = [b - a for a, b in zip(at, at[1:], strict=False)]
    assert pauses[0] >= 0.05 and pauses[1] >= 0.1 and pauses[2] >= 0.2
    at.clear()
    assert Overlapped(call, tries=2, pause=0.01)(["x"]) == [(None, "error: ConnectionError")]


def test_no_more_than_the_given_number_at_a_time():
    lock, now, most = threading.Lock(), [0], [0]

    def call(prompt):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return prompt, ""

    Overlapped(call, workers=4)([str(i) for i in range(40)])
    assert most[0] == pytest.approx(4, abs=0)


def test_as_a_model(spark):
    todo = spark.range(60).select(F.col("id").cast("string").alias("service_request_id")).repartition(2)
    found = batch_infer(todo, F.concat(F.lit("p"), F.col("service_request_id") % 7), Overlapped(slow), shared_prompts=True)
    assert {(r["result"], r["status"]) for r in found.collect()} == {(f"P{i}", "") for i in range(7)}
