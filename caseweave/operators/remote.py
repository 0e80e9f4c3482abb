"""Calls of a remote service, several at a time."""

from __future__ import annotations

import heapq
import queue
import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from caseweave.operators.infer import FAILED, Answer


@dataclass(frozen=True)
class Overlapped:
    """A model for ``batch_infer`` from a function that answers one prompt.

    At most ``workers`` calls of a task are under way.  One that raises, or takes
    longer than ``timeout`` seconds, is tried again after a pause that doubles
    each time; after ``tries`` its prompt gets an error status and the others go
    on.  Answers come in the order of the prompts.  A call that hangs cannot be
    ended; its thread is left behind, does not count as under way and ends
    with the worker.
    """

    call: Callable[..., Answer]
    workers: int = 10
    timeout: float = 15.0
    tries: int = 3
    pause: float = 0.5

    def __call__(self, prompts: Sequence[str], **options) -> list[Answer]:
        answers: list[Answer | None] = [None] * len(prompts)
        ended: queue.SimpleQueue = queue.SimpleQueue()
        waiting = [(0.0, place, 1) for place in range(len(prompts))]  # when to start, which prompt, which try
        running: dict[int, tuple[float, int, int]] = {}  # by number of the call: until when, which prompt, which try
        calls, left = 0, len(prompts)

        def run(number: int, prompt: str) -> None:
            try:
                ended.put((number, self.call(prompt, **options), None))
            except Exception as error:  # becomes the prompt's status
                ended.put((number, None, type(error).__name__))

        def failed(place: int, nth: int, error: str) -> int:
            if nth < self.tries:
                heapq.heappush(waiting, (time.monotonic() + self.pause * 2 ** (nth - 1), place, nth + 1))
                return 0
            answers[place] = (None, f"{FAILED}{error}")
            return 1

        while left:
            now = time.monotonic()
            for number in [n for n, (until, *_) in running.items() if until <= now]:
                _, place, nth = running.pop(number)
                left -= failed(place, nth, "TimeoutError")
            while waiting and waiting[0][0] <= now and len(running) < self.workers:
                _, place, nth = heapq.heappop(waiting)
                calls += 1
                running[calls] = (now + self.timeout, place, nth)
                threading.Thread(target=run, args=(calls, prompts[place]), daemon=True).start()
            moments = [until for until, *_ in running.values()]
            if waiting and len(running) < self.workers:
                moments.append(waiting[0][0])
            if not moments:
                continue
            try:
                number, answer, error = ended.get(timeout=max(0.0, min(moments) - time.monotonic()))
            except queue.Empty:
                continue
            if number not in running:  # it was given up before
                continue
            _, place, nth = running.pop(number)
            if error is None:
                answers[place] = answer
                left -= 1
            else:
                left -= failed(place, nth, error)
        return answers
