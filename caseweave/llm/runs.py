"""Cutting sorted streams of rows between keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def by_runs(batches: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """Sorted batches, cut so that no run of equal values is split."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[column].to_numpy()
        if rest and values[0] == rest[-1][column].iloc[-1] and values[-1] == values[0]:
            rest.append(batch)  # still the same run
            continue
        start = int(np.argmax(values == values[-1]))  # sorted: the last run begins here
        ready = [*rest, batch.iloc[:start]]
        rest = [batch.iloc[start:]]
        ready = [r for r in ready if len(r)]
        if ready:
            yield ready[0].reset_index(drop=True) if len(ready) == 1 else pd.concat(ready, ignore_index=True)
    if rest:
        yield rest[0].reset_index(drop=True) if len(rest) == 1 else pd.concat(rest, ignore_index=True)
