"""Structured Streaming twins of the ledger operators.

Each keeps one small state a key.  The reference data has no late-data rules; a
watermark is only there to bound state, and its delay is a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

REVISIONS = "key string, event_id long, value double, previous double, revision long, first_seen timestamp, event_type string"
HEALTH = "key string, event_id long, state string, streak long, failed_since timestamp"


def _ordered(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(frames)).sort_values(["ts", "event_id"])


def observation_events(rows: DataFrame) -> DataFrame:
    """``discovered`` and ``revised`` events of ``key, ts, event_id, value`` rows."""

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        value, revision, first = state.get if state.exists else (None, 0, None)
        now = _ordered(frames)
        before = now["value"].shift(1)
        if revision:
            before.iloc[0] = value
        changed = before != now["value"]
        changed.iloc[0] |= not revision
        now, before = now[changed], before[changed]
        if not len(now):
            return
        first = first or int(now["ts"].iloc[0].value // 1000)
        number = revision + 1 + np.arange(len(now))
        state.update((float(now["value"].iloc[-1]), int(number[-1]), first))
        columns = [key[0], now["event_id"], now["value"], before, number, pd.Timestamp(first, unit="us"), np.where(number > 1, "revised", "discovered")]
        yield pd.DataFrame(dict(zip([c.split()[0] for c in REVISIONS.split(", ")], columns)), index=now.index)

    return rows.groupBy("key").applyInPandasWithState(step, REVISIONS, "value double, revision long, first long", "append", GroupStateTimeout.NoTimeout)


def health_changes(rows: DataFrame) -> DataFrame:
    """State of each stream after every one of its ``key, ts, event_id, failed`` runs."""

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak, since = state.get if state.exists else (0, None)
        now = _ordered(frames)
        failed = now["failed"].astype(bool)
        block = (~failed).cumsum()  # a streak is what fails within one block
        run = failed.astype("int64").groupby(block).cumsum() + np.where(failed & (block == 0), streak, 0)
        begun = now["ts"].where(failed).groupby(block).transform("first").where(failed)
        if since:
            begun = begun.mask(failed & (block == 0), pd.Timestamp(since, unit="us"))
        after = failed.shift(1, fill_value=streak > 0)
        name = np.where(failed, "failed", np.where(after, "recovered", "healthy"))
        last = int(run.iloc[-1])
        state.update((last, int(begun.iloc[-1].value // 1000) if last else None))
        columns = [key[0], now["event_id"], name, run, begun]
        yield pd.DataFrame(dict(zip([c.split()[0] for c in HEALTH.split(", ")], columns)), index=now.index)

    return rows.groupBy("key").applyInPandasWithState(step, HEALTH, "streak long, since long", "append", GroupStateTimeout.NoTimeout)


def new_identities(rows: DataFrame, keys: list[str], ts: str, delay: str | None = None) -> DataFrame:
    """The first row of each identity.  As an append-only ledger it remembers all
    identities; with a ``delay`` it drops their state after it, to bound it."""
    if delay is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
