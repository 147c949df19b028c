"""A work queue as keyed state: when a key was first seen, how often it was tried,
and the last changes of its value.

The batch twin is ``ledger.attempts`` with ``ledger.revisions`` on its visits.
State lives in RocksDB (``use_rocksdb``), one value and one bounded list a key, and
an event-time timer frees what hasn't been seen for longer than it may stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

_STATE = "key string, event_id long, first long, attempt long, revision long, appended boolean, kept long"
_COLUMNS = [c.split()[0] for c in _STATE.split(", ")]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> None:
    """State by key needs this provider; a session that chose one keeps it."""
    if "RocksDB" not in (spark.conf.get(_PROVIDER, None) or ""):
        spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Queue(StatefulProcessor):
    def __init__(self, stay_ms: int, most: int):
        self.stay, self.most = stay_ms, most

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "first long, last long, attempt long, revision long, value double")
        self.history = handle.getListState("history", "at long, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = pd.concat(list(rows)).sort_values(["us", "event_id"])
        first, last, attempt, revision, value = self.seen.get() if self.seen.exists() else (None, None, 0, 0, None)
        if last is not None:
            self._forget_timer(last)
        history = [tuple(x) for x in self.history.get()] if attempt else []
        out = []
        for at, event, x in zip(now["us"].tolist(), now["event_id"].tolist(), now["value"].tolist()):
            if last is not None and at > last + 1000 * self.stay:
                first, attempt, revision, history = None, 0, 0, []
            first, last, attempt = at if first is None else first, at, attempt + 1
            changed = revision == 0 or x != value
            if changed:
                revision, value = revision + 1, x
                history = [*history, (at, x)][-self.most :]
            out.append((key[0], event, first, attempt, revision, changed, len(history)))
        self.seen.update((first, last, attempt, revision, value))
        self.history.put(history)
        self.handle.registerTimer(self._due(last))
        yield pd.DataFrame(out, columns=_COLUMNS, dtype=object)

    def _due(self, last: int) -> int:
        return last // 1000 + self.stay + 1

    def _forget_timer(self, last: int) -> None:
        self.handle.deleteTimer(self._due(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        self.history.clear()
        yield pd.DataFrame([], columns=_COLUMNS, dtype=object)

    def close(self) -> None:
        pass


def queue_states(rows: DataFrame, stay_ms: int, most: int = 200, delay: str = "0 seconds") -> DataFrame:
    """The queue's memory after each of its ``key, ts, event_id, value`` rows.

    ``revision`` counts changes of a value that isn't null, ``appended`` marks the
    rows that change it, and ``kept`` is the length of the history, ``most`` at most.
    Rows that are later than ``delay`` behind the newest one are dropped, as
    everywhere in a stream with a watermark.  Returns ``key, event_id, first_seen,
    attempt, revision, appended, kept``.
    """
    use_rocksdb(rows.sparkSession)
    timed = rows.withColumn("us", F.unix_micros("ts")).withWatermark("ts", delay)
    found = timed.groupBy("key").transformWithStateInPandas(_Queue(stay_ms, most), _STATE, "append", "eventTime")
    return found.select("key", "event_id", F.timestamp_micros("first").alias("first_seen"), "attempt", "revision", "appended", "kept")
