"""Queries on state that is kept from run to run: queues, histories, replayed sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.operators import ledger
from quarryline.plans.catalogue import _events, query
from quarryline.streaming import sinks
from quarryline.workspace import Workspace

_VISITS = """WITH p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM events),
    v AS (SELECT *, CAST(sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 4 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS BIGINT) AS visit FROM p)"""


@query(
    f"""{_VISITS} SELECT event_id, user_id, event_type, visit, min(ts) OVER (PARTITION BY user_id, event_type, visit) AS first_seen,
    row_number() OVER (PARTITION BY user_id, event_type, visit ORDER BY ts, event_id) AS attempt FROM v"""
)
def queue_attempts(spark, sf_dir):
    """When each queued item was first seen and how often it was tried; one that isn't
    seen for over four days is forgotten."""
    found = ledger.attempts(_events(spark, sf_dir), ["user_id", "event_type"], "ts", "event_id", "4 days")
    return found.select("event_id", "user_id", "event_type", "visit", "first_seen", "attempt")


@query(
    """WITH p AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS r FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    h AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS revision, count(*) OVER (PARTITION BY user_id) AS n FROM p WHERE r = 1 OR before IS DISTINCT FROM event_type)
    SELECT user_id, event_id, event_type, revision FROM h WHERE revision > n - 20"""
)
def bounded_history(spark, sf_dir):
    """The last twenty changes of each user's state; repeats aren't appended."""
    found = ledger.bounded_history(_events(spark, sf_dir), ["user_id"], "event_type", 20, F.asc("ts"), F.asc("event_id"))
    return found.select("user_id", "event_id", "event_type", "revision")


def _weeks(spark, sf_dir):
    """Events by the week of their month, as three and more batches."""
    rows = _events(spark, sf_dir)
    return rows.withColumn("week", F.floor((F.dayofmonth("ts") - 1) / 7).cast("int"))


@query(
    """SELECT CAST((day(ts) - 1) // 7 AS INTEGER) AS batch, count(*) AS events, count(*) FILTER (event_type = 'error') AS failed, count(DISTINCT user_id) AS streams, count(*) AS kept FROM events GROUP BY ALL"""
)
def replayed_runs(spark, sf_dir):
    """Events and run metadata of weekly batches, of which two were written twice, with
    the events that the ledger keeps of each."""
    path = Workspace(spark, "sinks").path
    rows = Workspace(spark, "weeks").keep(_weeks(spark, sf_dir), "weeks")
    write = sinks.events_and_runs(path, {"events": F.count("*"), "failed": F.count_if(F.expr("event_type = 'error'")), "streams": F.count_distinct("user_id")})
    for number in (0, 1, 2, 1, 3, 4, 4):
        write(rows.where(F.col("week") == number).drop("week"), number)
    events, runs = sinks.read_events(spark, path)
    kept = events.groupBy("batch").agg(F.count("*").alias("kept"))
    return runs.where("events > 0").join(kept, "batch").select("batch", "events", "failed", "streams", "kept")


@query(
    """WITH d AS (SELECT user_id, (day(ts) - 1) // 7 AS week, 1 + (day(ts) - 1) % 10 AS day, value FROM events),
    b AS (SELECT user_id, week, day, max(value) AS value FROM d GROUP BY ALL)
    SELECT user_id, CAST(day AS INTEGER) AS day, arg_max(value, week) AS value FROM b GROUP BY user_id, day"""
)
def merged_versions(spark, sf_dir):
    """A series by user and day of ten, after weekly batches: the newest batch wins."""
    path = Workspace(spark, "series").path
    rows = Workspace(spark, "weeks").keep(_weeks(spark, sf_dir).select("user_id", "week", (1 + (F.dayofmonth("ts") - 1) % 10).alias("day"), "value"), "weeks")
    write = sinks.series_versions(path, ["user_id"], "day", "value")
    for number in (0, 1, 2, 2, 3, 4):
        write(rows.where(F.col("week") == number).drop("week"), number)
    return sinks.read_series(spark, path)
