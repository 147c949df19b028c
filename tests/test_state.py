"""Keyed state and replayed batches, against their batch twins."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quarryline.operators import ledger, runs
from quarryline.streaming import queues, sinks
from quarryline.workspace import Workspace

SCHEMA = "key string, ts timestamp, event_id long, value double"


def visits(rows):
    rng = random.Random(rows)
    at = lambda h: dt.datetime(2024, 3, 1) + dt.timedelta(hours=h)
    hours = sorted(rng.randrange(2000) for _ in range(rows))
    return [(rng.choice("abc"), at(h), i, float(rng.randrange(2))) for i, h in enumerate(hours)]


def test_a_queue_in_three_runs_is_like_the_batch(spark, tmp_path):
    rows, stay = visits(150), 60
    source, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    for i in range(3):  # three runs of one query
        spark.createDataFrame(rows[50 * i : 50 * i + 50], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        opened = spark.readStream.schema(SCHEMA).parquet(source)
        run = queues.queue_states(opened, stay * 3_600_000, most=5).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
    got = {r.event_id: r for r in spark.read.parquet(out).collect()}
    batch = ledger.attempts(spark.createDataFrame(rows, SCHEMA), ["key"], "ts", "event_id", f"{stay} hours")
    want = {r.event_id: r for r in batch.collect()}
    assert set(got) == set(want) == set(range(150))
    assert all((got[i].first_seen, got[i].attempt) == (want[i].first_seen, want[i].attempt) for i in want)
    changes = {r.event_id: r.revision for r in ledger.revisions(batch, ["key", "visit"], "value", F.asc("ts"), F.asc("event_id")).collect()}
    assert {i: r.revision for i, r in got.items() if r.appended} == changes
    assert all(r.kept == min(r.revision, 5) for r in got.values()) and max(r.kept for r in got.values()) == 5
    assert len({(r.key, r.first_seen) for r in got.values()}) > 6  # some were forgotten


def test_attempts_against_a_loop(spark):
    rows = visits(120)
    want, last = {}, {}
    for key, ts, i, _ in rows:
        first, before, n, visit = last.get(key, (None, None, 0, 0))
        if before is None or ts > before + dt.timedelta(hours=40):
            first, n, visit = ts, 0, visit + 1
        last[key] = (first, ts, n + 1, visit)
        want[i] = (visit, first, n + 1)
    found = ledger.attempts(spark.createDataFrame(rows, SCHEMA).repartition(3), ["key"], "ts", "event_id", "40 hours")
    assert {r.event_id: (r.visit, r.first_seen, r.attempt) for r in found.collect()} == want


def test_runs_of_a_key_over_many_parts(spark):
    """One key with most rows, a null key and null values, dealt over seven parts."""
    rng = random.Random(1)
    rows = [("hot", i, rng.choice([None, 1, 2])) for i in range(400)] + [(None, i, i % 3) for i in range(20)] + [("z", 5, None)]
    frame = spark.createDataFrame(rows, "k string, n long, v long")
    order = [F.asc("n")]
    dealt = Workspace(spark, "t").keep(frame.repartitionByRange(7, "k", "n").withColumn("_part", F.spark_partition_id()), "dealt")
    assert dealt.where("k = 'hot'").select("_part").distinct().count() > 3
    found = runs.running_sum(dealt, ["k"], order, F.coalesce("v", F.lit(0)), "total")
    found = runs.previous_row(found, ["k"], order, F.col("v"), "before")
    found = runs.last_value(found, ["k"], order, F.col("v"), "known")
    total, before, known, want = {}, {}, {}, {}
    for k, n, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        total[k] = total.get(k, 0) + (v or 0)
        prior = before.get(k)
        before[k] = (v,)
        known[k] = known.get(k) if v is None else v
        want[(k, n)] = (total[k], prior, known[k])
    assert {(r.k, r.n): (r.total, tuple(r.before) if r.before else None, r.known) for r in found.collect()} == want


def test_two_sinks_and_a_replay(spark, tmp_path):
    write = sinks.events_and_runs(str(tmp_path), {"events": F.count("*"), "largest": F.max("value")})
    rows = spark.createDataFrame(visits(60), SCHEMA)
    for number in (0, 1, 1, 2):
        write(rows.where(f"event_id div 20 = {number}"), number)
    events, told = sinks.read_events(spark, str(tmp_path))
    assert events.count() == 60 and sorted((r.batch, r.events) for r in told.collect()) == [(0, 20), (1, 20), (2, 20)]
    # a batch of which only the first write was done doesn't count, until it is tried again
    rows.limit(5).write.parquet(f"{tmp_path}/events/batch=3")
    assert sinks.read_events(spark, str(tmp_path))[0].count() == 60
    write(rows.limit(5), 3)
    write(rows.limit(0), 4)
    events, told = sinks.read_events(spark, str(tmp_path))
    assert events.count() == 65 and {r.batch: r.events for r in told.collect()}[4] == 0


def test_the_sinks_take_a_stream(spark, tmp_path):
    source = f"{tmp_path}/in"
    for i in range(3):
        spark.createDataFrame(visits(60)[20 * i : 20 * i + 20], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    opened = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    write = sinks.events_and_runs(f"{tmp_path}/sink", {"events": F.count("*")})
    opened.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    events, told = sinks.read_events(spark, f"{tmp_path}/sink")
    assert events.count() == 60 and told.count() == 3


def test_a_series_never_goes_back(spark, tmp_path):
    write = sinks.series_versions(str(tmp_path), ["t"], "d", "p", span="10 days")
    day = lambda n: dt.date(2024, 1, n)
    frame = lambda rows: spark.createDataFrame(rows, "t string, d date, p double")
    write(frame([("a", day(1), 1.0), ("a", day(5), 5.0), ("b", day(2), 2.0)]), 0)
    for _ in range(2):
        write(frame([("a", day(5), 50.0), ("a", day(14), 14.0)]), 1)
    want = [("a", day(5), 50.0), ("a", day(14), 14.0), ("b", day(2), 2.0)]
    assert sorted(tuple(r) for r in sinks.read_series(spark, str(tmp_path)).select("t", "d", "p").collect()) == want
    write(frame([]), 2)
    assert sorted(tuple(r) for r in sinks.read_series(spark, str(tmp_path)).select("t", "d", "p").collect()) == want
