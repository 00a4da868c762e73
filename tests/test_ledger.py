"""Keyed state over streams against replays, across micro-batches and restarts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalforge.streaming import ledger
from signalforge.streaming.incremental import once_within

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp, user_id long, kind string"


def events(n, seed, kinds):
    rng = random.Random(seed)
    times = sorted(rng.randrange(30 * 24 * 3600) for _ in range(n))
    return [(i, START + timedelta(seconds=t), rng.randrange(4), rng.choice(kinds)) for i, t in enumerate(times)]


def ms(t):
    return int((t - START).total_seconds() * 1000) + 1704067200000


def run(spark, tmp_path, rows, cuts, operator, restart=True):
    """The rows given out when `rows` come in several files, each in a query that starts from the checkpoint of the last."""
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[a:b], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        ledger.run_to_table(operator(ledger.keyed(stream, "user_id", F.col("kind"))), f"{tmp_path}/out", f"{tmp_path}/state")
    return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())


def replay_cache(rows, ttl):
    ends, out = {}, []
    for i, ts, user, kind in rows:
        if kind == "set":
            ends[user] = ts + ttl
            out.append((i, "STORED"))
        else:
            out.append((i, "HIT" if user in ends and ts < ends[user] else "MISS"))
    return sorted(out)


def replay_retries(rows, pause):
    waiting, attempts, out = {}, {}, []
    newest = rows[-1][1]
    for _, ts, user, kind in rows:
        if user in waiting and waiting[user] <= ts:
            out.append((user, ms(waiting.pop(user)), attempts[user]))
        if kind == "throttled":
            attempts[user] = attempts.get(user, 0) + 1
            waiting[user] = ts + pause
        elif kind == "done":
            attempts[user] = 0
            waiting.pop(user, None)
    return sorted(out + [(u, ms(t), attempts[u]) for u, t in waiting.items() if t <= newest])


@pytest.mark.parametrize("cuts", [[], [20, 21, 60]])
def test_cache_keeps_entries_over_restarts_and_lets_them_end(spark, tmp_path, cuts):
    rows = events(90, 3, ["set", "get", "get", "get"])
    got = run(spark, tmp_path, rows, cuts, lambda s: ledger.cached(s, timedelta(days=1)))
    assert got == replay_cache(rows, timedelta(days=1))
    assert {s for _, s in got} == {"STORED", "HIT", "MISS"}


@pytest.mark.parametrize("cuts", [[], [30, 31, 70]])
def test_retries_become_due_by_the_streams_time(spark, tmp_path, cuts):
    rows = events(100, 5, ["throttled", "done", "other"])
    got = run(spark, tmp_path, rows, cuts, lambda s: ledger.eligible_again(s, timedelta(hours=20)))
    assert got == replay_retries(rows, timedelta(hours=20)) and got


def test_repeated_and_late_events(spark, tmp_path):
    def write(rows):
        spark.createDataFrame([(i, START + timedelta(hours=h), 1, "x") for i, h in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        once_within(stream, ["event_id"]).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()

    write([(1, 0), (1, 0), (2, 1)])
    write([(1, 2), (3, 30)])  # 1 comes again within a day
    write([(4, 3), (2, 24), (5, 60)])  # 4 is over a day late; 2 comes again within a day
    write([(2, 59)])  # the key of 2 is no longer kept
    got = sorted((r["event_id"], r["ts"].hour + 24 * (r["ts"].day - 1)) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, 0), (2, 1), (2, 59), (3, 30), (5, 60)]
