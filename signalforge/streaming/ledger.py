"""Keyed state over streams: a cache whose entries end, and a ledger of calls to try again.

Both keep one small entry a key in the state store (RocksDB, so it need not fit in memory) and go by event time: rows of a key
are taken in the order of (ts, event_id) within a micro-batch, what is due by a row's time happens before the row, and timers
do what no further row brings about once the watermark has passed. So the rows given out do not depend on where the
micro-batches were cut, and a query that is started again from its checkpoint goes on as if it had not stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from signalforge.sources.shared import shared_folder
from signalforge.streaming.incremental import event_stream

#: How long an entry of the cache holds, and after how long a throttled call may be tried again.
TTL, PAUSE = timedelta(days=7), timedelta(hours=6)
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ms(t: datetime) -> int:
    return int((t if t.tzinfo else t.replace(tzinfo=timezone.utc)).timestamp() * 1000 + 0.5)


def _in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=lambda r: (r["ms"], r["event_id"]))


class TtlCache(StatefulProcessor):
    """Rows of kind 'set' store an entry; others look it up: HIT while it holds, else MISS. An entry that has ended is removed by a timer."""

    def __init__(self, ttl: timedelta = TTL) -> None:
        self.ttl = int(ttl.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ends = handle.getValueState("ends", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.ends.get()[0] if self.ends.exists() else None
        ends = before
        for r in _in_order(rows):
            if r["kind"] == "set":
                ends = r["ms"] + self.ttl
                state = "STORED"
            else:
                state = "HIT" if ends is not None and r["ms"] < ends else "MISS"
            yield Row(event_id=r["event_id"], state=state)
        if ends is not None and ends != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.ends.update((ends,))
            self.handle.registerTimer(ends)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.ends.clear()
        yield from ()

    def close(self) -> None:
        pass


class RetryLedger(StatefulProcessor):
    """A 'throttled' row counts an attempt and makes its key eligible PAUSE later; a 'done' row clears the key.

    Given out is every time at which a key became eligible again: (key, eligible_ms, attempts). A key that is throttled or
    done before that is not given out for the earlier attempt.
    """

    def __init__(self, pause: timedelta = PAUSE) -> None:
        self.pause = int(pause.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "attempts long, eligible long")

    def _load(self) -> tuple[int, int]:
        """Attempts so far, and when the key becomes eligible (0: nothing is waiting)."""
        return tuple(self.entry.get()) if self.entry.exists() else (0, 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        attempts, eligible = self._load()
        waiting = eligible
        for r in _in_order(rows):
            if eligible and eligible <= r["ms"]:
                yield Row(key=key[0], eligible_ms=eligible, attempts=attempts)
                eligible = 0
            if r["kind"] == "throttled":
                attempts, eligible = attempts + 1, r["ms"] + self.pause
            elif r["kind"] == "done":
                attempts, eligible = 0, 0
        if waiting and waiting != eligible:
            self.handle.deleteTimer(waiting)
        if eligible and waiting != eligible:
            self.handle.registerTimer(eligible)
        self.entry.update((attempts, eligible)) if attempts else self.entry.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        attempts, eligible = self._load()
        if eligible == expiredTimerInfo.getExpiryTimeInMs():
            yield Row(key=key[0], eligible_ms=eligible, attempts=attempts)
            self.entry.update((attempts, 0))

    def close(self) -> None:
        pass


def keyed(stream: DataFrame, key: str, kind, late: str = "0 seconds") -> DataFrame:
    """(key, kind, event_id, ts, ms) of a stream of events; rows of another kind than the processor knows are looked at only."""
    rows = stream.select(F.col(key).alias("key"), kind.alias("kind"), "event_id", "ts", F.expr("unix_millis(CAST(ts AS TIMESTAMP))").alias("ms"))
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def cached(rows: DataFrame, ttl: timedelta = TTL) -> DataFrame:
    return rows.groupBy("key").transformWithState(TtlCache(ttl), "event_id long, state string", "append", "eventTime")


def eligible_again(rows: DataFrame, pause: timedelta = PAUSE) -> DataFrame:
    return rows.groupBy("key").transformWithState(RetryLedger(pause), "key long, eligible_ms long, attempts long", "append", "eventTime")


def run_to_table(out: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over what is there now, then once more for what the watermark has made due."""
    spark = out.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def _over(spark: SparkSession, out: DataFrame, name: str) -> DataFrame:
    path = shared_folder(spark, name)
    run_to_table(out, path, shared_folder(spark, f"{name}-state"))
    return spark.read.schema(out.schema).parquet(path)


#: In the table of events, purchases store an entry and errors are calls that were throttled.
CACHE_KIND, RETRY_KIND = "CASE WHEN event_type = 'purchase' THEN 'set' ELSE 'get' END", "CASE event_type WHEN 'error' THEN 'throttled' WHEN 'purchase' THEN 'done' ELSE 'other' END"


def inc_ttl_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a user against the cache of that user's purchases, which hold seven days."""
    return _over(spark, cached(keyed(event_stream(spark, sf_dir), "user_id", F.expr(CACHE_KIND))), "cache")


def led_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When users whose calls failed may be called again, as far as the stream's time has come."""
    return _over(spark, eligible_again(keyed(event_stream(spark, sf_dir), "user_id", F.expr(RETRY_KIND))), "ledger").withColumnRenamed("key", "user_id")


CACHE_SQL = f"""SELECT event_id, CASE WHEN kind = 'set' THEN 'STORED' WHEN ms < last_value(CASE WHEN kind = 'set' THEN ms END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {int(TTL.total_seconds() * 1000)} THEN 'HIT' ELSE 'MISS' END AS state
 FROM (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, {CACHE_KIND} AS kind FROM events) e"""
RETRY_SQL = f"""SELECT user_id, eligible_ms, attempts FROM (
 SELECT user_id, ms + {int(PAUSE.total_seconds() * 1000)} AS eligible_ms, CAST(count(*) OVER (PARTITION BY user_id, round ORDER BY ms, event_id) AS BIGINT) AS attempts, next_ms, newest
 FROM (SELECT *, lead(ms) OVER w AS next_ms, sum(CASE WHEN kind = 'done' THEN 1 ELSE 0 END) OVER w AS round
 FROM (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, {RETRY_KIND} AS kind, (SELECT epoch_us(max(ts)) // 1000 FROM events) AS newest FROM events WHERE event_type IN ('error', 'purchase')) e
 WINDOW w AS (PARTITION BY user_id ORDER BY ms, event_id)) s WHERE kind = 'throttled') t WHERE (next_ms IS NULL OR next_ms >= eligible_ms) AND eligible_ms <= newest"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"inc_ttl_cache": inc_ttl_cache, "led_throttle": led_throttle}


def oracle_sql() -> dict[str, str]:
    return {"inc_ttl_cache": CACHE_SQL, "led_throttle": RETRY_SQL}
