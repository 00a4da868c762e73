"""Incremental runs: an idempotent sink, a keyed verdict cache, and watermark-bounded de-duplication.

Each function takes a streaming frame, so tests and queries can drive them by a file source and an available-now trigger.
The sink's state lies in the table itself: every micro-batch is joined against the keys already stored and appended, so a
replayed batch writes nothing twice; the stored batch number guards against a batch that was written but not recorded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalforge.sources.shared import exists, shared_folder


#: Stored keys lie in so many folders by their hash; a batch reads those of its own keys only.
BUCKETS = 64


def append_new(target: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: the first row of each key that the target does not hold yet is appended.

    The target is partitioned by a bucket of the key, so that a batch is joined with the folders of its own buckets, not
    with all that was ever stored. A batch that is run again, whether it was written or not, finds its keys there.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first = batch.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_n = 1").drop("_n")
        first = first.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
        if exists(spark, target):
            met = [r["bucket"] for r in first.select("bucket").distinct().collect()]  # BUCKETS at most
            stored = spark.read.parquet(target).filter(F.col("bucket").isin(met)).select("bucket", key)
            first = first.join(stored, ["bucket", key], "left_anti")
        first.withColumn("batch_no", F.lit(number)).write.mode("append").partitionBy("bucket").parquet(target)

    return write


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    batch = spark.read.parquet(path)
    reader = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1)
    if batch.inputFiles()[0].endswith("/events.parquet"):  # one file, not a folder of them: a stream reads folders
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(path)


def inc_idempotent_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and type, appended once, though the stream is replayed from its start."""
    target = shared_folder(spark, "sink")
    stream = event_stream(spark, sf_dir).withColumn("key", F.concat_ws("/", "user_id", "event_type"))
    for _ in range(2):
        run_available(stream, append_new(target, "key", "event_id"), shared_folder(spark, "state"))
    return spark.read.parquet(target).select("key", "event_id")


def once_within(stream: DataFrame, keys: list[str], late: str = "24 hours") -> DataFrame:
    """Each event once, though it may come again while it is not older than `late`; what comes later than that is dropped.

    The state holds the keys of that span only, however long the stream runs.
    """
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def inc_pull_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last day before the newest one, from a stream that brings each event twice."""
    path = shared_folder(spark, "pull")
    stream = event_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    twice = once_within(stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))), ["event_id"])
    twice.writeStream.format("parquet").option("path", path).option("checkpointLocation", shared_folder(spark, "pull-state")).trigger(availableNow=True).start().awaitTermination()
    events = spark.read.schema(twice.schema).parquet(path)
    newest = events.agg(F.max("ts").alias("newest"))
    return events.join(F.broadcast(newest), F.col("ts") > F.col("newest") - F.expr("INTERVAL 24 HOURS")).select("event_id", "user_id", "event_type")


def inc_verdict_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last verdict of each key wins; only evaluated ones are final."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    last = events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"), F.count("*").alias("versions"))
    return last.withColumn("final", F.col("event_type") != "error")


PULL_SQL = "SELECT event_id, user_id, event_type FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOURS"
CACHE_SQL = "SELECT user_id, arg_max(event_type, row(ts, event_id)) AS event_type, CAST(count(*) AS BIGINT) AS versions, arg_max(event_type, row(ts, event_id)) <> 'error' AS final FROM events GROUP BY user_id"
SINK_SQL = "SELECT concat_ws('/', user_id, event_type) AS key, min(event_id) AS event_id FROM events GROUP BY 1"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"inc_idempotent_sink": inc_idempotent_sink, "inc_pull_24h": inc_pull_24h, "inc_verdict_cache": inc_verdict_cache}


def oracle_sql() -> dict[str, str]:
    return {"inc_idempotent_sink": SINK_SQL, "inc_pull_24h": PULL_SQL, "inc_verdict_cache": CACHE_SQL}
