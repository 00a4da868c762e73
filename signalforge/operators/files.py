"""Queries that go through files and checked writes, each with the SQL of what must come back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalforge.functions.dialect import Checker, Dialect
from signalforge.operators.relations import assemble
from signalforge.plans.store import relation
from signalforge.sources import files
from signalforge.sources.shared import shared_folder

POSTS = "SELECT ingest_seq, post_url, text, author_name, source_query FROM raw_posts"
KEPT = "SELECT ingest_seq, post_url, major_category, market FROM gated WHERE reject_reason = ''"
REAL = "SELECT destination, source_link FROM sinks"


def _sql(d: Dialect, body: str, *needs: str) -> str:
    return assemble(d, body, needs)


def _rows(spark: SparkSession, sf_dir: str, body: str, *needs: str) -> DataFrame:
    return relation(spark, sf_dir, body, needs)


def src_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts through JSON lines and back."""
    rows, path = _rows(spark, sf_dir, POSTS, "raw_posts"), shared_folder(spark, "lines")
    files.write_lines(rows, path)
    return files.read_lines(spark, path, rows.schema)


def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts, with line ends and quotes in their texts, through CSV and back."""
    rows, path = _rows(spark, sf_dir, POSTS, "raw_posts"), shared_folder(spark, "table")
    files.write_table(rows, path)
    return files.read_table(spark, path, rows.schema)


def src_shape_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document a source query, whose list of posts is found by its shape."""
    rows, path = _rows(spark, sf_dir, "SELECT source_query, ingest_seq, post_url FROM raw_posts", "raw_posts"), shared_folder(spark, "shape")
    # A document holds the posts of one query and thousand of sequence numbers, so none grows with the table.
    packed = rows.groupBy("source_query", F.floor(F.col("ingest_seq") / 1000).alias("part")).agg(F.collect_list(F.struct("ingest_seq", "post_url")).alias("items"))
    files.write_lines(packed, path)
    return files.read_records(spark, path)


def snk_write_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ungated append: refused when live, unless allowed in so many words."""
    rows, path = _rows(spark, sf_dir, KEPT, "gated"), shared_folder(spark, "posts")
    try:
        files.append_rows(rows, path, live=True)
    except files.GateRequired:
        files.append_rows(rows, path, live=True, allowed=True)
    return spark.read.parquet(path)


def snk_replace_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored keys rewritten to a new place, read again and compared before they count."""
    return files.replace_verified(_rows(spark, sf_dir, REAL, "sinks"), shared_folder(spark, "replaced"))


def led_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts persisted by a run that was cut off, taken up from storage: those that have no outcome yet are gated."""
    path = shared_folder(spark, "ledger")
    _rows(spark, sf_dir, KEPT, "gated").filter("ingest_seq % 2 = 0").write.parquet(path)
    done = spark.read.parquet(path)
    rest = _rows(spark, sf_dir, KEPT, "gated").join(done.select("ingest_seq"), "ingest_seq", "left_anti")
    return done.withColumn("resumed", done["ingest_seq"] < 0).unionByName(rest.withColumn("resumed", rest["ingest_seq"] >= 0))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (src_jsonl, src_csv, src_shape_sniff, snk_write_posts, snk_replace_verify, led_resume)}


def oracle_sql() -> dict[str, str]:
    d = Checker()
    return {
        "src_jsonl": _sql(d, POSTS, "raw_posts"),
        "src_csv": _sql(d, POSTS, "raw_posts"),
        "src_shape_sniff": _sql(d, "SELECT ingest_seq, post_url FROM raw_posts", "raw_posts"),
        "snk_write_posts": _sql(d, KEPT, "gated"),
        "snk_replace_verify": _sql(d, REAL, "sinks"),
        "led_resume": _sql(d, "SELECT ingest_seq, post_url, major_category, market, ingest_seq % 2 <> 0 AS resumed FROM gated WHERE reject_reason = ''", "gated"),
    }
