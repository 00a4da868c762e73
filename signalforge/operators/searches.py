"""Queries through the post search: the composed items are recorded as a search returns them, and searched."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalforge.functions.dialect import Checker
from signalforge.operators.relations import assemble
from signalforge.plans.store import relation
from signalforge.sources.search import MIN_MAX_POSTS, NO_ADDRESS_OR_TEXT, RECORDED, posts_of, search
from signalforge.sources.shared import shared_folder

#: Posts of `src_single` come from this keyword, of which it asks for fewer than the least.
KEYWORD, ASKED = "query 5", 4


def record(spark: SparkSession, sf_dir: str) -> str:
    """All raw items, as JSON lines in a folder for each keyword."""
    path = shared_folder(spark, "recorded")
    relation(spark, sf_dir, RECORDED, ("raw_items",)).repartition("source_query").sortWithinPartitions("source_query", "ingest_seq").write.partitionBy("source_query").json(path)
    return path


def src_bulk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts of a search for every keyword, in one read."""
    return posts_of(search(spark, recorded=record(spark, sf_dir)))


def src_search_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same search could not read, by keyword: errors in the items and records without address or text."""
    return search(spark, recorded=record(spark, sf_dir)).filter("error IS NOT NULL").groupBy("source_query", "error").count().withColumnRenamed("count", "n")


def src_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest posts of one keyword; a search asks for ten at least."""
    return posts_of(search(spark, [KEYWORD], ASKED, recorded=record(spark, sf_dir)))


def _sql(source: str) -> str:
    card = lambda c: f"CASE WHEN card_type = 'job' THEN trim({c}) ELSE '' END"
    none = lambda c: f"coalesce(nullif({c}, ''), 'Unclear')"
    return f"""SELECT source_query, split_part(post_url, '?', 1) AS post_url, text, author_name, split_part(author_profile_url, '?', 1) AS author_profile_url, coalesce(strftime(make_timestamp(posted_ms * 1000), '%Y-%m-%dT%H:%M:%S+00:00'), '') AS post_date,
 {card('card_location')} AS job_card_location, {none(f"regexp_replace({card('card_subtitle')}, '(?i)^job by ', '')")} AS job_card_company, {none(f"coalesce(nullif({card('card_employment')}, ''), {card('card_type')})")} AS job_card_employment_type,
 {none(card('card_experience'))} AS job_card_experience, regexp_extract(post_url, 'activity-([0-9]+)', 1) AS activity_id FROM {source} WHERE error IS NULL AND trim(text) <> '' AND post_url <> ''"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (src_bulk_search, src_search_errors, src_single)}


def oracle_sql() -> dict[str, str]:
    newest = f"(SELECT * FROM raw_items WHERE source_query = '{KEYWORD}' ORDER BY coalesce(posted_ms, -1) DESC, ingest_seq LIMIT {max(ASKED, MIN_MAX_POSTS)}) i"
    made = {
        "src_bulk_search": _sql("raw_items"),
        "src_search_errors": f"SELECT source_query, CASE WHEN error IS NULL THEN '{NO_ADDRESS_OR_TEXT}' ELSE error END AS error, CAST(count(*) AS BIGINT) AS n FROM raw_items WHERE error IS NOT NULL OR trim(text) = '' OR post_url = '' GROUP BY 1, 2",
        "src_single": _sql(newest),
    }
    return {name: assemble(Checker(), body, ("raw_items",)) for name, body in made.items()}
