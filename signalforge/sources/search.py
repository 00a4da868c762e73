"""The post search as a Spark data source: one partition a keyword.

    spark.read.format("post_search").option("client", "package.module:Factory").option("keywords", '["a", "b"]').load()

Options: `keywords`, a JSON list (blank ones are left out, repeated ones are searched once; without the option, all that the
client names); `max_posts` for each keyword, of which a search asks for MIN_MAX_POSTS at least, and for all without it;
`date_filter`; `client`, what makes the client from the options in each task, by default a folder of recorded items.
A client has search(keyword, max_posts, date_filter), which gives raw items newest first, and may have keywords().

Keywords are chosen by the option, which prunes partitions, not by pushed filters: in Spark 4.1 a Python source that takes
filters keeps them for every later scan of the same loaded frame (counting all rows, those of one keyword, and all again gave
8, 4 and 4), so a filter would lose rows of other queries. A filter on the frame is applied by Spark to the rows read.

Every item becomes one row, errors too: an item with an error, or without address or text, has its `error` set, so that
nothing is lost between what was searched and what was read. Fields of a job card count only where the attachment is a job.
"""

from __future__ import annotations

import heapq
import importlib
import io
import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The least number of posts that a search asks for.
MIN_MAX_POSTS = 10
#: Where a job card keeps its kind of employment and its experience: the first that says something counts.
EMPLOYMENT_FIELDS = ("employment_type", "job_type", "work_type", "type")
EXPERIENCE_FIELDS = ("experience", "years_of_experience", "experience_required", "seniority")
NO_ADDRESS_OR_TEXT = "record missing post_url or text"
SCHEMA = "source_query string, place long, post_url string, text string, author_name string, author_profile_url string, posted_ms long, activity_id string, card_company string, card_location string, card_employment string, card_experience string, error string"
_ARROW = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in SCHEMA.split(", ")])
_BATCH = 4096


def _text(value: Any) -> str:
    return value.strip() if isinstance(value, str) else ""


def _first(card: dict, fields: tuple[str, ...]) -> str:
    return next((v for f in fields if (v := _text(card.get(f)))), "Unclear")


def _millis(value: Any) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def item_row(keyword: str, place: int, item: dict) -> tuple:
    """A raw item as a row of SCHEMA."""
    content = item.get("content")
    card = content if isinstance(content, dict) and content.get("type") == "job" else {}
    author = item["author"] if isinstance(item.get("author"), dict) else {}
    posted = _millis(item.get("timestamp"))
    if posted is None and isinstance(item.get("posted_at"), dict):
        posted = _millis(item["posted_at"].get("timestamp"))
    url, text = item.get("post_url") or "", item.get("text") or ""
    error = str(item["error"]) if item.get("error") else None if url and text.strip() else NO_ADDRESS_OR_TEXT
    subtitle = _text(card.get("subtitle"))
    company = subtitle[7:].strip() if subtitle.lower().startswith("job by ") else ""
    name = author.get("name") or item.get("owner_name") or ""
    return keyword, place, url, text, name, author.get("profile_url") or "", posted, str(item.get("activity_id") or ""), company or "Unclear", _text(card.get("description")), _first(card, EMPLOYMENT_FIELDS), _first(card, EXPERIENCE_FIELDS), error


class RecordedClient:
    """A client over JSON lines of items that a run recorded, in folders source_query=<keyword> below the option `recorded`."""

    def __init__(self, options: dict[str, str]) -> None:
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(options["recorded"]) if "://" in options["recorded"] or options["recorded"].startswith("file:") else (fs.LocalFileSystem(), options["recorded"])

    def _folders(self) -> dict[str, str]:
        from urllib.parse import unquote

        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(self.root))
        return {unquote(f.base_name.split("=", 1)[1]): f.path for f in found if f.type == fs.FileType.Directory and "=" in f.base_name}

    def keywords(self) -> list[str]:
        return sorted(self._folders())

    def _items(self, folder: str) -> Iterator[dict]:
        from pyarrow import fs

        for f in sorted(self.fs.get_file_info(fs.FileSelector(folder)), key=lambda f: f.path):
            if f.base_name.startswith("part-"):
                with io.TextIOWrapper(self.fs.open_input_stream(f.path), "utf-8", newline="\n") as lines:
                    for line in lines:
                        yield json.loads(line)

    def search(self, keyword: str, max_posts: int | None, date_filter: str | None) -> Iterator[dict]:
        folder = self._folders().get(keyword)
        if folder is None:
            return
        items = self._items(folder)
        if max_posts is None:
            yield from items
        else:  # the newest; items without a time last, in the order of the record
            newest = heapq.nsmallest(max_posts, ((-(_millis(x.get("timestamp")) or -1), k, x) for k, x in enumerate(items)), key=lambda r: r[:2])
            yield from (x for _, _, x in newest)


def _client(options: dict[str, str]):
    module, _, name = options.get("client", f"{__name__}:RecordedClient").partition(":")
    return getattr(importlib.import_module(module), name)(options)


class Keyword(InputPartition):
    def __init__(self, keyword: str) -> None:
        self.keyword = keyword


class SearchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Keyword]:
        named = json.loads(self.options["keywords"]) if "keywords" in self.options else _client(self.options).keywords()
        keywords = dict.fromkeys(k for k in (n.strip() for n in named) if k)
        return [Keyword(k) for k in keywords]

    def read(self, partition: Keyword) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing to search
            return
        limit = self.options.get("max_posts")
        items = _client(self.options).search(partition.keyword, max(int(limit), MIN_MAX_POSTS) if limit else None, self.options.get("date_filter"))
        rows: list[tuple] = []
        for place, item in enumerate(items):
            rows.append(item_row(partition.keyword, place, item))
            if len(rows) == _BATCH:
                yield _packed(rows)
                rows = []
        if rows:
            yield _packed(rows)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class PostSearch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "post_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SearchReader:
        return SearchReader(dict(self.options))


def search(spark: SparkSession, keywords: list[str] | None = None, max_posts: int | None = None, **options: str) -> DataFrame:
    """Rows of a search; see the module's options."""
    spark.dataSource.register(PostSearch)
    reader = spark.read.format("post_search").options(**options)
    if keywords is not None:
        reader = reader.option("keywords", json.dumps(keywords))
    if max_posts is not None:
        reader = reader.option("max_posts", str(max_posts))
    return reader.load()


def posts_of(items: DataFrame) -> DataFrame:
    """Posts of the rows without an error: canonical addresses, UTC times, and the job card's fields."""
    return items.filter("error IS NULL").selectExpr(
        "source_query", "split_part(post_url, '?', 1) AS post_url", "text", "author_name", "split_part(author_profile_url, '?', 1) AS author_profile_url",
        "coalesce(date_format(timestamp_millis(posted_ms), \"yyyy-MM-dd'T'HH:mm:ssxxx\"), '') AS post_date",
        "card_location AS job_card_location", "card_company AS job_card_company", "card_employment AS job_card_employment_type", "card_experience AS job_card_experience",
        "coalesce(nullif(activity_id, ''), regexp_extract(post_url, 'activity-([0-9]+)', 1)) AS activity_id",
    )


#: Raw items as a search returns them: nested, a job card in the attachment.
RECORDED = """SELECT source_query, ingest_seq, post_url, text, posted_ms AS timestamp, named_struct('name', author_name, 'profile_url', author_profile_url) AS author,
 named_struct('type', card_type, 'subtitle', card_subtitle, 'description', card_location, 'job_type', card_employment, 'experience_required', card_experience) AS content, error FROM raw_items"""
