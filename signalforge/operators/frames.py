"""Operators that SQL cannot express: HTML parsing by the standard parser, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SKIPPED = ("script", "style", "noscript", "template")


class Visible(HTMLParser):
    """Visible text, with the addresses of personal profiles put after their link's text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0
        self.links: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.hidden += 1
        elif tag == "a":
            self.links.append(dict(attrs).get("href") or "")

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.hidden = max(0, self.hidden - 1)
        elif tag == "a" and self.links and "/in/" in (link := self.links.pop()):
            self.parts.append(f" {link} ")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)

    @classmethod
    def of(cls, html: str | None) -> str:
        parser = cls()
        parser.feed(html or "")
        parser.close()
        return " ".join("".join(parser.parts).split())


#: Bytes of HTML that are parsed at once: a batch may hold thousands of pages.
PIECE = 1 << 20


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """A batch as runs of whole rows of about `most` bytes of a column; a longer row is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for k, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def visible_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in pieces(batch, "html"):
            yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array([Visible.of(h.as_py()) for h in b.column("html")], pa.string())], ["page_id", "visible"])


def text_with_links(pages: DataFrame) -> DataFrame:
    """(page_id, visible) of pages (page_id, html), in pieces of bounded size. Null html: empty text."""
    return pages.select("page_id", "html").mapInArrow(visible_texts, "page_id long, visible string")


def html_text_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_with_links(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def html_managers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People whom a page names with a profile or as the one to write to."""
    seen = text_with_links(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    near = F.regexp_extract_all("visible", F.lit(r"([A-Z][a-z]+ [A-Z][a-z]+)\s+https?://\S*/in/"), F.lit(1))
    told = F.regexp_extract_all("visible", F.lit(r"(?:[Rr]each out to|[Cc]ontact|[Hh]iring manager:?) ([A-Z][a-z]+ [A-Z][a-z]+)"), F.lit(1))
    return seen.select("page_id", F.array_join(F.array_sort(F.array_distinct(F.concat(near, told))), ",").alias("managers"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"html_text_links": html_text_links, "html_managers": html_managers}


def oracle_sql() -> dict[str, str]:
    return {}
