"""Readers and writers of record files, and table writes that are checked: all of them Spark reads and writes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON documents (one a line) of unknown shape: records themselves, or dicts whose first list value holds them.

    Spark sorts the fields that it infers, so which list comes first is read from the first document itself.
    """
    found = spark.read.json(path)
    lists = [f.name for f in found.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
    if len(lists) > 1:
        first = spark.read.text(path).filter("trim(value) <> ''").head()
        lists = [k for k in json.loads(first["value"]) if k in lists] or lists
    return found.select(F.inline(lists[0])) if lists else found


def read_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines of a known schema; lines that are no such record are left out, records without any value are kept."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    marked = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    return spark.read.schema(marked).option("columnNameOfCorruptRecord", "_broken").json(path).filter("_broken IS NULL").drop("_broken")


def write_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def read_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header, quoted fields and line ends inside them."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(path)


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


class GateRequired(RuntimeError):
    """A live write without the production gate."""


def guard(live: bool, gated: bool, allowed: bool = False) -> None:
    """Refuse a live write that no gate has seen, unless it was allowed in so many words."""
    if live and not gated and not allowed:
        raise GateRequired("a live write needs the production gate")


def append_rows(rows: DataFrame, path: str, live: bool, gated: bool = False, allowed: bool = False) -> None:
    """Append to a table; a dry run (live=False) checks the plan and writes nothing."""
    guard(live, gated, allowed)
    if live:
        rows.write.mode("append").parquet(path)
    else:
        rows.write.format("noop").mode("overwrite").save()


def fingerprint(rows: DataFrame) -> tuple[int, int]:
    """How many rows there are, and a sum of their hashes, which their order does not change."""
    r = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("h")).first()
    return r["n"], int(r["h"] or 0)


def replace_verified(rows: DataFrame, path: str) -> DataFrame:
    """Write rows to a new path, read them again, and give them out only if they are the same rows: one pass over each."""
    rows.write.mode("errorifexists").parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    if fingerprint(rows) != fingerprint(stored):
        raise RuntimeError("the stored rows differ from those written")
    return stored
