"""Stored relations: the heavy links of the chain are computed once for a set of input tables and read from Parquet after that.

A filter on a column that a deep chain of expressions derives is pushed through the projections and copies the whole tree of
rules into the predicate. A stored relation ends the tree: what reads it prunes columns and filters on plain columns, and a
lost executor reads the table again. Tables lie below spark.checkpoint.dir, under a name for the inputs' paths, sizes and
times, so changed inputs give new tables; a session keeps its own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from signalforge.functions.dialect import TABLES, Dialect
from signalforge.functions.terms import nearest_term
from signalforge.operators import relations as R
from signalforge.sources.shared import shared_folder

#: The links that are stored, and the column that each is partitioned by, if any.
STORED = {"firsts": None, "gated": "passes", "fields": None, "posters": None, "passing_posters": None, "decided": None, "asked_decided": None, "weighed": None, "batch": None}

_paths: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def tables_of(sql: str) -> list[str]:
    """The star tables that a query names after FROM, JOIN or a comma."""
    named = set(re.findall(r"(?:FROM|JOIN|,)\s+([a-z_]+)", sql))
    return [t for t in TABLES if t in named]


def signature(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    """Paths, sizes and times of the files of some tables."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        for f in path.getFileSystem(conf).listStatus(path):
            out.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join(out)


def view_tables(spark: SparkSession, sf_dir: str, sql: str) -> None:
    for t in tables_of(sql):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, signature(spark, sf_dir, ["orders", "customer", "nation"]), name


def ensure(spark: SparkSession, sf_dir: str, name: str) -> None:
    """Make the view `name` of a stored relation, computing it where these inputs have none yet."""
    key = _key(spark, sf_dir, name)
    if key not in _paths:
        path = shared_folder(spark, name)
        rows, part = relation(spark, sf_dir, *R.link(Dialect(), name), name in ENDS), STORED[name]
        writer = rows.withColumn(part, rows["reject_reason"] == "").write.partitionBy(part) if part else rows.write
        writer.parquet(path)
        _paths[key] = path, rows.schema.add(part, "boolean") if part else rows.schema
    path, schema = _paths[key]
    spark.read.schema(schema).parquet(path).createOrReplaceTempView(name)


#: Stored relations that filter, or join by, what the one below them derives: that one is stored first.
ENDS = ("batch", "passing_posters", "asked_decided")

#: Stored relations that every query reads as tables, also one that does not filter: in one plan, what is below them would be made twice.
ALWAYS = ("firsts", "asked_decided")


def stored_needs(needs: tuple[str, ...]) -> list[str]:
    """The stored relations that a query meets first, going down from what it needs."""
    out: list[str] = []
    for name in needs:
        out += [name] if name in STORED else stored_needs(R.link(Dialect(), name)[1])
    return list(dict.fromkeys(out))


def register_functions(spark: SparkSession) -> None:
    """Make the functions known that the SQL of relations calls."""
    spark.udf.register("nearest_term", nearest_term(R.SIGNALS))


def relation(spark: SparkSession, sf_dir: str, body: str, needs: tuple[str, ...], filters: bool | None = None) -> DataFrame:
    """The rows of an SQL text over some relations.

    A text that filters reads stored relations, which are computed if need be. One that does not filter reads them where they
    are there already; else it is one plan with the relations but ALWAYS, so that columns that it does not name are not computed.
    """
    if filters is None:
        filters = re.search(r"\b(?:WHERE|HAVING|EXISTS)\b|(?<!CROSS )\bJOIN\b", body) is not None or any("WHERE" in R.link(Dialect(), n)[0] for n in needs if n not in STORED)
    given, todo = [], stored_needs(needs)
    while todo:
        name = todo.pop()
        if filters or name in ALWAYS or _key(spark, sf_dir, name) in _paths:
            ensure(spark, sf_dir, name)
            given.append(name)
        else:
            todo += stored_needs(R.link(Dialect(), name)[1])
    register_functions(spark)
    text = R.assemble(Dialect(), body, needs, tuple(given))
    view_tables(spark, sf_dir, text)
    return spark.sql(text)


def forget(spark: SparkSession) -> None:
    """Compute stored relations anew from now on."""
    for key in [k for k in _paths if k[0] == spark.sparkContext.applicationId]:
        del _paths[key]
