"""The two tables that leads are stored in: opened and checked by the catalog, appended to with a commit, and never half seen.

`open_table` makes a table that is absent (only when live), and refuses one whose columns are not the expected ones in their
order. `CheckedAppend` is a Spark data source that writes: every task stages its rows in a file of its own and tells the
driver how many; the driver's commit names all staged files in one manifest, and a reader sees what manifests name. A task
that fails makes Spark abort, which removes the run's staged files (one that a cancelled task was still writing may stay; no
manifest names it); a commit whose end is not known leaves them.

`write_production` gives one outcome for a batch: EMPTY, DRY_RUN, READ_FAILED, DUPLICATE, SUCCESS, FAILED or UNKNOWN. Reads of
stored keys are tried again; appends are made once.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from signalforge.operators.calls import retried

#: Messages after which it is not known whether an append took place.
UNKNOWN_RX = r"timed? ?out|429|getaddrinfo|connection reset"


class HeaderMismatch(ValueError):
    """A stored table whose columns are not the expected ones."""


def open_table(spark: SparkSession, name: str, schema: StructType, live: bool, path: str | None = None) -> str:
    """CREATED, MATCHES or MISSING; a mismatch raises when live, and is DRY_RUN else, as is a catalog that cannot be read."""
    try:
        there = spark.catalog.tableExists(name)
    except Exception:  # noqa: BLE001 - no access is no reason to stop a dry run
        if live:
            raise
        return "DRY_RUN"
    if not there:
        if not live:
            return "MISSING"
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
        return "CREATED"
    found = [c.name for c in spark.catalog.listColumns(name)]
    if found == schema.names:
        return "MATCHES"
    if live:
        raise HeaderMismatch(f"{name} has the columns {found}, expected are {schema.names}")
    return "DRY_RUN"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if re.match(r"[a-z0-9]+:", uri) else (fs.LocalFileSystem(), uri)


@dataclass
class Staged(WriterCommitMessage):
    file: str
    rows: int


class AppendWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.path, self.run, self.schema = options["path"], options["run"], schema

    def write(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        fs, root = _fs(self.path)
        name, rows, out = f"{self.run}-{uuid.uuid4().hex}.parquet", 0, None
        fs.create_dir(f"{root}/staged", recursive=True)
        for b in batches:
            out = out or pq.ParquetWriter(f"{root}/staged/{name}", b.schema, filesystem=fs)
            out.write_batch(b)
            rows += b.num_rows
        if out:
            out.close()
        return Staged(name if out else "", rows)

    def commit(self, messages: list[Staged | None]) -> None:
        fs, root = _fs(self.path)
        fs.create_dir(f"{root}/manifests", recursive=True)
        with fs.open_output_stream(f"{root}/manifests/{self.run}.json") as f:
            f.write(json.dumps([{"file": m.file, "rows": m.rows} for m in messages if m and m.file]).encode())

    def abort(self, messages: list[Staged | None]) -> None:
        from pyarrow.fs import FileSelector, FileType

        fs, root = _fs(self.path)
        if fs.get_file_info(f"{root}/manifests/{self.run}.json").type != FileType.NotFound:
            return  # committed, whatever the caller was told
        for f in fs.get_file_info(FileSelector(f"{root}/staged", allow_not_found=True)):
            if f.base_name.startswith(self.run):
                fs.delete_file(f.path)


class CheckedAppend(DataSource):
    @classmethod
    def name(cls) -> str:
        return "checked_append"

    def writer(self, schema: StructType, overwrite: bool) -> AppendWriter:
        return AppendWriter(dict(self.options), schema)


def committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that the manifests of a table name."""
    from pyarrow.fs import FileSelector

    fs, root = _fs(path)
    files: list[str] = []
    for m in fs.get_file_info(FileSelector(f"{root}/manifests", allow_not_found=True)):
        with fs.open_input_stream(m.path) as f:
            files += [f"{path}/staged/{x['file']}" for x in json.loads(f.read())]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


@dataclass
class Written:
    outcome: str
    attempted: int
    written: int


def append_once(rows: DataFrame, path: str, source: type[DataSource] = CheckedAppend) -> Written:
    """One append, not tried again: SUCCESS with its rows, FAILED with none, or UNKNOWN."""
    n = rows.count()
    try:
        rows.sparkSession.dataSource.register(source)
        rows.write.format(source.name()).mode("append").option("path", path).option("run", uuid.uuid4().hex).save()
        return Written("SUCCESS", n, n)
    except Exception as error:  # noqa: BLE001 - the outcome is what a caller acts on
        return Written("UNKNOWN" if re.search(UNKNOWN_RX, str(error).lower()) else "FAILED", n, 0)


def write_production(rows: DataFrame, paths: dict[str, str], live: bool, read: Callable[[str], DataFrame] | None = None, sources: dict[str, type[DataSource]] | None = None, sleep: Callable[[float], None] = time.sleep) -> Written:
    """Append rows (destination, post_url, ...) to the table of their destination, those whose address no table holds yet."""
    spark, schema = rows.sparkSession, rows.schema
    total = rows.count()
    if not total:
        return Written("EMPTY", 0, 0)
    if not live:
        return Written("DRY_RUN", total, 0)
    stored = read or (lambda p: committed(spark, p, schema))
    try:
        held = [retried(lambda p=p: stored(p).select("post_url"), sleep=sleep) for p in paths.values()]
    except Exception:  # noqa: BLE001 - nothing is written where the keys are not known
        return Written("READ_FAILED", total, 0)
    keys = held[0]
    for h in held[1:]:
        keys = keys.union(h)
    first = rows.dropDuplicates(["post_url"])
    new = first.join(keys, "post_url", "left_anti").select(rows.columns)
    sizes = {r["destination"]: r["count"] for r in new.groupBy("destination").count().collect()}  # a row a table
    if not sizes:
        return Written("DUPLICATE", total, 0)
    done = [append_once(new.filter(F.col("destination") == name), path, (sources or {}).get(name, CheckedAppend)) for name, path in paths.items() if sizes.get(name)]
    outcomes = [w.outcome for w in done]
    if not done:
        return Written("EMPTY", total, 0)
    outcome = "SUCCESS" if all(o == "SUCCESS" for o in outcomes) else "UNKNOWN" if "UNKNOWN" in outcomes else "FAILED"
    return Written(outcome, total, sum(w.written for w in done))
