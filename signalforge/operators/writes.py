"""Queries through the checked append: what becomes of a batch in runs that end in each of the ways that a run can end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalforge.functions.dialect import Checker
from signalforge.operators.relations import assemble
from signalforge.plans.store import relation
from signalforge.sources import sheets
from signalforge.sources.shared import shared_folder

BATCH = "SELECT destination, post_url, final_category, final_company, exact_role FROM batch WHERE barrier = ''"


class RefusedWriter(sheets.AppendWriter):
    """A writer whose tasks are refused after they have staged their rows."""

    def write(self, batches):
        super().write(batches)
        raise PermissionError("the table does not take rows")


class CutOffWriter(sheets.AppendWriter):
    """A writer whose commit takes place but is not answered."""

    def commit(self, messages):
        super().commit(messages)
        raise TimeoutError("timed out")


class Refused(sheets.CheckedAppend):
    @classmethod
    def name(cls) -> str:
        return "refused_append"

    def writer(self, schema, overwrite):
        return RefusedWriter(dict(self.options), schema)


class CutOff(sheets.CheckedAppend):
    @classmethod
    def name(cls) -> str:
        return "cut_off_append"

    def writer(self, schema, overwrite):
        return CutOffWriter(dict(self.options), schema)


def snk_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch written in eight runs: (run, outcome, attempted, written, stored), the last being the rows a reader then sees."""
    rows = relation(spark, sf_dir, BATCH, ("batch",))

    def tables() -> dict[str, str]:
        return {name: shared_folder(spark, name) for name in ("MAIN", "DATA")}

    def unreadable(path: str) -> DataFrame:
        raise ConnectionError("no route to the table")

    one, done = tables(), []

    def run(name: str, paths: dict[str, str], frame: DataFrame = rows, live: bool = True, **how) -> None:
        w = sheets.write_production(frame, paths, live, sleep=lambda s: None, **how)
        done.append((name, w.outcome, w.attempted, w.written, sum(sheets.committed(spark, p, rows.schema).count() for p in paths.values())))

    run("none", one, rows.limit(0))
    run("dry", one, live=False)
    run("unreadable", one, read=unreadable)
    run("refused", one, sources={"MAIN": Refused, "DATA": Refused})
    run("first", one)
    run("again", one)
    run("half", tables(), sources={"DATA": Refused})
    run("cut off", tables(), sources={"MAIN": CutOff, "DATA": CutOff})
    return spark.createDataFrame(done, "run string, outcome string, attempted long, written long, stored long")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"snk_outcome": snk_outcome}


def oracle_sql() -> dict[str, str]:
    """Where nothing passes the barrier at all, every run is EMPTY; with rows for one table only, the other is not written to."""
    body = f"""SELECT run, CASE WHEN n = 0 THEN 'EMPTY' WHEN run = 'half' AND n_data = 0 THEN 'SUCCESS' ELSE outcome END AS outcome, CASE WHEN run = 'none' THEN 0 ELSE n END AS attempted,
 CASE run WHEN 'first' THEN n WHEN 'half' THEN n - n_data ELSE 0 END AS written, CASE WHEN run IN ('first', 'again', 'cut off') THEN n WHEN run = 'half' THEN n - n_data ELSE 0 END AS stored
 FROM (SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(CASE WHEN destination = 'DATA' THEN 1 END) AS BIGINT) AS n_data FROM ({BATCH}) b) t
 CROSS JOIN (VALUES ('none', 'EMPTY'), ('dry', 'DRY_RUN'), ('unreadable', 'READ_FAILED'), ('refused', 'FAILED'), ('first', 'SUCCESS'), ('again', 'DUPLICATE'), ('half', 'FAILED'), ('cut off', 'UNKNOWN')) AS r(run, outcome)"""
    return {"snk_outcome": assemble(Checker(), body, ("batch",))}
