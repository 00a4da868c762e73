"""All queries of the engine's own operators, each with equivalent SQL for a second engine where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalforge.functions.dialect import Checker, Dialect
from signalforge.operators import calls, files, frames, searches, writes
from signalforge.operators.catalog import CATALOG, SPARK_NEEDS
from signalforge.operators.relations import assemble
from signalforge.plans.store import relation
from signalforge.streaming import incremental, ledger

Query = Callable[[SparkSession, str], DataFrame]


def sql_query(name: str) -> Query:
    needs, body = CATALOG[name]

    return lambda spark, sf_dir: relation(spark, sf_dir, body(Dialect()), SPARK_NEEDS.get(name, needs))


def queries() -> dict[str, Query]:
    return {name: sql_query(name) for name in CATALOG} | frames.queries() | files.queries() | searches.queries() | calls.queries() | writes.queries() | incremental.queries() | ledger.queries()


def oracle_sql() -> dict[str, str]:
    check = Checker()
    return {name: assemble(check, body(check), needs) for name, (needs, body) in CATALOG.items()} | frames.oracle_sql() | files.oracle_sql() | searches.oracle_sql() | calls.oracle_sql() | writes.oracle_sql() | incremental.oracle_sql() | ledger.oracle_sql()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_query("agg_funnel")(spark, sf_dir)
