"""Stored tables: opening, header checks, commits and the outcomes of a write; recovery by its decision table."""

import duckdb
import pytest
from pyspark.sql.types import StructType

from signalforge.functions.dialect import Checker, Dialect
from signalforge.operators import recovery, writes
from signalforge.sources import sheets

SCHEMA = StructType().add("destination", "string").add("post_url", "string")


def batch(spark, n, start=0, name="MAIN"):
    return spark.createDataFrame([(name, f"u{i}") for i in range(start, start + n)], SCHEMA).repartition(3)


def test_tables_are_opened_made_and_checked(spark, tmp_path):
    name, path = "leads_opened", f"{tmp_path}/leads"
    assert sheets.open_table(spark, name, SCHEMA, live=False, path=path) == "MISSING" and not spark.catalog.tableExists(name)
    assert sheets.open_table(spark, name, SCHEMA, live=True, path=path) == "CREATED"
    assert sheets.open_table(spark, name, SCHEMA, live=True, path=path) == "MATCHES"
    moved = StructType().add("post_url", "string").add("destination", "string")
    assert sheets.open_table(spark, name, moved, live=False) == "DRY_RUN"
    with pytest.raises(sheets.HeaderMismatch):
        sheets.open_table(spark, name, moved, live=True)
    spark.sql(f"DROP TABLE {name}")


def test_a_catalog_without_access_degrades_dry_runs_only(spark):
    class Closed:
        class catalog:  # noqa: N801
            @staticmethod
            def tableExists(name):
                raise PermissionError("no access")

    assert sheets.open_table(Closed, "x", SCHEMA, live=False) == "DRY_RUN"
    with pytest.raises(PermissionError):
        sheets.open_table(Closed, "x", SCHEMA, live=True)


def test_a_failed_task_leaves_nothing_to_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    w = sheets.append_once(batch(spark, 20), path, writes.Refused)
    assert (w.outcome, w.written) == ("FAILED", 0)
    assert sheets.committed(spark, path, SCHEMA).count() == 0
    assert sheets.append_once(batch(spark, 20), path).outcome == "SUCCESS" and sheets.committed(spark, path, SCHEMA).count() == 20


def test_an_unanswered_commit_is_unknown_and_keeps_its_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sheets.append_once(batch(spark, 20), path, writes.CutOff).outcome == "UNKNOWN"
    assert sheets.committed(spark, path, SCHEMA).count() == 20
    again = sheets.write_production(batch(spark, 20), {"MAIN": path}, live=True)
    assert again.outcome == "DUPLICATE"


def test_repeated_batches_write_new_rows_only(spark, tmp_path):
    paths = {"MAIN": f"{tmp_path}/m", "DATA": f"{tmp_path}/d"}
    first = sheets.write_production(batch(spark, 10).union(batch(spark, 5)), paths, live=True)
    assert (first.outcome, first.attempted, first.written) == ("SUCCESS", 15, 10)
    more = sheets.write_production(batch(spark, 8, 6).union(batch(spark, 3, 100, "DATA")).union(batch(spark, 2, 0, "DATA")), paths, live=True)
    assert (more.outcome, more.written) == ("SUCCESS", 7)  # a key of one table is not written to the other
    assert sheets.write_production(batch(spark, 3, 500, "HOLD"), paths, live=True).outcome == "EMPTY"
    waits = []

    def unreadable(path):
        raise ConnectionError

    assert sheets.write_production(batch(spark, 1, 900), paths, True, unreadable, sleep=waits.append).outcome == "READ_FAILED"
    assert waits == [5, 10, 15] and sheets.committed(spark, paths["MAIN"], SCHEMA).count() == 14


#: has_text, passes, evaluated, decision, exact_input -> disposition: the decision table in full words.
TABLE = [
    ((False, True, False, "", True), "HOLD"),
    ((False, False, True, "ACCEPT", True), "HOLD"),
    ((True, False, False, "", True), "REJECT"),
    ((True, False, True, "ACCEPT", True), "REJECT"),
    ((True, True, False, "REVIEW", True), "HOLD"),
    ((True, True, False, "", False), "HOLD"),
    ((True, True, True, "ACCEPT", True), "ACCEPT"),
    ((True, True, True, "ACCEPT", False), "REVIEW"),
    ((True, True, True, "REVIEW", True), "REVIEW"),
    ((True, True, True, "REVIEW", False), "REVIEW"),
    ((True, True, True, "REJECT", True), "REJECT"),
    ((True, True, True, "REJECT", False), "REJECT"),
]
#: failed, called, decision, by_gates -> status of the model and classification.
OLD = [
    ((True, True, "REVIEW", False), ("UNAVAILABLE", "keep")),
    ((True, False, "", True), ("UNAVAILABLE", "keep")),
    ((False, False, "", True), ("NOT_RUN", "REJECT")),
    ((False, False, "REJECT", False), ("NOT_RUN", "keep")),
    ((False, True, "ACCEPT", False), ("SUCCESS", "ACCEPT")),
    ((False, True, "REJECT", False), ("REJECT", "REJECT")),
    ((False, True, "REVIEW", False), ("REVIEW", "REVIEW")),
    ((False, True, "", False), ("NOT_RUN", "REJECT")),
]


def _both(spark, columns, rows, rules, give, other="''"):
    literal = lambda v: str(v).lower() if isinstance(v, bool) else f"'{v}'"
    out = []
    for d, run in ((Dialect(), lambda s: [tuple(r) for r in spark.sql(s).collect()]), (Checker(), lambda s: duckdb.sql(s).fetchall())):
        source = " UNION ALL ".join(f"SELECT {k} AS k, " + ", ".join(f"{literal(v)} AS {c}" for c, v in zip(columns, row)) for k, row in enumerate(rows))
        out.append([v for _, v in sorted(run(f"SELECT k, {recovery.first_match(d, rules, columns, give, other)} AS v FROM ({source}) x"))])
    assert out[0] == out[1]
    return out[0]


def test_every_row_of_the_decision_table(spark):
    columns = ("has_text", "passes", "evaluated", "decision", "exact_input")
    assert _both(spark, columns, [r for r, _ in TABLE], recovery.RULES, 0) == [w for _, w in TABLE]


def test_every_row_of_the_table_of_old_records(spark):
    columns = ("failed", "called", "decision", "by_gates")
    assert _both(spark, columns, [r for r, _ in OLD], recovery.OLD_RULES, 0) == [w[0] for _, w in OLD]
    assert _both(spark, columns, [r for r, _ in OLD], recovery.OLD_RULES, 1, "'keep'") == [w[1] for _, w in OLD]
