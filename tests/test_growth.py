"""What keeps the time and memory of queries in proportion to large inputs."""

import duckdb
import pandas as pd
import pyarrow as pa
import pytest

from signalforge.operators import frames
from signalforge.plans import registry, store

SF = "/root/testdata/sf0.001"
CHANGED = ("cls_availability", "cls_old_record", "join_left_verdict", "agg_fp_flags", "cls_guessed_email", "srv_leads", "out_candidates", "set_intersect_tabs", "rpt_baseline_join", "cnt_discover", "cnt_status", "rpt_gate_record", "ext_cold_email")


def stored_names():
    return {name for _, _, name in store._paths}


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def cell(v):
    return "" if pd.isna(v) else v if isinstance(v, str) else round(float(v), 6)


def rows(frame):
    return sorted((tuple(map(cell, r)) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", CHANGED)
def test_same_rows_in_both_engines(spark, name):
    con = duckdb.connect()
    for t in ("nation", "customer", "supplier", "part", "orders", "events", "documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = registry.queries()[name](spark, SF).toPandas(), con.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_first_copies_are_found_without_their_texts(spark):
    store.forget(spark)
    frame = store.relation(spark, SF, "SELECT ingest_seq, t FROM posts", ("posts",))
    assert "firsts" in stored_names()
    text = plan(frame)
    assert text.index("WindowGroupLimit") < text.index("Join LeftSemi")


@pytest.mark.parametrize("name", ["join_left_verdict", "agg_fp_flags", "rpt_gate_record"])
def test_only_verdicts_that_posts_ask_for_are_parsed(spark, name):
    store.forget(spark)
    registry.queries()[name](spark, SF)
    assert "asked_decided" in stored_names() and "decided" not in stored_names()
    asked = store.relation(spark, SF, "SELECT ingest_seq FROM asked_decided", ("asked_decided",)).count()
    assert asked == store.relation(spark, SF, "SELECT ingest_seq FROM gated WHERE reject_reason = ''", ("gated",)).count()


def test_sets_of_names_are_joined_as_names(spark):
    lines, found = plan(registry.queries()["set_zero_yield"](spark, SF)).splitlines(), 0
    for k, line in enumerate(lines):
        if "Join LeftAnti" in line:
            at = line.index("Join")
            left, right = [x[at + 3 :] for x in lines[k + 1 :] if x[at : at + 3] in (":- ", "+- ")][:2]
            assert right.startswith("Aggregate"), right
            found += 1
    assert found == 2


def test_pages_are_parsed_in_pieces(monkeypatch):
    monkeypatch.setattr(frames, "PIECE", 100)
    htmls = ["<p>a</p>" * 5, None, "<p>b</p>" * 40, "", "<p>c</p>" * 5, "<p>d</p>" * 5]
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(6)), "html": htmls})
    parts = list(frames.pieces(batch, "html", 100))
    assert [p.num_rows for p in parts] == [2, 1, 3] and pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    big = pa.RecordBatch.from_pydict({"page_id": list(range(50)), "html": ["<p>x</p>" * 20_000] * 50})
    out = list(frames.visible_texts(iter([big])))
    assert len(out) > 5 and sum(b.num_rows for b in out) == 50
    assert list(frames.pieces(batch.slice(0, 0), "html")) == []
