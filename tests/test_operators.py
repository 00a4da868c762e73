"""Each query against its SQL in a second engine at the smallest scale, and literal cases."""

import duckdb
import pytest

from signalforge.functions.dialect import Checker, Dialect
from signalforge.operators.frames import Visible
from signalforge.plans import registry
from signalforge.sources.posts import normalize

SF = "/root/testdata/sf0.001"
TABLES = ("nation", "customer", "supplier", "part", "orders", "events", "documents", "pages")
SAMPLE = ("agg_funnel", "agg_reason_hist", "join_interval_prox", "geo_market", "ext_cold_email", "gte_verdict", "gte_production", "snk_write_counts", "agg_category_rollup", "agg_yield_status", "win_topk_reorder", "set_zero_yield", "inc_verdict_cache", "inc_idempotent_sink", "inc_ttl_cache", "led_throttle", "llm_chain", "src_bulk_search", "snk_outcome", "snk_row_build", "snk_reason_artifacts", "win_max_per_run", "scr_data_quality", "dsp_recovery", "lbl_resolution")


@pytest.fixture(scope="module")
def second():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple("" if v is None or v != v else round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_in_both_engines(spark, second, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = second.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", [n for n in registry.queries() if not n.startswith("inc_")])
def test_every_query_has_a_plan(spark, name):
    assert registry.queries()[name](spark, SF).columns


@pytest.mark.parametrize("text, want", [("We’re HIRING – now", "we're hiring - now"), ("𝗖𝗵𝗶𝗲𝗳", "chief"), ("“Data”", '"data"')])
def test_normalize(spark, text, want):
    d = Dialect()
    assert spark.sql(f"SELECT {normalize(d, d.lit(text))} AS t").first()["t"] == want
    c = Checker()
    assert duckdb.sql(f"SELECT {normalize(c, c.lit(text))} AS t").fetchall()[0][0] == want


def test_sink_writes_nothing_twice(spark):
    got = registry.queries()["inc_idempotent_sink"](spark, SF)
    assert got.count() == got.select("key").distinct().count()


def test_visible_text():
    assert Visible.of('<p>Hi <script>no</script><a href="https://x.com/in/priya">Priya Rao</a></p>') == "Hi Priya Rao https://x.com/in/priya"
    assert Visible.of(None) == ""
