"""Exact duplicates against brute force and SQL."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from signalforge.llm import exact_dedup


def brute(rows):
    body = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in rows:
        groups.setdefault(body(t), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        g = groups[body(t)]
        out.append((i, min(g, key=lambda r: r[:3])[3], len(g), hashlib.sha256(body(t).encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [f"text {k} " + "é𝗖x"[k % 3] * rng.randrange(9) for k in range(120)]
    out = [(i, rng.choice(texts).replace(" ", rng.choice([" ", "  ", "\n", "\t\x0b"]))) for i in range(600)]
    out += [(i, "hot line\r\n" + " " * (i % 5)) for i in range(1000, 1400)]
    out += [(2000, None), (2001, ""), (2002, " \n"), (None, "text 3"), (None, None), (2003, "a b"), (2004, "ab"), (2005, "z" * 500_000), (2006, "z" * 250_000 + " " + "z" * 250_000), (2007, "unlike any")]
    return out


@pytest.mark.parametrize("block, most_bitmap, weak", [(1 << 16, 1 << 26, False), (64, 50, False), (1 << 16, 1 << 26, True)])
def test_duplicates_are_those_of_brute_force(spark, rows, tmp_path, monkeypatch, block, most_bitmap, weak):
    monkeypatch.setattr(exact_dedup, "BLOCK", block)
    frame = spark.createDataFrame([(i, t, "clash", 3) for i, t in rows], "doc_id long, text string, file string, block int")
    frame.repartition(5).write.parquet(f"{tmp_path}/d")
    digest = (lambda b: bytes([len(b) % 3])) if weak else exact_dedup._sha256
    got = exact_dedup.exact_duplicates(exact_dedup.located(spark, f"{tmp_path}/d"), digest, most_bitmap).collect()
    want = brute(rows)
    if weak:  # unlike texts share a digest and are told apart by their bytes
        assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"])) for r in got) == sorted(str(tuple(eval(w)[:3])) for w in want)
    else:
        assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == want
        kept = [r["text_sha256"] for r in got if r["kept"]]
        assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in got})


def test_repeated_rows_keep_one(spark):
    got = exact_dedup.exact_duplicates_of(spark.createDataFrame([(7, "same text")] * 5 + [(8, "other")], "doc_id long, text string")).collect()
    assert sum(r["kept"] for r in got if r["doc_id"] == 7) == 1 and {r["group_size"] for r in got if r["doc_id"] == 7} == {5}


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates_of(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_golomb_code_round_trip():
    rng = np.random.default_rng(2)
    for top in (1, 2, 50, 1 << 20, 1 << 50):
        for n in (1, 2, 7, 300):
            gaps = rng.integers(0, top, n).astype("uint64")
            assert (exact_dedup.rice_decode(exact_dedup.rice_encode(gaps), n) == gaps).all()


def test_query_agrees_with_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(exact_dedup.OP12_SQL).df()
    got = exact_dedup.op12_exact_dedup(spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(map(str, got[columns].itertuples(index=False, name=None))) == sorted(map(str, want[columns].itertuples(index=False, name=None)))
