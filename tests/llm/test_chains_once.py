"""Chains of the same words are aligned once; pairs of two matches are judged as `chains` judges them."""

import random

import numpy as np
import pyarrow as pa

from signalforge.llm import fuzzy_passages as P


def test_chains_of_the_same_words_are_aligned_once(monkeypatch):
    rng = np.random.default_rng(1)
    one, two = (rng.integers(0, 1 << 32, 80, dtype="uint32") for _ in range(2))
    edited = np.r_[one[:50], two[50:]]
    place = lambda *x: np.array(x, "int32").tobytes()
    rows = [(k, 10 * k, 500 + k, 3 * k, place([0, 0], [20, 20]), one.tobytes(), edited.tobytes()) for k in range(40)]
    rows += [(90 + k, 7, 600 + k, 9, place([0, 0], [20 + k, 20 + k]), one.tobytes(), edited.tobytes()) for k in range(2)]  # other places
    rows += [(95, 7, 605, 9, place([0, 0], [20, 20]), two.tobytes(), edited.tobytes())]  # other words
    names = ["a_cls", "a_start", "b_cls", "b_start", "places", "a_data", "b_data"]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names)
    calls, plain = [], P.can_hold
    monkeypatch.setattr(P, "can_hold", lambda *chain: calls.append(1) or plain(*chain))
    found = [tuple(r.values()) for b in P.spans_of(iter([batch.slice(0, 15), batch.slice(15)])) for r in b.to_pylist()]
    assert len(calls) == 3
    want = []
    for ac, a0, bc, b0, places, x, y in rows:
        chain = np.frombuffer(x, "uint32"), a0, np.frombuffer(y, "uint32"), b0, np.frombuffer(places, "int32").reshape(-1, 2) + (a0, b0)
        for s, e, t, f in P.good_stretches(P.align(*chain)) if plain(*chain) else ():
            want += [(ac, s, e), (bc, t, f)]
    assert found == want and (0, 0, 50) in want


def test_chains_are_those_of_each_pair(spark):
    rng = random.Random(8)
    rows = []
    for pair in range(300):
        x = [rng.randrange(200) for _ in range(rng.choice([1, 2, 2, 2, 3, 9]))]
        rows += [(pair // 3, p, 1000 + pair, max(0, p + rng.randrange(-40, 41))) for p in set(x)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # most batches end within a pair
    try:
        got = P.chained(spark.createDataFrame(rows, "cls long, place int, head_cls long, head_place int")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = []
    for c, hc in {(r[0], r[2]) for r in rows}:
        x, y = map(np.array, zip(*sorted((p, q) for a, p, b, q in rows if (a, b) == (c, hc))))
        for chain in P.chains(x, y):
            a, b = (max(0, int(z[chain[0]]) - P.MARGIN) for z in (x, y))
            ends = (int(z[chain[-1]]) + P.SEED + P.MARGIN for z in (x, y))
            want.append((c, a, next(ends), hc, b, next(ends), (np.c_[x[chain], y[chain]] - (a, b)).astype("int32").tobytes()))
    assert len(want) > 50 and sorted((*r[:6], bytes(r[6])) for r in got) == sorted(want)
