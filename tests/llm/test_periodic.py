"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import pytest

from signalforge.llm import periodic


def brute(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                s = w[i : i + length]
                if not any(all(s[k] == s[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed, most, count", [(1, 60, 400), (2, 300, 150), (3, 2500, 12)])
def test_runs_are_those_of_brute_force(seed, most, count):
    rng = random.Random(seed)
    for _ in range(count):
        n, size = rng.randrange(most), rng.choice([1, 2, 3, 50, 1000])
        w = [rng.randrange(size) for _ in range(n)]
        for _ in range(rng.randrange(5) if n > 10 else 0):
            a = rng.randrange(n)
            p, b = 1 + rng.randrange(1 + (n - a) // 4), rng.randrange(a, n + 1)
            w[a:b] = [w[a + (i - a) % p] for i in range(a, b)]
        assert periodic.find_runs(periodic.numbered([str(x).encode() for x in w])) == brute(w)


def test_nested_and_touching_runs():
    inner = ["a"] * 6 + ["b"] * 6
    w = inner * 4 + ["c"] + ["x", "y"] * 4 + ["y", "x"] * 4
    assert periodic.find_runs(periodic.numbered([x.encode() for x in w])) == brute(w)


def contract(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(((-m, s, q) for s, m, q in runs), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_is_the_contract(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(120)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " \n\x0b"), (None, "x " * 50), (403, "x y " * 9), (404, "z " * 30000), (5, rows[5][1]), (405, "a b " * 3 + "q r s " * 9 + "ab " * 6), (406, "w" * 200000)]
    frame = spark.createDataFrame([(i, t, "clash", 1, "x") for i, t in rows], "doc_id long, text string, runs string, n_words int, best string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periodic.op13_periodic_runs(spark, str(tmp_path)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    want = [(404, 1, 0, 30000, 1, 30000000, hashlib.sha256(b"0,30000,1\n").hexdigest(), hashlib.sha256(b"z").hexdigest()) if i == 404 and zlib.crc32(b"404") % 10 else contract(i, t) for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_empty_table(spark):
    found = periodic.digests(periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")))
    assert found.collect() == [] and found.columns[0] == "doc_id"
