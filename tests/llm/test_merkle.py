"""Merkle manifests against brute force and SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from signalforge.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, g string, idx int, path string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def climb(nodes):
    """(root, each node's siblings) of a list of hashes."""
    proofs, at, level = [""] * len(nodes), list(range(len(nodes))), list(nodes)
    sides = [[] for _ in nodes]
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for k, i in enumerate(at):
            run, pos = runs[i // 3], i % 3
            sides[k].append(("".join(run[:pos]), "".join(run[pos + 1 :])))
        at, level = [i // 3 for i in at], [sha("".join(r)) for r in runs]
    return level[0], sides


def brute(rows):
    def leaf(i, t, lang, s, n):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, lang, n, t)))

    groups = {}
    for r in rows:
        i, t = r[0], r[1]
        tampered = i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and t is not None
        own = leaf(*r[:5])
        groups.setdefault(r[3], []).append((i is not None, i or 0, own, leaf(i, t.replace("\n", ""), *r[2:5]) if tampered else own))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort()
        trees[s] = climb([g[2] for g in groups[s]])
    root, above = climb([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above):
        for (_, i, own, changed), sides in zip(groups[s], trees[s][1]):
            h, path = changed, sides + up
            for a, b in path:
                h = sha(a + h + b)
            out.append((own, trees[s][0], root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(map(str, out))


def query(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return merkle.op11_merkle_manifest(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("sources, n", [(1, 1), (1, 40), (5, 90), (11, 12)])
def test_manifest_is_that_of_brute_force(spark, tmp_path, sources, n):
    rng = random.Random(n)
    rows = [(i * 7, rng.choice([None, "", "a\nb", "é\n\n", "plain", "long " * 20000 if i == 3 else "x"]), rng.choice([None, "en"]), f"s{rng.randrange(sources)}", rng.choice([None, 3])) for i in range(n)]
    if sources == 5:
        rows += [(7, "a\nb", "en", None, 1), (None, "no\nid", None, None, None), (None, "no\nid", None, None, None), (21, "twice", "en", "é", 1), (21, "twice", "en", "é", 1), (5, None, None, "", None)]
    got = query(spark, rows, tmp_path)
    assert sorted(str(tuple(r[c] for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))) for r in got) == brute(rows)
    if n > 1:
        assert {r["verified"] for r in got} >= {True}


def test_empty_table(spark, tmp_path):
    assert query(spark, [], tmp_path) == []


def test_query_agrees_with_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(merkle.OP11_SQL).df()
    got = merkle.op11_merkle_manifest(spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(map(str, got[columns].itertuples(index=False, name=None))) == sorted(map(str, want[columns].itertuples(index=False, name=None)))
