"""A group of near copies gives no more pairs than it has members, and keeps its components."""

import random

import pyarrow as pa
import pytest

from signalforge.llm import jaccard_join
from signalforge.llm.common import shingle_sets


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    base = [f"w{k}" for k in range(240)]
    out = []
    for _ in range(150):  # each with three to six words changed, so that many pairs lie on either side of 80 percent
        words = list(base)
        for k in rng.sample(range(240), rng.randrange(3, 7)):
            words[k] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def brute(texts):
    sets = [set(s.tolist()) for s in shingle_sets(pa.array(texts))]
    label = list(range(len(sets)))
    for i, s in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def one_block(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    _, names, _ = jaccard_join.linked_classes(docs, 80)
    return docs, names, names.selectExpr("7L AS block", "cls", "CAST(n AS INT) AS n", "cls AS comp")


def test_a_walk_gives_no_more_pairs_than_members(spark, texts):
    _, names, groups = one_block(spark, texts)
    pairs = [(r["a"], r["b"]) for r in jaccard_join.across_components(names, groups, 80).collect()]
    assert sum(a != b for a, b in pairs) < len(texts) and len(pairs) < 2 * len(texts)


@pytest.mark.parametrize("part", [1 << 10, 32 << 20])
def test_pairs_left_out_are_verified_where_they_meet(spark, texts, monkeypatch, part):
    monkeypatch.setattr(jaccard_join, "PART", 200 * part)
    docs, names, groups = one_block(spark, texts)
    links = jaccard_join.rest_across(docs, names, groups, 80)
    found = {r["node"]: r["component"] for r in jaccard_join.connected(links).collect()}
    ids = {r["cls"]: r["id"] for r in names.collect()}
    least = {}
    for cls, comp in found.items():
        least[comp] = min(least.get(comp, ids[cls]), ids[cls])
    assert [least[found[c]] if c in found else i for c, i in sorted(ids.items(), key=lambda x: x[1])] == brute(texts)
    assert links.count() < len(texts) * (1 if part > 1 << 10 else 4)


def test_components_are_those_of_all_pairs(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
