"""All links of the n-gram join come through its signature trees."""

import random

import pytest

from signalforge.llm import jaccard_join

DOCS = "doc_id long, text string, block int, comp string"


@pytest.fixture(scope="module")
def near_copies(spark):
    rng = random.Random(6)
    base = [[f"w{rng.randrange(900)}" for _ in range(150)] for _ in range(6)]
    rows = []
    for i in range(90):
        words = list(base[i % 6])
        words[rng.randrange(150)] = f"x{i % 40}"
        rows.append((i, " ".join(words), 1, "clash"))
    rows += [(90, "long " + " ".join(f"v{k % 7000}" for k in range(60_000)), 1, "clash"), (91, "long " + " ".join(f"v{k % 7000}" for k in range(60_000)) + " end", 1, "clash")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def components(docs):
    return {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect()}


def test_without_candidates_from_trees_there_are_no_links(spark, near_copies, monkeypatch):
    found = components(near_copies)
    assert {found[i] for i in range(90)} == set(range(6)) and found[91] == 90
    monkeypatch.setattr(jaccard_join, "block_candidates", lambda members, percent: spark.createDataFrame([], "a long, b long"))
    alone = components(near_copies)
    texts = {r["doc_id"]: r["text"] for r in near_copies.collect()}
    assert all(alone[i] == i or texts[alone[i]] == texts[i] for i in alone)


@pytest.mark.parametrize("block", [2, 2048])
def test_a_star_of_any_size_keeps_its_links(spark, near_copies, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows, names, links = jaccard_join.linked_classes(near_copies, 80)
    classes = [r["cls"] for r in names.orderBy("id").collect()]
    stars = spark.createDataFrame([(classes[0], c) for c in classes[1:]], "a long, b long")
    got = {(r["a"], r["b"]) for r in jaccard_join.star_candidates(stars, names, 80).collect()}
    true = {(min(a, b), max(a, b)) for a, b in ((classes[0], c) for c in classes[1:])}
    same = {(min(a, b), max(a, b)) for a, b in ((r["a"], r["b"]) for r in links.collect()) if classes[0] in (a, b)}
    assert same <= got <= true and len(got) < len(true)
