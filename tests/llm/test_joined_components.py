"""Components are joined up step by step, and pairs that are no links are seldom candidates."""

import random

import numpy as np

from signalforge.llm import jaccard_join
from signalforge.llm.components import connected, joined


def test_joined_components_are_those_of_all_links(spark):
    rng = random.Random(3)
    links = [[(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (25, 10, 0, 12)]
    made = [spark.createDataFrame(x, "a long, b long") for x in links]
    comps, every = connected(made[0]), made[0]
    for m in made[1:]:
        comps, every = joined(comps, m), every.unionByName(m)
        want = {r["node"]: r["component"] for r in connected(every).collect()}
        got = [(r["node"], r["component"]) for r in comps.collect()]
        assert dict(got) == want and len(got) == len(want)


def test_pairs_that_are_no_links_are_ruled_out_by_their_bitmaps():
    rng = np.random.default_rng(5)
    kept = 0
    for _ in range(100):
        both, one, two = (rng.integers(0, 1 << 63, n, dtype="uint64") for n in (172, 28, 28))  # 172 of 228: 0.754
        sets = [np.unique(np.r_[both, x]) for x in (one, two)]
        bits = jaccard_join.folded([jaccard_join.bitmap(s).tobytes() for s in sets], len(jaccard_join.bitmap(sets[0])))
        forest = jaccard_join.SignatureForest(np.zeros(2, "int64"), bits, np.array([len(s) for s in sets]), np.arange(2))
        kept += sum(len(i) for i, _ in forest.join(forest, jaccard_join.PERCENT, True))
    assert kept < 20


def test_rows_of_one_id_and_copies_take_the_least_id_of_their_component(spark):
    text = lambda k: " ".join(f"w{k}-{i}" for i in range(30))
    rows = [(9, text(1)), (4, text(1)), (9, text(2)), (7, text(2)), (9, ""), (8, None), (3, text(3)), (2, text(3)), (5, text(4))]
    found = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(9, 26): 4, (4, 26): 4, (7, 26): 4, (9, 0): 4, (8, 0): 8, (3, 26): 2, (2, 26): 2, (5, 26): 5}
