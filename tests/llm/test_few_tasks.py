"""Steps on small tables take few tasks, however many partitions a shuffle has; results are those of any number."""

import random

import pytest

from signalforge.llm import jaccard_join
from signalforge.llm.common import FEW_TASKS, packed
from signalforge.llm.components import connected, joined


@pytest.fixture
def wide(spark):
    """A session whose shuffles have 64 partitions that Spark may not coalesce."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def tasks_of(spark, work):
    """What work returns, and the number of tasks that it started."""
    sc = spark.sparkContext
    sc.setJobGroup(group := f"few-{random.random()}", "")
    out = work()
    sc.setJobGroup("rest", "")
    found = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(group)]
    stages = [sc.statusTracker().getStageInfo(s) for j in found for s in j.stageIds]
    return out, sum(s.numCompletedTasks for s in stages if s)


def test_components_of_small_tables_take_few_tasks(wide):
    rng = random.Random(5)
    edges = [[(rng.randrange(90), rng.randrange(90)) for _ in range(40)] for _ in range(2)]
    one, two = (packed(wide.createDataFrame(x, "a long, b long").repartition(64, "a")) for x in edges)
    comps, n = tasks_of(wide, lambda: connected(one))
    more, m = tasks_of(wide, lambda: joined(comps, two))
    assert n < 500 and m < 1500
    assert comps.rdd.getNumPartitions() <= FEW_TASKS and more.rdd.getNumPartitions() <= FEW_TASKS
    label = {k: k for x in edges for e in x for k in e if e[0] != e[1]}
    while any(label[a] != label[b] for x in edges for a, b in x if a != b):
        for a, b in (e for x in edges for e in x if e[0] != e[1]):
            label[a] = label[b] = min(label[a], label[b])
    assert {r["node"]: r["component"] for r in more.collect()} == label


def test_links_and_components_come_in_few_partitions(wide):
    words = [f"w{k}" for k in range(60)]
    docs = wide.createDataFrame([(i, " ".join(words + [f"x{i}"])) for i in range(20)] + [(20, "alone in the world it was")], "doc_id long, text string")
    _, _, _, comps = jaccard_join.class_components(docs, 80)
    assert comps.rdd.getNumPartitions() <= FEW_TASKS
    assert comps.select("component").distinct().count() == 1 and comps.count() == 20
