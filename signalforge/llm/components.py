"""Connected components of an edge table, without gathering it anywhere.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step joins every node to the least node it knows
of, and after a few steps all edges are stars around their component's least node. Every step is written to the shared
checkpoint folder. The neighbours of a node are never collected: a step is an aggregation and a join on the node. Up to FEW_ROWS
rows, least neighbours and labels are broadcast and edges stay in FEW_TASKS partitions, so that steps on small tables take
few tasks and shuffle files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW_ROWS, FEW_TASKS, cut, maybe_broadcast, packed


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """From undirected edges (a, b) of longs: (node, component), component being the least node; nodes without edges absent."""
    edges = cut(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, small_enough = None, edges.limit(FEW_ROWS + 1).count() <= FEW_ROWS  # no step makes more edges than there were
    near, few = (F.broadcast, lambda x: x.coalesce(FEW_TASKS)) if small_enough else (lambda x: x, lambda x: x)
    edges = few(edges)
    while True:  # each step lowers labels, so it ends; chains halve, so it ends after a logarithm of steps
        # Large star: a node's greater neighbours go to the least of its neighbours and itself.
        both = few(_both(edges))
        least = few(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.filter(F.col("b") > F.col("a")).join(near(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its lesser neighbours go to the least of these.
        large = few(large.distinct())
        least = few(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(near(least), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        edges = cut(few(small))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return few(stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))


def joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) after more links (a, b): the labels that links meet are joined up, not all edges anew."""
    known = maybe_broadcast(comps, FEW_ROWS)
    for side in ("a", "b"):
        named = known.withColumnsRenamed({"node": "at", "component": "label"})
        links = links.join(named, links[side] == named["at"], "left").withColumn(side, F.coalesce("label", side)).drop("at", "label")
    more = packed(connected(links))
    fresh = maybe_broadcast(more, FEW_ROWS)
    named = fresh.withColumnsRenamed({"node": "at", "component": "label"})
    old = comps.join(named, comps["component"] == named["at"], "left").select("node", F.coalesce("label", "component").alias("component"))
    return packed(old.unionByName(more.join(known, "node", "left_anti")))
