"""Operator 2: a time-varying curriculum over sources.

Each source has a weight schedule over training time t in [0, 1]. The schedule's integral is the source's weight in the
mix; the integral up to t, times the source's target, is its cumulative demand for words. A document pass that covers
the words [a, b) of its source's supply is trained at the time when the demand reaches their middle, which is the
inverse of the demand. The demand of all sources together up to that time is the pass's position in training, in words;
sorting passes by it (a range sort) gives the training order, `training_order`.

Supply of a source: its documents in the order of md5(doc_id), repeated whole as often as the target needs; the last pass
ends at the very word where the demand ends, so a source's taken words equal its rounded target. Nothing is gathered in
one task but a row a source: running sums are made of per-bucket totals (4096 buckets a source) and of windows in a bucket.

Defined cases: null text or no words: size 0, nothing taken, no position. Null source: a source of its own, last in
order. Null doc_id: ordered as the empty string. Equal doc_ids: ordered by size, and equal rows are interchangeable.
Ties of position: by doc_id and pass. Very long texts: a size like any other. Empty table: no rows. Extra columns asked
for are carried along untouched; one that is named like a column of the result is called document_<name>.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_RX, cut, table

WEIGHTS = (5.0, 2.0, 1.0)
#: Relative weight at t = 0 and t = 1 of the 1st, 2nd and 3rd weight; between them it is linear, and each integrates to 1.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
MAX_REPEATS = 3
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RX)), F.lit(0)).cast("long")


def _cycle(values: Sequence[float], rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """From (source, source_size): source_rank, weight and target.

    The targets are w * level, or max_repeats times the source's size if that is less, with the one level at which they
    sum up to all sizes. A source is at its stop if, at the level where it just reaches it, no more than all is given out.
    One row a source goes through single-partition windows; documents do not.
    """
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = Window.orderBy(F.col("source").isNull(), F.col("source"))
    up = Window.orderBy("stop_level", "source_rank")
    df = sizes.withColumn("source_rank", F.row_number().over(rank))
    df = df.withColumn("weight", _cycle(weights, F.col("source_rank")))
    df = df.withColumn("stop", F.col("source_size") * F.lit(float(max_repeats))).withColumn("stop_level", F.col("stop") / F.col("weight"))
    df = df.withColumn("total", F.sum("source_size").over(every))
    df = df.withColumn("given", F.sum("stop").over(up) + F.col("stop_level") * (F.sum("weight").over(every) - F.sum("weight").over(up)))
    df = df.withColumn("stopped", F.col("given") <= F.col("total"))
    df = df.withColumn("level", (F.col("total") - F.sum(F.when(F.col("stopped"), F.col("stop")).otherwise(0.0)).over(every)) / F.sum(F.when(F.col("stopped"), 0.0).otherwise(F.col("weight"))).over(every))
    df = df.withColumn("target", F.when(F.col("stopped"), F.col("stop")).otherwise(F.col("weight") * F.col("level")))
    return df.select(*sizes.columns, "source_rank", "weight", "target")


def inverse_demand(share: Column, start: Column, end: Column) -> Column:
    """The time t at which the integral of the linear schedule from `start` to `end` (area 1) reaches `share`."""
    a = (end - start) / 2
    linear = share / start
    root = (F.sqrt(F.greatest(start * start + 4 * a * share, F.lit(0.0))) - start) / (2 * a)
    return F.least(F.greatest(F.when(F.abs(a) < 1e-12, linear).otherwise(root), F.lit(0.0)), F.lit(1.0))


OWN = ("doc_id", "source", "size", "source_size", "target", "taken", "passes", "pass_no", "words", "time", "position")


def assign(docs: DataFrame, weights: Sequence[float] = WEIGHTS, ramps: Sequence[tuple[float, float]] = RAMPS, max_repeats: int = MAX_REPEATS, keep: Sequence[str] = ()) -> DataFrame:
    """Per row of docs (doc_id, text, source, and the columns of `keep`): size, source_size, target, taken, and passes.

    passes is an array of (pass_no, words, time, position), one for each time that the mix takes the document; empty if never.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    tag = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-"))
    extra = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"), tag.alias("_source"), extra.alias("_extra"))
    rows = rows.withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    if not keep:
        rows = cut(rows)  # narrow: the texts are read and counted once
    buckets = rows.groupBy("source", "_source", "_bucket").agg(F.sum("size").alias("_words"))
    targets = source_targets(buckets.groupBy("source", "_source").agg(F.sum("_words").alias("source_size")), weights, max_repeats)
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0))).drop("source", "_words")
    ramp = lambda end: _cycle([r[end] for r in ramps], F.col("source_rank"))
    targets = targets.select("_source", "source_size", "target", F.floor(F.col("target") + 0.5).alias("_demand"), ramp(0).alias("_from"), ramp(1).alias("_to"))
    # All sources' demand up to t is _linear * t + _square * t * t.
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    targets = targets.withColumn("_linear", F.sum(F.col("_demand") * F.col("_from")).over(whole)).withColumn("_square", F.sum(F.col("_demand") * (F.col("_to") - F.col("_from")) / 2).over(whole))
    rows = rows.join(cut(offsets.join(targets, "_source")), ["_source", "_bucket"])
    own = Window.partitionBy("_source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_start", (F.col("_before") + F.sum("size").over(own) - F.col("size")).cast("double"))

    n = F.array(*[F.lit(i) for i in range(max_repeats)])

    def one(i: Column) -> Column:
        at = F.col("_start") + i * F.col("source_size")
        took = F.least(F.greatest(F.col("_demand") - at, F.lit(0)), F.col("size")).cast("long")
        share = (at + took / 2) / F.greatest(F.col("_demand"), F.lit(1))
        return F.struct(i.cast("int").alias("pass_no"), took.alias("words"), inverse_demand(share, F.col("_from"), F.col("_to")).alias("time"))

    def placed(p: Column) -> Column:
        return F.struct(p["pass_no"], p["words"], p["time"], (F.col("_linear") * p["time"] + F.col("_square") * p["time"] * p["time"]).alias("position"))

    rows = rows.withColumn("passes", F.transform(F.filter(F.transform(n, one), lambda p: p["words"] > 0), placed))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda acc, p: acc + p["words"])
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "passes", *[F.col("_extra")[c].alias(f"document_{c}" if c in OWN else c) for c in keep])


def training_order(assigned: DataFrame) -> DataFrame:
    """One row for each taken pass, range-sorted by its position (ties: by doc_id and pass)."""
    rest = [c for c in assigned.columns if c not in ("passes", "taken")]
    return assigned.select(*rest, F.inline("passes")).orderBy("position", "doc_id", "pass_no")


def op2_mixing_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assign(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    # A document is one row here, whatever its passes; F.get gives null where there is no such pass.
    position = lambda k: F.round(F.get("passes", F.lit(k))["position"], 3)
    rows = rows.select("doc_id", "size", "source_size", "target", "taken", F.round(F.get("passes", F.lit(0))["time"], 9).alias("first_time"), *[position(k).alias(f"{name}_position") for k, name in enumerate(("first", "second", "third"))])
    return rows.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS source_rank FROM s),
w AS (SELECT *, CASE (source_rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 3.0::DOUBLE AS stop FROM r),
l AS (SELECT *, stop / weight AS stop_level, sum(source_size) OVER () AS total FROM w),
g AS (SELECT *, sum(stop) OVER u + stop_level * (sum(weight) OVER () - sum(weight) OVER u) <= total AS stopped FROM l WINDOW u AS (ORDER BY stop_level, source_rank)),
t AS (SELECT *, CASE WHEN stopped THEN stop ELSE weight * (total - sum(CASE WHEN stopped THEN stop ELSE 0 END) OVER ()) / sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER () END AS target FROM g),
z AS (SELECT *, floor(target + 0.5) AS demand, CASE (source_rank - 1) % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS b FROM t),
f AS (SELECT *, sum(demand * b) OVER () AS linear, sum(demand * (2 - b - b) / 2) OVER () AS square FROM z),
c AS (SELECT d.doc_id, d.size, f.source_size, f.target, f.demand, f.b, f.linear, f.square,
       (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::DOUBLE AS s0
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
k AS (SELECT *, least(greatest(demand - s0, 0), size)::BIGINT AS a0, least(greatest(demand - s0 - source_size, 0), size)::BIGINT AS a1, least(greatest(demand - s0 - 2 * source_size, 0), size)::BIGINT AS a2 FROM c),
p AS (SELECT *, (s0 + a0 / 2.0::DOUBLE) / greatest(demand, 1) AS h0, (s0 + source_size + a1 / 2.0::DOUBLE) / greatest(demand, 1) AS h1, (s0 + 2 * source_size + a2 / 2.0::DOUBLE) / greatest(demand, 1) AS h2 FROM k),
v AS (SELECT *, CASE WHEN a0 > 0 THEN least(greatest(CASE WHEN b = 1 THEN h0 ELSE (sqrt(greatest(b * b + 4 * (1 - b) * h0, 0)) - b) / (2 * (1 - b)) END, 0), 1) END AS t0,
       CASE WHEN a1 > 0 THEN least(greatest(CASE WHEN b = 1 THEN h1 ELSE (sqrt(greatest(b * b + 4 * (1 - b) * h1, 0)) - b) / (2 * (1 - b)) END, 0), 1) END AS t1,
       CASE WHEN a2 > 0 THEN least(greatest(CASE WHEN b = 1 THEN h2 ELSE (sqrt(greatest(b * b + 4 * (1 - b) * h2, 0)) - b) / (2 * (1 - b)) END, 0), 1) END AS t2 FROM p)
SELECT doc_id, size, source_size, target, a0 + a1 + a2 AS taken, round(t0, 9) AS first_time,
  round(linear * t0 + square * t0 * t0, 3) AS first_position, round(linear * t1 + square * t1 * t1, 3) AS second_position, round(linear * t2 + square * t2 * t2, 3) AS third_position
FROM v
"""
