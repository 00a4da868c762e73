"""Operator 3: quality rules by robust multivariate outliers.

Exact statistics of each whole text become a vector of five transformed values. For each language and source a minimum
covariance determinant estimate gives centre and scatter; a text whose squared Mahalanobis distance is over a chi-square
quantile is rejected.

The estimate has several starts: medians with quartile ranges, and small sets of rows drawn by hash. From each it takes
concentration steps: the share `CORE` of a group's rows nearest to the centre gives the next centre and scatter. Of each
group the start that ends with the least determinant is kept. A step is one scan for all starts: rows are summed into
(group, start, distance bin) cells of counts and moments, and the cells up to the wanted count are the core (whole bins of
1/64 of a power of e). So no group, however large, meets in one task, and all rows take part. FLOORS are variances added to
the scatter: a value that is the same in nearly all texts must not make the scatter singular.

A group of fewer than FEWEST rows that pass the base rules has no estimate: for it the base rules alone decide.

Defined cases: null or empty text: zeros, base_failed. Null lang or source: a value of its own. Null or repeated doc_id:
each row is judged for itself. Ties of distance: in one bin, all of them in the core or none. Very long texts: whole, with
exact counts. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, maybe_broadcast, slices, table, text_array, words

VALUES = ("y0", "y1", "y2", "y3", "y4")
#: Standard deviations at least: log word length, log symbols a word, log share of repeated lines, of repeated words, log length.
FLOORS = (0.06, 0.15, 0.6, 0.5, 0.7)
CORE, STEPS, STARTS, TAIL = 0.6, 4, 4, 1e-6
#: Rows of a drawn start, and the least that a group needs: twice what a scatter of five values needs.
FEWEST = 2 * (len(VALUES) + 1)
BIN, GRID = 64, 128
BLANK = " \t\n\v\f\r"
STATS = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def chi_square(p: float, k: int) -> float:
    """The quantile, by the cube approximation of Wilson and Hilferty."""
    return k * (1 - 2 / (9 * k) + NormalDist().inv_cdf(p) * (2 / (9 * k)) ** 0.5) ** 3


def triples(idx: np.ndarray, n: int) -> np.ndarray:
    """A number for each three neighbours of idx, whose values are under n: equal for equal threes alone."""
    pair = idx[:-2] * np.int64(max(1, n)) + idx[1:-1]
    if n >= 2_000_000:  # its third power is beyond 64 bits
        pair = np.unique(pair, return_inverse=True)[1].astype("int64")
    return pair * np.int64(max(1, n)) + idx[2:]


def text_stats(texts: pa.Array) -> np.ndarray:
    """Rows of n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines, n_repeat_words."""
    texts = text_array(texts)
    distinct, idx, ends = words(texts, lower=False)
    idx = idx.astype("int64")
    chars = np.r_[0, np.cumsum(pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype("int64")[idx])]
    out = np.zeros((len(texts), 6), "int64")
    out[:, 0] = np.diff(ends)
    out[:, 1] = chars[ends[1:]] - chars[ends[:-1]]
    out[:, 2] = pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False)
    triple = triples(idx, len(distinct))
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        if b - a > 3:
            own = triple[a : b - 2]
            s = np.sort(own)
            again = s[1:][s[1:] == s[:-1]]
            if len(again):
                hit, cover = np.isin(own, again), np.zeros(b - a, bool)
                cover[:-2] |= hit
                cover[1:-1] |= hit
                cover[2:] |= hit
                out[i, 5] = cover.sum()
    for i, text in enumerate(texts.to_pylist()):
        lines = [x for x in text.split("\n") if x.strip(BLANK)]
        out[i, 3] = len(lines)
        out[i, 4] = len(lines) - len(set(lines))
    return out


def quality_stats(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=3 << 20):
                s = text_stats(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), part.column("source"), *(pa.array(s[:, i]) for i in range(6))], ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"])

    return docs.select(F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("lang", "source", "text")]).mapInArrow(run, STATS)


def vector(df: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda c, of: F.log1p(10 * F.col(c) / of)
    values = (F.log(F.greatest(F.col("word_chars") / n, F.lit(0.1))), share("n_symbols", n), share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))), share("n_repeat_words", n), F.log(n.cast("double")))
    return df.withColumns(dict(zip(VALUES, values)))


def _group() -> Column:
    tag = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c)), F.lit("-"))
    return F.concat_ws("\x1f", tag("lang"), tag("source"))


def _quartiles(rows: DataFrame) -> DataFrame:
    """For each group the quartiles of each value on a grid of 1/GRID."""
    cells = rows.select("g", F.posexplode(F.array(*VALUES)).alias("k", "y")).withColumn("cell", F.floor(F.col("y") * GRID)).groupBy("g", "k", "cell").agg(F.count("*").alias("n"))
    up = Window.partitionBy("g", "k").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("g", "k")
    cells = cells.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(every))
    at = lambda q, name: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("cell"))).alias(name)
    got = cells.groupBy("g", "k").agg(at(0.25, "q1"), at(0.5, "q2"), at(0.75, "q3"))
    return got.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("k", "q1", "q2", "q3"))).alias("q"))


_PARAMS = "g string, start int, mean array<double>, prec array<double>, scale double, logdet double"
_NAMES = [c.split()[0] for c in _PARAMS.split(", ")]


def _fitted(g: str, start: int, centre: np.ndarray, cov: np.ndarray, scale: float) -> list:
    cov = cov + np.diag(np.square(FLOORS))
    return [g, start, centre.tolist(), np.linalg.inv(cov).ravel().tolist(), scale, float(np.linalg.slogdet(cov)[1])]


def _medians(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for g, q in zip(b["g"], b["q"]):
            m = np.array([[r["q1"], r["q2"], r["q3"]] for r in q]) / GRID
            out.append(_fitted(g, 0, m[:, 1] + 0.5 / GRID, np.diag(((m[:, 2] - m[:, 0]) / 1.349) ** 2), 1.0))
        yield pd.DataFrame(out, columns=_NAMES)


def _drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for g, start, ys in zip(b["g"], b["start"], b["ys"]):
            y = np.array([list(r) for r in ys])
            out.append(_fitted(g, start, y.mean(axis=0), np.cov(y.T, bias=True), 1.0))
        yield pd.DataFrame(out, columns=_NAMES)


def _starts(fit: DataFrame, starts: int) -> DataFrame:
    """The first parameters of each group: start 0 from medians, the others from FEWEST rows of least hash each."""
    key = F.xxhash64("doc_id", *VALUES)
    cells = fit.select("g", F.array(*VALUES).alias("y"), key.alias("h")).withColumn("cell", F.pmod("h", F.lit(FEWEST * max(1, starts - 1))))
    rows = cells.groupBy("g", "cell").agg(F.min(F.struct("h", "y"))["y"].alias("y"))
    drawn = rows.groupBy("g", (F.floor(F.col("cell") / FEWEST) + 1).cast("int").alias("start")).agg(F.array_sort(F.collect_list("y")).alias("ys"))
    medians = _quartiles(fit).mapInPandas(_medians, _PARAMS)
    return medians.unionByName(drawn.mapInPandas(_drawn, _PARAMS)) if starts > 1 else medians


def _next(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    k = len(VALUES)
    for b in batches:
        out = []
        for g, start, n, s, ss, middle in zip(b["g"], b["start"], b["n"], b["s"], b["ss"], b["middle"]):
            mean = np.array(s) / n
            cov = np.array(ss).reshape(k, k) / n - np.outer(mean, mean)
            out.append(_fitted(g, start, mean, cov, max(1.0, float(np.exp(middle / BIN)) / chi_square(0.5, k))))
        yield pd.DataFrame(out, columns=_NAMES)


def _distance(mean: Column, prec: Column) -> Column:
    k = len(VALUES)
    off = [F.col(y) - F.element_at(mean, i + 1) for i, y in enumerate(VALUES)]
    return sum((F.element_at(prec, i * k + j + 1) * off[i] * off[j] * (1 if i == j else 2) for i in range(k) for j in range(i, k)), F.lit(0.0))


def _step(rows: DataFrame, params: DataFrame, starts: int) -> DataFrame:
    k = len(VALUES)
    one = lambda i: F.max(F.when(F.col("start") == i, F.struct("mean", "prec"))).alias(f"p{i}")
    wide = cut(params.groupBy("g").agg(*[one(i) for i in range(starts)]))
    at = [F.struct(F.lit(i).alias("start"), _distance(F.col(f"p{i}.mean"), F.col(f"p{i}.prec")).alias("d2")) for i in range(starts)]
    spread = rows.join(maybe_broadcast(wide, 100_000), "g").select("g", *VALUES, F.inline(F.array(*at))).filter("d2 IS NOT NULL")
    cell = F.floor(F.log(F.greatest(F.col("d2"), F.lit(1e-4))) * BIN)
    moments = [F.sum(F.col(a) * F.col(b)).alias(f"m{i}{j}") for i, a in enumerate(VALUES) for j, b in enumerate(VALUES) if i <= j]
    cells = spread.withColumn("cell", cell).groupBy("g", "start", "cell").agg(F.count("*").alias("n"), *[F.sum(y).alias(f"s{i}") for i, y in enumerate(VALUES)], *moments)
    up = Window.partitionBy("g", "start").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(up), F.lit(0))).withColumn("all", F.sum("n").over(Window.partitionBy("g", "start")))
    middle = F.max(F.when(F.col("before") < F.col("all") * 0.5, F.col("cell"))).alias("middle")
    core = F.col("before") < F.col("all") * CORE
    total = lambda c: F.sum(F.when(core, F.col(c)).otherwise(0.0))
    got = cells.groupBy("g", "start").agg(
        F.sum(F.when(core, F.col("n")).otherwise(0)).cast("double").alias("n"),
        F.array(*[total(f"s{i}") for i in range(k)]).alias("s"),
        F.array(*[total(f"m{min(i, j)}{max(i, j)}") for i in range(k) for j in range(k)]).alias("ss"),
        middle,
    )
    return got.mapInPandas(_next, _PARAMS)


def estimates(fit: DataFrame, steps: int = STEPS, starts: int = STARTS) -> DataFrame:
    """The parameters of each group of fit (g, doc_id, VALUES): of all starts those of least determinant (ties: the first)."""
    params = cut(_starts(fit, starts))
    for _ in range(steps):
        params = cut(_step(fit, params, starts))
    return params.groupBy("g").agg(F.min(F.struct(F.round("logdet", 9).alias("least"), "start", "mean", "prec", "scale", "logdet")).alias("p")).select("g", "p.mean", "p.prec", "p.scale", "p.logdet")


def robust_outliers(stats: DataFrame, steps: int = STEPS, tail: float = TAIL, starts: int = STARTS) -> DataFrame:
    """stats with distance (null where base rules alone decide), base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = cut(vector(stats).withColumn("base_failed", failed).withColumn("g", _group()))
    sizes = cut(rows.filter(~F.col("base_failed")).groupBy("g").agg(F.count("*").alias("n")).filter(F.col("n") >= FEWEST).select("g"))
    fit = rows.filter(~F.col("base_failed")).join(maybe_broadcast(sizes, 100_000), "g")
    params = cut(estimates(fit, steps, starts))
    judged = rows.join(maybe_broadcast(params, 100_000), "g", "left").withColumn("distance", F.when(~F.col("base_failed"), _distance(F.col("mean"), F.col("prec")) / F.col("scale")))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi_square(1 - tail, len(VALUES)), F.lit(True)))


def op3_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = robust_outliers(quality_stats(table(spark, sf_dir, "documents")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
