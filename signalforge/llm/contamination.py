"""Operator 7: benchmark decontamination by size-partitioned MinHash containment and an exact check.

A document that holds 0.8 of an item's n shingles lacks at most a fifth of them, so of any n - ceil(0.8 n) + j of them it
holds j. An item's sketch is that many of its least shingles in one order of all: first those that fewest items hold, then
by hash (a bottom-k MinHash whose order keeps words of many items out). Items are partitioned by size, each partition with
its own j: larger sets have larger sketches and need more hits, so that short items are found and long ones make few
candidates. Every shingle of the whole document is looked up in the sketches, and each candidate is verified by counting
the distinct shingles of its set that the whole document holds. No true case is missed, in however many pieces it is quoted.

The items are a test suite: their texts go to every worker while they are at most `max_item_shingles` words; beyond that
the suite is searched in several passes of that size. The pairs of each pass are written to the checkpoint folder and its
texts released before the next one begins, so neither broadcasts nor the driver's memory grow with the suite.

Shingles are of five lower-cased words; an item with fewer words is one shingle and cannot be found inside longer texts
except as a whole document. Defined cases: null or empty item or text: matches nothing. Ties: a document that holds several
items, or an item that stands in the suite twice, gives a pair for each. Repeated rows: each row counts. Very long texts:
whole. Null ids: kept as they are. Extra columns: ignored by contained_items, kept by uncontaminated, whatever their names.
Empty tables: no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import combine, cut, shingle_sets, slices, table, word_hashes, words

THRESHOLD, MAX_ITEM_SHINGLES = 0.8, 2_000_000
#: Sketch hits that a candidate needs, by the least size of its partition.
HITS = ((1, 1), (16, 2), (64, 4), (256, 8))
K = 5
PAIRS = "doc_id long, item_id long, n_item_shingles long, n_shared long"


class Suite:
    """The items of one pass: the shingles they hold, and their sketches."""

    def __init__(self, ids: list, sets: list[np.ndarray]) -> None:
        self.ids, self.sets = ids, sets
        self.all, counts = np.unique(np.concatenate(sets) if sets else np.zeros(0, "uint64"), return_counts=True)
        bits = 1 << max(16, (8 * len(self.all) - 1).bit_length())
        self.mask = np.uint64(bits - 1)
        self.bits = np.zeros(bits, bool)
        self.bits[self.all & self.mask] = True
        sketches = []
        self.hits = np.array([max(j for least, j in HITS if least <= len(own)) for own in sets], "int64")
        for own, hits in zip(sets, self.hits):
            size = len(own) - int(np.ceil(THRESHOLD * len(own) - 1e-9)) + hits
            sketches.append(own[np.argsort(counts[np.searchsorted(self.all, own)], kind="stable")[:size]])
        keys = np.concatenate(sketches) if sets else self.all
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], np.repeat(np.arange(len(sets)), [len(r) for r in sketches])[order]

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes some item holds."""
        out = self.bits[hashes & self.mask]
        maybe = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(self.all, hashes[maybe]), max(0, len(self.all) - 1))
        out[maybe] = self.all[at] == hashes[maybe]
        return out

    def candidates(self, held: np.ndarray) -> np.ndarray:
        """Items that may be contained in a document that holds these shingles, in order."""
        at, to = np.searchsorted(self.keys, held), np.searchsorted(self.keys, held, "right")
        owners, hits = np.unique(np.concatenate([self.owners[a:z] for a, z in zip(at, to)]), return_counts=True)
        return owners[hits >= self.hits[owners]]


def search(suite: Suite, texts: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, size of the item's set, shared shingles) of every verified containment."""
    distinct, idx, ends = words(texts)
    h = word_hashes(distinct)[idx] if len(idx) else np.zeros(0, "uint64")
    rolled = combine([h[i : len(h) - K + 1 + i] for i in range(K)]) if len(h) >= K else h[:0]
    hits = suite.known(rolled) if len(suite.all) else np.zeros(len(rolled), bool)
    sums = np.r_[0, np.cumsum(hits)]
    for row, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        if 0 < b - a < K:
            own = combine([h[i : i + 1] for i in range(a, b)])
            marks = suite.known(own) if len(suite.all) else np.zeros(1, bool)
        elif b - a >= K and sums[b - K + 1] > sums[a]:
            own, marks = rolled[a : b - K + 1], hits[a : b - K + 1]
        else:
            continue
        if marks.any():
            held = np.unique(own[marks])
            for i in suite.candidates(held).tolist():
                shared = int(np.isin(suite.sets[i], held, assume_unique=True).sum())
                if shared >= THRESHOLD * len(suite.sets[i]) - 1e-9:
                    yield row, i, len(suite.sets[i]), shared


_built: dict = {}


def worker_suite(ids: list, texts: list) -> Suite:
    key = hash((tuple(ids), tuple(texts)))
    if key not in _built:
        sets = shingle_sets(pa.array(texts, pa.string()))
        full = [i for i, s in enumerate(sets) if len(s)]
        _built.clear()
        _built[key] = Suite([ids[i] for i in full], [sets[i] for i in full])
    return _built[key]


def passes(items: DataFrame, max_item_shingles: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of items (item_id, text), in runs of at most max_item_shingles words and one item."""
    ids, texts, size = [], [], 0
    for r in items.select("item_id", F.col("text").cast("string")).filter(F.col("text").isNotNull()).orderBy("item_id", "text").toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        size += len(r["text"].split())
        if size > max_item_shingles:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def contained_items(docs: DataFrame, items: DataFrame, max_item_shingles: int = MAX_ITEM_SHINGLES) -> DataFrame:
    """Pairs (doc_id, item_id, n_item_shingles, n_shared) of docs (doc_id, text) and items (item_id, text)."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = spark.createDataFrame([], PAIRS)
    for ids, texts in passes(items, max_item_shingles):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            suite = worker_suite(*shared.value)
            for batch in batches:
                for part in slices(batch):
                    doc_ids, found = part.column("doc_id").to_pylist(), list(search(suite, part.column("text")))
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([doc_ids[r] for r, *_ in found], [suite.ids[i] for _, i, _, _ in found], [n for *_, n, _ in found], [s for *_, s in found])], ["doc_id", "item_id", "n_item_shingles", "n_shared"])

        out = out.unionByName(cut(source.mapInArrow(run, PAIRS)))
        shared.unpersist()
    return out


def uncontaminated(docs: DataFrame, items: DataFrame, max_item_shingles: int = MAX_ITEM_SHINGLES) -> DataFrame:
    """The rows of docs whose text holds no item, each judged by its own text."""
    at, names = docs.columns.index("text"), [f"c{i}" for i in range(len(docs.columns))]
    left = docs.toDF(*names)
    for k, (ids, texts) in enumerate(passes(items, max_item_shingles)):
        if k:  # ends the pass before, whose texts can go
            left = cut(left)
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            suite = worker_suite(*shared.value)
            for batch in batches:
                for part in slices(batch, at):
                    clean = np.ones(part.num_rows, bool)
                    clean[[r for r, *_ in search(suite, part.column(at))]] = False
                    yield part.filter(pa.array(clean))

        left = left.mapInArrow(run, left.schema)
    return left.toDF(*docs.columns)


def op7_benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item_shingles", "n_shared", (F.col("n_shared") / F.col("n_item_shingles")).alias("containment"))
