"""Shared helpers of the training-data operators: loading, lineage cuts, checked broadcasts, vectorised words and shingles."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of every contract: runs of anything but ASCII white space.
WORD_RX = r"[^\x20\x09-\x0D]+"

#: Rows up to which an id-like table is sent to all executors (16 to 64 MB); beyond it the same join is shuffled.
BROADCAST_ROWS = 2_000_000

#: Narrow tables of at most FEW_ROWS rows are dealt to FEW_TASKS tasks, however many a shuffle has.
FEW_ROWS, FEW_TASKS = 200_000, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the checkpoint folder that all executors share; later reads survive lost executors.

    The folder is spark.checkpoint.dir. A session in one process, as in tests, may do without: a folder of its own is made.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set where it is not yet."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def packed(df: DataFrame) -> DataFrame:
    """Like cut; of at most FEW_ROWS rows in FEW_TASKS partitions, so that steps on them start no tasks and make no files for next to nothing."""
    df = cut(df)
    return df.coalesce(FEW_TASKS) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


def stored(df: DataFrame) -> DataFrame:
    """Like cut, as a Parquet table in the shared folder: for many narrow rows, of which a checkpoint takes several times the disk."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_broadcast(small: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a materialised narrow table for broadcasting if it has at most `bound` rows, else leave the join to a shuffle."""
    return F.broadcast(small) if small.limit(bound + 1).count() <= bound else small


def slices(batch: pa.RecordBatch, column: str | int = "text", max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Split a batch into runs of whole rows of about max_bytes of text, so that vectorised work has bounded memory."""
    if not batch.num_rows:
        return
    sizes = np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype("float64"))
    group = (np.cumsum(sizes) // max_bytes).astype("int64")
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def text_array(column: pa.Array) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    # A slice, also after cast(), keeps its parent's buffers, whose offsets ascii_lower of pyarrow 23 misreads; take() copies.
    return column.take(pa.array(np.arange(len(column))))


def words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, each token's index into them, and per text the end offsets of its tokens (length n + 1)."""
    texts = text_array(texts)
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    values, ends = lists.flatten(), np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))].astype("int64")
    full = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(bool)
    ends = np.r_[0, np.cumsum(full)][ends]
    coded = pc.dictionary_encode(values.filter(pa.array(full)))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), ends


def word_hashes(distinct: pa.Array) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in distinct.to_pylist()), "uint64", len(distinct))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_K = np.uint64(0x9E3779B97F4A7C15)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash for each position of equally long arrays of word hashes."""
    acc = np.zeros_like(parts[0]) + np.uint64(len(parts))
    for p in parts:
        acc = acc * _K + p
        acc ^= acc >> np.uint64(29)
    return mix(acc)


def shingle_sets(texts: pa.Array, k: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its k-word shingles, words lower-cased.

    A text of fewer than k words is one shingle of all its words; a text without words (or null) has none.
    """
    distinct, idx, ends = words(texts)
    h = word_hashes(distinct)[idx] if len(idx) else np.zeros(0, "uint64")
    rolled = combine([h[i : len(h) - k + 1 + i] for i in range(k)]) if len(h) >= k else np.zeros(0, "uint64")
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            out.append(combine([h[i : i + 1] for i in range(a, b)]))
        else:
            out.append(rolled[:0])
    return out
