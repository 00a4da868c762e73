"""Exact duplicates by an exchange of Golomb-coded fingerprints, after which only suspects' texts move.

1. Every task reads its rows in blocks (a Parquet file's rows k * BLOCK to (k + 1) * BLOCK - 1), removes white space and takes
   a fingerprint of so many bits that few different texts share one. For each owner, a range of fingerprints, it sends one
   message: the block's distinct fingerprints in that range, sorted, their gaps Golomb-coded (Rice's parameter: quotients
   in unary, remainders in binary), and a bit for each that the block itself holds twice. Which rows have which
   fingerprint stays behind, in the same stored table.
2. An owner decodes its messages, marks what several blocks hold or one holds twice, and answers each with a bitmap.
3. Bitmaps over fingerprints become bitmaps over rows of a block, an eighth of a byte a row. They go to all executors
   while they are under BITMAP_BYTES together; beyond that the files are dealt into passes of that size, each of which
   reads its own files only.
4. Suspects go by their SHA-256 to be compared byte by byte: all texts of one digest are equal if the least and the greatest
   of them are. Aggregation starts in the task that reads them, so a text copied a million times moves once a task.
   Should two texts share a digest, their rows are grouped by the text itself.
5. Rows learn of their group by their digest; groups that hold over a thousandth of the suspects, of which there can be a
   thousand at most, are sent to all executors, so no key of the remaining join is hot.

Message tables and marked rows are written below spark.checkpoint.dir, so a lost executor costs its running tasks only.

Texts are equal when they are identical after deleting ASCII white space. Of equal texts, the row with the most code points
in the original stays, then that of the smallest doc_id (null last), then the one that was read first, so of wholly
repeated rows exactly one is kept. Null text counts as empty; all empty texts are equal. Texts of any length are hashed
whole. Extra columns, whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored

#: Rows of a file in a block; offsets in a block have 16 bits.
BLOCK = 1 << 16
#: Fingerprints have so many bits more than the number of rows, so that one in 256 unique texts is suspected for nothing.
SPARE_BITS = 8
#: Rows to an owner: at most the first on average, and not under the second for the sake of more owners.
MOST_OWNED, LEAST_OWNED = 1 << 22, 1 << 12
#: Row bitmaps are sent to all executors up to this size (64 MB cover 500 million rows), else in several passes.
BITMAP_BYTES = 64 << 20
#: A group is hot if it holds more than one in so many suspects; there are fewer hot groups than that.
HOT = 1000
SPACE = b"\t\n\x0b\x0c\r "


def rice_encode(gaps: np.ndarray) -> bytes:
    """Sorted fingerprints as gaps: the parameter in one byte, the unary part's length in four, unary part, remainders."""
    mean = float(gaps.mean()) if len(gaps) else 0.0
    b = max(0, int(np.log2(max(1.0, mean * np.log(2)))))
    high, low = gaps >> np.uint64(b), gaps & np.uint64((1 << b) - 1)
    ends = np.cumsum(high.astype("int64") + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, "uint8")
    unary[ends] = 1
    packed = np.packbits(unary).tobytes()
    bits = (low[:, None] >> np.arange(b, dtype="uint64")) & np.uint64(1)
    return bytes([b]) + len(packed).to_bytes(4, "big") + packed + np.packbits(bits.astype("uint8")).tobytes()


def rice_decode(code: bytes, n: int) -> np.ndarray:
    """The gaps that rice_encode was given."""
    b, m = code[0], int.from_bytes(code[1:5], "big")
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(code, "uint8", m, 5)))[:n]
    high = (np.diff(ends, prepend=-1) - 1).astype("uint64")
    bits = np.unpackbits(np.frombuffer(code, "uint8", offset=5 + m))[: n * b].reshape(n, b).astype("uint64")
    return (high << np.uint64(b)) + (bits << np.arange(b, dtype="uint64")).sum(axis=1, dtype="uint64")


def located(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and text of Parquet files, with each row's file and number in it, which stay the same however often they are read."""
    return spark.read.parquet(path).select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _bytes(column: pa.Array) -> list[bytes]:
    return [t.translate(None, SPACE) if t else b"" for t in column.cast(pa.large_binary()).to_pylist()]


_SENT = "message long, owner int, n int, payload binary, twice binary, file string, block long, offsets binary, firsts binary"


def messages(rows: DataFrame, bits: int, owners: int) -> DataFrame:
    """One row for each block and owner: what is sent (n, payload, twice) and what stays (file, block, offsets, firsts)."""
    span = -(-(1 << bits) // owners)

    def send(file: str, block: int, prints: np.ndarray, offsets: np.ndarray, number: int) -> Iterator[tuple]:
        order = np.argsort(prints, kind="stable")
        prints, offsets = prints[order], offsets[order]
        firsts = np.r_[True, prints[1:] != prints[:-1]]
        owner = (prints // np.uint64(span)).astype("int64")
        cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for a, z in zip(cuts, np.r_[cuts[1:], len(prints)]):
            starts = np.flatnonzero(firsts[a:z])
            own = prints[a:z][starts] - np.uint64(owner[a] * span)
            twice = np.diff(np.r_[starts, z - a]) > 1
            yield number, int(owner[a]), len(own), rice_encode(np.diff(own, prepend=np.uint64(0))), np.packbits(twice).tobytes(), file, block, offsets[a:z].astype("<u2").tobytes(), np.packbits(firsts[a:z]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SENT.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
        pack = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        number, here, prints, offsets = TaskContext.get().partitionId() << 33, None, [], []
        for whole in batches:
            for b in slices(whole):
                found = [xxhash.xxh3_64_intdigest(t) >> (64 - bits) for t in _bytes(b.column("text"))]
                for file, row, x in zip(b.column("file").to_pylist(), b.column("row").to_pylist(), found):
                    if here != (file, row // BLOCK):
                        if prints:
                            yield pack(list(send(*here, np.array(prints, "uint64"), np.array(offsets), number)))
                            number += 1
                        here, prints, offsets = (file, row // BLOCK), [], []
                    prints.append(x)
                    offsets.append(row % BLOCK)
        if prints:
            yield pack(list(send(*here, np.array(prints, "uint64"), np.array(offsets), number)))

    return rows.select("text", "file", "row").mapInArrow(run, _SENT)


def answers(sent: DataFrame) -> DataFrame:
    """(message, owner, bits): for each fingerprint of a message that has any, whether several rows of all have it."""

    def own(t: pa.Table) -> pa.Table:
        n = t.column("n").to_numpy()
        codes = t.column("payload").to_pylist()
        prints = np.concatenate([np.cumsum(rice_decode(c, k), dtype="uint64") for c, k in zip(codes, n)])
        twice = np.concatenate([np.unpackbits(np.frombuffer(x, "uint8"))[:k] for x, k in zip(t.column("twice").to_pylist(), n)]).astype(bool)
        _, which, times = np.unique(prints, return_inverse=True, return_counts=True)
        several = times > 1
        several[which[twice]] = True
        marked, ends = several[which], np.cumsum(n)
        parts = [marked[e - k : e] for e, k in zip(ends, n)]
        keep = [i for i, p in enumerate(parts) if p.any()]
        return pa.table({"message": t.column("message").take(pa.array(keep, pa.int64())), "owner": t.column("owner").take(pa.array(keep, pa.int64())), "bits": pa.array([np.packbits(parts[i]).tobytes() for i in keep], pa.binary())})

    return sent.select("message", "owner", "n", "payload", "twice").groupBy("owner").applyInArrow(own, "message long, owner int, bits binary")


def row_bitmaps(sent: DataFrame, answered: DataFrame) -> DataFrame:
    """(file, block, words): bit r % 64 of word r / 64 tells whether row r of the block is a suspect; blocks without any are absent."""

    def gather(t: pa.Table) -> pa.Table:
        rows = np.zeros(BLOCK, "uint8")
        for offsets, firsts, bits in zip(t.column("offsets").to_pylist(), t.column("firsts").to_pylist(), t.column("bits").to_pylist()):
            at = np.frombuffer(offsets, "<u2")
            which = np.cumsum(np.unpackbits(np.frombuffer(firsts, "uint8"))[: len(at)].astype("int64")) - 1
            rows[at] |= np.unpackbits(np.frombuffer(bits, "uint8"))[which]
        words = np.packbits(rows[: (np.flatnonzero(rows)[-1] // 64 + 1) * 64], bitorder="little").view("<i8")
        return pa.table({"file": t.column("file")[:1], "block": t.column("block")[:1], "words": pa.array([words.tolist()], pa.list_(pa.int64()))})

    met = sent.select("message", "owner", "file", "block", "offsets", "firsts").join(answered, ["message", "owner"])
    return met.groupBy("file", "block").applyInArrow(gather, "file string, block long, words array<long>")


def suspected(rows: DataFrame, bitmaps: DataFrame, most: int = BITMAP_BYTES) -> DataFrame:
    """rows with `suspect`, by their block's bitmap."""
    size = bitmaps.agg(F.sum(8 * F.size("words") + F.length("file"))).first()[0] or 0
    passes = -(-size // most) or 1
    at = F.col("row") % BLOCK
    bit = F.expr(f"(shiftright(get(words, CAST((row % {BLOCK}) DIV 64 AS INT)), CAST(row % 64 AS INT)) & 1) = 1")
    share = lambda f, p: f if passes == 1 else f.filter(F.pmod(F.xxhash64("file"), F.lit(passes)) == p)
    out = None
    for p in range(passes):
        blocks = share(bitmaps, p).withColumnRenamed("file", "in_file")
        one = share(rows, p).join(F.broadcast(blocks), (F.col("file") == F.col("in_file")) & (((F.col("row") - at) / BLOCK).cast("long") == F.col("block")), "left")
        one = one.select("doc_id", "text", F.coalesce(bit, F.lit(False)).alias("suspect"))
        out = one if out is None else out.unionByName(one)
    return out


def _sha256(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def digested(marked: DataFrame, digest: Callable[[bytes], bytes] = _sha256) -> DataFrame:
    """(doc_id, place, n_chars, sha, body): body is the text without white space, of suspects only; place numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        for whole in batches:
            for b in slices(whole):
                texts, n = _bytes(b.column("text")), b.num_rows
                sizes = pc.fill_null(pc.utf8_length(b.column("text")), 0).cast(pa.int64())
                bodies = [t if s else None for t, s in zip(texts, b.column("suspect").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(range(place, place + n), pa.int64()), sizes, pa.array([digest(t) for t in texts], pa.binary()), pa.array(bodies, pa.binary())], ["doc_id", "place", "n_chars", "sha", "body"])
                place += n

    return marked.mapInArrow(run, "doc_id long, place long, n_chars long, sha binary, body binary")


#: Of a group: most code points, then smallest doc_id (null last), then the row read first.
_BEST = "min(named_struct('fewest', -n_chars, 'unknown', doc_id IS NULL, 'doc_id', doc_id, 'place', place)) AS best"


def exact_duplicates(rows: DataFrame, digest: Callable[[bytes], bytes] = _sha256, most_bitmap: int = BITMAP_BYTES) -> DataFrame:
    """One row for each of `located` rows: doc_id, keep_id, group_size, kept, text_sha256."""
    spark, n = rows.sparkSession, rows.count()
    bits = min(62, SPARE_BITS + max(8, n.bit_length()))
    owners = max(-(-n // MOST_OWNED), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST_OWNED)), 1)
    sent = stored(messages(rows, bits, owners))
    bitmaps = stored(row_bitmaps(sent, answers(sent)))
    marked = stored(digested(suspected(rows, bitmaps, most_bitmap), digest))

    suspects = marked.filter("body IS NOT NULL")
    groups = stored(suspects.groupBy("sha").agg((F.min("body") == F.max("body")).alias("same"), F.count("*").alias("group_size"), F.expr(_BEST)))
    size = lambda f: f.agg(F.sum("group_size")).first()[0] or 0
    hot = groups.filter(F.col("same") & (F.col("group_size") * HOT > size(groups))).select("sha", "group_size", "best")
    cool = groups.filter(F.col("same") & (F.col("group_size") * HOT <= size(groups))).select("sha", "group_size", "best")
    thin = suspects.select("sha", "doc_id", "place")
    parts = [thin.join(F.broadcast(hot), "sha"), thin.join(F.broadcast(hot.select("sha")), "sha", "left_anti").join(cool, "sha")]
    if not groups.filter(~F.col("same")).isEmpty():  # two texts of one digest: by the texts themselves
        both = suspects.join(groups.filter(~F.col("same")).select("sha"), "sha", "left_semi")
        own = both.groupBy("sha", "body").agg(F.count("*").alias("group_size"), F.expr(_BEST))
        parts.append(both.join(own, ["sha", "body"]).select("sha", "doc_id", "place", "group_size", "best"))
    found = [p.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("place") == F.col("best.place")).alias("kept"), "sha") for p in parts]
    found.append(marked.filter("body IS NULL").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def exact_duplicates_of(docs: DataFrame) -> DataFrame:
    """exact_duplicates of any frame, which is written to the shared folder first so that its rows have a place."""
    copy = stored(docs.select("doc_id", "text"))
    return exact_duplicates(copy.select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(located(spark, f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY body ORDER BY length(text) DESC, doc_id) AS keep_id, CAST(count(*) OVER (PARTITION BY body) AS BIGINT) AS group_size,
 row_number() OVER (PARTITION BY body ORDER BY length(text) DESC, doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM d
"""
