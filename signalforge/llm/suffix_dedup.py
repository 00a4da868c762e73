"""Operator 6: exact substring removal by suffix arrays, on bytes, exact at any skew.

A byte goes if a string of LENGTH bytes that covers it starts at another place too, in any document or in its own.

1. Equal texts form a class; of each class one text is searched. A class of several texts is wholly repeated.
2. Every window of LENGTH bytes belongs to the leftmost least-hashed GRAM-byte string inside it (a minimiser). The choice
   depends on the window's bytes alone, so equal windows have equal minimisers at equal places. Runs of windows with one
   minimiser make a region of some 275 bytes; regions whose minimiser occurs once cannot hold a repeated window. Of a
   minimiser that a task meets several times, one run is sent to where all its runs are counted, and the others anywhere.
3. Regions are dealt to shards by minimiser; equal regions count as one with a multiplicity. A shard's regions are
   concatenated, their suffixes sorted by Larsson-Sadakane doubling in numpy (only unsorted groups are refined), and Kasai's
   pass, in step over all regions, gives common prefixes; windows in a run of common prefixes of LENGTH or more repeat.
4. A minimiser with over BLOCK different regions is split into parts: each part has its suffix array, and the windows of
   one part are looked up in another's by binary search, one task for each pair of parts.
5. Repeated windows go back to their documents as spans; the remaining bytes are cut out of each text.

A class is known by a 64-bit hash of its text, a region by one of its bytes.

Defined cases: null text: empty. Texts under LENGTH bytes: kept whole. Very long texts: whole, searched in overlapping
parts. Null doc_id: a document like any other. Repeated rows are different documents with equal texts; rows of one doc_id
with unlike texts are different documents. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, maybe_broadcast, mix, slices, table

LENGTH, GRAM = 200, 50
BLOCK = 4096
SHARD_BYTES = 1 << 20
_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_B), -1, 2**64))


def classed(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with null texts empty, and cls, the class of each text."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("cls", F.xxhash64("text"))


def of_class(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of classed docs joined with chosen (id, cls, ...) on both; by both keys, so no class makes a large partition."""
    chosen = chosen.withColumnRenamed("cls", "_cls")
    return docs.join(chosen, (docs["cls"] == chosen["_cls"]) & docs["doc_id"].eqNullSafe(chosen["id"])).drop("_cls", "id")


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of each gram-byte string of data."""
    n = len(data)
    power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, _B)])
    back = np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(0, n - gram), _INVERSE)])
    sums = np.r_[np.uint64(0), np.cumsum((data.astype("uint64") + np.uint64(1)) * power[:n])]
    return mix((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least value of each w neighbours, by running minima from both ends of blocks of w."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo("uint64").max, "uint64")
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def runs_of_windows(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, minimiser hash, its place in the text, distance to it from the run's first and last window)."""
    flat = np.frombuffer(b"".join(texts), "uint8")
    sizes = np.array([len(t) for t in texts], "int64")
    if len(flat) < length:
        return tuple(np.zeros(0, t) for t in ("int64", "uint64", "int64", "int64", "int64"))
    h = gram_hashes(flat, gram)
    low = np.uint64((1 << 24) - 1)
    key = (h & ~low) | np.arange(len(h), dtype="uint64")
    at = (sliding_min(key, length - gram + 1) & low).astype("int64")  # the minimiser of the window that starts here
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
    inside = np.arange(len(at)) + length <= ends[owner]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return tuple(np.zeros(0, t) for t in ("int64", "uint64", "int64", "int64", "int64"))
    p, o = at[starts], owner[starts]
    first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (o[1:] != o[:-1])])
    last = np.r_[first[1:], len(starts)] - 1
    p, o = p[first], o[first]
    return o, h[p], p - (ends - sizes)[o], p - starts[first], p - starts[last]


RUNS = "gram long, cls long, place long, far short, near short, kind byte"
FIRST_OF_MANY, ALONE, MORE = 0, 1, 2


def window_runs(docs: DataFrame) -> DataFrame:
    """A row for each run of windows of each class; copies within a task count once.

    kind: MORE for runs whose minimiser another run of this slice has too, FIRST_OF_MANY for that other one, else ALONE.
    """
    names = [c.split()[0] for c in RUNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, max_bytes=2 << 20):
                texts, cls = [], []
                for t, c in zip(part.column("text").to_pylist(), part.column("cls").to_pylist()):
                    data = t.encode()
                    if len(data) >= LENGTH and c not in seen:
                        if len(seen) < 200_000:  # only saves work: repeats are removed later too
                            seen.add(c)
                        texts.append(data)
                        cls.append(c)
                group, size = [], 0
                for i, t in enumerate(texts):  # a flat run of bytes has at most 2^24 places, but for a single longer text
                    group.append(i)
                    size += len(t)
                    if size > 2 << 20 or i == len(texts) - 1:
                        yield from _emit([texts[k] for k in group], [cls[k] for k in group])
                        group, size = [], 0

    def _emit(texts: list[bytes], cls: list[int]) -> Iterator[pa.RecordBatch]:
        step = 4 << 20
        if len(texts) == 1 and len(texts[0]) > step:
            # A very long text goes in overlapping parts; each window starts in exactly one of them.
            for a in range(0, len(texts[0]) - LENGTH + 1, step):
                yield _rows([texts[0][a : a + step + LENGTH - 1]], cls, a)
        else:
            yield _rows(texts, cls, 0)

    def _rows(texts: list[bytes], cls: list[int], shift: int) -> pa.RecordBatch:
        o, h, place, far, near = runs_of_windows(texts)
        _, first, which, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        kind = np.where(times[which] > 1, MORE, ALONE)
        kind[first[times > 1]] = FIRST_OF_MANY
        return pa.RecordBatch.from_arrays([pa.array(h.view("int64")), pa.array(np.array(cls, "int64")[o]), pa.array(place + shift), pa.array(far.astype("int16")), pa.array(near.astype("int16")), pa.array(kind.astype("int8"))], names)

    return docs.select("text", "cls").mapInArrow(run, RUNS)


def repeated_grams(runs: DataFrame) -> DataFrame:
    """The runs whose minimiser occurs at two or more different places."""
    names = [c.split()[0] for c in RUNS.split(", ")]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, given = None, True  # the last row, with the kind of its minimiser's first row, and whether it was given out
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(n).to_numpy(zero_copy_only=False) for n in names]
            if last is not None:
                cols = [np.r_[x, c].astype(c.dtype) for x, c in zip(last, cols)]
            g, c, p, f = cols[:4]
            fresh = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (p[1:] != p[:-1]) | (f[1:] != f[:-1])]
            held = last is not None
            cols = [x[fresh] for x in cols]
            g, kind = cols[0], cols[5].copy()
            same = g[1:] == g[:-1]
            start = np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(g)), 0))
            kind = np.minimum(kind, np.where(kind[start] == FIRST_OF_MANY, FIRST_OF_MANY, MORE))
            out = np.r_[False, same] | np.r_[same, False] | (kind != ALONE)
            if held and given:
                out[0] = False
            # The last row waits: the next batch may hold its partner.
            given = bool(out[-1]) or (held and len(g) == 1 and given)
            cols[5] = kind.astype("int8")
            last = [x[-1:] for x in cols]
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in cols], names)

    ordered = runs.repartition(F.when(F.col("kind") == MORE, F.xxhash64("cls", "place")).otherwise(F.col("gram"))).sortWithinPartitions("gram", "kind", "cls", "place", F.desc("far"))
    return ordered.mapInArrow(keep, RUNS).drop("kind")


def regions(docs: DataFrame, names: DataFrame, runs: DataFrame) -> DataFrame:
    """(cls, start, gram, rid, size, data): the region of each run; data only where this task has not yet given the region rid."""
    by_text = runs.groupBy("cls").agg(F.collect_list(F.struct("gram", "place", "far", "near")).alias("runs"))
    texts = of_class(docs, by_text.join(names, "cls")).select("text", "cls", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, max_bytes=1 << 20):
                out: list[list] = [[] for _ in range(6)]
                for text, cls, own in zip(part.column("text").to_pylist(), part.column("cls").to_pylist(), part.column("runs").to_pylist()):
                    data = text.encode()
                    for gram, place, far, near in sorted({tuple(r.values()) for r in own}):
                        a = place - far
                        piece = data[a : place - near + LENGTH]
                        rid = int(np.array([xxhash.xxh3_64_intdigest(piece, seed=far)], "uint64").view("int64")[0])
                        new = rid not in seen
                        if new and len(seen) < 500_000:
                            seen.add(rid)
                        for column, value in zip(out, (cls, a, gram, rid, len(piece), piece if new else None)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:5]), pa.array(out[5], pa.binary())], ["cls", "start", "gram", "rid", "size", "data"])

    return texts.mapInArrow(run, "cls long, start long, gram long, rid long, size long, data binary")


class SuffixArray:
    """The suffixes of concatenated regions in order."""

    def __init__(self, pieces: list[bytes], length: int = LENGTH) -> None:
        self.length = length
        self.sizes = np.array([len(p) for p in pieces], "int64")
        self.starts = np.r_[0, np.cumsum(self.sizes)][:-1].astype("int64")
        flat = np.frombuffer(b"".join(pieces) + bytes(length + 16), "uint8").astype("uint64")
        n = self.n = int(self.sizes.sum())
        pack = flat
        for shift in (1, 2, 4):  # eight bytes from each place, the first one highest
            pack = (pack << np.uint64(8 * shift)) | np.r_[pack[shift:], np.zeros(shift, "uint64")]
        self.pack = pack
        order = np.argsort(pack[:n], kind="stable")
        sorted_pack = pack[order]
        head = np.r_[True, sorted_pack[1:] != sorted_pack[:-1]]
        rank = np.empty(n + length + 16, "int64")
        rank[n:] = -1
        group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[order] = group
        h = 8
        while True:  # to the end: Kasai's pass needs the full order
            slots = np.flatnonzero(~(head & np.r_[head[1:], True]))  # places in groups of two or more
            if not len(slots):
                break
            own = order[slots]
            key = rank[own] * (n + 2) + rank[np.minimum(own + h, n)] + 1
            by = np.argsort(key, kind="stable")
            own, key = own[by], key[by]
            order[slots] = own
            fresh = np.r_[True, key[1:] != key[:-1]]
            head[slots] = fresh
            group = np.maximum.accumulate(np.where(fresh, slots, 0))
            rank[own] = group
            h *= 2
        self.order = order
        self.window = np.zeros(n, bool)  # where a window of whole length starts
        for a, size in zip(self.starts, self.sizes):
            self.window[a : a + size - length + 1] = True

    def extend(self, other: SuffixArray, i: np.ndarray, j: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The common prefix, length at most, of the suffixes i of this and j of the other, of which k bytes are known to agree."""
        k = k.copy()
        live = np.arange(len(i))
        while len(live):
            same = self.pack[i[live] + k[live]] == other.pack[j[live] + k[live]]
            k[live[same]] += 8
            live = live[same & (k[live] < self.length)]
        x = self.pack[np.minimum(i + k, len(self.pack) - 1)] ^ other.pack[np.minimum(j + k, len(other.pack) - 1)]
        more = sum((x < np.uint64(1 << b)).astype("int64") for b in range(8, 64, 8))
        return np.minimum(np.where(k < self.length, k + more, k), self.length)

    def common_prefixes(self) -> np.ndarray:
        """Kasai: for each place in the order the common prefix with the one before; one pass, in step over all regions."""
        place = np.empty(self.n, "int64")
        place[self.order] = np.arange(self.n)
        before = self.order[place - 1]
        out = np.zeros(self.n, "int64")
        live, k = np.arange(len(self.sizes)), np.zeros(len(self.sizes), "int64")
        for t in range(int(self.sizes.max(initial=0))):
            keep = self.sizes[live] > t
            live, k = live[keep], k[keep]
            i = self.starts[live] + t
            first = place[i] == 0
            k = np.where(first, 0, self.extend(self, i, before[i], k))
            out[place[i]] = k
            k = np.maximum(k - 1, 0)
        return out

    def repeated(self) -> np.ndarray:
        """Which windows occur twice or more here."""
        run = np.cumsum(self.common_prefixes() < self.length) - 1
        counts = np.bincount(run, weights=self.window[self.order], minlength=1)
        out = np.zeros(self.n, bool)
        out[self.order] = counts[run] >= 2
        return out & self.window

    def found_in(self, other: SuffixArray) -> np.ndarray:
        """Which windows of this occur in the other: binary search in its order."""
        at = np.flatnonzero(self.window)
        lo, hi = np.zeros(len(at), "int64"), np.full(len(at), other.n, "int64")
        zero = np.zeros(len(at), "int64")
        while (open_ := lo < hi).any():
            middle = np.minimum((lo + hi) // 2, other.n - 1)
            k = self.extend(other, at, other.order[middle], zero)
            less = (k < self.length) & (other.pack[other.order[middle] + np.minimum(k, self.length)] < self.pack[at + np.minimum(k, self.length)])
            lo = np.where(open_ & less, middle + 1, lo)
            hi = np.where(open_ & ~less, middle, hi)
        # The first suffix that is not less; any later window among its equals will do.
        out = np.zeros(self.n, bool)
        valid = np.r_[np.flatnonzero(other.window[other.order]), other.n]
        nxt = valid[np.searchsorted(valid, lo)]
        ok = nxt < other.n
        out[at[ok]] = self.extend(other, at[ok], other.order[nxt[ok]], zero[ok]) >= self.length
        return out


def _window_rows(sa: SuffixArray, rids: list[int], hit: np.ndarray) -> Iterator[tuple[int, int, int]]:
    for rid, a, size in zip(rids, sa.starts, sa.sizes):
        own = hit[a : a + size]
        if own.any():
            edge = np.diff(np.r_[0, own.astype("int8"), 0])
            for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                yield rid, int(x), int(y) - 1 + LENGTH


def repeated_parts(wide: DataFrame) -> DataFrame:
    """wide (block, side, rid, data), side 0 for a block within itself, 1 and 2 for the two of a pair of parts: (rid, a, z), the bytes of regions covered by windows that other regions hold, or themselves twice."""

    def emit(groups: list[list]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int]] = []
        plain = [r for g in groups if not any(x[0] for x in g) for r in g]
        if plain:
            sa, rids = SuffixArray([r[2] for r in plain]), [r[1] for r in plain]
            rows += _window_rows(sa, rids, sa.repeated())
        for g in groups:
            if any(x[0] for x in g):
                one, two = ([r for r in g if r[0] == side] for side in (1, 2))
                if one and two:
                    a, b = SuffixArray([r[2] for r in one]), SuffixArray([r[2] for r in two])
                    rows += _window_rows(a, [r[1] for r in one], a.found_in(b))
                    rows += _window_rows(b, [r[1] for r in two], b.found_in(a))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["rid", "a", "z"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, own, groups, size = None, [], [], 0
        for b in batches:
            for k, *r in zip(*(b.column(c).to_pylist() for c in ("block", "side", "rid", "data"))):
                if k != block:
                    if len(own) > 1:
                        groups.append(own)
                        size += sum(len(x[2]) for x in own)
                    if size > SHARD_BYTES:
                        yield from emit(groups)
                        groups, size = [], 0
                    block, own = k, []
                own.append(r)
        if len(own) > 1:
            groups.append(own)
        if groups:
            yield from emit(groups)

    return wide.repartition("block").sortWithinPartitions("block", "side").select("block", "side", "rid", "data").mapInArrow(run, "rid long, a long, z long")


def repeated_spans(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """(cls, spans) for classes with anything to remove; spans as array<struct<a, z>>, not yet merged."""
    classes = cut(scanned.filter(F.col("n_bytes") >= LENGTH).groupBy("cls").agg(F.count("*").alias("copies"), F.min("doc_id").alias("id"), F.min("n_bytes").alias("n_bytes")))
    runs = repeated_grams(window_runs(docs))
    found = cut(regions(docs, classes.select("cls", "id"), runs))
    times = found.groupBy("gram", "rid").agg(F.count("*").alias("times"), F.max("size").alias("size"))
    different = times.groupBy("gram").agg(F.count("*").alias("regions")).filter("regions > 1")
    wide = found.filter("data IS NOT NULL").select("gram", "rid", "data").dropDuplicates(["rid"]).join(different, "gram")
    wide = wide.withColumn("parts", F.ceil(F.col("regions") / F.lit(BLOCK)).cast("int")).withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int"))
    wide = wide.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    lo, hi = F.least("part", "other"), F.greatest("part", "other")
    wide = wide.select(F.when(F.col("parts") == 1, F.col("gram")).otherwise(F.xxhash64("gram", lo, hi)).alias("block"), F.when(lo == hi, 0).when(F.col("part") == lo, 1).otherwise(2).alias("side"), "rid", "data")
    whole = times.filter("times > 1").select("rid", F.lit(0).cast("long").alias("a"), F.col("size").alias("z"))
    parts = cut(repeated_parts(wide).unionByName(whole).distinct())
    places = found.select("cls", "start", "rid")
    spans = places.join(maybe_broadcast(parts), "rid").select("cls", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("z")).alias("z"))
    spans = spans.unionByName(classes.filter("copies > 1").select("cls", F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("z")))
    return spans.groupBy("cls").agg(F.array_sort(F.collect_set(F.struct("a", "z"))).alias("spans"))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, kept binary, spans array<struct<a, z>>) for each row of docs (doc_id, text)."""
    docs = classed(docs)
    scanned = cut(docs.select("doc_id", "cls", F.octet_length("text").cast("long").alias("n_bytes")))
    spans = cut(repeated_spans(docs, scanned))
    known = scanned.select("doc_id", "cls").distinct().join(spans, "cls").select(F.col("doc_id").alias("id"), F.col("cls").alias("_cls"), "spans")
    joined = docs.join(known, (docs["cls"] == known["_cls"]) & docs["doc_id"].eqNullSafe(known["id"]), "left").select("doc_id", "text", "spans")
    one = pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=4 << 20):
                sizes, kept, gone = [], [], []
                for text, known in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    data, spans = text.encode(), merge_spans([(s["a"], s["z"]) for s in known or ()])
                    at, left = 0, []
                    for a, z in spans:
                        left.append(data[at:a])
                        at = z
                    left.append(data[at:])
                    sizes.append(len(data))
                    kept.append(b"".join(left))
                    gone.append([{"a": a, "z": z} for a, z in spans])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(gone, one)], ["doc_id", "n_bytes", "kept", "spans"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, kept binary, spans array<struct<a: long, z: long>>")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
