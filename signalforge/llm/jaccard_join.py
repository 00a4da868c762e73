"""Operator 1: n-gram Jaccard join by signature trees, exact at any skew.

1. Each text becomes the set of its 5-word shingle hashes; equal sets form a class, and only classes are joined.
2. Every class is dealt to the blocks of its prefix shingles: under one total order of all shingles, two sets with
   100 * |both| >= 80 * |either| share one of their first n - ceil(0.8 n) + 1 shingles. Any fixed order will do; shingles
   seen to be frequent while scanning come last, so that passages which many texts share seldom make a block. A block is
   cut where sizes differ too much for a link.
3. All candidates come from signature trees: leaves are bitmaps of the classes' sets, nodes hold the OR and AND of their
   bitmaps and the ranges of their sizes, and a dual traversal drops pairs of nodes whose greatest possible overlap is too
   small, or which lie in one component. The trees of many blocks are built and walked together, as a forest. Surviving
   pairs are verified on whole sets.
4. The trees are walked three times. First the members of all blocks of a head, its class of least size and id, are one
   tree, walked against the head alone; then, of blocks that still hold several components, that of the class that meets
   most others is. The links that these give make components. At last every block that still holds several components, of
   two members or of thousands, is walked against itself, and pairs within a component are dropped. This walk gives some
   of its pairs first, fewer than members, which join all that all of them join. Once these are verified, the classes of
   pairs left out, where components still differ, are walked with their sets: pairs are verified where they meet, and only
   links that join what is apart are given. So no walk gives more pairs than it has members.
5. Components are joined up. A pair that was never verified is either in one component already or cannot be a link, so no
   link that matters is lost and no group of near copies is expanded into all pairs.

Blocks over BLOCK members are cut into parts, and every pair of parts, or a part and its centre, are trees of their own.

Defined cases: null text or no words: empty set, linked with nothing, component its own id. Fewer than five words: one
shingle. Rows with one doc_id are one node. Null doc_id: n_shingles and null component. Ties: the least id. Very long
texts: whole; bitmaps of sets over MOST_BITS / BITS_EACH shingles only prune less. Extra columns are ignored. Empty table:
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, maybe_broadcast, mix, packed, shingle_sets, slices, table
from .components import connected, joined

PERCENT = 80
#: A bitmap has BITS_EACH bits for each shingle, rounded up to a power of two, within LEAST_BITS and MOST_BITS.
LEAST_BITS, BITS_EACH, MOST_BITS = 512, 16, 1 << 14
BLOCK = 2048
#: A shingle is frequent if slices (of SLICE shingles) that hold it at least twice hold it FREQUENT times together; at most
#: MAX_FREQUENT, the most frequent, are put last.
FREQUENT, MAX_FREQUENT, SLICE = 8, 1_000_000, 2_000_000
#: Blocks are joined together up to FOREST bytes of bitmaps; blocks with whole sets are cut into parts of about PART bytes.
FOREST, PART = 4 << 20, 32 << 20
SEEN = 500_000


def _digest(s: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()) ^ len(s)).astype("int64"))) if len(s) else 0


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in slices(batch):
            yield part, shingle_sets(part.column("text"))


def classes_and_frequent(docs: DataFrame) -> DataFrame:
    """kind 0: (id = doc_id, key = text key, cls, n, bits = its bitmap) of each row of docs (doc_id, key, text); kind 1: (cls = a shingle, n = how many sets of a slice hold it) where two or more do."""

    names = ["kind", "id", "key", "cls", "n", "bits"]

    def often(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        values, counts = values[counts >= 2], counts[counts >= 2]
        k = len(values)
        return pa.RecordBatch.from_arrays([pa.array([1] * k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(values.view("int64")), pa.array(counts), pa.nulls(k, pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for part, sets in _texts(batches):
            cls = [_digest(s) for s in sets]
            for c, s in zip(cls, sets):
                if len(s) and c not in seen:
                    seen.add(c)
                    held.append(s)
                    size += len(s)
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(sets), pa.int32()), part.column("doc_id"), part.column("key"), pa.array(cls, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([bitmap(s).tobytes() for s in sets], pa.binary())], names)
            if size > SLICE:
                yield often(held)
                held, size, seen = [], 0, set()
        if held:
            yield often(held)

    return docs.mapInArrow(run, "kind int, id long, key long, cls long, n long, bits binary")


def _need(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least overlap that a set of n can have with a set it links to."""
    return -(-percent * n // 100)


def prefix(s: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a sorted set under the order (frequent, hash)."""
    k = int(len(s) - _need(len(s), percent) + 1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        late = frequent[at] == s
        if late.any():
            return np.r_[s[~late], s[late]][:k]
    return s[:k]


def postings(docs: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """(shingle, cls, n) for each prefix shingle of each class; copies within a task count once."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most MAX_FREQUENT hashes, 8 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _texts(batches):
            heads, cls, n = [], [], []
            for s in sets:
                if len(s) and (c := _digest(s)) not in seen:
                    if len(seen) < 1_000_000:  # only saves work: repeats are removed later too
                        seen.add(c)
                    heads.append(prefix(s, shared.value, percent))
                    cls.append(c)
                    n.append(len(s))
            if heads:
                times = [len(h) for h in heads]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(heads).view("int64")), pa.array(np.repeat(np.array(cls, "int64"), times)), pa.array(np.repeat(np.array(n, "int32"), times))], ["shingle", "cls", "n"])

    return docs.select("text").mapInArrow(run, "shingle long, cls long, n int")


def shared_blocks(posted: DataFrame, percent: int) -> DataFrame:
    """Members of blocks of two or more classes: (block, cls, n, head, second, head_n), head and second being its first two.

    The classes of a shingle are taken in order of size and cut where the next one is too large for a link with the one
    before: classes on two sides of such a cut cannot be linked, so every part is a block of its own.
    """
    names = ("block", "cls", "n", "head", "second", "head_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, k) for k in ("int64", "int64", "int32")]  # the first row of a block, until the second comes
        last = None  # shingle, class, size, head, second, head's size
        for b in batches:
            s, c, n = (np.r_[h, b.column(i).to_numpy(zero_copy_only=False)] for i, h in enumerate(held))
            fresh = np.r_[last is None or s[0] != last[0] or c[0] != last[1], (s[1:] != s[:-1]) | (c[1:] != c[:-1])] if len(s) else np.zeros(0, bool)
            s, c, n = s[fresh], c[fresh], n[fresh].astype("int64")
            if not len(s):
                continue
            old = last is not None and s[0] == last[0] and percent * n[0] <= 100 * last[2]
            start = np.r_[not old, (s[1:] != s[:-1]) | (percent * n[1:] > 100 * n[:-1])]
            at = np.maximum.accumulate(np.where(start, np.arange(len(s)), -1))
            after = np.minimum(at + 1, len(s) - 1)
            alone = (at >= 0) & ((after == at) | start[after])  # the first row of a block, with none after it here
            of = lambda x, k: np.where(at >= 0, x[np.maximum(at, 0)], last[k] if old else 0)
            head, head_n, second = of(c, 3), of(n, 5), np.where(at >= 0, c[after], last[4] if old else 0)
            block = mix(s.view("uint64") ^ mix(head.astype("int64").view("uint64"))).view("int64")
            wait = alone & (np.arange(len(s)) == len(s) - 1)
            held = [s[wait], c[wait], n[wait].astype("int32")]
            last = None if wait.any() else (s[-1], c[-1], n[-1], head[-1], second[-1], head_n[-1])
            keep = ~alone
            yield pa.RecordBatch.from_arrays([pa.array(x[keep].astype("int32" if k in ("n", "head_n") else "int64")) for k, x in zip(names, (block, c, n, head, second, head_n))], names)

    return posted.repartition("shingle").sortWithinPartitions("shingle", "n", "cls").mapInArrow(run, "block long, cls long, n int, head long, second long, head_n int")


def alike(n: str, m: str, percent: int) -> Column:
    """Whether sets of these sizes can be linked."""
    return (100 * F.col(n) >= percent * F.col(m)) & (100 * F.col(m) >= percent * F.col(n))


def bitmap(s: np.ndarray) -> np.ndarray:
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * max(1, len(s)) - 1).bit_length()))
    out = np.zeros(bits, bool)
    out[(s >> np.uint64(13)) % np.uint64(bits)] = True
    return np.packbits(out)


def folded(maps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps as rows of `width` bytes; wider ones are folded onto themselves, which only adds bits."""
    return np.array([np.bitwise_or.reduce(np.frombuffer(m, "uint8").reshape(-1, width), axis=0) for m in maps], "uint8").reshape(-1, width)


def sets_of(docs: DataFrame, wanted: DataFrame, names: DataFrame) -> DataFrame:
    """(cls, data) of the wanted classes: their sets, made anew from one text of each class."""
    ids = packed(wanted.join(names.select("cls", "id", "key"), "cls"))
    texts = docs.join(maybe_broadcast(ids), docs["doc_id"].eqNullSafe(ids["id"]) & (text_key(docs["text"]) == ids["key"])).select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _texts(batches):
            yield pa.RecordBatch.from_arrays([part.column("cls"), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "data"])

    return texts.mapInArrow(run, "cls long, data binary").dropDuplicates(["cls"])


def linked(a: bytes, b: bytes, percent: int) -> bool:
    s, t = np.frombuffer(a, "uint64"), np.frombuffer(b, "uint64")
    shared = len(s) + len(t) - len(np.union1d(s, t))
    return 100 * shared >= percent * (len(s) + len(t) - shared)


def verified(docs: DataFrame, names: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are links."""
    pairs = packed(pairs)
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    sets = cut(sets_of(docs, wanted, names))
    left = pairs.join(sets.withColumnsRenamed({"cls": "b", "data": "set_b"}), "b")
    both = left.join(sets.withColumnsRenamed({"cls": "a", "data": "set_a"}), "a").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [linked(s, t, percent) for s, t in zip(*(b.column(c).to_pylist() for c in ("set_a", "set_b")))]
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


class SignatureForest:
    """A tree for each block over the bitmaps of its members, in the order of set size.

    A node is a run of leaves of one block: the OR and the AND of their bitmaps, and the ranges of their sizes and components.
    """

    FAN = 8

    def __init__(self, block: np.ndarray, bits: np.ndarray, n: np.ndarray, comp: np.ndarray) -> None:
        order = np.lexsort((comp, n, block))
        self.rows, own = order, block[order]
        bits, n, comp = bits[order], n[order], comp[order]
        self.levels, self.first = [(bits, bits, n, n, comp, comp)], [np.arange(len(own) + 1)]
        while (own[1:] == own[:-1]).any():
            start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            within = np.arange(len(own)) - np.repeat(start, np.diff(np.r_[start, len(own)]))
            at = np.flatnonzero(within % self.FAN == 0)
            b, every, lo, hi, c0, c1 = self.levels[-1]
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.bitwise_and.reduceat(every, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.minimum.reduceat(c0, at), np.maximum.reduceat(c1, at)))
            self.first.append(np.r_[at, len(own)])
            own = own[at]
        self.roots = own

    def join(self, other: SignatureForest, percent: int, itself: bool, most_bytes: int = 8 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves of the trees of one block, as row numbers of the two inputs, that no node could rule out."""
        top, step = max(len(self.levels), len(other.levels)) - 1, max(64, most_bytes // self.levels[0][0].shape[1])
        _, i, j = np.intersect1d(self.roots, other.roots, assume_unique=True, return_indices=True)
        stack = [(top, i, j)]
        while stack:
            level, i, j = stack.pop()
            if len(i) > step:
                stack += [(level, i[:step], j[:step]), (level, i[step:], j[step:])]
                continue
            i, j = self._possible(other, level, i, j, percent, itself)
            if not len(i):
                continue
            if level == 0:
                yield self.rows[i], other.rows[j]
                continue
            (a, na), (b, nb) = self._children(level, i), other._children(level, j)
            each = na * nb
            pair = np.repeat(np.arange(len(i)), each)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
            stack.append((level - 1, a[pair] + k // nb[pair], b[pair] + k % nb[pair]))

    def _children(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if level >= len(self.levels):
            return at, np.ones(len(at), "int64")
        first = self.first[level]
        return first[at], first[at + 1] - first[at]

    def _possible(self, other, level, i, j, percent, itself):
        b, every, lo, hi, c0, c1 = self.levels[min(level, len(self.levels) - 1)]
        b2, every2, lo2, hi2, d0, d1 = other.levels[min(level, len(other.levels) - 1)]
        if itself:
            keep = i < j if level == 0 else i <= j
            i, j = i[keep], j[keep]
        keep = ~((c0[i] == c1[i]) & (d0[j] == d1[j]) & (c0[i] == d0[j])) & (percent * lo2[j] <= 100 * hi[i]) & (percent * lo[i] <= 100 * hi2[j])
        i, j = i[keep], j[keep]
        if len(i):
            # Every x of the node has the bits of its AND; those that the other node's OR lacks are shingles that x shares
            # with no y. So x and y share at most hi - that many, which must reach what the least sizes ask for.
            lacks = lambda x, y: np.bitwise_count(x & ~y).sum(axis=1, dtype="int64")
            most = np.minimum(hi[i] - lacks(every[i], b2[j]), hi2[j] - lacks(every2[j], b[i]))
            keep = (100 + percent) * most >= percent * (lo[i] + lo2[j])
            i, j = i[keep], j[keep]
        return i, j


class Joined:
    """Which nodes the pairs given so far have joined."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart; now they are not."""
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def block_candidates(members: DataFrame, percent: int) -> DataFrame:
    """members (block, side, cls, n, comp, data), side 0 for a block with itself, 1 and 2 for two parts of one: candidate pairs (a, b).

    With a column `spare`, each task gives pairs only as long as they join classes that are apart; both classes of a pair left
    out are given as pairs with themselves. With a column `whole`, the class's set, pairs between components are verified at
    once, and a task gives only links, as long as they join components that are apart.
    """
    spare, whole = ("spare" in members.columns), ("whole" in members.columns)
    names = ["block", "side", "cls", "n", "comp", "data", *["whole"] * whole]

    def pairs(left: tuple, right: tuple, width: int, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(left[0]) and len(right[0]):
            one = SignatureForest(left[0], folded(left[4], width), left[2], left[3])
            two = one if itself else SignatureForest(right[0], folded(right[4], width), right[2], right[3])
            for i, j in one.join(two, percent, itself):
                yield left[1][i], right[1][j]

    def candidates(rows: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        block, side, cls, n, comp = (np.array([r[k] for r in rows], "int64") for k in range(5))
        data = [r[5] for r in rows]
        wide = np.array([len(d) for d in data])
        take = lambda at: (block[at], cls[at], n[at], comp[at], [data[i] for i in at])
        # Sets that link differ by a factor under two in size, so their bitmaps are as wide, or one is twice as wide.
        for w in np.unique(wide).tolist():
            own, wider = ([take(np.flatnonzero((wide == k) & (side == s))) for s in range(3)] for k in (w, 2 * w))
            yield from pairs(own[0], own[0], w, True)
            yield from pairs(own[0], wider[0], w, False)
            yield from pairs(own[1], own[2], w, False)
            yield from pairs(own[1], wider[2], w, False)
            yield from pairs(wider[1], own[2], w, False)

    def chosen(a: int, b: int, seen: set, apart: Joined, of: dict) -> list[tuple[int, int]]:
        """What is given of a candidate pair."""
        if spare and not apart.join(a, b):
            new = [(c, c) for c in (a, b) if (c, c) not in seen]
            seen.update(new)
            return new
        if whole and apart.root(of[a][0]) == apart.root(of[b][0]):
            return []
        seen.add((a, b))
        if whole:
            if not linked(of[a][1], of[b][1], percent):
                return []
            apart.join(of[a][0], of[b][0])
        return [(a, b)]

    def fresh(rows: list[tuple], seen: set, apart: Joined) -> Iterator[pa.RecordBatch]:
        of = {r[2]: (r[4], r[6]) for r in rows} if whole else {}
        for x, y in candidates(rows) if len(rows) > 1 else ():
            given = []
            for pair in zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist()):
                if pair not in seen:
                    given += chosen(*pair, seen, apart, of)
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in given], pa.int64()) for i in range(2)], ["a", "b"])
            if len(seen) > SEEN:  # only saves rows: repeats are removed later too
                seen.clear()
                apart.up.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, seen, apart = [], 0, set(), Joined()
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in names)):
                if size > FOREST and row[0] != rows[-1][0]:
                    yield from fresh(rows, seen, apart)
                    rows, size = [], 0
                rows.append(row)
                size += sum(map(len, row[5:])) + 200
        yield from fresh(rows, seen, apart)

    ordered = members.repartition("block").sortWithinPartitions("block").select(*names)
    return ordered.mapInArrow(run, "a long, b long").distinct()


def mixed_groups(blocks: DataFrame, comps: DataFrame) -> DataFrame:
    """(block, cls, n, comp, met) of blocks with several components; blocks with the same two least classes are one, and
    met is the sum of their sizes.

    Texts that share a passage or most of a text meet in many blocks of nearly the same members; as one block they meet once.
    """
    labelled = blocks.join(maybe_broadcast(comps), blocks["cls"] == comps["node"], "left").select("block", "cls", "n", F.coalesce("component", "cls").alias("comp"), F.xxhash64("head", "second").alias("to"))
    mixed = labelled.groupBy("block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).filter("lo <> hi").select("block", "size")
    return labelled.join(mixed, "block").groupBy(F.col("to").alias("block"), "cls", "n", "comp").agg(F.sum("size").alias("met"))


def hub_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the member of each block that met most others, here and elsewhere, and members in other components.

    Of many near copies of one text, the one with the fewest edits meets most and links with most.
    """
    weights = groups.groupBy("cls").agg(F.sum("met").alias("met"))
    weighed = groups.drop("met").join(weights, "cls")
    hubs = weighed.groupBy("block").agg(F.max(F.struct("met", "cls", "comp", "n")).alias("h")).select("block", F.col("h.cls").alias("hub"), F.col("h.comp").alias("hub_comp"), F.col("h.n").alias("hub_n"))
    met = groups.join(hubs, "block").filter((F.col("comp") != F.col("hub_comp")) & alike("n", "hub_n", percent))
    return met.select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()


def star_candidates(stars: DataFrame, names: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of stars (a = centre, b = member): the tree of a centre's members walked against the centre."""
    stars = packed(stars)
    large = maybe_broadcast(packed(stars.groupBy("a").agg(F.count("*").alias("size")).filter(F.col("size") > BLOCK).select(F.col("a").alias("centre"), F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("parts"))))
    dealt = stars.join(large, stars["a"] == large["centre"], "left").withColumn("part", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int"))
    block = F.xxhash64("a", "part").alias("block")
    members = dealt.select(block, F.lit(1).alias("side"), F.col("b").alias("cls"))
    centres = dealt.select(block, F.lit(2).alias("side"), F.col("a").alias("cls")).distinct()
    rows = members.unionByName(centres).join(names.select("cls", "n", F.col("bits").alias("data")), "cls")
    return block_candidates(rows.withColumn("comp", F.col("cls")), percent)


def across_components(names: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs from groups (block, cls, n, comp) that join all classes which candidates between different components join; a
    class of a candidate that is left out is also paired with itself."""
    rows = in_parts(groups, F.ceil(F.col("size") / F.lit(BLOCK)))
    return block_candidates(rows.join(names.select("cls", F.col("bits").alias("data")), "cls").withColumn("spare", F.lit(True)), percent)


def rest_across(docs: DataFrame, names: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links from groups (block, cls, n, comp) that join all components which links between members of a block join."""
    rows = packed(in_parts(groups, F.ceil(F.greatest(F.col("size") / F.lit(BLOCK), 8 * F.col("total") / F.lit(PART)))))
    sets = sets_of(docs, rows.select("cls").distinct(), names).withColumnRenamed("data", "whole")
    return block_candidates(rows.join(names.select("cls", F.col("bits").alias("data")), "cls").join(sets, "cls"), percent)


def in_parts(groups: DataFrame, parts: Column) -> DataFrame:
    """(block, cls, n, comp, side) of the blocks of groups (block, cls, n, comp) with several components, cut into parts: every
    part with itself and every pair of parts is a block. `parts` is over size, the members, and total, their sets' sizes."""
    sizes = groups.groupBy("block").agg(F.count("*").alias("size"), F.sum("n").alias("total"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    rows = groups.join(sizes.select("block", parts.cast("int").alias("parts")), "block").withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    lo, hi = F.least("part", "other"), F.greatest("part", "other")
    return rows.select(F.xxhash64("block", lo, hi).alias("block"), "cls", "n", "comp", F.when(lo == hi, 0).when(F.col("part") == lo, 1).otherwise(2).alias("side"))


def relabelled(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """groups (block, cls, n, comp) with the components of now."""
    labels = maybe_broadcast(comps)
    return groups.join(labels, groups["cls"] == labels["node"], "left").select("block", "cls", "n", F.coalesce("component", "comp").alias("comp"))


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def linked_classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows and classes as of class_components; links (a, b) of classes, which join all that links join but are not all links."""
    rows, names, links, _ = class_components(docs, percent)
    return rows, names, links


def class_components(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(doc_id, key, cls, n_shingles) of each row of docs (doc_id, text); (cls, id, n, times, bits) of each class, of `times` rows;
    links (a, b) of classes; (node, component) of each class that links join to others.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scanned = cut(classes_and_frequent(docs.withColumn("key", text_key(F.col("text")))))
    rows = scanned.filter("kind = 0").select(F.col("id").alias("doc_id"), "key", "cls", F.col("n").alias("n_shingles"), "bits")
    often = scanned.filter("kind = 1").groupBy("cls").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "cls").limit(MAX_FREQUENT)
    frequent = np.sort(often.toPandas()["cls"].to_numpy("int64").view("uint64"))
    # One row stands for its class: the one of least doc_id (null last) and text key.
    known = rows.filter("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "n_shingles", "bits")).alias("m")
    names = cut(known.groupBy("cls").agg(first, F.count("*").alias("times")).select("cls", F.col("m.doc_id").alias("id"), "m.key", F.col("m.n_shingles").alias("n"), "times", "m.bits"))
    blocks = packed(shared_blocks(postings(docs, frequent, percent), percent))
    first = blocks.filter((F.col("cls") != F.col("head")) & alike("n", "head_n", percent)).select(F.col("head").alias("a"), F.col("cls").alias("b")).distinct()
    links = packed(verified(docs, names, star_candidates(first, names, percent), percent))
    comps = packed(connected(links))
    groups = packed(mixed_groups(blocks, comps))
    more = packed(verified(docs, names, star_candidates(hub_pairs(groups, percent), names, percent), percent))
    comps = joined(comps, more)
    groups = relabelled(groups, comps)
    pairs = packed(across_components(names, groups, percent))
    some = packed(verified(docs, names, pairs.filter("a <> b"), percent))
    comps, links = joined(comps, some), links.unionByName(more).unionByName(some)
    unseen = pairs.filter("a = b").select(F.col("a").alias("cls"))
    if not unseen.isEmpty():
        last = packed(rest_across(docs, names, relabelled(groups.join(maybe_broadcast(unseen), "cls", "left_semi"), comps), percent))
        comps, links = joined(comps, last), links.unionByName(last)
    return rows.drop("bits"), names, links, comps


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows, names, _, comps = class_components(docs.filter("doc_id IS NOT NULL"), percent)
    known, empty = rows.filter("n_shingles > 0"), rows.filter("n_shingles = 0")
    # Rows of one doc_id are one node: its classes are linked.
    classes = packed(known.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).filter("a <> b"))
    if not classes.isEmpty():
        comps = joined(comps, known.join(classes.select("doc_id", "a"), "doc_id").select("a", F.col("cls").alias("b")).filter("a <> b").distinct())
    # Of a component counts the least document of its classes; classes of one row that nothing is linked to need no label.
    linked = names.select("cls", "id").join(comps, names["cls"] == comps["node"]).select("cls", "id", "component")
    least = linked.groupBy("component").agg(F.min("id").alias("label"))
    alone = names.filter("times > 1").select("cls", F.col("id").alias("label")).join(comps, names["cls"] == comps["node"], "left_anti")
    labels = packed(linked.join(least, "component").select("cls", "label").unionByName(alone)).withColumnRenamed("cls", "of")
    found = known.join(maybe_broadcast(labels), known["cls"] == labels["of"], "left").select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))
    same = found.join(empty.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "component_id").distinct()
    out = found.unionByName(empty.join(same, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
    nameless = classes_and_frequent(docs.filter("doc_id IS NULL").withColumn("key", text_key(F.col("text")))).filter("kind = 0")
    return out.unionByName(nameless.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))


def one_of_each_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs (doc_id, text, any others) without near duplicates.

    Of the rows whose texts are joined by links one stays: that of least doc_id (null last) and text key, whole rows that
    are repeated counting once. Rows of one doc_id with unlike texts are judged each by its own text. Rows without words stay.
    """
    rows, _, _, comps = class_components(docs, percent)
    grouped = rows.filter("n_shingles > 0").join(maybe_broadcast(comps), rows["cls"] == comps["node"], "left").select("doc_id", "key", F.coalesce("component", "cls").alias("g"))
    keys = grouped.groupBy("g", "doc_id", "key").agg(F.count("*").alias("times"))
    first = grouped.groupBy("g").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("m"))
    judged = packed(keys.join(first, "g").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "times", (F.col("doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("key") == F.col("m.key"))).alias("stays")))

    def meets(keys: DataFrame):
        return docs["doc_id"].cast("long").eqNullSafe(keys["_id"]) & (text_key(docs["text"].cast("string")) == keys["_key"])

    gone, twice = judged.filter("NOT stays").select("_id", "_key"), judged.filter("stays AND times > 1").select("_id", "_key")
    plain = packed(gone.unionByName(twice))
    once = docs.join(maybe_broadcast(plain), meets(plain), "left_anti")
    several = maybe_broadcast(packed(twice))
    again = docs.join(several, meets(several)).dropDuplicates(["_id", "_key"]).select(*[docs[c] for c in docs.columns])
    return once.unionByName(again)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
