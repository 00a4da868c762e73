"""Operator 10: fuzzy passages by collinear chaining.

1. Equal texts form a class; of each class one text is searched. A class of several texts is wholly repeated.
2. Seeds are minimisers: of each WINDOW neighbouring SEED-word strings (lower-cased) the least-hashed one. A seed's first
   place, by class and position, is its head; every place in another class is matched to the head. So a seed that a third of
   all texts hold gives one match a text, not all pairs.
3. The matches of a pair of classes are chained: in the order of one text, each match extends the best chain that ends
   before it in both texts, less a cost for the gap; a Fenwick tree of running maxima finds that chain.
4. A chain is aligned as a whole: the gaps between its seeds and MARGIN words beyond its ends by longest common
   subsequences, of gaps over GAP_MOST words only the MARGIN words at either end. If the alignment as a whole has LEAST
   words or more and IDENTITY of them matched, it is a passage in both texts; else of all its stretches that have, the
   best-scoring one is, and what lies on either side of it is searched again. Chains that cannot reach LEAST words of which IDENTITY
   are matched, whatever their seeds' gaps and margins match, are not aligned.

A class is known by a 64-bit hash of its text; words are aligned by 32-bit hashes.

Defined cases: null text or no words: nothing. Texts under LEAST words: nothing, copies included. Very long texts: whole.
Null doc_id: a document like any other. Repeated rows are different documents with equal texts; rows of one doc_id with
unlike texts are different documents. Ties: of equally good stretches the first. Extra columns are ignored. Empty table:
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_RX, combine, cut, slices, stored, table, word_hashes, words
from .suffix_dedup import classed, merge_spans, of_class, sliding_min

SEED, WINDOW = 5, 10
GAP_COST, FEWEST = 0.03, 2
MARGIN, GAP_MOST = 30, 96
RUN, RUN_SPAN = 4, 48
LEAST, IDENTITY = 40, 0.8
#: Bytes of aligned chains that a task keeps.
KNOWN = 32 << 20


def seeds(docs: DataFrame) -> DataFrame:
    """(seed, cls, place) of the minimisers of each text; copies within a task count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                distinct, idx, ends = words(part.column("text"))
                if len(idx) < SEED:
                    continue
                h = word_hashes(distinct)[idx]
                rolled = combine([h[i : len(h) - SEED + 1 + i] for i in range(SEED)])
                out: list[list[np.ndarray]] = [[], [], []]
                for a, b, c in zip(ends[:-1], ends[1:], part.column("cls").to_pylist()):
                    if b - a < LEAST or c in seen:
                        continue
                    if len(seen) < 200_000:  # only saves work: repeats are harmless
                        seen.add(c)
                    own = rolled[a : b - SEED + 1]
                    least = sliding_min(own, WINDOW)
                    # A place is chosen if it is the least of some window: if the greatest of its windows' minima is itself.
                    padded = np.r_[np.zeros(WINDOW - 1, "uint64"), least, np.zeros(WINDOW - 1, "uint64")]
                    at = np.flatnonzero(~sliding_min(~padded, WINDOW)[: len(own)] == own)
                    out[0].append(own[at])
                    out[1].append(np.full(len(at), c, "int64"))
                    out[2].append(at)
                if out[0]:
                    s, c, p = (np.concatenate(x) for x in out)
                    yield pa.RecordBatch.from_arrays([pa.array(s.view("int64")), pa.array(c), pa.array(p.astype("int32"))], ["seed", "cls", "place"])

    return docs.select("text", "cls").mapInArrow(run, "seed long, cls long, place int")


MATCHED = "seed long, cls long, place int, head_cls long, head_place int"


def rows_of(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    kinds = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c.astype("int64" if k == "long" else "int32")) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])


def matches(found: DataFrame) -> DataFrame:
    """(seed, cls, place, head_cls, head_place) of the places of a seed that several classes hold.

    Further places in the head's class are matched to the first place in another class; the head itself is its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # seed, head class, head place, once another class was seen
        held = [np.zeros(0, k) for k in ("int64", "int64", "int32")]  # the head's class of an unfinished seed
        for b in batches:
            if not b.num_rows:
                continue
            s, c, p = (np.r_[h, b.column(n).to_numpy(zero_copy_only=False)] for h, n in zip(held, ("seed", "cls", "place")))
            first = np.r_[last is None or s[0] != last[0], s[1:] != s[:-1]]
            at = np.maximum.accumulate(np.where(first, np.arange(len(s)), -1))
            hc, hp = np.where(at >= 0, c[at], 0 if last is None else last[1]), np.where(at >= 0, p[at], 0 if last is None else last[2])
            other = hc != c
            # The next row of another class, where it is of the same seed.
            nxt = np.minimum.accumulate(np.where(other, np.arange(len(s)), len(s))[::-1])[::-1]
            there = np.minimum(nxt, len(s) - 1)
            shared = (nxt < len(s)) & (s[there] == s)
            wait = (s == s[-1]) & ~other & ~shared if at[-1] >= 0 and not other[-1] else np.zeros(len(s), bool)
            more = ~other & (p != hp) & shared
            hc, hp, keep = np.where(more, c[there], hc), np.where(more, p[there], hp), other | shared
            yield rows_of(MATCHED, s[keep], c[keep], p[keep], hc[keep], hp[keep])
            held = [x[wait] for x in (s, c, p)]
            last = None if wait.any() else (s[-1], hc[-1], hp[-1])

    return found.repartition("seed").sortWithinPartitions("seed", "cls", "place").mapInArrow(run, MATCHED)


def runs(matched: DataFrame) -> DataFrame:
    """(seed, cls, place, until) of runs of RUN neighbouring shared seeds whose heads do not follow each other in one text.

    Two texts that share such a run may each share its seeds with other heads only; so the run is a key too.
    """
    schema = "seed long, cls long, place int, until int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            new = [b.column(n.split()[0]).to_numpy(zero_copy_only=False) for n in MATCHED.split(", ")]
            s, c, p, hc, hp = (np.r_[h, x] for h, x in zip(held, new)) if held else new
            old = len(held[0]) if held else 0
            fresh = np.r_[True, (c[1:] != c[:-1]) | (p[1:] != p[:-1])] if len(s) else np.zeros(0, bool)
            s, c, p, hc, hp = (x[fresh] for x in (s, c, p, hc, hp))
            if not len(s):
                continue
            apart = np.cumsum(np.r_[False, (hc[1:] != hc[:-1]) | (hp[1:] <= hp[:-1]) | (hp[1:] - hp[:-1] > RUN_SPAN)])
            d = RUN - 1
            i = np.arange(max(0, old - d), max(0, len(s) - d))
            i = i[(c[i] == c[i + d]) & (p[i + d] - p[i] <= RUN_SPAN) & (apart[i + d] > apart[i])]
            if len(i):
                key = combine([s[i + k].view("uint64") for k in range(RUN)]).view("int64")
                yield rows_of(schema, key, c[i], p[i], p[i + d])
            held = [x[-d:] for x in (s, c, p, hc, hp)]

    return matched.repartition("cls").sortWithinPartitions("cls", "place").mapInArrow(run, schema)


def run_matches(found: DataFrame) -> DataFrame:
    """Matches of both ends of each run with its first holder."""
    schema = MATCHED.removeprefix("seed long, ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # run, head class, its place, its end
        for b in batches:
            if not b.num_rows:
                continue
            s, c, p, u = (b.column(n).to_numpy(zero_copy_only=False) for n in ("seed", "cls", "place", "until"))
            first = np.r_[last is None or s[0] != last[0], s[1:] != s[:-1]]
            at = np.maximum.accumulate(np.where(first, np.arange(len(s)), -1))
            hc, hp, hu = (np.where(at >= 0, x[at], 0 if last is None else last[k]) for k, x in ((1, c), (2, p), (3, u)))
            keep, last = hc != c, (s[-1], hc[-1], hp[-1], hu[-1])
            yield rows_of(schema, np.r_[c[keep], c[keep]], np.r_[p[keep], u[keep]], np.r_[hc[keep], hc[keep]], np.r_[hp[keep], hu[keep]])

    return found.repartition("seed").sortWithinPartitions("seed", "cls", "place").mapInArrow(run, schema).distinct()


class Fenwick:
    """Greatest (value, index) over a prefix, with updates."""

    def __init__(self, n: int) -> None:
        self.best = [(-1e18, -1)] * (n + 1)

    def update(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def prefix(self, i: int) -> tuple[float, int]:
        """Over indexes below i."""
        out = (-1e18, -1)
        while i > 0:
            out = max(out, self.best[i])
            i -= i & -i
        return out


def chains(x: np.ndarray, y: np.ndarray, cost: float = GAP_COST) -> list[list[int]]:
    """Chains of the matches (x, y), sorted by x and then y: lists of row numbers, each match in one chain at most, best first."""
    columns = np.unique(y)
    rank = np.searchsorted(columns, y)
    tree, score, before = Fenwick(len(columns)), [0.0] * len(x), [-1] * len(x)
    waiting: list[int] = []
    for m in range(len(x)):
        if waiting and x[waiting[0]] < x[m]:  # matches of one x cannot follow each other
            for w in waiting:
                tree.update(int(rank[w]), (score[w] + cost * float(x[w] + y[w]), w))
            waiting = []
        value, b = tree.prefix(int(rank[m]))
        gained = value - cost * float(x[m] + y[m])
        score[m], before[m] = (1 + gained, b) if b >= 0 and gained > 0 else (1.0, -1)
        waiting.append(m)
    used, out = set(), []
    for m in sorted(range(len(x)), key=lambda m: (-score[m], m)):
        chain = []
        while m >= 0 and m not in used:
            used.add(m)
            chain.append(m)
            m = before[m]
        if len(chain) >= FEWEST:
            out.append(chain[::-1])
    return out


CHAINS = "a_cls long, a_start int, a_end int, b_cls long, b_start int, b_end int, places binary"


def pairs_chain(x: np.ndarray, y: np.ndarray, cost: float = GAP_COST) -> np.ndarray:
    """Whether the two matches in each row of x and y are a chain, as `chains` finds it."""
    gained = 1 + cost * (x[:, 0] + y[:, 0]) - cost * (x[:, 1] + y[:, 1])
    return (x[:, 0] < x[:, 1]) & (y[:, 0] < y[:, 1]) & (gained > 0)


def chained(matched: DataFrame) -> DataFrame:
    """Chains between pairs of classes, with the stretches of words to align; places are relative to these stretches.

    Most pairs have one match, which is no chain, or two: those are judged together.
    """
    names = [c.split()[0] for c in CHAINS.split(", ")]
    side = lambda cls, first, last: (cls, np.maximum(0, first - MARGIN), last + SEED + MARGIN)

    def batch(c: np.ndarray, hc: np.ndarray, places: list[np.ndarray]) -> pa.RecordBatch:
        """Of chains with their matches (place in c, place in hc)."""
        first, last = (np.array([p[k] for p in places], "int64").reshape(-1, 2) for k in (0, -1))
        columns = *side(c, first[:, 0], last[:, 0]), *side(hc, first[:, 1], last[:, 1])
        starts = np.c_[columns[1], columns[4]]
        own = [(p - s).astype("int32").tobytes() for p, s in zip(places, starts)]
        types = (pa.int64(), pa.int32(), pa.int32()) * 2
        return pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(columns, types)), pa.array(own, pa.binary())], names)

    def found(c: np.ndarray, p: np.ndarray, hc: np.ndarray, hp: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = start[end - start == 2]
        two = np.c_[at, at + 1]
        two = two[pairs_chain(p[two], hp[two])]
        if len(two):
            yield batch(c[two[:, 0]], hc[two[:, 0]], list(np.stack([p[two], hp[two]], axis=2)))
        rows, places = [], []
        for a, b in zip(start[end - start > 2].tolist(), end[end - start > 2].tolist()):
            x, y = p[a:b], hp[a:b]
            for chain in chains(x, y):
                rows.append(a)
                places.append(np.c_[x[chain], y[chain]])
        if rows:
            yield batch(c[rows], hc[rows], places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, "int64")] * 4  # the pair that the next batch may go on with
        for b in batches:
            if not b.num_rows:
                continue
            rows = [np.r_[h, b.column(n).to_numpy(zero_copy_only=False)] for h, n in zip(held, ("cls", "place", "head_cls", "head_place"))]
            c, hc = rows[0], rows[2]
            start = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (hc[1:] != hc[:-1])])
            yield from found(*rows, start[:-1], start[1:])
            held = [x[start[-1] :] for x in rows]
        if len(held[0]):
            yield from found(*held, np.array([0]), np.array([len(held[0])]))

    return matched.repartition("cls", "head_cls").sortWithinPartitions("cls", "head_cls", "place", "head_place").mapInArrow(run, CHAINS)


def stretches(docs: DataFrame, names: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, start, end, data): the hashes of the words [start, end) of each wanted class, cut at the text's end."""
    by_text = wanted.groupBy("cls").agg(F.collect_set(F.struct("start", "end")).alias("spans")).join(names, "cls")
    texts = of_class(docs, by_text).select("text", "cls", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=2 << 20):
                distinct, idx, ends = words(part.column("text"))
                h = (word_hashes(distinct) & np.uint64(0xFFFFFFFF)).astype("uint32")[idx] if len(idx) else np.zeros(0, "uint32")
                rows: list[tuple] = []
                for a, b, cls, spans in zip(ends[:-1], ends[1:], *(part.column(c).to_pylist() for c in ("cls", "spans"))):
                    rows += [(cls, s["start"], s["end"], h[a + s["start"] : min(b, a + s["end"])].tobytes()) for s in spans]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["cls", "start", "end", "data"])

    return texts.mapInArrow(run, "cls long, start int, end int, data binary").dropDuplicates(["cls", "start", "end"])


Pairs = list[tuple[int, int]]


def lcs_rows(a: list[int], b: list[int]) -> list[int]:
    """Rows of bits (Hyyro): row k has, among its lowest j bits, a zero for each word that the last k words of a and the last j of b have in common."""
    places: dict[int, int] = {}
    for k, w in enumerate(reversed(b)):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for w in reversed(a):
        if met := row & places.get(w, 0):
            row = ((row + met) | (row - met)) & full
        rows.append(row)
    return rows


def shared_words(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Both rows of words without words that the other lacks."""
    both = set(a).intersection(b)
    return ([w for w in a if w in both], [w for w in b if w in both]) if both else ([], [])


def lcs_length(a: list[int], b: list[int]) -> int:
    """The length of a longest common subsequence."""
    return len(b) - lcs_rows(a, b)[-1].bit_count() if a != b else len(a)


def common(a: list[int], b: list[int]) -> Pairs:
    """The pairs (place in a, place in b) of a longest common subsequence of two short word rows, early ones preferred."""
    n = min(len(a), len(b))
    same = [k for k in range(n) if a[k] == b[k]]
    if len(same) == n or (len(a) == len(b) and len(same) * 2 >= n):
        return [(k, k) for k in same]
    rows = lcs_rows(a, b)
    left = len(b) - rows[-1].bit_count()
    out, i, j = [], 0, 0
    while left:  # the words that a[i:] and b[j:] have in common
        if a[i] == b[j]:
            out.append((i, j))
            i, j, left = i + 1, j + 1, left - 1
        else:
            rest = len(b) - j
            if rest - (rows[len(a) - i - 1] & ((1 << rest) - 1)).bit_count() == left:
                i += 1
            else:
                j += 1
    return out


def in_gap(a: list[int], b: list[int]) -> Pairs:
    """The pairs of words matched in a gap between seeds; of a long gap, near its ends."""
    if not a or not b:
        return []
    if max(len(a), len(b)) <= GAP_MOST:
        return common(a, b)
    head = common(a[:MARGIN], b[:MARGIN])
    i, j = (head[-1][0] + 1, head[-1][1] + 1) if head else (0, 0)
    tail = common(a[i:][::-1][:MARGIN], b[j:][::-1][:MARGIN])
    return head + [(len(a) - 1 - p, len(b) - 1 - q) for p, q in reversed(tail)]


def align(a: np.ndarray, a_start: int, b: np.ndarray, b_start: int, places: np.ndarray) -> np.ndarray:
    """The pairs (place in the first text, place in the second) of matched words, increasing in both."""
    a, b = a.tolist(), b.tolist()
    seeded = [(p - a_start, q - b_start) for p, q in places.tolist()]
    x, y = seeded[0]
    out = [(x - 1 - p, y - 1 - q) for p, q in reversed(common(a[:x][::-1], b[:y][::-1]))]
    for p, q in seeded:
        if p > x or q > y:
            out += [(x + k, y + m) for k, m in in_gap(a[x : max(x, p)], b[y : max(y, q)])]
        new = max(0, min(p + SEED - max(x, p), q + SEED - max(y, q)))
        out += zip(range(p + SEED - new, p + SEED), range(q + SEED - new, q + SEED))
        x, y = max(x, p + SEED), max(y, q + SEED)
    out += [(x + k, y + m) for k, m in common(a[x : x + MARGIN], b[y : y + MARGIN])]
    return np.array(out, "int64").reshape(-1, 2) + np.array([a_start, b_start])


def best_stretch(pairs: np.ndarray) -> tuple[int, int] | None:
    """First and last row of the best-scoring stretch of LEAST words or more with IDENTITY of them matched."""
    n = np.arange(len(pairs))[:, None]
    share = n - IDENTITY * pairs  # a stretch of rows p to q has the share if share[q] + 1 - IDENTITY >= share[p] in both texts
    score = 3 * n[:, 0] - pairs.sum(axis=1)  # a matched word gains one, an unmatched one costs two
    found, most = None, -np.inf
    fewest = int(np.ceil(IDENTITY * LEAST - 1e-9))
    step = max(1, (1 << 21) // len(pairs))
    for at in range(0, len(pairs) - fewest + 1, step):
        p, q = slice(at, min(at + step, len(pairs) - fewest + 1)), slice(at + fewest - 1, None)
        good = np.ones((p.stop - p.start, len(pairs) - q.start), bool)
        for side in (0, 1):
            good &= share[None, q, side] + (1 - IDENTITY + 1e-9) >= share[p, side, None]
            good &= pairs[None, q, side] - pairs[p, side, None] >= LEAST - 1
        if good.any():
            gain = np.where(good, score[None, q] - score[p, None], -np.inf)
            k = int(gain.argmax())
            if gain.flat[k] > most:
                most, found = gain.flat[k], (at + k // gain.shape[1], q.start + k % gain.shape[1])
    return found


def good(pairs: np.ndarray) -> bool:
    """Whether an alignment as a whole has LEAST words or more, in both texts, and IDENTITY of them matched."""
    spans = pairs[-1] - pairs[0] + 1
    return spans.min() >= LEAST and len(pairs) >= IDENTITY * spans.max() - 1e-9


def good_stretches(pairs: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first from, first to, second from, second to) of the passages of an alignment."""
    waiting = [pairs]
    while waiting:
        part = waiting.pop()
        if len(part) >= IDENTITY * LEAST - 1e-9 and (found := (0, len(part) - 1) if good(part) else best_stretch(part)):
            p, q = found
            yield int(part[p, 0]), int(part[q, 0]) + 1, int(part[p, 1]), int(part[q, 1]) + 1
            waiting += [part[:p], part[q + 1 :]]


def can_hold(a: np.ndarray, a_start: int, b: np.ndarray, b_start: int, places: np.ndarray) -> bool:
    """False only if the chain's alignment has no passage: the words from its first seed to its last, and what both margins
    can match, are too few."""
    (x, y), (v, w) = places[0] - (a_start, b_start), places[-1] + (SEED - a_start, SEED - b_start)
    need = int(np.ceil(IDENTITY * LEAST - 1e-9)) - min(v - x, w - y)
    if need <= 0:
        return True
    before, after = shared_words(a[:x].tolist(), b[:y].tolist()), shared_words(a[v : v + MARGIN].tolist(), b[w : w + MARGIN].tolist())
    most = min(map(len, after))
    if min(map(len, before)) + most < need:
        return False
    need -= lcs_length(*before)
    return need <= 0 or (most >= need and lcs_length(*after) >= need)


def aligned(places: bytes, a: bytes, b: bytes) -> list[tuple[int, int, int, int]]:
    """The passages of a chain, in words of its two stretches."""
    chain = np.frombuffer(a, "uint32"), 0, np.frombuffer(b, "uint32"), 0, np.frombuffer(places, "int32").reshape(-1, 2)
    return list(good_stretches(align(*chain))) if can_hold(*chain) else []


def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, start, end) of the passages of chains (a_cls, a_start, b_cls, b_start, places, a_data, b_data), for both texts.

    Chains of the same words and places, as of boilerplate in many texts, are aligned once in a task while KNOWN bytes hold them.
    """
    known, size = {}, 0
    for b in batches:
        rows = []
        for ac, a0, bc, b0, *chain in zip(*(c.to_pylist() for c in b.columns)):
            key = tuple(chain)
            if (spans := known.get(key)) is None:
                spans = aligned(*chain)
                if (own := sum(map(len, key)) + 300) < KNOWN // 1000:  # texts repeat short passages; long ones seldom, as a whole
                    if (size := size + own) > KNOWN:
                        known, size = {}, own
                    known[key] = spans
            for s, e, t, f in spans:
                rows += [(ac, a0 + s, a0 + e), (bc, b0 + t, b0 + f)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["cls", "start", "end"])


def passages(chain_rows: DataFrame, data: DataFrame) -> DataFrame:
    """(cls, start, end) of accepted passages, for both texts of each chain."""
    side = lambda s: data.select(F.col("cls").alias(f"{s}_cls"), F.col("start").alias(f"{s}_start"), F.col("end").alias(f"{s}_end"), F.col("data").alias(f"{s}_data"))
    both = chain_rows.join(side("a"), ["a_cls", "a_start", "a_end"]).join(side("b"), ["b_cls", "b_start", "b_end"]).select("a_cls", "a_start", "b_cls", "b_start", "places", "a_data", "b_data")
    return both.mapInArrow(spans_of, "cls long, start long, end long").distinct()


def fuzzy_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, spans array<struct<start, end>>) for each row of docs (doc_id, text), spans in words, merged."""
    docs = classed(docs)
    scanned = cut(docs.select("doc_id", "cls", F.regexp_count("text", F.lit(WORD_RX)).cast("long").alias("n_words")))
    classes = cut(scanned.filter(F.col("n_words") >= LEAST).groupBy("cls").agg(F.count("*").alias("copies"), F.min("doc_id").alias("id"), F.max("n_words").alias("n_words")))
    names = classes.select("cls", "id")
    matched = stored(matches(seeds(docs)))
    direct = matched.filter("cls <> head_cls").drop("seed")
    found = cut(chained(direct.unionByName(run_matches(runs(matched)))))
    wanted = found.select(F.col("a_cls").alias("cls"), F.col("a_start").alias("start"), F.col("a_end").alias("end")).unionByName(found.select(F.col("b_cls").alias("cls"), F.col("b_start").alias("start"), F.col("b_end").alias("end"))).distinct()
    spans = passages(found, cut(stretches(docs, names, wanted)))
    spans = spans.unionByName(classes.filter("copies > 1").select("cls", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    spans = spans.groupBy("cls").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    rows = scanned.join(spans, "cls", "left").select("doc_id", "n_words", "found")
    one = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            merged = [[{"start": s, "end": e} for s, e in merge_spans([(x["start"], x["end"]) for x in f or ()])] for f in b.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), pa.array(merged, one)], ["doc_id", "n_words", "spans"])

    return rows.mapInArrow(run, "doc_id long, n_words long, spans array<struct<start: long, end: long>>")


def op10_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fuzzy_passages(table(spark, sf_dir, "documents"))
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return out.select("doc_id", "n_words", covered.alias("n_repeat_words"), F.size("spans").cast("long").alias("n_spans"), F.concat_ws(",", F.transform("spans", lambda s: F.concat(s["start"], F.lit("-"), s["end"]))).alias("spans"))
