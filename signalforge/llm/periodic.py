"""Periodic runs of words, found by comparing a text with itself at every lag in big-integer bit planes.

The words of a text are numbered, and bit i of plane k is bit k of the number of word i, so one Python integer holds a
plane of the whole text. A lag q mismatches where any plane differs from itself shifted by q: XOR, then OR over planes.
Zeros of the mismatches are matches; AND with itself shifted by 1, 2, 4, ... leaves only starts of long enough stretches.

A run is a stretch of consecutive words with smallest period q that is as long as max(SHORTEST, REPEATS * q) and that no
neighbouring word extends. Lags are tried in ascending order up to n / REPEATS. A lag of some dozens of words first sees
every s-th word only (s grows with the lag, so that a run's stretch still spans SAMPLES of them): all lags together cost
about n log n bit operations. What survives is compared exactly, in its neighbourhood. A stretch that lies within a run of
a smaller period belongs to that run and is left out; one that does not has q as its smallest period (Fine and Wilf).

One text is one row of one task, whole; nothing is shuffled, and a lost task is simply run again. Null, empty and wordless
texts have no runs. Repeated rows and rows with a null doc_id are judged by their own text. Ties between longest runs: the
least start, then the least period. Extra columns, whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import slices, table

#: The contract's least length of a run, in words and in periods.
SHORTEST, REPEATS = 6, 4
#: Sampled words in the shortest stretch that a sampled lag must find, and planes compared in that first look.
SAMPLES, FIRST_PLANES = 64, 4

Run = tuple[int, int, int]  # start, length, period


def bit_planes(ids: np.ndarray, most: int = 64) -> list[int]:
    """Plane k holds bit k of every id, the first id in the lowest bit; at least one plane for a text with words."""
    many = max(1, int(ids.max(initial=0)).bit_length())
    return [int.from_bytes(np.packbits((ids >> k & 1).astype("uint8"), bitorder="little").tobytes(), "little") for k in range(min(most, many))]


def _strided_planes(ids: np.ndarray, step: int, most: int) -> list[list[int]]:
    """For each r < step the planes of the words r, r + step, r + 2 * step, ..."""
    rows = np.zeros(-(-len(ids) // step) * step, ids.dtype)
    rows[: len(ids)] = ids
    grid = rows.reshape(-1, step)
    packed = [np.packbits((grid >> k & 1).astype("uint8"), axis=0, bitorder="little").T for k in range(most)]
    return [[int.from_bytes(p[r].tobytes(), "little") for p in packed] for r in range(step)]


def stretches(matches: int, least: int) -> Iterator[tuple[int, int]]:
    """(start, length) of each maximal stretch of at least `least` ones: starts are isolated by shift-doubling AND."""
    left, have = matches, 1
    while have < least and left:
        step = min(have, least - have)
        left &= left >> step
        have += step
    while left:  # each stretch of m ones has left m - least + 1 of them
        start = (left & -left).bit_length() - 1
        tail = left >> start
        many = (~tail & (tail + 1)).bit_length() - 1
        yield start, many + least - 1
        left = tail >> many << (start + many)


class _Known:
    """Runs found so far, for one question: does a run of a smaller period hold this stretch?

    Runs are kept by start; of two runs, one within the other, only the outer one is of use.
    """

    def __init__(self) -> None:
        self.spans: list[tuple[int, int]] = []

    def hold(self, a: int, b: int) -> bool:
        lo, hi = 0, len(self.spans)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if self.spans[mid][0] <= a else (lo, mid)
        return lo > 0 and self.spans[lo - 1][1] >= b

    def add(self, found: list[Run]) -> None:
        spans = sorted(self.spans + [(a, a + n) for a, n, _ in found], key=lambda s: (s[0], -s[1]))
        self.spans = []
        for a, b in spans:
            if not self.spans or b > self.spans[-1][1]:
                self.spans.append((a, b))


def find_runs(ids: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of a sequence of small integers, by start, then period."""
    n = len(ids)
    if n < SHORTEST:
        return []
    planes, known, runs = bit_planes(ids), _Known(), []
    most = max(1, n // REPEATS)
    lag = 1
    while lag <= most:
        step = max(1, (REPEATS - 1) * lag // SAMPLES)
        top = min(most, 2 * lag - 1)
        sampled = _sampler(ids, step) if step > 1 else None
        for q in range(lag, top + 1):
            found: list[Run] = []
            least = max(SHORTEST - q, (REPEATS - 1) * q)
            if sampled is None:
                found = [(a, m + q, q) for a, m in _exact(planes, q, least, 0, n) if not known.hold(a, a + m + q)]
            else:
                done = 0  # neighbourhoods may overlap; a stretch is taken once
                for a, m in sampled(q, least // step):
                    # Chance matches can lengthen the sampled stretch; four samples fewer at each end still tell.
                    if known.hold((a + 4) * step, (a + m - 5) * step + q + 1):
                        continue
                    lo, hi = max(0, (a - 1) * step), min(n, (a + m) * step + 1 + q)
                    for x, length in _exact(planes, q, least, lo, hi):
                        if x >= done and not known.hold(x, x + length + q):
                            found.append((x, length + q, q))
                            done = x + length
            if found:
                known.add(found)
                runs += found
        lag = top + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _exact(planes: list[int], q: int, least: int, lo: int, hi: int) -> list[tuple[int, int]]:
    """Stretches of matches at lag q between words lo and hi, which hold the whole stretch and a word on each side."""
    if hi - lo - q < least:
        return []
    here = planes if lo == 0 else [p >> lo for p in planes]
    mask, missed = (1 << (hi - lo - q)) - 1, 0
    for p in here:
        missed |= (p ^ (p >> q)) & mask
        if missed == mask:
            return []
    return [(lo + a, m) for a, m in stretches(mask ^ missed, least)]


def _sampler(ids: np.ndarray, step: int) -> Callable[[int, int], Iterator[tuple[int, int]]]:
    """A function of (lag, least): stretches of matches among the words 0, step, 2 * step, ... in the first planes."""
    n, parts = len(ids), _strided_planes(ids, step, FIRST_PLANES)

    def look(q: int, least: int) -> Iterator[tuple[int, int]]:
        missed, far = 0, q // step
        for p, later in zip(parts[0], parts[q % step]):
            missed |= p ^ (later >> far)
        mask = (1 << (n - q + step - 1) // step) - 1
        return stretches(mask & ~missed, least)

    return look


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word's number in order of first occurrence."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), "int64", len(words))


def kept_words(n: int, runs: list[Run]) -> list[bool]:
    """Which words stay: all but those that a run holds after its first period."""
    keep = [True] * n
    for start, length, period in runs:
        keep[start + period : start + length] = [False] * (length - period)
    return keep


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's texts: every tenth document, by its checksum, repeats its words from some place on."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_ROWS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, change: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of docs (doc_id, text): all runs, and the text with each run's repeats left out.

    `change` may put other words in place of a document's own before they are searched.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                ids, counts, found, texts = b.column("doc_id").to_pylist(), [], [], []
                for doc_id, text in zip(ids, b.column("text").cast(pa.large_binary()).to_pylist()):
                    words = (text or b"").split()  # of bytes: at ASCII white space only
                    words = change(words, doc_id) if change else words
                    runs = find_runs(numbered(words))
                    counts.append(len(words))
                    found.append([{"start": s, "length": m, "period": q} for s, m, q in runs])
                    texts.append(b" ".join(w for w, k in zip(words, kept_words(len(words), runs)) if k).decode())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(found, _RUNS), pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(search, _ROWS)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of periodic_runs: the longest run, and checksums of all runs and of the collapsed text."""
    return found.selectExpr(
        "doc_id",
        "CAST(size(runs) AS BIGINT) AS n_runs",
        # The least of (-length, start, period) is the longest run; runs are sorted by start, then period.
        "array_min(transform(runs, r -> named_struct('least', -r.length, 'start', r.start, 'period', r.period))) AS best",
        "sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    ).selectExpr("doc_id", "n_runs", "best.start AS start", "-best.least AS length", "best.period AS period", "1000 * -best.least DIV best.period AS exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(table(spark, sf_dir, "documents"), planted))
