"""Places of many terms in a text by one automaton: one pass a text however many terms there are, in Arrow batches."""

from __future__ import annotations

import bisect
import functools

import pyarrow as pa
from pyspark.sql import functions as F

#: (start, end, number in the list) of a term in a text.
Place = tuple[int, int, int]


@functools.lru_cache(maxsize=8)
def automaton(terms: tuple[str, ...]):
    """The automaton of a list of terms; of equal terms the first counts. Built once a worker."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        if term not in found:
            found.add_word(term, (k, len(term)))
    found.make_automaton()
    return found


def term_places(text: str, terms: tuple[str, ...]) -> list[Place]:
    """Where terms stand in a text, by start; no place of a term overlaps an earlier place of the same term."""
    ends: dict[int, int] = {}
    out = []
    for last, (k, size) in automaton(terms).iter(text):
        start = last + 1 - size
        if start >= ends.get(k, 0):
            ends[k] = last + 1
            out.append((start, last + 1, k))
    return sorted(out)


def word_starts(text: str, word: str) -> list[int]:
    out, at = [], text.find(word) if word else -1
    while at >= 0:
        out.append(at)
        at = text.find(word, at + len(word))
    return out


def nearest(text: str, word: str, terms: tuple[str, ...]) -> tuple[int, int] | None:
    """(gap, term number) of the least gap between any place of the word and any place of a term, None where one is missing.

    Ties: the earliest word, then the first term in list and place order. Once a gap is known, each further word looks
    only at the terms that stand nearer than that, so long texts do not compare all places with all.
    """
    starts = word_starts(text, word)
    places = term_places(text, terms) if starts else []
    if not places:
        return None
    longest, best = max(map(len, terms)), None
    for r in starts:
        end = r + len(word)
        lo, hi = 0, len(places)
        if best is not None:
            lo = bisect.bisect_left(places, (r - best[0] - longest,))
            hi = bisect.bisect_right(places, (end + best[0],))
        here = min(((max(0, s - end, r - e), k, s) for s, e, k in places[lo:hi]), default=None)
        if here is not None and (best is None or here[0] < best[0]):
            best = here
            if not best[0]:
                break
    return best[0], best[1]


def nearest_term(terms: list[str]):
    """A function of (text, word) columns: a struct (gap, term), null where the text lacks the word or every term, or either is null.

    Marked as not deterministic, so that Catalyst neither runs it twice nor copies what it reads into a filter on its result.
    """
    fixed = tuple(terms)

    @F.arrow_udf("gap long, term string")
    def run(texts: pa.Array, words: pa.Array) -> pa.Array:
        found = [nearest(t, w, fixed) if t and w else None for t, w in zip(texts.to_pylist(), words.to_pylist())]
        return pa.array([None if x is None else {"gap": x[0], "term": fixed[x[1]]} for x in found], pa.struct([("gap", pa.int64()), ("term", pa.string())]))

    return run.asNondeterministic()
