"""Places of terms by one automaton, against all pairs of places; stored relations."""

import random
import shutil

import pyarrow.parquet as pq

from signalforge.functions.terms import nearest, term_places
from signalforge.operators.relations import SIGNALS
from signalforge.plans import store


def pairs(text, word, terms):
    def places(w):
        out, at = [], text.find(w)
        while at >= 0:
            out.append(at)
            at = text.find(w, at + len(w))
        return out

    found = [(max(0, p - r - len(word), r - p - len(t)), r, k, p) for r in places(word) for k, t in enumerate(terms) for p in places(t)]
    best = min(found, default=None)
    return best and (best[0], best[2])


def test_nearest_is_that_of_all_pairs():
    rng = random.Random(8)
    terms = ("hiring", "we are hiring", "looking for", "aa", "role:", "ring")
    for _ in range(2000):
        text = " ".join(rng.choice(["cat", "hiring", "we are hiring", "looking for", "aaa", "role:", "x" * rng.randrange(30), "spring"]) for _ in range(rng.randrange(40)))
        assert nearest(text, "cat", terms) == pairs(text, "cat", terms)


def test_long_texts_do_not_compare_all_places():
    text = ("chief of staff " + "x " * 400) * 3000 + "hiring"
    assert nearest(text, "chief of staff", tuple(SIGNALS))[0] == 801


def test_terms_overlap_others_but_not_themselves():
    assert term_places("aaaa we're hiring", ("aa", "hiring", "we're hiring")) == [(0, 2, 0), (2, 4, 0), (5, 17, 2), (11, 17, 1)]
    assert nearest("", "x", ("a",)) is None and nearest("x", "", ("a",)) is None


def test_changed_inputs_are_computed_anew(spark, tmp_path):
    for t in ("orders", "customer", "nation"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path)
    count = lambda: store.relation(spark, str(tmp_path), "SELECT ingest_seq FROM gated WHERE reject_reason = ''", ("gated",)).count()
    before = count()
    made = len(store._paths)
    assert count() == before and len(store._paths) == made
    table = pq.read_table(tmp_path / "orders.parquet")
    pq.write_table(table.slice(0, 0), tmp_path / "orders.parquet", coerce_timestamps="us")
    assert count() == 0 < before
