"""The corpus pipeline, stage by stage, on small tables with nulls, ties, repeats, long texts and clashing columns."""

import collections
import random

import pytest

import corpus_pipeline
from signalforge.llm import contamination, language

DOCS = "doc_id long, text string, lang string, source string, size string, key string"
SF = "/root/testdata/sf0.001"


def _words(rng, n, size=3000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    base = [" ".join(_words(rng, 80)) for _ in range(6)]
    near = base[0].split()
    near[3] = "changed"
    rows = [(i, t, "en", f"s{i % 2}", "a", "b") for i, t in enumerate(base)]
    rows += [(10, base[0], "en", "s0", "a", "b"), (11, " ".join(near), "en", "s1", "a", "b"), (None, base[1], "en", "s0", "a", "b"), (None, base[1], "en", "s0", "a", "b"), (None, base[5] + " tail", "en", None, None, None)]
    rows += [(20, base[2], "en", "s0", "a", "b"), (20, " ".join(_words(rng, 60)), "en", "s0", "a", "b"), (21, None, None, None, None, None), (22, "", "en", "s0", "a", "b"), (22, "", "en", "s0", "a", "b"), (23, " ".join(_words(rng, 40_000, 10**6)), "en", "s1", "a", "b"), (24, "only here once now", "en", "s1", "a", "b"), (24, "only here once now", "en", "s1", "a", "b")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def _rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_near_duplicates_keep_one_row_of_each_group(spark, docs):
    got = corpus_pipeline.near_duplicate(spark, docs, SF)
    assert got.columns == docs.columns

    def sh(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset({tuple(w)} - {()})

    rows = [tuple(r) for r in docs.collect()]
    sets, group = [sh(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    kept = _rows(got)
    for g in set(group):
        members = [r for r, k in zip(rows, group) if k == g]
        left = [r for r in set(members) for _ in range(kept[r])]
        if not sh(members[0][1]):
            assert len(left) == sum(kept[r] for r in set(members)) and kept[members[0]] == rows.count(members[0])
        else:
            ids = [r[0] for r in members if r[0] is not None]
            assert len(left) == 1 and left[0][0] == (min(ids) if ids else None), members


def test_decontamination_judges_rows_by_their_texts(spark, docs):
    bad = "the quick brown fox jumps over the lazy dog and runs away"
    extra = spark.createDataFrame([(None, f"a b c {bad} d", "en", "s0", "x", "y"), (0, bad, "en", "s0", "x", "y"), (5, "clean", "en", "s0", "x", "y")], DOCS)
    items = spark.createDataFrame([(1, bad), (2, None), (3, "")], "item_id long, text string")
    for most in (2_000_000, 1):
        got = contamination.uncontaminated(docs.unionByName(extra), items, most)
        assert _rows(got) == _rows(docs) + _rows(extra.filter("text = 'clean'"))


def test_language_stage(spark, docs):
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = language.load_pieces()
    model = language.learn(known, pieces)
    odd = spark.createDataFrame([(None, known.filter("lang = 'en' AND n_chars > 500").first()["text"], "en", "s", "a", "b"), (1, None, None, None, None, None), (2, "12 34", None, None, None, None), (3, "́ ̀", None, None, None, None)], DOCS)
    found = language.identified(odd, model, pieces)
    assert found.columns[:-2] == odd.columns
    assert [(r["doc_id"], r[language.LANG]) for r in found.collect()] == [(None, "en"), (1, "und"), (2, "und"), (3, "und")]


def test_secrets_and_mix_keep_columns_and_rows(spark, docs):
    hidden = corpus_pipeline.hide_secrets(spark, docs, SF)
    assert hidden.columns == docs.columns and hidden.count() == docs.count()
    mixed = corpus_pipeline.mix(spark, hidden, SF)
    assert {"doc_id", "text", "document_size", "key", "pass_no", "words", "position"} <= set(mixed.columns)
    total = sum(len((r["text"] or "").split()) for r in hidden.collect())
    assert abs(sum(r["words"] for r in mixed.collect()) - total) <= 4


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, none, SF)
        assert got.columns == docs.columns and got.count() == 0
    assert corpus_pipeline.mix(spark, none, SF).count() == 0


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in docs.collect()}
    rows = out.collect()
    assert rows and {r["doc_id"] for r in rows} <= ids
    items = {r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert not any(t and len(t.split()) >= 5 and t in (r["text"] or "") for r in rows for t in items)
