"""Operator 8: language identification by unigram pieces, summed over all segmentations.

The pieces of a fixed public vocabulary (lower-cased) get a probability per language. A word's probability in a language
is the sum, over every way to cut it into pieces, of the product of the pieces' probabilities; a forward pass computes it.
A text's score is the sum of its words' logarithms and the logarithm of the language's share; all words of the whole text
count. Letters and the marks on them are scored: everything else separates words, and a word needs a letter.

Learning: expectation maximisation (forward and backward passes over all segmentations) on about `docs_per_lang` documents
a language, drawn by hash from the rows that may be learned from: the bound of the fitting sample. All words of these
documents count. The words are counted in one scan for all languages; a round is a Spark job over the counted words, of
which the driver gets one sum for each piece and language. Prediction has no bounds.

A word of any length is scored whole: short ones together in a lattice of bounded size, each over LONGEST letters for itself
in logarithms. A letter that is no piece has probability 1e-7 in every language.

Defined cases: null text, or no letter (marks alone are none): lang_pred "und", score 0. Null doc_id: not held out, never
learned from. Null lang: not learned from. No row to learn from: every text is "und". Ties between languages: the lesser
name. Repeated rows: each predicted alike, whatever lies beside it. Very long texts and words: whole. Extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, slices, table, text_array, words
from .tokenizer import TOKENIZERS

DOCS_PER_LANG, ROUNDS = 600, 4
#: Words up to LONGEST letters share lattices of about LETTERS letters; both only bound memory.
LONGEST, LETTERS, UNKNOWN = 63, 150_000, 1e-7
_MARK = 0x2581  # stands before each word, as in the vocabulary
_BASE = np.uint64(0x100000001B3)


def load_pieces(folder: str = TOKENIZERS, name: str = "piece_bpe_32k.model") -> list[str]:
    """The vocabulary's pieces in lower case, without control and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, name))
    return sorted({sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))})


def letters(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_lower(text_array(texts)), r"[^\pL\pM]+", " ")


class Lattice:
    """All segmentations of a list of words: edges (start, end, piece), grouped so that an end occurs once in a group."""

    def __init__(self, vocabulary: Vocabulary, parts: list[str]) -> None:
        length = np.fromiter(map(len, parts), "int64", len(parts)) + 1
        codes = np.frombuffer("".join("▁" + p for p in parts).encode("utf-32-le"), "uint32").astype("uint64")
        self.start = np.r_[0, np.cumsum(length)].astype("int64")[:-1]
        self.length, n = length, len(codes)
        where = np.arange(n) - np.repeat(self.start, length)  # place within its part
        left = np.repeat(length, length) - where
        self.node = self.start + np.arange(len(parts))  # node of boundary 0; a part of length m has m + 1 nodes
        first = np.arange(n) + np.repeat(np.arange(len(parts)), length)
        self.nodes = n + len(parts)
        h, self.groups = np.zeros(n, "uint64"), {}
        at = np.arange(n)
        for size in range(1, vocabulary.longest + 1):
            at = at[left[at] >= size]
            if not len(at):
                break
            h[at] = h[at] * _BASE + codes[at + size - 1] + np.uint64(1)
            piece = vocabulary.find(h[at], size)
            if size == 1:
                piece = np.where(piece < 0, len(vocabulary.pieces), piece)
            hit = piece >= 0
            a, p = at[hit], piece[hit]
            ends = where[a] + size
            order = np.argsort(ends, kind="stable")
            a, p, ends = a[order], p[order], ends[order]
            cuts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]]) if len(a) else []
            for x, y in zip(cuts, np.r_[cuts[1:], len(a)] if len(a) else []):
                self.groups[int(ends[x]), size] = (first[a[x:y]], first[a[x:y]] + size, p[x:y])
        self.order = sorted(self.groups)

    def forward(self, probs: np.ndarray) -> np.ndarray:
        alpha = np.zeros((self.nodes, probs.shape[1]))
        alpha[self.node] = 1
        for key in self.order:
            a, z, p = self.groups[key]
            alpha[z] += alpha[a] * probs[p]
        return alpha

    def log_probs(self, probs: np.ndarray) -> np.ndarray:
        """A row for each word: its log probability in each language."""
        return np.log(np.maximum(self.forward(probs)[self.node + self.length], 1e-300))

    def expected(self, probs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts under one language's probs (a column), for words that occur `counts` times."""
        alpha, beta = self.forward(probs), np.zeros((self.nodes, 1))
        beta[self.node + self.length] = 1
        for key in reversed(self.order):
            a, z, p = self.groups[key]
            beta[a] += beta[z] * probs[p]
        scale = np.zeros((self.nodes, 1))
        weight = counts / np.maximum(alpha[self.node + self.length, 0], 1e-300)
        scale[:, 0] = np.repeat(weight, self.length + 1)
        out = np.zeros(len(probs))
        for a, z, p in self.groups.values():
            np.add.at(out, p, (alpha[a] * beta[z] * scale[a] * probs[p])[:, 0])
        return out


class LongWord:
    """All segmentations of one word of any length, in logarithms."""

    def __init__(self, vocabulary: Vocabulary, word: str) -> None:
        codes = np.frombuffer(("▁" + word).encode("utf-32-le"), "uint32").astype("uint64")
        n = self.length = len(codes)
        h, starts, ends, pieces = np.zeros(n, "uint64"), [], [], []
        for size in range(1, min(n, vocabulary.longest) + 1):
            h = h[: n - size + 1] * _BASE + codes[size - 1 :] + np.uint64(1)
            piece = vocabulary.find(h, size)
            if size == 1:
                piece = np.where(piece < 0, len(vocabulary.pieces), piece)
            at = np.flatnonzero(piece >= 0)
            starts.append(at)
            ends.append(at + size)
            pieces.append(piece[at])
        self.start, self.end, self.piece = (np.concatenate(x) for x in (starts, ends, pieces))
        order = np.lexsort((self.start, self.end))
        self.start, self.end, self.piece = self.start[order], self.end[order], self.piece[order]

    def forward(self, logs: np.ndarray) -> np.ndarray:
        out = np.full((self.length + 1, logs.shape[1]), -np.inf)
        out[0] = 0
        edges = np.searchsorted(self.end, np.arange(self.length + 2))
        for end in range(1, self.length + 1):
            own = slice(edges[end], edges[end + 1])
            out[end] = np.logaddexp.reduce(out[self.start[own]] + logs[self.piece[own]], axis=0)
        return out

    def log_probs(self, probs: np.ndarray) -> np.ndarray:
        return self.forward(np.log(probs))[-1]

    def expected(self, probs: np.ndarray, count: float) -> np.ndarray:
        """Expected piece counts under one language's probs (a column)."""
        logs = np.log(probs)
        alpha, beta = self.forward(logs)[:, 0], np.full(self.length + 1, -np.inf)
        beta[-1] = 0
        order = np.lexsort((self.end, self.start))
        start, end, piece = self.start[order], self.end[order], self.piece[order]
        edges = np.searchsorted(start, np.arange(self.length + 1))
        for at in range(self.length - 1, -1, -1):
            own = slice(edges[at], edges[at + 1])
            beta[at] = np.logaddexp.reduce(beta[end[own]] + logs[piece[own], 0])
        out = np.zeros(len(probs))
        np.add.at(out, piece, count * np.exp(alpha[start] + logs[piece, 0] + beta[end] - alpha[-1]))
        return out


def chunks(distinct: list[str]) -> Iterator[np.ndarray]:
    """The numbers of the words of up to LONGEST letters, in runs of about LETTERS letters."""
    sizes = np.fromiter(map(len, distinct), "int64", len(distinct))
    short = np.flatnonzero(sizes <= LONGEST)
    edges = np.flatnonzero(np.diff(np.cumsum(sizes[short] + 1) // LETTERS, prepend=-1)) if len(short) else []
    for a, b in zip(edges, [*edges[1:], len(short)]):
        yield short[a:b]


def word_logs(vocabulary: Vocabulary, probs: np.ndarray, distinct: list[str]) -> np.ndarray:
    """A row for each word: its log probability in each language."""
    out = np.zeros((len(distinct), probs.shape[1]))
    for own in chunks(distinct):
        out[own] = Lattice(vocabulary, [distinct[i] for i in own]).log_probs(probs)
    for i, w in enumerate(distinct):
        if len(w) > LONGEST:
            out[i] = LongWord(vocabulary, w).log_probs(probs)
    return out


def expected_pieces(vocabulary: Vocabulary, probs: np.ndarray, distinct: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected piece counts of the words under one language's probs (a column)."""
    out = np.zeros(len(probs))
    for own in chunks(distinct):
        out += Lattice(vocabulary, [distinct[i] for i in own]).expected(probs, counts[own])
    for i, w in enumerate(distinct):
        if len(w) > LONGEST:
            out += LongWord(vocabulary, w).expected(probs, counts[i])
    return out


class Vocabulary:
    def __init__(self, pieces: list[str]) -> None:
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        by: dict[int, list[tuple[int, int]]] = {}
        for i, p in enumerate(pieces):
            h = 0
            for c in p:
                h = (h * int(_BASE) + ord(c) + 1) % 2**64
            by.setdefault(len(p), []).append((h, i))
        self.tables = {}
        for size, pairs in by.items():
            bits = max(8, (len(pairs) * 8 - 1).bit_length())
            keys = np.array([h for h, _ in pairs], "uint64")
            slots, ids = np.zeros(1 << bits, "uint64"), np.full(1 << bits, -1, "int32")
            rest = []
            for h, (_, i) in zip(keys, pairs):
                s = self._slot(h, bits)
                if ids[s] < 0:
                    slots[s], ids[s] = h, i
                else:
                    rest.append((int(h), i))
            rest.sort()
            self.tables[size] = (bits, slots, ids, np.array([h for h, _ in rest], "uint64"), np.array([i for _, i in rest], "int32"))

    @staticmethod
    def _slot(h, bits: int):
        with np.errstate(over="ignore"):
            return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)

    def find(self, h: np.ndarray, size: int) -> np.ndarray:
        """The piece of this size with each hash, or -1."""
        if size not in self.tables:
            return np.full(len(h), -1, "int32")
        bits, slots, ids, rest, rest_ids = self.tables[size]
        s = self._slot(h, bits)
        out = np.where(slots[s] == h, ids[s], np.int32(-1))
        if len(rest):
            lost = np.flatnonzero((out < 0) & (ids[s] >= 0))
            k = np.minimum(np.searchsorted(rest, h[lost]), len(rest) - 1)
            out[lost] = np.where(rest[k] == h[lost], rest_ids[k], -1)
        return out


def worker_vocabulary(pieces: list[str]) -> Vocabulary:
    if "vocabulary" not in _cached or _cached["vocabulary"].pieces != pieces:
        _cached["vocabulary"] = Vocabulary(pieces)
    return _cached["vocabulary"]


_cached: dict = {}


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learnable() -> Column:
    return F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()


def lettered(distinct: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(distinct, r"\pL").to_numpy(zero_copy_only=False).astype(bool)


def counted_words(sample: DataFrame) -> DataFrame:
    """(lang, word, n) of all languages in one scan of sample (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                for part in slices(batch.filter(pa.array([x == lang for x in langs]))):
                    distinct, idx, _ = words(letters(part.column("text")), lower=False)
                    n, keep = np.bincount(idx, minlength=len(distinct)).astype("int64"), lettered(distinct)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * int(keep.sum()), pa.string()), distinct.filter(pa.array(keep)).cast(pa.string()), pa.array(n[keep])], ["lang", "word", "n"])

    return sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def one_round(counts: DataFrame, pieces: list[str], langs: list[str], probs: np.ndarray) -> np.ndarray:
    """Expected counts of pieces (a row a piece, a column a language) over all counted words."""
    shared = counts.sparkSession.sparkContext.broadcast((pieces, langs, probs))  # bounded by the vocabulary and the languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, langs, probs = shared.value
        vocabulary, sums = worker_vocabulary(pieces), np.zeros(probs.shape)
        for batch in batches:
            own, strings = np.array(batch.column("lang").to_pylist()), batch.column("word").to_pylist()
            n = batch.column("n").to_numpy(zero_copy_only=False).astype("float64")
            for k, lang in enumerate(langs):
                at = np.flatnonzero(own == lang)
                if len(at):
                    sums[:, k] += expected_pieces(vocabulary, probs[:, k : k + 1], [strings[i] for i in at], n[at])
        piece, lang = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(piece.astype("int32")), pa.array(lang.astype("int32")), pa.array(sums[piece, lang])], ["piece", "lang", "n"])

    got = counts.mapInArrow(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
    shared.unpersist()
    out = np.zeros(probs.shape)
    out[got["piece"], got["lang"]] = got["n"]
    return out


def learn(docs: DataFrame, pieces: list[str], docs_per_lang: int = DOCS_PER_LANG, rounds: int = ROUNDS) -> dict:
    """The model from docs (doc_id, text, lang): languages in order, piece probabilities (a row a piece, the last one for
    unknown letters), log shares."""
    docs = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    known = docs.filter(learnable())
    rows = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    size = len(pieces)
    if not rows:
        return {"langs": [], "probs": np.zeros((size + 1, 0)), "prior": np.zeros(0)}
    rates = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, min(1.0, docs_per_lang / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    counts = cut(counted_words(known.filter(draw < F.element_at(rates, F.col("lang"))).select("lang", "text")))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    probs = np.full((size + 1, len(langs)), 1.0 / size)
    for _ in range(rounds if langs else 0):
        probs[size] = UNKNOWN
        # Rounded, so that the order in which tasks end cannot show in the model.
        got = np.round(one_round(counts, pieces, langs, probs)[:size], 6) + 0.01
        probs[:size] = got / got.sum(axis=0)
    probs[size] = UNKNOWN
    total = sum(rows[x] for x in langs)
    return {"langs": langs, "probs": probs, "prior": np.log([rows[x] / total for x in langs])}


def score_texts(vocabulary: Vocabulary, model: dict, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The predicted language and its posterior probability for each text, each by its own words alone."""
    distinct, idx, ends = words(letters(texts), lower=False)
    n, langs = len(ends) - 1, model["langs"]
    if not langs or not len(distinct):
        return ["und"] * n, np.zeros(n)
    good = lettered(distinct)
    if not good.all():  # a word of marks alone is none
        keep = good[idx]
        ends, idx = np.r_[0, np.cumsum(keep)][ends], (np.cumsum(good) - 1)[idx[keep]]
        distinct = distinct.filter(pa.array(good))
    logs = word_logs(vocabulary, model["probs"], distinct.to_pylist())
    full = np.flatnonzero(ends[1:] > ends[:-1])
    out, score = ["und"] * n, np.zeros(n)
    if len(full):
        got = np.column_stack([np.add.reduceat(logs[idx, k], ends[full]) for k in range(len(langs))]) + model["prior"]
        best = got.argmax(axis=1)
        score[full] = 1 / np.exp(got - got.max(axis=1, keepdims=True)).sum(axis=1)
        for i, b in zip(full, best):
            out[i] = langs[b]
    return out, score


LANG, SCORE = "_lang_pred_", "_score_"


def identified(docs: DataFrame, model: dict, pieces: list[str]) -> DataFrame:
    """docs (a column text, any others) with two columns more, LANG and SCORE."""
    shared = docs.sparkSession.sparkContext.broadcast((pieces, model))  # bounded by the vocabulary and the languages
    at, names = docs.columns.index("text"), [*(f"c{i}" for i in range(len(docs.columns))), LANG, SCORE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, model = shared.value
        vocabulary = worker_vocabulary(pieces)
        for batch in batches:
            for part in slices(batch, at):
                langs, scores = score_texts(vocabulary, model, part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names)

    plain = docs.toDF(*names[:-2])
    schema = T.StructType([*plain.schema.fields, T.StructField(LANG, T.StringType()), T.StructField(SCORE, T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*docs.columns, LANG, SCORE)


def identify(docs: DataFrame, model: dict, pieces: list[str]) -> DataFrame:
    """(doc_id, lang_pred, score) of docs (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return identified(rows, model, pieces).select("doc_id", F.col(LANG).alias("lang_pred"), F.col(SCORE).alias("score"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pieces = table(spark, sf_dir, "documents"), load_pieces()
    out = identify(docs, learn(docs, pieces), pieces)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
