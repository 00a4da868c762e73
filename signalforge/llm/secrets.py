"""Operator 4: secret scan with a random forest that removes false positives.

Candidates: runs of 16 or more key characters, values assigned to a secret's name (which may be part of a longer name),
passwords in addresses, and private key blocks. For each the
forest sees its length, entropy, character classes and transitions, how far dictionary pieces cover it, whether it lies in
a path or address, and the neighbouring words. Candidates that the forest takes for secrets are replaced by a mark.

The forest is trained here from labelled findings (before, candidate, after, label); `example_findings` makes such a table
by rule from a seed, `train` takes any. Training sees at most `max_findings` of them (a bound of the fitting sample).
Whole texts are scanned, and a candidate has no greatest length: possessive repeats keep the scan linear.

Defined cases: null text stays null, without findings. Empty text: none. Equal or overlapping candidates: the first, then
the longest. Repeated rows: each row for itself. All columns but text are passed on as they are. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, table
from .language import load_pieces

MARK = "[SECRET]"
MAX_FINDINGS, TREES, DEPTH, LEAST_LEAF, ACCEPT = 20_000, 40, 9, 4, 0.5
#: Words that name secrets, and words that name other machine strings.
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api-key", "access_key", "accesskey", "private_key", "credential", "credentials", "auth", "authorization", "bearer", "client_secret", "key")
OTHER_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "hash", "digest", "revision", "uuid", "guid", "id", "etag", "build", "version", "example", "sample", "http", "https", "www", "file", "path", "isbn")
#: Beginnings of well-known key formats.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "rk_live_", "sk-", "AIza", "eyJ", "npm_", "hf_")
CANDIDATE = re.compile(
    r"-----BEGIN [A-Z ]*?PRIVATE KEY-----[A-Za-z0-9+/=\s]*+-----END [A-Z ]*?PRIVATE KEY-----"
    r"|://[^\s:/@\"'<>]*+:(?P<cred>[^\s:/@\"'<>]{6,}+)@"
    r"|(?i:(?<![a-z0-9_-])(?=[a-z0-9_-]*?(?:password|passwd|pwd|secret|api_?key|access_?key|private_?key|token))[a-z0-9_-]++[\"']?\s*+[:=]\s*+[\"']?)(?P<value>(?!-----BEGIN [A-Z ]*?PRIVATE KEY-----)[^\s\"'<>]{8,}+)"
    r"|(?P<run>[A-Za-z0-9+/_=-]{16,})"
)
AROUND = 48


@dataclass
class Lexicon:
    """Character transitions and dictionary pieces, from a public vocabulary."""

    pieces: frozenset
    transitions: np.ndarray

    @classmethod
    def of(cls, pieces: Sequence[str]) -> Lexicon:
        plain = [p.replace("▁", "") for p in pieces]
        counts = np.ones((128, 128))
        for p in plain:
            codes = [min(ord(c), 127) for c in p]
            for a, b in zip(codes, codes[1:]):
                counts[a, b] += 1
        return cls(frozenset(p for p in plain if len(p) >= 4 and p.isalpha()), np.log(counts / counts.sum(axis=1, keepdims=True)))

    def covered(self, s: str) -> float:
        """The share of s that pieces of four letters or more cover, longest first from the left."""
        s, i, n = s.lower(), 0, 0
        while i < len(s):
            for k in range(min(12, len(s) - i), 3, -1):
                if s[i : i + k] in self.pieces:
                    n += k
                    i += k
                    break
            else:
                i += 1
        return n / max(1, len(s))


def features(lexicon: Lexicon, before: str, value: str, after: str) -> list[float]:
    n = len(value)
    counts = np.bincount(np.frombuffer(value.encode("utf-32-le"), "uint32") % 128, minlength=128)
    p = counts[counts > 0] / n
    codes = [min(ord(c), 127) for c in value.lower()]
    steps = [lexicon.transitions[a, b] for a, b in zip(codes, codes[1:])]
    classes = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]
    near = re.split(r"[^a-z0-9_-]+", before.lower())[-4:]
    close = "".join(before.split())[-4:]
    share = lambda k: classes.count(k) / n
    return [
        min(n, 400),
        float(-(p * np.log2(p)).sum()),
        share(0), share(1), share(2), share(3),
        sum(c in "0123456789abcdefABCDEF" for c in value) / n,
        sum(a != b for a, b in zip(classes, classes[1:])) / n,
        float(np.mean(steps)) if steps else 0.0,
        lexicon.covered(value),
        float(value.count("/") + value.count("_") + value.count("-")) / n,
        float(any(before.endswith(x) for x in ("/", "\\", ".", "@")) or "://" in before[-AROUND:].split(" ")[-1] or after[:1] in ("/", "@")),
        float(any(w.strip("_-") in SECRET_WORDS for w in near)),
        float(any(w.strip("_-") in OTHER_WORDS for w in near)),
        float(close.endswith(("=", ":", '="', ':"', "='", ":'"))),
        float(value.startswith(PREFIXES)),
        len(set(value)) / n,
    ]


class Forest:
    """A random forest of binary trees: bootstrap rows, a random third of the features at a node, Gini splits."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]) -> None:
        self.trees = trees

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> Forest:
        rng, out = np.random.default_rng(seed), []
        for _ in range(trees):
            rows = rng.integers(0, len(x), len(x))
            nodes: list[list[float]] = []
            cls._grow(x[rows], y[rows], depth, rng, nodes)
            t = np.array(nodes)
            out.append((t[:, 0].astype(int), t[:, 1], t[:, 2].astype(int), t[:, 3].astype(int), t[:, 4]))
        return cls(out)

    @classmethod
    def _grow(cls, x, y, depth, rng, nodes) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, me, me, float(y.mean())])
        if depth and len(y) >= 2 * LEAST_LEAF and 0 < y.mean() < 1:
            best = (y.mean() * (1 - y.mean()) - 1e-9, None, None)
            for f in rng.choice(x.shape[1], max(2, x.shape[1] // 3), replace=False):
                for cut in np.unique(np.quantile(x[:, f], np.linspace(0.04, 0.96, 24))):
                    left = x[:, f] <= cut
                    n = left.sum()
                    if LEAST_LEAF <= n <= len(y) - LEAST_LEAF:
                        a, b = y[left].mean(), y[~left].mean()
                        if (g := (n * a * (1 - a) + (len(y) - n) * b * (1 - b)) / len(y)) < best[0]:
                            best = (g, f, cut)
            if best[1] is not None:
                left = x[:, best[1]] <= best[2]
                nodes[me][:2] = [best[1], best[2]]
                nodes[me][2] = cls._grow(x[left], y[left], depth - 1, rng, nodes)
                nodes[me][3] = cls._grow(x[~left], y[~left], depth - 1, rng, nodes)
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH + 1):
                f = feature[at]
                go = x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at]
                at = np.where(f < 0, at, np.where(go, left[at], right[at]))
            out += value[at]
        return out / max(1, len(self.trees))


def example_findings(n: int = 4000, seed: int = 11, pieces: Sequence[str] = ()) -> list[tuple[str, str, str, int]]:
    """Labelled findings made by rule: (before, candidate, after, 1 for a secret)."""
    rng = np.random.default_rng(seed)
    words = [p.replace("▁", "") for p in pieces if p.replace("▁", "").isalpha() and len(p) > 2] or ["alpha", "river", "stone", "window", "paper", "light"]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chars = lambda alphabet, k: "".join(pick(alphabet) for _ in range(k))
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    hexes, mixed = digits + "abcdef", lower + lower.upper() + digits
    text = lambda k: " ".join(pick(words) for _ in range(k))
    names = ("token", "secret", "api_key", "apikey", "access_key", "client_secret", "auth_token", "password", "private_key", "TOKEN", "SECRET_KEY")
    out = []
    for i in range(n):
        before, after = text(int(rng.integers(0, 5))), text(int(rng.integers(0, 5)))
        if i % 2:
            value = pick([chars(hexes, 40), chars(hexes, 32), chars(hexes.upper(), 40), chars(mixed, int(rng.integers(20, 64))), chars(mixed + "+/", 40), pick(PREFIXES[:12]) + chars(mixed, int(rng.integers(20, 40))), chars(mixed + "_-", 24)])
            kind = int(rng.integers(5))
            name = pick(names)
            head = f'{name} = "' if kind < 2 else f"{name}: " if kind == 2 else f"{name}=" if kind == 3 else pick(["Authorization: Bearer ", "export API_KEY="])
            if value.startswith(PREFIXES) and rng.random() < 0.3:
                head = ""
            if i % 5 == 0:  # passwords that people choose, named or in an address
                value = pick([pick(words) + chars(digits, int(rng.integers(1, 5))) + pick(words), pick(words).capitalize() + chars(mixed, 4) + chars("!#$%", 1), chars(mixed, int(rng.integers(8, 16)))])
                if len(value) < 8:
                    value += chars(digits, 8 - len(value))
                if i % 10 == 5:
                    out.append((f"{before} {pick(['postgres', 'https', 'redis', 'mysql', 'ftp'])}://{pick(words)}:", value, f"@{pick(words)}/{after}", 1))
                    continue
                head = pick(["password: ", "password=", "passwd = ", 'pwd: "', "my password: ", "DB_PASSWORD="])
            out.append((f"{before} {head}", value, ('" ' if head.endswith('"') else " ") + after, 1))
        else:
            k = int(rng.integers(8))
            head, tail = " ", " "
            if k == 0:
                value, head = chars(hexes, 40), pick([" commit ", " revision ", " sha1: ", " sha: "])
            elif k == 1:
                value, head = chars(hexes, int(pick([32, 64]))), pick([" md5: ", " checksum ", " sha256 ", " etag: ", " digest="])
            elif k == 2:
                value = "-".join(chars(hexes, m) for m in (8, 4, 4, 4, 12))
                head = pick([" id ", " uuid: ", " "])
            elif k == 3:
                value = (pick(words) + pick(words) + pick(words) + pick(words) + pick(words) + "abcdefghijkl")[: int(rng.integers(16, 36))]
            elif k == 4:
                value = pick(["/", "_", "-"]).join(pick(words) for _ in range(5)) + "-page"
                head = pick([" ", " https://", " www."])
            elif k == 5:
                value = chars(digits, int(rng.integers(16, 20)))
            elif k == 6:
                value, head = pick(["your_api_key_here_please", "x" * 24, "changeme-changeme", "example_token_example", "A" * 20, "0" * 32, "insert-your-token-here", "changeme", "yourpassword", "password", "required", "forgotten", "=" * 20, "-" * 30, "_" * 18]), pick([" token = ", " api_key: ", " password: ", " "])
            else:
                value = "".join(pick(words).capitalize() for _ in range(6))[:60] + "Factory"
            out.append((before + head, value, tail + after, 0))
    return out


def train(findings: Sequence[tuple[str, str, str, int]], lexicon: Lexicon, max_findings: int = MAX_FINDINGS) -> Forest:
    chosen = sorted(findings, key=lambda f: hashlib.md5(repr(f).encode()).digest())[:max_findings]  # a bound of the fitting sample
    return Forest.fit(np.array([features(lexicon, b, v, a) for b, v, a, _ in chosen]), np.array([y for *_, y in chosen], float))


def find(model: tuple[Lexicon, Forest], texts: Sequence[str | None]) -> list[list[tuple[int, int, float]]]:
    """For each text its candidates as (start, end, the forest's score)."""
    lexicon, forest = model
    rows, spans = [], []
    for i, text in enumerate(texts):
        for m in CANDIDATE.finditer(text or ""):
            name = m.lastgroup
            a, z = m.span(name) if name else m.span()
            rows.append(features(lexicon, text[max(0, a - AROUND) : a], text[a:z], text[z : z + AROUND]))
            spans.append((i, a, z, name is None))
    out: list[list[tuple[int, int, float]]] = [[] for _ in texts]
    if rows:
        for (i, a, z, block), score in zip(spans, forest.predict(np.array(rows))):
            out[i].append((a, z, 1.0 if block else float(score)))
    return out


def redacted(text: str, found: list[tuple[int, int, float]], accept: float = ACCEPT) -> str:
    parts, at = [], 0
    for a, z, score in found:
        if score >= accept:
            parts += [text[at:a], MARK]
            at = z
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, model: tuple[Lexicon, Forest], accept: float = ACCEPT, findings: bool = False) -> DataFrame:
    """docs with secrets in `text` replaced; with findings=True a column `_findings` array<struct<start, end, score>> follows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary and the number of trees
    at = docs.columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes=8 << 20):
                texts = part.column(at).to_pylist()
                found = find(shared.value, texts)
                clean = pa.array([None if t is None else redacted(t, f, accept) if f else t for t, f in zip(texts, found)], pa.string())
                columns = [clean if i == at else c for i, c in enumerate(part.columns)]
                names = list(part.schema.names)
                if findings:
                    columns.append(pa.array([[{"start": a, "end": z, "score": s} for a, z, s in f] for f in found], kind))
                    names.append("_findings")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = docs.schema
    if findings:
        one = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
        schema = T.StructType([*schema.fields, T.StructField("_findings", T.ArrayType(one))])
    return docs.mapInArrow(run, schema)


def default_model() -> tuple[Lexicon, Forest]:
    pieces = load_pieces()
    lexicon = Lexicon.of(pieces)
    return lexicon, train(example_findings(pieces=pieces), lexicon)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = redact(docs, default_model(), findings=True)
    hit = F.filter("_findings", lambda f: f["score"] >= ACCEPT)
    return out.select("doc_id", F.size("_findings").cast("long").alias("n_candidates"), F.size(hit).cast("long").alias("n_secrets"), F.concat_ws(",", F.transform(hit, lambda f: F.concat(f["start"], F.lit("-"), f["end"]))).alias("secret_spans"), F.length("text").cast("long").alias("clean_chars"), F.sha2("text", 256).alias("clean_sha256"))
