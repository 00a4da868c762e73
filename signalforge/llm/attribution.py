"""Operator 9: token counts by section, from one encoding of the whole document.

A document is encoded once by a byte-level vocabulary, whose tokens partition the document's UTF-8 bytes; running sums of
token lengths give each token its byte span. A section is a line with its line end. Token spans are joined to section
spans by position. Rule for a token that crosses a boundary: it counts wholly for the section that holds most of its
bytes, on a tie for the earliest of them.

A section's kind: blank (no word), else title (the first line with a word), table (starts with |), list (starts with -, *
or +, then a space), or body.

Defined cases: null or empty text: no tokens, no sections. Very long lines or texts: whole, in one encoding. Null or
repeated doc_id: every row counts for itself. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table
from .tokenizer import load_ranks, worker_encoding, worker_lengths

KINDS = ("title", "body", "table", "list", "blank")
SCHEMA = "doc_id long, n_bytes long, n_tokens long, n_crossing long, sections array<struct<kind: string, start: long, end: long, n_tokens: long>>"


def section_kinds(lines: list[bytes]) -> np.ndarray:
    """The index in KINDS of each line."""
    out, titled = np.empty(len(lines), "int8"), False
    for i, line in enumerate(lines):
        s = line.lstrip()
        if not s:
            out[i] = 4
        elif not titled:
            out[i], titled = 0, True
        elif s[:1] == b"|":
            out[i] = 2
        elif s[:2] in (b"- ", b"* ", b"+ "):
            out[i] = 3
        else:
            out[i] = 1
    return out


def allocate(token_ends: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens for each section, and how many tokens crossed a boundary. Both arrays are rising and end at the same byte."""
    starts = np.r_[0, token_ends[:-1]]
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    crossing = np.flatnonzero(first != last)
    for i in crossing:
        a, z = int(first[i]), int(last[i])
        edges = np.r_[starts[i], section_ends[a:z], token_ends[i]]
        first[i] = a + int(np.argmax(np.diff(edges)))
    return np.bincount(first, minlength=len(section_ends)), len(crossing)


def attribute(docs: DataFrame, ranks: bytes) -> DataFrame:
    """One row for each row of docs (doc_id, text), with its sections as an array."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = worker_encoding(shared), worker_lengths(shared)
        names = pa.array(KINDS)
        for batch in batches:
            for part in slices(batch):
                sums, kinds, bounds, counts, ends = [], [], [], [], [0]
                for text in part.column("text").to_pylist():
                    data = (text or "").encode()
                    lines = data.split(b"\n")
                    cuts = np.cumsum([len(x) + 1 for x in lines])
                    cuts[-1] -= 1
                    if len(cuts) > 1 and cuts[-1] == cuts[-2]:
                        cuts, lines = cuts[:-1], lines[:-1]
                    if data:
                        ids = encoding.encode_to_numpy(text, disallowed_special=())
                        got, crossed = allocate(np.cumsum(lengths[ids]), cuts)
                        kinds.append(section_kinds(lines))
                        bounds.append(np.c_[np.r_[0, cuts[:-1]], cuts])
                        counts.append(got)
                        sums.append((len(data), len(ids), crossed))
                        ends.append(ends[-1] + len(got))
                    else:
                        sums.append((0, 0, 0))
                        ends.append(ends[-1])
                flat = lambda xs, dtype, shape: np.concatenate(xs) if xs else np.zeros(shape, dtype)
                b = flat(bounds, "int64", (0, 2))
                rows = pa.StructArray.from_arrays([names.take(pa.array(flat(kinds, "int8", 0))), pa.array(b[:, 0], pa.int64()), pa.array(b[:, 1], pa.int64()), pa.array(flat(counts, "int64", 0), pa.int64())], ["kind", "start", "end", "n_tokens"])
                s = np.array(sums, "int64").reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(s[:, i]) for i in range(3)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)], ["doc_id", "n_bytes", "n_tokens", "n_crossing", "sections"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def section_rows(attributed: DataFrame) -> DataFrame:
    """The long form: one row for each section."""
    return attributed.select("doc_id", F.posexplode("sections").alias("section_no", "s")).select("doc_id", "section_no", "s.*")


def op9_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attribute(table(spark, sf_dir, "documents"), load_ranks())

    def total(kind: str):
        return F.aggregate("sections", F.lit(0).cast("long"), lambda acc, s: acc + F.when(s["kind"] == kind, s["n_tokens"]).otherwise(0)).alias(f"{kind}_tokens")

    return rows.select("doc_id", "n_bytes", "n_tokens", F.size("sections").cast("long").alias("n_sections"), "n_crossing", *[total(k) for k in KINDS])
