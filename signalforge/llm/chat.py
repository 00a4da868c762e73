r"""Operator 5: budgeted chat windows.

A turn is formatted as <|im_start|>role\ntext<|im_end|>\n. Inside roles and texts every "<", any backslashes, "|" gets one
more backslash, so no control string can arise there, and taking one away restores it; roles also escape line ends.
A conversation is cut into windows of whole turns. Running sums of turn tokens decide where: a window holds the system
turn (if the conversation starts with one), then as many of the turns just before the window as fit `history` tokens, and
then new turns while the sum stays within `budget`. A turn that alone exceeds the budget has a window of its own, whole.
Only new assistant texts are targets: repeated history and the repeated system turn are outside the loss mask, so each
assistant text is a target exactly once.

Turns are sorted by (turn, role, text as it stands in the table) and streamed: memory holds one window, not a conversation.

Defined cases: null text or role: empty. Null turn: first. Null conv_id: one conversation of its own. Ties and repeated
rows: kept, in sorted order. Very long turns: whole, each a window of its own. Empty table: no windows. Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokenizer import load_ranks, worker_encoding

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY = 1024, 256
WINDOWS = "conv_id long, window_no long, text string, n_tokens long, n_repeated int, n_new int, loss_starts array<int>, loss_ends array<int>"


def escape(s: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", s)


def unescape(s: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", s)


def escape_role(s: str) -> str:
    return escape(s.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(s))


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The formatted turn and where its text starts."""
    head = f"{START}{escape_role(role)}\n"
    return f"{head}{escape(text)}{END}\n", len(head)


def parse_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of each turn of a formatted window."""
    out, at = [], 0
    while at < len(formatted):
        body = formatted.index("\n", at) + 1
        end = formatted.index(END, body)
        out.append((unescape_role(formatted[at + len(START) : body - 1]), unescape(formatted[body:end]), body, end))
        at = end + len(END) + 1
    return out


class _Windows:
    """Builds the windows of one conversation, turn by turn."""

    def __init__(self, conv, budget: int, history: int) -> None:
        self.conv, self.budget, self.history = conv, budget, history
        self.system: tuple[str, int, int, bool] | None = None
        self.repeated: list[tuple[str, int, int, bool]] = []
        self.new: list[tuple[str, int, int, bool]] = []
        self.sum = self.base = self.number = self.seen = 0

    def add(self, turn: tuple[str, int, int, bool], system: bool) -> dict | None:
        out = None
        if self.new and self.sum + turn[2] > self.budget:
            out = self.flush()
            past, self.repeated, used = out.pop("past"), [], 0
            for t in reversed(past):
                if t is self.system or used + t[2] > self.history or self.base + used + t[2] + turn[2] > self.budget:
                    break
                used += t[2]
                self.repeated.insert(0, t)
            if self.system is not None:
                self.repeated.insert(0, self.system)
            self.sum = self.base + used
        if not self.seen and system:
            self.system, self.base = turn, turn[2]
        self.seen += 1
        self.new.append(turn)
        self.sum += turn[2]
        return out

    def flush(self) -> dict:
        parts, starts, ends, at = [], [], [], 0
        for i, (s, head, _, target) in enumerate([*self.repeated, *self.new]):
            if target and i >= len(self.repeated):
                starts.append(at + head)
                ends.append(at + len(s) - len(END) - 1)
            parts.append(s)
            at += len(s)
        out = {"conv_id": self.conv, "window_no": self.number, "text": "".join(parts), "n_tokens": sum(t[2] for t in [*self.repeated, *self.new]), "n_repeated": len(self.repeated), "n_new": len(self.new), "loss_starts": starts, "loss_ends": ends, "past": self.new}
        self.number, self.new = self.number + 1, []
        return out


def chat_windows(turns: DataFrame, ranks: bytes, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Format turns (conv_id, turn, role, text) into windows; the rows of a conversation are adjacent and in order."""
    shared = turns.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary file of fixed size

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = worker_encoding(shared)
        for b in batches:
            roles, texts = ([x or "" for x in b.column(c).to_pylist()] for c in ("role", "text"))
            done = [format_turn(r, t) for r, t in zip(roles, texts)]
            raw = [t if "<" in t and len(s) != h + len(t) + len(END) + 1 else None for t, (s, h) in zip(texts, done)]  # texts with escapes
            n = [len(x) for x in encoding.encode_ordinary_batch([s for s, _ in done], num_threads=1)]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), pa.array(roles, pa.string()), pa.array([s for s, _ in done], pa.string()), pa.array([h for _, h in done], pa.int32()), pa.array(n, pa.int64()), pa.array(raw, pa.string())], ["conv_id", "turn", "role", "turn_text", "head", "n", "raw"])

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, out, size = None, [], 0
        columns = ["conv_id", "window_no", "text", "n_tokens", "n_repeated", "n_new", "loss_starts", "loss_ends"]
        frame = lambda rows: pd.DataFrame([[r[c] for c in columns] for r in rows], columns=columns).astype({"conv_id": "Int64"})
        for b in batches:
            convs = [None if pd.isna(c) else int(c) for c in b["conv_id"]]
            for conv, role, s, head, n in zip(convs, b["role"], b["turn_text"], b["head"], b["n"]):
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(now.flush())
                    now = _Windows(conv, budget, history)
                if (w := now.add((s, int(head), int(n), role == "assistant"), role == "system")) is not None:
                    out.append(w)
                    size += len(w["text"])
                if size > 4 << 20 or len(out) > 2000:
                    yield frame(out)
                    out, size = [], 0
        if now is not None:
            out.append(now.flush())
        if out:
            yield frame(out)

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = rows.mapInArrow(formatted, "conv_id long, turn long, role string, turn_text string, head int, n long, raw string")
    text = F.coalesce("raw", F.col("turn_text").substr(F.col("head") + 1, F.length("turn_text") - F.col("head") - len(END) - 1))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", text)
    return ordered.select("conv_id", "role", "turn_text", "head", "n").mapInPandas(windows, WINDOWS)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: the turns' digest, and that of the text under the loss mask."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        conv, state, out = object(), None, []
        close = lambda: out.append([conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]])
        for b in batches:
            for c, text, repeated, starts, ends in zip(b["conv_id"], b["text"], b["n_repeated"], b["loss_starts"], b["loss_ends"]):
                c = None if pd.isna(c) else int(c)
                if state is None or c != conv:
                    if state is not None:
                        close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body, _, _ in parse_turns(text)[int(repeated) :]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                for a, z in zip(starts, ends):
                    target = unescape(text[a:z])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(text)
            if len(out) > 5000:
                yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})
                out = []
        if state is not None:
            close()
        if out:
            yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})

    return windows.mapInPandas(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.sql("SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, :said AS text UNION ALL SELECT -1L, 1L, 'assistant', :said", {"said": said})
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(chat_windows(turns, load_ranks()))
