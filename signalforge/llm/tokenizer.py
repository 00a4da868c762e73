"""Public vocabularies: read on the driver, sent to the workers as bytes, built once in each worker."""

from __future__ import annotations

import base64
import os

import numpy as np

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-tokenisation pattern of the byte-level vocabulary (public).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_built: dict = {}


def load_ranks(folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken") -> bytes:
    with open(os.path.join(folder, name), "rb") as f:
        return f.read()


def build_encoding(data: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_lengths(data: bytes) -> np.ndarray:
    """The number of bytes of each token id."""
    pairs = [(int(b), len(base64.b64decode(a))) for a, b in map(bytes.split, data.splitlines()) if a]
    out = np.zeros(max(i for i, _ in pairs) + 1, "int64")
    for i, n in pairs:
        out[i] = n
    return out


def worker_encoding(shared):
    if (key := ("encoding", hash(shared.value))) not in _built:
        _built[key] = build_encoding(shared.value)
    return _built[key]


def worker_lengths(shared) -> np.ndarray:
    if (key := ("lengths", hash(shared.value))) not in _built:
        _built[key] = token_lengths(shared.value)
    return _built[key]
