"""Secrets that the tables of documents hold, labelled by a rule of their own: none of the model's examples has it."""

import re

import pyarrow.parquet as pq

from signalforge.llm import secrets

PLANTED = re.compile(r'(?i)token = "([0-9a-f]{40})"')


def test_planted_secrets_are_found_and_nothing_else():
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column(0).to_pylist()
    model, right, missed, wrong = secrets.default_model(), 0, 0, 0
    for k in range(0, len(texts), 500):
        part = texts[k : k + 500]
        for text, found in zip(part, secrets.find(model, part)):
            planted = {m.span(1) for m in PLANTED.finditer(text or "")}
            got = {(a, z) for a, z, score in found if score >= secrets.ACCEPT}
            right, missed, wrong = right + len(planted & got), missed + len(planted - got), wrong + len(got - planted)
    assert right > 150 and right / (right + missed) > 0.98 and right / (right + wrong) > 0.98, (right, missed, wrong)


def test_names_blanks_and_users_of_any_length():
    model = secrets.default_model()
    value = "8433386cf9a9b29519756edeba98a525620ae820"
    for text in (f"token_{'x' * 60} = {value}", f"api_key{' ' * 10}={' ' * 10}{value}", f"https://{'u' * 300}:{value}@host/db"):
        assert value not in secrets.redacted(text, secrets.find(model, [text])[0]), text[:40]


def test_scans_stay_linear():
    import time

    model = secrets.default_model()
    for text in ("password" * 40_000, "://" + "a" * 400_000, "token" + " " * 400_000, "-----BEGIN " * 30_000, "key-" * 60_000):
        began = time.time()
        secrets.find(model, [text])
        assert time.time() - began < 20, text[:20]
