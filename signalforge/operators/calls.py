"""Calls to outside services over rows: one set of clients a task, bounded retries, an ordered chain of providers, typed results.

A provider has a name and complete_json(system, user), which gives a dict or raises. `complete` asks the providers of a chain
in order. Each gets ATTEMPTS tries; only a failure of availability moves on to the next provider. A refused key ends the row
at once, since a wrong setting must show; a broken answer ends it after its tries, since another opinion is no repair. An
answer of any kind ends it too: there is no vote. Every row comes back with a status, so none is lost.

Calls are made once: `called` writes the results to the shared folder and reads them from there, so no later plan calls
again. A task that is lost repeats its own rows' calls; with `known`, results of earlier runs that were final are kept and
only the other rows are called, so a run that was cut off is taken up where it ended.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalforge.functions.dialect import Checker
from signalforge.operators.relations import assemble
from signalforge.plans.store import relation
from signalforge.sources.shared import shared_folder

ATTEMPTS = 2
#: Kinds of failure, in the order in which their marks are looked for in a message.
KINDS = [
    ("AUTH_FAILURE", ["401", "403", "unauthorized", "forbidden", "invalid api key", "api key not valid", "api_key_invalid", "api key is invalid", "api key expired", "invalid gemini key", "permission denied", "authentication failed", "authentication error"]),
    ("RATE_LIMITED", ["429", "rate limit", "rate-limit", "rate_limited", "too many requests", "quota exceeded", "quota-exceeded", "resource exhausted"]),
    ("DNS_FAILURE", ["getaddrinfo", "dns", "name or service not known", "temporary failure in name resolution", "nodename nor servname", "no such host", "name resolution", "errno 11001"]),
    ("TIMEOUT", ["timeout", "timed out", "deadline exceeded", "readtimeout", "connecttimeout", "writetimeout", "pooltimeout"]),
    ("TLS_FAILURE", ["tls", " ssl", "ssl ", "certificate", "handshake", "verify failed", "cert verify", "cert_validate"]),
]
#: Failures after which the chain ends.
ENDS = ("AUTH_FAILURE", "MALFORMED_RESPONSE")


class Provider(Protocol):
    name: str

    def complete_json(self, system: str, user: str) -> dict[str, Any]: ...


class Malformed(Exception):
    """An answer that is no object, or lacks what the caller needs."""


def kind_of(error: BaseException | str) -> str:
    """The kind of a failure, by its message."""
    if isinstance(error, Malformed):
        return "MALFORMED_RESPONSE"
    said = " ".join(str(error or "").split()).lower()
    about_key = "api key" in said and any(m in said for m in ("invalid", "not valid", "expired", "missing", "required"))
    for kind, marks in KINDS:
        if any(m in said for m in marks) or (kind == "AUTH_FAILURE" and about_key):
            return kind
    return "PROVIDER_ERROR"


def ask(chain: list[Provider], system: str, user: str, check: Callable[[dict], None] | None = None, attempts: int = ATTEMPTS) -> dict[str, Any]:
    """One row through a chain: status, provider, kind, error, calls and the answer."""
    out: dict[str, Any] = {"status": "NOT_RUN", "provider": "", "kind": "", "error": "", "calls": 0, "answer": None}
    for provider in chain:
        out["provider"] = provider.name
        for _ in range(attempts):
            out["calls"] += 1
            try:
                answer = provider.complete_json(system, user)
                if not isinstance(answer, dict):
                    raise Malformed("not an object")
                if check is not None:
                    check(answer)
                return out | {"status": "SUCCESS", "kind": "", "error": "", "answer": json.dumps(answer, ensure_ascii=False)}
            except Exception as error:  # noqa: BLE001 - whatever a client raises is this row's failure, not the task's
                out |= {"status": "UNAVAILABLE", "kind": kind_of(error), "error": " ".join(str(error).split())[:300]}
                if out["kind"] == "AUTH_FAILURE":
                    break
        if out["kind"] in ENDS:
            break
    return out


class KeyRing:
    """A provider with several keys: one pass over them, to the next one where a key is throttled or refused."""

    def __init__(self, name: str, keys: list[str], call: Callable[[str, str, str], dict]) -> None:
        self.name, self.call = name, call
        self.keys = list(dict.fromkeys(k.strip() for k in keys if k.strip()))

    def complete_json(self, system: str, user: str) -> dict[str, Any]:
        for left, key in zip(range(len(self.keys) - 1, -1, -1), self.keys):
            try:
                return self.call(key, system, user)
            except Exception as error:
                said = str(error)
                if not left or not ("429" in said or "rate limit" in said.lower() or "HTTP 401" in said or "HTTP 403" in said):
                    raise
        raise RuntimeError("no key is configured")


def retried(read: Callable[[], Any], attempts: int = 4, wait: float = 5, sleep: Callable[[float], None] = time.sleep) -> Any:
    """A read that is tried again after wait, 2 * wait, ... seconds. Appends are never given to this."""
    for k in range(1, attempts + 1):
        try:
            return read()
        except Exception:
            if k == attempts:
                raise
            sleep(wait * k)


RESULT = "status string, provider string, kind string, error string, calls long, answer string"
_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]


def complete(rows: DataFrame, key: str, prompt: str, chain: Callable[[], list[Provider]], system: str = "", check: Callable[[dict], None] | None = None, attempts: int = ATTEMPTS) -> DataFrame:
    """(key, RESULT) of each row; `chain` makes the providers, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        providers = chain()
        for b in batches:
            found = [ask(providers, system, text or "", check, attempts) for text in b.column(1).to_pylist()]
            columns = [pa.array([f[c.split()[0]] for f in found], t) for c, t in zip(RESULT.split(", "), _TYPES)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], [key, *(c.split()[0] for c in RESULT.split(", "))])

    return rows.select(key, prompt).mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, {RESULT}")


def called(rows: DataFrame, key: str, prompt: str, chain: Callable[[], list[Provider]], known: DataFrame | None = None, **how: Any) -> DataFrame:
    """complete(), stored; rows whose result in `known` was final (SUCCESS) keep it and are not called."""
    path = shared_folder(rows.sparkSession, "calls")
    if known is not None:
        kept = known.filter("status = 'SUCCESS'")
        rows = rows.join(kept.select(key), key, "left_anti")
        kept.write.parquet(path)
    made = complete(rows, key, prompt, chain, **how)
    made.write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(made.schema).parquet(path)


# Recorded answers: what a row's verdict table says is what the services of these queries answer.
CHAIN = ("provider0", "provider1", "provider2")
_RECORDED = "SELECT ingest_seq, to_json(named_struct('answers', provider, 'state', llm_status, 'attempts', attempts, 'text', verdict_json)) AS prompt FROM verdicts"


class Recorded:
    """A provider that answers as recorded: throttled unless it is the recorded one; with an odd number of attempts its first call times out."""

    def __init__(self, name: str) -> None:
        self.name, self.before = name, ""

    def complete_json(self, system: str, user: str) -> dict[str, Any]:
        r = json.loads(user)
        again, self.before = self.before == user, user
        if self.name < r["answers"]:
            raise RuntimeError("HTTP 429 too many requests")
        if r["state"] == "UNAVAILABLE":
            raise RuntimeError("deadline exceeded")
        if self.name == r["answers"] and r["attempts"] % 2 and not again:
            raise RuntimeError("read timed out")
        if r["state"] == "ERROR":
            raise RuntimeError("HTTP 401 unauthorized")
        try:
            return json.loads(r["text"])
        except ValueError as error:
            raise Malformed(str(error)) from error


def llm_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every verdict asked for through the chain of recorded providers."""
    return called(relation(spark, sf_dir, _RECORDED, ("verdicts",)), "ingest_seq", "prompt", lambda: [Recorded(n) for n in CHAIN]).select("ingest_seq", "status", "provider", "kind", "calls")


def llm_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every verdict asked for with three keys, of which as many are throttled as the row has attempts."""

    def call(key: str, system: str, user: str) -> dict:
        if int(key[3:]) < json.loads(user)["attempts"]:
            raise RuntimeError("HTTP 429")
        return {"key": key}

    made = called(relation(spark, sf_dir, _RECORDED, ("verdicts",)), "ingest_seq", "prompt", lambda: [KeyRing("ring", ["key0", "key1", " ", "key1", "key2"], call)])
    return made.select("ingest_seq", "status", "kind", F.coalesce(F.get_json_object("answer", "$.key"), F.lit("")).alias("key"))


def snk_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read of stored keys for every verdict, which fails twice for each of its attempts: reads made, seconds waited, outcome."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for n in b.column(1).to_pylist():
                waits, fails = [], iter([True] * (2 * n))

                def read() -> None:
                    if next(fails, False):
                        raise TimeoutError("timed out")

                try:
                    retried(read, sleep=waits.append)
                    out.append((len(waits) + 1, int(sum(waits)), "READ"))
                except TimeoutError:
                    out.append((len(waits) + 1, int(sum(waits)), "READ_FAILED"))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in zip(*out))], ["ingest_seq", "reads", "waited", "outcome"])

    return relation(spark, sf_dir, "SELECT ingest_seq, attempts FROM verdicts", ("verdicts",)).mapInArrow(run, "ingest_seq long, reads long, waited long, outcome string")


def _chain_sql() -> str:
    r = "CAST(substring(provider, 9) AS BIGINT)"
    state = "CASE WHEN llm_status = 'UNAVAILABLE' THEN 'TIMEOUT' WHEN llm_status = 'ERROR' THEN 'AUTH_FAILURE' WHEN NOT json_valid(verdict_json) THEN 'MALFORMED_RESPONSE' ELSE '' END"
    return f"""SELECT ingest_seq, CASE WHEN kind = '' THEN 'SUCCESS' ELSE 'UNAVAILABLE' END AS status, CASE WHEN kind = 'TIMEOUT' THEN 'provider2' ELSE provider END AS provider, kind,
 CASE kind WHEN 'TIMEOUT' THEN 6 WHEN 'MALFORMED_RESPONSE' THEN 2 * {r} + 2 ELSE 2 * {r} + 1 + attempts % 2 END AS calls FROM (SELECT *, {state} AS kind FROM verdicts) v"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"llm_chain": llm_chain, "llm_keys": llm_keys, "snk_retry": snk_retry}


def oracle_sql() -> dict[str, str]:
    keys = "SELECT ingest_seq, CASE WHEN attempts < 3 THEN 'SUCCESS' ELSE 'UNAVAILABLE' END AS status, CASE WHEN attempts < 3 THEN '' ELSE 'RATE_LIMITED' END AS kind, CASE WHEN attempts < 3 THEN 'key' || CAST(attempts AS VARCHAR) ELSE '' END AS key FROM verdicts"
    retry = "SELECT ingest_seq, CASE WHEN attempts < 2 THEN 2 * attempts + 1 ELSE 4 END AS reads, CASE WHEN attempts < 2 THEN 5 * attempts * (2 * attempts + 1) ELSE 30 END AS waited, CASE WHEN attempts < 2 THEN 'READ' ELSE 'READ_FAILED' END AS outcome FROM verdicts"
    return {name: assemble(Checker(), body, ("verdicts",)) for name, body in {"llm_chain": _chain_sql(), "llm_keys": keys, "snk_retry": retry}.items()}
