"""Calls to outside services and searches, through doubles."""

import itertools
import json

import pytest

from signalforge.operators.calls import KeyRing, Malformed, ask, called, kind_of, retried
from signalforge.sources import search as S

OUTCOMES = {"ok": None, "auth": "HTTP 401 unauthorized", "throttled": "HTTP 429", "dns": "getaddrinfo failed", "bad": Malformed("no object"), "list": [1]}


class Double:
    """A provider that gives the outcomes of its script in order, the last one for ever."""

    def __init__(self, name, script):
        self.name, self.script, self.calls = name, list(script), 0

    def complete_json(self, system, user):
        self.calls += 1
        said = OUTCOMES[self.script.pop(0) if len(self.script) > 1 else self.script[0]]
        if isinstance(said, Exception):
            raise said
        if isinstance(said, str):
            raise RuntimeError(said)
        return said if said is not None else {"answer": user}


def brute(scripts):
    """(status, provider number, calls) by the rules in so many words."""
    calls, last = 0, ("NOT_RUN", None)
    for k, script in enumerate(scripts):
        for a in range(2):
            calls += 1
            said = script[min(a, len(script) - 1)]
            if said == "ok":
                return "SUCCESS", k, calls
            last = said
            if said == "auth":
                break
        if last in ("auth", "bad", "list"):
            return "UNAVAILABLE", k, calls
    return "UNAVAILABLE", len(scripts) - 1, calls


def test_chains_follow_the_rules():
    scripts = [list(p) for p in itertools.product(OUTCOMES, repeat=2)]
    for two in itertools.product(scripts, repeat=2):
        got = ask([Double(str(k), s) for k, s in enumerate(two)], "", "x")
        assert (got["status"], int(got["provider"]), got["calls"]) == brute(two), two
    assert ask([], "", "x")["status"] == "NOT_RUN"


@pytest.mark.parametrize("said, want", [("HTTP 401", "AUTH_FAILURE"), ("api key missing", "AUTH_FAILURE"), ("HTTP 400 json_validate_failed", "PROVIDER_ERROR"), ("429 Too many requests", "RATE_LIMITED"), ("[Errno 11001] getaddrinfo", "DNS_FAILURE"), ("Deadline exceeded", "TIMEOUT"), ("certificate verify failed", "TLS_FAILURE"), ("", "PROVIDER_ERROR")])
def test_kinds_of_failure(said, want):
    assert kind_of(RuntimeError(said)) == want


def test_no_row_is_lost_or_called_twice(spark, tmp_path):
    log = str(tmp_path)

    class Counting:
        name = "counting"

        def complete_json(self, system, user):
            import os
            import uuid

            open(os.path.join(log, f"{user}-{uuid.uuid4().hex}"), "w").close()
            if int(user) % 3 == 0:
                raise RuntimeError("HTTP 503")
            return {"n": user}

    rows = spark.range(60).selectExpr("id", "CAST(id AS STRING) AS prompt").repartition(4)
    first = called(rows, "id", "prompt", lambda: [Counting()], attempts=1)
    assert first.count() == first.distinct().count() == 60 and first.filter("status = 'SUCCESS'").count() == 40
    first.orderBy("id").collect()
    assert len(list(tmp_path.iterdir())) == 60
    again = called(rows, "id", "prompt", lambda: [Counting()], known=first, attempts=1)
    assert again.count() == 60 and len(list(tmp_path.iterdir())) == 80


def test_keys_rotate_only_where_a_key_is_at_fault():
    met = []

    def call(key, system, user):
        met.append(key)
        raise RuntimeError({"a": "HTTP 429", "b": "HTTP 403", "c": "HTTP 500"}[key])

    with pytest.raises(RuntimeError, match="500"):
        KeyRing("r", ["a", "b", "a", "", "c", "d"], call).complete_json("", "")
    assert met == ["a", "b", "c"]
    with pytest.raises(RuntimeError, match="no key"):
        KeyRing("r", [], call).complete_json("", "")


def test_reads_are_retried_with_growing_waits():
    waits = []
    with pytest.raises(KeyError):
        retried(lambda: {}["x"], sleep=waits.append)
    assert waits == [5, 10, 15]


class Client:
    """A search service that names three keywords and fails on one of them."""

    def __init__(self, options):
        self.options = options

    def keywords(self):
        return ["a", "b", "fails"]

    def search(self, keyword, max_posts, date_filter):
        if keyword == "fails":
            raise RuntimeError("the service is down")
        yield {"post_url": f"u?{max_posts}", "text": date_filter or "t", "posted_at": {"timestamp": "7"}, "content": {"type": "job", "job_type": " ", "work_type": "Contract", "seniority": "2 years", "subtitle": "JOB BY Acme"}}
        yield {"post_url": "u", "text": " "}
        yield {"error": "blocked", "content": "none"}
        yield {"post_url": "u", "text": "t", "timestamp": "x", "content": {"type": "article", "job_type": "no"}, "owner_name": "O"}


def test_search_reads_a_partition_a_keyword_and_prunes(spark):
    how = {"client": "tests.test_calls:Client", "date_filter": "past-24h"}
    found = S.search(spark, None, 3, **how)
    assert found.rdd.getNumPartitions() == 3
    only = S.search(spark, ["a"], 3, **how)
    assert only.rdd.getNumPartitions() == 1
    rows = sorted(only.collect(), key=lambda r: r["place"])
    assert [r["error"] for r in rows] == [None, S.NO_ADDRESS_OR_TEXT, "blocked", None]
    assert (rows[0]["post_url"], rows[0]["text"], rows[0]["posted_ms"], rows[0]["card_company"], rows[0]["card_employment"], rows[0]["card_experience"]) == ("u?10", "past-24h", 7, "Acme", "Contract", "2 years")
    assert (rows[3]["posted_ms"], rows[3]["author_name"], rows[3]["card_employment"]) == (None, "O", "Unclear")
    both = S.search(spark, ["a", "b"], 3, **how)
    assert [both.count(), both.filter("source_query = 'b'").count(), both.count(), both.filter("error IS NULL").count()] == [8, 4, 8, 4]
    assert S.search(spark, [], 3, **how).count() == 0
    assert S.search(spark, [" a ", "", "a"], **how).rdd.getNumPartitions() == 1
    assert S.posts_of(only).filter("post_date = '1970-01-01T00:00:00+00:00'").count() == 1
    with pytest.raises(Exception, match="the service is down"):
        found.count()
