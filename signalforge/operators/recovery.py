"""Recovery of records whose verdict never came: ordered rules, of which the first that fits a row counts.

A rule names what it asks of some columns (None: anything) and what it gives. The rules are one CASE in the plan, so a row is
settled where it is read, without a join to the rules or an aggregation over matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from signalforge.functions.dialect import Dialect

#: Attempts after which a record is left to people.
MOST_ATTEMPTS = 3
#: Marks in a stored reason which prove that no model judged the record, and those of a throttle.
FAILURE_MARKS = ["llm unavailable", "provider error", "http 429", "rate limit", "rate-limit", "invalid llm json structure", "llm verification unavailable", "transport failure"]
THROTTLE_MARKS = ["http 429", "rate limit", "rate-limit"]
NOT_EVALUATED = ["NOT_RUN", "UNAVAILABLE", "ERROR"]

#: (has text, passes the gates, evaluated, decision, exact input) -> (disposition, reason)
RULES = [
    ((False, None, None, None, None), ("HOLD", "no stored text to recover from")),
    ((None, False, None, None, None), ("REJECT", "deterministic gate unchanged; no call made")),
    ((None, None, False, None, None), ("HOLD", "not evaluated; retry later, keep the review")),
    ((None, None, None, "ACCEPT", False), ("REVIEW", "accepted on derived input; confirm on the original")),
    ((None, None, None, "ACCEPT", None), ("ACCEPT", "accepted on the exact stored text")),
    ((None, None, None, "REVIEW", None), ("REVIEW", "held for review")),
    ((None, None, None, None, None), ("REJECT", "rejected")),
]
#: (has a failure mark, called, decision, by the gates alone) -> (status of the model, classification, note)
OLD_RULES = [
    ((True, None, None, None), ("UNAVAILABLE", None, "stored failure marker")),
    ((None, False, "", True), ("NOT_RUN", "REJECT", "deterministic outcome only")),
    ((None, False, None, None), ("NOT_RUN", None, "never called")),
    ((None, None, "ACCEPT", None), ("SUCCESS", "ACCEPT", "stored evaluated outcome")),
    ((None, None, "REJECT", None), ("REJECT", "REJECT", "stored evaluated outcome")),
    ((None, None, "REVIEW", None), ("REVIEW", "REVIEW", "stored evaluated outcome")),
    ((None, None, None, None), ("NOT_RUN", "REJECT", "no evaluation on record")),
]


def first_match(d: Dialect, rules: Sequence[tuple[tuple, tuple]], columns: Sequence[str], give: int, other: str = "''") -> str:
    """The value number `give` of the first rule that fits the columns; where a rule gives None, `other`."""

    def fits(asked: tuple) -> str:
        tests = []
        for c, v in zip(columns, asked):
            if v is True or v is False:
                tests.append(c if v else f"NOT {c}")
            elif v is not None:
                tests.append(f"{c} = {d.lit(v)}")
        return " AND ".join(tests) or "true"

    return d.case([(fits(asked), d.lit(given[give]) if given[give] is not None else other) for asked, given in rules], "NULL")


def _marked(d: Dialect, text: str, marks: list[str]) -> str:
    return "(" + " OR ".join(d.has(f"lower({text})", m) for m in marks) + ")"


def recoverable(d: Dialect, derived: str) -> str:
    """Every item that arrived first under its address, and those without text, with what recovery asks of it.

    Spark joins numbers and a flag, not the texts of all items.
    """
    has_text = "trim(coalesce(i.text, '')) <> ''"
    items, found, blank = "raw_items", has_text, "trim(coalesce(i.text, '')) = ''"
    if d.name == "spark":
        items, found, blank = f"(SELECT ingest_seq, error, post_url, {has_text} AS has_text FROM raw_items i)", "i.has_text", "NOT i.has_text"
    return f"""SELECT i.ingest_seq, {found} AS has_text, coalesce(w.reject_reason, '') = '' AS passes, coalesce(w.reject_reason, '') AS gate_reason, coalesce(w.evaluated, false) AS evaluated,
 CASE WHEN w.evaluated THEN 'OK' WHEN w.llm_status = 'OK' THEN 'UNAVAILABLE' ELSE coalesce(w.llm_status, 'NOT_RUN') END AS llm_status, coalesce(w.llm_status = 'OK' AND NOT w.evaluated, false) AS broken, coalesce(w.gate, '') AS decision, coalesce(w.attempts, 0) AS prior, coalesce(w.reasons, '') AS reasons,
 coalesce(w.provider, '') AS provider, coalesce(w.confidence, 0) AS confidence, coalesce(w.exact_input, true) AS exact_input
 FROM {items} i LEFT JOIN (SELECT *, text = {derived} AS exact_input FROM weighed) w ON w.ingest_seq = i.ingest_seq WHERE i.error IS NULL AND i.post_url <> '' AND (w.ingest_seq IS NOT NULL OR {blank})"""


def recovery(d: Dialect, derived: str) -> str:
    """Disposition and reason, attempts, whether another attempt is of use, and a token for queues."""
    columns = ("has_text", "passes", "evaluated", "decision", "exact_input")
    disposition, reason = first_match(d, RULES, columns, 0), first_match(d, RULES, columns, 1)
    called = "has_text AND passes"
    detail = f"CASE WHEN {called} AND NOT evaluated THEN 'LLM ' || llm_status || CASE WHEN broken THEN ' (invalid LLM JSON structure)' WHEN llm_status = 'UNAVAILABLE' THEN ' (HTTP 429)' ELSE '' END WHEN NOT passes THEN gate_reason ELSE reasons END"
    again = f"disposition = 'HOLD' AND has_text AND {d.isin('llm_status', NOT_EVALUATED)} AND attempt_count < {MOST_ATTEMPTS}"
    token = d.case([("disposition <> 'HOLD'", "'EVALUATED_' || disposition"), ("NOT has_text", "'HOLD_NO_INPUT'"), (_marked(d, "detail", THROTTLE_MARKS), "'HOLD_RATE_LIMITED'")], "'HOLD_OTHER'")
    return f"""SELECT ingest_seq, disposition, reason, detail, attempt_count, {again} AS retry_eligible, {token} AS availability
 FROM (SELECT *, {disposition} AS disposition, {reason} AS reason, {detail} AS detail, prior + CASE WHEN {called} THEN 1 ELSE 0 END AS attempt_count FROM ({recoverable(d, derived)}) r) s"""


def old_records(d: Dialect, derived: str) -> str:
    """What a stored record says of its model: status, provider, classification, and why."""
    # A record's reason is written when its verdict is: failed calls leave their message there.
    said = "CASE WHEN broken THEN 'LLM verification unavailable (invalid LLM JSON structure) ' || provider WHEN has_text AND passes AND llm_status = 'UNAVAILABLE' THEN 'LLM unavailable after retry - provider error: ' || provider || ' HTTP 429' WHEN has_text AND passes AND llm_status = 'ERROR' THEN 'provider error: ' || provider ELSE reasons END"
    columns = ("failed", "called", "decision", "by_gates")
    give = lambda k, other="''": first_match(d, OLD_RULES, columns, k, other)
    return f"""SELECT ingest_seq, {give(0)} AS llm_status, {give(1, "CASE WHEN decision = '' THEN 'REVIEW' ELSE decision END")} AS classification, {give(2)} AS note, CASE WHEN failed OR called THEN coalesce(nullif({d.extract('said', 'provider[0-9]')}, ''), 'unknown') ELSE 'none' END AS provider, confidence
 FROM (SELECT *, {_marked(d, 'said', FAILURE_MARKS)} AS failed FROM (SELECT *, {said} AS said, has_text AND passes AS called, NOT passes AS by_gates FROM ({recoverable(d, derived)}) r) s) t"""
