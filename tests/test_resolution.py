"""Literal posts with the state, evidence and detail that each field must get, in both engines."""

import duckdb
import pytest

from signalforge.functions import lexicon as L
from signalforge.functions.dialect import Checker, Dialect
from signalforge.operators import relations, resolution
from signalforge.sources.posts import normalize

from .test_rules import COLUMNS

PERSON, PAGE = "https://www.linkedin.com/in/priya-sharma", "https://www.linkedin.com/company/acme"
#: (text, author, profile, card's place, card's company), field, (state, beginning of the evidence, detail)
CASES = [
    (("Zylo Tech is hiring a Data Analyst in Pune.", "A B", PERSON, "", "Unclear"), "company", ("EXPLICIT", "Zylo Tech is hiring", "EXPLICIT_EMPLOYER")),
    (("Join Enqurious as a Data Analyst in Pune. Hiring.", "A B", PERSON, "", "Unclear"), "company", ("EXPLICIT", "Join Enqurious", "EXPLICIT_EMPLOYER")),
    (("Hiring a Data Analyst in Pune.", "A B", PERSON, "", "Beta Works"), "company", ("EXPLICIT", "job card company: Beta Works", "EXPLICIT_EMPLOYER")),
    (("Hiring a Data Analyst in Pune for our client.", "A B", PERSON, "", "Unclear"), "company", ("NOT_FOUND", "for our client", "INTERMEDIARY_CLIENT_UNDISCLOSED")),
    (("Hiring a Data Analyst in Pune. Company not disclosed.", "A B", PERSON, "", "Unclear"), "company", ("NOT_FOUND", "Company not disclosed", "EMPLOYER_UNDISCLOSED")),
    (("Hiring a Data Analyst in Pune.", "Best Staffing", PAGE, "", "Unclear"), "company", ("NOT_FOUND", "agency-shaped poster: Best Staffing", "INTERMEDIARY_CLIENT_UNDISCLOSED")),
    (("Hiring a Data Analyst in Pune.", "A B", PERSON, "", "Unclear"), "company", ("NOT_FOUND", "no employer evidence", "EXTRACTION_UNRESOLVED")),
    (("We are hiring. Role: Senior Data Analyst in Pune", "A B", PERSON, "", "Unclear"), "role", ("EXPLICIT", "Role: Senior Data Analyst", "")),
    (("We are hiring a Data Analyst in Pune", "A B", PERSON, "", "Unclear"), "role", ("EXTRACTED", "verbatim title in post", "")),
    (("We are hiring people in Pune", "A B", PERSON, "", "Unclear"), "role", ("NOT_FOUND", "no role extracted", "")),
    (("We are hiring a Data Analyst in Pune", "A B", PERSON, "Pune, Maharashtra, India", "Unclear"), "location", ("EXPLICIT", "job card: Pune", "")),
    (("We are hiring a Data Analyst in Pune", "A B", PERSON, "", "Unclear"), "location", ("EXPLICIT", "place: Pune", "")),
    (("We are hiring a Data Analyst", "A B", PERSON, "", "Unclear"), "location", ("NOT_FOUND", "no location evidence", "")),
    (("Full-time Data Analyst, hiring", "A B", PERSON, "", "Unclear"), "employment_type", ("EXPLICIT", "explicit employment token: Full-time", "FULL_TIME")),
    (("Freelance Data Analyst, hiring", "A B", PERSON, "", "Unclear"), "employment_type", ("EXPLICIT", "explicit employment token: Freelance", "CONTRACT")),
    (("Data Analyst, hiring", "A B", PERSON, "", "Unclear"), "employment_type", ("NOT_FOUND", "employment unstated", "UNKNOWN")),
    (("Hiring a Data Analyst, 2-4 years", "A B", PERSON, "", "Unclear"), "experience", ("EXTRACTED", "2-4 years", "")),
    (("Hiring a Data Analyst in Pune with my co-founder Rishi Jain.", "A B", PERSON, "", "Unclear"), "hiring_manager", ("EXPLICIT", "named in post: Rishi Jain", "DIRECT_HIRING_PERSON")),
    (("Hiring a Data Analyst.\nPooja Rani | Manager - Talent Acquisition\npooja@zylo.in", "A B", PERSON, "", "Unclear"), "hiring_manager", ("EXPLICIT", "recruiter signature", "RECRUITER")),
    (("Hiring a Data Analyst for our client.\nPooja Rani | Manager - Talent Acquisition\npooja@zylo.in", "A B", PERSON, "", "Unclear"), "hiring_manager", ("EXPLICIT", "recruiter signature", "AGENCY_RECRUITER")),
    (("I'm hiring a Data Analyst in Pune.", "Priya Sharma", PERSON, "", "Unclear"), "hiring_manager", ("EXPLICIT", "author states hiring side", "DIRECT_HIRING_PERSON")),
    (("Hiring a Data Analyst. It reports to Anita Rao, Head of Data.", "A B", PERSON, "", "Unclear"), "hiring_manager", ("INFERRED_WITH_STRONG_EVIDENCE", "Anita Rao", "HIRING_TEAM_MEMBER")),
    (("We're hiring a Data Analyst.", "Acme", PAGE, "", "Unclear"), "hiring_manager", ("NOT_FOUND", "hiring-side post", "POSTER_ONLY")),
    (("Data Analyst wanted.", "Acme", PAGE, "", "Unclear"), "hiring_manager", ("NOT_FOUND", "no hiring-side evidence", "NOT_FOUND")),
]
WORTH = {"EXPLICIT": 0.95, "EXTRACTED": 0.8, "INFERRED_WITH_STRONG_EVIDENCE": 0.7}


def test_every_case_in_both_engines(spark, monkeypatch):
    rows = [[k, f"https://x/{k}", text, author, profile, "", place, company, "Unclear", "Unclear", str(k), "q"] for k, ((text, author, profile, place, company), _, _) in enumerate(CASES)]
    monkeypatch.setitem(relations.RELATIONS, "raw_posts", (lambda d: d.values(rows, COLUMNS), ()))
    sql = lambda d: relations.assemble(d, resolution.resolved(d), ("fields",))
    here = {(r["ingest_seq"], r["field"]): r.asDict() for r in spark.sql(sql(Dialect())).collect()}
    there = {(r["ingest_seq"], r["field"]): r for r in duckdb.sql(sql(Checker())).df().to_dict("records")}
    wrong = []
    for k, (post, field, (state, evidence, detail)) in enumerate(CASES):
        for got in (here[k, field], there[k, field]):
            if (got["state"], got["evidence"][: len(evidence)], got["detail"]) != (state, evidence, detail):
                wrong.append((post[0], field, got))
            if field != "company" and got["confidence"] != WORTH.get(state, 0):
                wrong.append((post[0], field, got["confidence"]))
    assert not wrong and len(here) == 6 * len(CASES)


#: Phrases that prove what "fo" means.
PROOFS = ["founder's office", "founders office", "founder’s office", "founder office", "office of the founder", "founder associate", "founder's associate", "founder’s associate"]


@pytest.mark.parametrize("proof", PROOFS)
def test_a_proof_of_fo_is_a_role_itself(spark, proof):
    """So a post that says "fo" with proof has passed as a founder's office post before, and one without fails."""
    d = Dialect()
    said = spark.sql(f"SELECT {normalize(d, d.lit('FO role, ' + proof))} AS t").first()["t"]
    assert any(k in said for k in L.FOUNDERS_OFFICE)
