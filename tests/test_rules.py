"""Literal cases: posts with the outcome that the rules must give, in both engines."""

import duckdb
import pytest

from signalforge.functions.dialect import Checker, Dialect
from signalforge.operators import relations

COLUMNS = "ingest_seq, post_url, text, author_name, author_profile_url, post_date, job_card_location, job_card_company, job_card_employment_type, job_card_experience, activity_id, source_query"
#: (text, job card's place) and what the relation `fields` must say of it.
POSTS = [
    (("We're hiring a Chief of Staff in Bangalore. 2-4 years experience.", ""), {"reject_reason": "", "major_category": "Chief of Staff", "market": "India", "location": "Bengaluru", "experience": "2-4 years"}),
    (("Looking for a Founder's Office Associate in Mumbai. DM me with your CV.", ""), {"reject_reason": "", "major_category": "Founder's Office", "market": "India", "location": "Mumbai", "exact_role": "Founder's Office Associate"}),
    (("Chief of Staff - CEO Office, Gurgaon, 2-4 years, ₹18 LPA. We are looking for candidates.", ""), {"reject_reason": "", "ctc": "₹18 LPA"}),
    (("Open to work as Chief of Staff in Bangalore.", ""), {"reject_reason": "job seeker phrase"}),
    (("Excited to join Acme Corp as their new Chief of Staff in India!", ""), {"reject_reason": "congratulatory"}),
    (("What does a Chief of Staff do in an Indian startup?", ""), {"reject_reason": "informational"}),
    (("UNISON INTERNATIONAL CONSULTING is hiring a Chief of Staff to CEO in Ahmedabad, 50 LPA.", ""), {"reject_reason": "", "market": "India"}),
    (("We are hiring a Chief of Staff Intern - Bangalore", ""), {"reject_reason": "", "exact_role": "Chief of Staff Intern"}),
    (("FO hiring in Bangalore", ""), {"reject_reason": "no target role (fo without proof)"}),
    (("Hiring a Chief of Staff, CTC 20 LPA. Apply now.", ""), {"reject_reason": "india relevance (unclear)"}),
    (("Hiring a Chief of Staff in Bangalore.", "Austin, Texas, United States"), {"reject_reason": "india relevance (job card)"}),
    (("Hiring: Business Analyst (SQL, Power BI) in Pune. Apply here: https://jobs.acme.com/7.", ""), {"reject_reason": "", "major_category": "Data Analyst", "apply_link": "https://jobs.acme.com/7"}),
    (("Hiring: Business Analyst in Pune, ERP and BRD work, some SQL.", ""), {"reject_reason": "no target role"}),
    (("We are hiring an Applied Scientist, machine learning, in Pune.", ""), {"reject_reason": "", "data_keyword": "applied scientist"}),
    (("We are hiring a Data Engineer in Pune for our data science team.", ""), {"reject_reason": "no target role"}),
    (("We are hiring a Product Analyst in Pune.", ""), {"reject_reason": "", "data_keyword": "product analyst", "gap": 3}),
    (("Role: Data Entry Operator. Data Analyst team in Pune is hiring.", ""), {"reject_reason": "data entry"}),
    (("Hiring a Data Analyst (not data entry) in Pune.", ""), {"reject_reason": ""}),
    (("Zylo Tech is hiring a Data Analyst in Pune. We are hiring now.", ""), {"reject_reason": "", "company_name": "Zylo Tech"}),
    (("Acme Foods is hiring. Beta Works is recruiting. Data Analyst in Pune.", ""), {"reject_reason": "several employers"}),
    (("Hiring a Data Analyst in Pune. Follow us for hiring updates, career opportunities, and industry insights!", ""), {"reject_reason": ""}),
    (("Career opportunities this month: hiring a Data Analyst in Pune.", ""), {"reject_reason": "aggregator (career opportunities)"}),
    (("I am looking for a Chief of Staff in Pune", ""), {"reject_reason": "first person seeker"}),
    (("We're hiring a Data Analyst in Bhubaneswar, Odisha.", ""), {"location": "Bhubaneswar"}),
    (("We're hiring a Data Analyst in Pune and Delhi NCR.", ""), {"location": "Delhi / Delhi Ncr / Pune"}),
    (("We're hiring a Data Analyst, remote.", "Indore, Madhya Pradesh, India"), {"location": "Indore", "market": "Remote - India"}),
    (("Hiring a Data Analyst in Pune. Send your resume to priya.k@gmail.com", ""), {"cold_email": "priya.k@gmail.com"}),
    (("Hiring a Data Analyst in Pune. My own mail is priya.k@gmail.com", ""), {"cold_email": "Not Available"}),
    (("Hiring a Data Analyst in Pune. Mail no-reply@acme.com, priya.k@gmail.com or hr@beta.co.", ""), {"cold_email": "hr@beta.co"}),
    (("Hiring a Data Analyst in Pune. It reports to Anita Rao, Head of Data. https://www.linkedin.com/in/other", ""), {"manager_name": "Anita Rao", "manager_tier": "CONTEXT", "manager_link": ""}),
    (("Hiring a Data Analyst in Pune. Reach out to Anita Rao https://www.linkedin.com/in/anita-rao", ""), {"manager_name": "Anita Rao", "manager_link": "https://www.linkedin.com/in/anita-rao"}),
    (("Hiring a Data Analyst in Pune with my co-founder Rishi Jain.", ""), {"manager_name": "Rishi Jain", "manager_tier": "FOUNDER"}),
    (("Hiring a Data Analyst in Pune.\nPooja Rani | Manager - Talent Acquisition\npooja@zylo.in", ""), {"manager_name": "Pooja Rani", "manager_tier": "SIGNATURE"}),
    (("Hiring a Data Analyst in Pune.\nWE ARE HIRING | Manager - Talent\nx@zylo.in", ""), {"manager_name": ""}),
    (("Full-time Data Analyst in Pune, hiring.\nVignesh Chandrasekar\nSr HR Executive\nvignesh@beta.co", ""), {"manager_name": "Vignesh Chandrasekar", "employment_type": "Full-time"}),
    (("I'm hiring a Data Analyst in Pune.", ""), {"manager_name": "Priya Sharma", "manager_tier": "AUTHOR"}),
    (("Join Enqurious, an AI-native firm, as a Data Analyst in Pune. We worked at Fractal. Hiring.", ""), {"company_name": "Enqurious"}),
    (("Our Team is hiring a Data Analyst in Pune.", ""), {"company_name": "Unclear"}),
    (("I work in Indiana", ""), {"is_india": False}),
    (("sailing across the Indian Ocean", ""), {"is_india": False}),
    (("Apply here https://lnkd.in/eruUdaEu", ""), {"is_india": False}),
    (("x", "Hyderabad, Sindh, Pakistan"), {"is_india": False}),
    (("x", "Kochi, Japan"), {"is_india": False}),
    (("x", "United States (Remote)"), {"is_india": False}),
    (("x", "Noida, Uttar Pradesh, India (On-site)"), {"is_india": True}),
    (("x", "Greater Delhi Area (On-site)"), {"is_india": True}),
    (("CTC 10 LPA", ""), {"is_india": True}),
    (("raised 5 crores", ""), {"is_india": True}),
    (("call +91 98765 43210", ""), {"is_india": True}),
    (("Pvt. Ltd. company based in Dhaka, Bangladesh", ""), {"is_india": False}),
]


def _assembled(d, body, monkeypatch):
    rows = [[k, f"https://x/{k}", text, "Priya Sharma", "https://www.linkedin.com/in/priya-sharma", "", place, "Unclear", "Unclear", "Unclear", str(k), "q"] for k, ((text, place), _) in enumerate(POSTS)]
    monkeypatch.setitem(relations.RELATIONS, "raw_posts", (lambda dialect: dialect.values(rows, COLUMNS), ()))
    return relations.assemble(d, body, ("fields",))


def test_posts_get_their_outcomes(spark, monkeypatch):
    body = "SELECT * FROM fields"
    here = {r["ingest_seq"]: r.asDict() for r in spark.sql(_assembled(Dialect(), body, monkeypatch)).collect()}
    there = {r["ingest_seq"]: r for r in duckdb.sql(_assembled(Checker(), body, monkeypatch)).df().to_dict("records")}
    wrong = []
    for k, ((text, place), want) in enumerate(POSTS):
        for got in (here[k], there[k]):
            wrong += [(text, place, c, got[c], v) for c, v in want.items() if got[c] != v]
    assert not wrong


VERDICTS = [
    ({}, ""),
    ({"destination": "'HOLD'"}, "non-production destination"),
    ({"status": "'Review'"}, "status blocked"),
    ({"status": "''"}, "status blocked"),
    ({"llm_confidence": "0.59"}, "confidence under 0.60"),
    ({"llm_status": "'UNAVAILABLE'"}, "verdict not evaluated"),
    ({"final_company": "' Unclear '"}, "company missing"),
    ({"manager_name": "''"}, "hiring manager missing"),
    ({"exact_role": "'N/A'"}, "role missing"),
    ({"destination": "'DATA'"}, "category in the wrong table"),
    ({"final_category": "'Data Analyst'"}, "category in the wrong table"),
]


@pytest.mark.parametrize("change, want", VERDICTS)
def test_barrier(spark, change, want):
    good = {"destination": "'MAIN'", "status": "'New'", "llm_confidence": "0.9", "llm_status": "'OK'", "evaluated": "true", "final_company": "'Acme'", "manager_name": "'Anita Rao'", "exact_role": "'Chief of Staff'", "final_category": "'Chief of Staff'"}
    row = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in (good | change).items())
    assert spark.sql(f"SELECT {relations.barrier(Dialect())} AS why FROM ({row}) r").first()["why"] == want


def test_priority_scores(spark):
    from signalforge.operators.catalog import priority

    cases = [(("Series D", "$100M", "Bengaluru", "AI"), 95), (("Seed", "$500K", "Bangalore", "AI"), 45), (("Bootstrapped", "Undisclosed", "Unknown", "Unknown"), 5)]
    score, number = priority(Dialect())
    for (stage, amount, city, industry), want in cases:
        row = f"SELECT lower('{stage}') AS stage, '{amount}' AS amount, '{city}' AS city, '{industry}' AS industry"
        assert spark.sql(f"SELECT {score} AS s FROM (SELECT *, {number} AS number FROM ({row}) r) n").first()["s"] == want


def test_only_eligible_rows_are_written(spark):
    from signalforge.plans import registry

    written = registry.queries()["snk_write_production"](spark, "/root/testdata/sf0.001")
    assert {(r["gate"], r["disposition"]) for r in written.collect()} <= {("ACCEPT", "ELIGIBLE")}
