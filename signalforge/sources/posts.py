"""Input relations composed from the star tables by one SQL text: posts, verdicts and the two sink tables.

Each order makes one post: remainders of its key by co-prime numbers pick an opener, a role, a place, a contact phrase and
so on, so every combination occurs. Repeated addresses, tracking parameters and missing fields are made on purpose.
"""

from __future__ import annotations

import unicodedata

from signalforge.functions.dialect import Dialect

OPENERS = [
    "We're hiring a {role} in {place}.", "We are looking for a {role} to join our team in {place}.", "Hiring: {role} - {place}.", "I'm hiring a {role} for my team in {place}.",
    "Open to work as {role} in {place}. Please hire me.", "I am looking for a {role} role in {place}. Open to opportunities.", "Excited to join Acme Corp as their new {role} in {place}! Congratulations to all.",
    "Things I learned as a {role} in {place}. Salary discussion inside.", "Hiring alert: 12 roles across multiple companies, {role} in {place} and more jobs.", "Pay a registration fee to apply for {role} in {place}. Hiring now.",
    "Acme Labs is hiring. Beta Works is recruiting. {role} in {place}.", "Role: {role}{nl}Location: {place}{nl}Apply now.", "Seeking candidates: {role}, {place}. Experience with founders preferred.",
    "Our client is looking for a {role} in {place}.", "Follow us for job updates and career opportunities. Zylo Tech is hiring a {role} in {place}.", "Company: Acme Position: {role} Company: Beta Company: Gamma. Opening in {place}.",
    "A long story about the team and what we have built together over the years, with many customers, many lessons and a great deal of patience on all sides, which I wanted to share with everyone here before the year is over and before we go into the next one with new plans and new people at our side. {role}. There is more to say about how it went and why we did it this way and not another, and what the founders thought about it at the time, long before any of it had worked out. We are hiring in {place}.",
]
ROLES = ["Chief of Staff", "Founder’s Office Associate", "Senior Data Analyst", "Data Scientist - NLP", "Business Analyst (SQL, Power BI)", "Software Engineer", "Chief of Staff Intern", "Applied Scientist, machine learning", "BI Analyst", "Founder's Office", "Data Entry Operator", "Product Analyst", "𝗖𝗵𝗶𝗲𝗳 𝗼𝗳 𝗦𝘁𝗮𝗳𝗳"]
PLACES = ["Bangalore", "Mumbai, India", "London", "Remote", "Hyderabad", "Delhi NCR, work from home", "Singapore", "Pune – hybrid", "the Indian Ocean", "Noida", "Dhaka"]
TERMS = ["CTC 18 LPA, 2-4 years experience.", "5+ years.", "Freshers welcome. Full-time.", "", "Contract, 3 yrs, ₹25 LPA.", "Part-time, 10-12 LPA.", "Internship."]
CONTACTS = ["Send your CV to careers@acme.in or priya.k@gmail.com.", "DM Priya to apply.", "Apply here: https://forms.gle/AbC123xyz.", "Apply via https://jobs.acme.com/apply?id=7 today!", "Share with friends.", "Mail no-reply@acme.com, then hr@beta.co.", "Reports to Anita Rao. https://www.linkedin.com/in/anita-rao", "Interested? Contact me to apply.",
    "Pooja Rani | Manager - Talent Acquisition\npooja@zylo.in", "You will work with our CEO Jane Doe at Zylo Tech. Share your resume at jane.doe@gmail.com", "Full-time. Reports to Rahul Verma, Head of Analytics.\nVignesh Chandrasekar\nSr HR Executive\nvignesh@beta.co",
]
AUTHORS = [("Priya Sharma", "https://www.linkedin.com/in/priya-sharma?x=1"), ("Acme Labs", "https://www.linkedin.com/company/acme-labs"), ("CareerJobs India", "https://www.linkedin.com/company/careerjobs"), ("Steve Jobs", "https://www.linkedin.com/in/steve-jobs"), ("Talent Recruiters Pvt Ltd", "https://www.linkedin.com/company/talent-recruiters")]
CARDS = ["Bengaluru, Karnataka, India", "", "Austin, Texas, United States", "Hyderabad, Sindh, Pakistan", "Remote", "Noida, Uttar Pradesh, India (On-site)"]


def _pick(d: Dialect, values: list[str], key: str) -> str:
    n = len(values)
    return d.case([(f"{key} % {n} = {i}", d.lit(v)) for i, v in enumerate(values[:-1])], d.lit(values[-1]))


def raw_items(d: Dialect) -> str:
    """(ingest_seq, post_url, text, author_name, author_profile_url, posted_ms, card_*, source_query, error) as a scraper would give them."""
    k, year = "o_orderkey", 1704067200000
    return f"""SELECT CAST(o_orderkey AS BIGINT) AS ingest_seq,
 'https://www.linkedin.com/posts/p_activity-' || CAST(o_orderkey % 9973 + (o_orderkey % 7) * 100000 AS STRING) || CASE WHEN {k} % 3 = 0 THEN '?utm=' || CAST({k} AS STRING) ELSE '' END AS post_url,
 CASE WHEN {k} % 97 = 5 THEN '' ELSE replace(replace(replace({_pick(d, OPENERS, f"CAST(floor({k} / 3) AS BIGINT)")}, '{{role}}', {_pick(d, ROLES, k)}), '{{place}}', {_pick(d, PLACES, k)}), '{{nl}}', chr(10)) || ' ' || {_pick(d, TERMS, k)} || ' ' || {_pick(d, CONTACTS, f"CAST(floor({k} / 5) AS BIGINT)")} || ' #' || replace(n_name, ' ', '') END AS text,
 {_pick(d, [a for a, _ in AUTHORS], f"CAST(floor({k} / 2) AS BIGINT)")} AS author_name, {_pick(d, [u for _, u in AUTHORS], f"CAST(floor({k} / 2) AS BIGINT)")} AS author_profile_url,
 CASE WHEN {k} % 13 = 0 THEN NULL ELSE {year} + CAST({k} % 100000 AS BIGINT) * 60000 END AS posted_ms,
 CASE WHEN {k} % 4 = 1 THEN 'job' ELSE 'article' END AS card_type, {_pick(d, CARDS, f"CAST(floor({k} / 7) AS BIGINT)")} AS card_location,
 CASE {k} % 4 WHEN 1 THEN 'Job by ' || c_mktsegment ELSE '' END AS card_subtitle, CASE WHEN {k} % 8 = 1 THEN 'Full-time' WHEN {k} % 8 = 5 THEN 'job' ELSE '' END AS card_employment, CASE WHEN {k} % 12 = 1 THEN '3-5 years' ELSE '' END AS card_experience,
 'query ' || CAST({k} % 48 AS STRING) AS source_query, CASE WHEN {k} % 211 = 3 THEN 'blocked' ELSE NULL END AS error
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def raw_posts(d: Dialect) -> str:
    """One post an item that has an address and a text: canonical address, UTC time, and the job card's fields."""
    none = lambda c: f"coalesce(nullif(trim({c}), ''), 'Unclear')"
    card = lambda c: none(f"CASE WHEN card_type = 'job' THEN {c} ELSE '' END")
    return f"""SELECT ingest_seq, split_part(post_url, '?', 1) AS post_url, text, author_name, split_part(author_profile_url, '?', 1) AS author_profile_url,
 coalesce({d.utc('posted_ms')}, '') AS post_date, CASE WHEN card_type = 'job' THEN trim(card_location) ELSE '' END AS job_card_location,
 {none(d.replace("CASE WHEN card_type = 'job' THEN card_subtitle ELSE '' END", '(?i)^job by '))} AS job_card_company, {card('card_employment')} AS job_card_employment_type, {card('card_experience')} AS job_card_experience,
 {d.extract('post_url', 'activity-([0-9]+)', 1)} AS activity_id, source_query
 FROM raw_items WHERE error IS NULL AND trim(text) <> '' AND post_url <> ''"""


#: Mathematical letters and digits, and what they stand for: all of their block whose compatibility form is one ASCII character.
_FOLDED = [(c, f.lower()) for c in map(chr, range(0x1D400, 0x1D800)) if len(f := unicodedata.normalize("NFKC", c)) == 1 and f.isascii()]
FANCY, PLAIN = ("".join(x) for x in zip(*_FOLDED))


def firsts(d: Dialect) -> str:
    """When the first copy of each address arrived: numbers alone, which are aggregated where they are read."""
    return "SELECT min(ingest_seq) AS first_seq FROM raw_posts GROUP BY post_url"


def posts(d: Dialect) -> str:
    """The first copy of each address, in arrival order, with its normalised text `t`.

    Spark finds the first copies by `firsts`: a window over all copies would sort every text of a split in one task.
    """
    source = "raw_posts LEFT SEMI JOIN firsts ON ingest_seq = first_seq" if d.name == "spark" else "raw_posts"
    return f"""SELECT *, {normalize(d, 'text')} AS t FROM (SELECT *, row_number() OVER (PARTITION BY post_url ORDER BY ingest_seq) AS copy_no FROM {source}) r WHERE copy_no = 1"""


def normalize(d: Dialect, col: str) -> str:
    """Lower case, straight quotes, plain spaces, hyphens and letters; the length stays."""
    return f"lower(translate({col}, {d.lit('’‘“” ‐‑‒–—−' + FANCY)}, {d.lit(chr(39) * 2 + chr(34) * 2 + ' ' + '-' * 6 + PLAIN)}))"


def verdicts(d: Dialect, source: str = "orders") -> str:
    """One external verdict an order, as JSON text with the usual faults: missing fields, numbers as text, odd values."""
    k = "o_orderkey"
    return f"""SELECT CAST(o_orderkey AS BIGINT) AS ingest_seq, CASE WHEN {k} % 29 = 0 THEN '{{bad' ELSE '{{"decision": "' || CASE WHEN {k} % 5 < 3 THEN 'accept' WHEN {k} % 5 = 3 THEN 'REVIEW' ELSE 'REJECT' END || '", "confidence": "' || CAST(CAST({k} % 121 AS DOUBLE) / 100 AS STRING) || '", "is_current_job": ' || CASE WHEN {k} % 17 = 0 THEN 'false' ELSE 'true' END || ', "is_genuine_hiring": ' || CASE WHEN {k} % 19 = 0 THEN 'false' ELSE 'true' END || ', "is_aggregator": ' || CASE WHEN {k} % 23 = 0 THEN 'true' ELSE 'false' END || ', "major_category": "' || CASE {k} % 6 WHEN 0 THEN 'Chief of Staff' WHEN 1 THEN 'Data Analyst' WHEN 2 THEN 'Data Scientist' WHEN 3 THEN 'Astronaut' WHEN 4 THEN 'None' ELSE 'Founder''s Office' END || '", "india_relevance": "' || CASE {k} % 4 WHEN 0 THEN 'India' WHEN 1 THEN 'Remote - India' WHEN 2 THEN 'Unclear' ELSE 'India + Global' END || '", "employment_type": "' || CASE {k} % 7 WHEN 0 THEN 'Contract' WHEN 1 THEN 'Internship' WHEN 2 THEN 'Unclear' ELSE 'Full-time' END || '", "company": "' || CASE WHEN {k} % 3 = 0 THEN '' ELSE 'Acme Labs' END || '", "reason": "  several   words  "}}' END AS verdict_json,
 CASE {k} % 11 WHEN 0 THEN 'UNAVAILABLE' WHEN 1 THEN 'ERROR' ELSE 'OK' END AS llm_status, 'provider' || CAST({k} % 3 AS STRING) AS provider, CAST({k} % 4 AS BIGINT) AS attempts FROM {source}""".replace("''s Office", "''s Office" if d.name == "checker" else "\\'s Office")


def sinks(d: Dialect) -> str:
    """What both sink tables already hold: (destination, source_link)."""
    return "SELECT CASE WHEN ingest_seq % 2 = 0 THEN 'MAIN' ELSE 'DATA' END AS destination, post_url AS source_link FROM posts WHERE ingest_seq % 9 = 0"
