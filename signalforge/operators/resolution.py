"""How each field of a post was come by: its value, a state, the words that show it, and a confidence that follows from the state.

States: EXPLICIT (said in so many words), EXTRACTED (found in the text), INFERRED_WITH_STRONG_EVIDENCE, AMBIGUOUS, NOT_FOUND.
A detail tells further why a company is not named, how a manager is related, and what kind of employment it is. All is labelling:
no value is changed and no decision depends on it.
"""

from __future__ import annotations

from signalforge.functions import lexicon as L
from signalforge.functions.dialect import Dialect
from signalforge.operators import relations as R

STRONG, FOUND, INFERRED, AMBIGUOUS, MISSING = "EXPLICIT", "EXTRACTED", "INFERRED_WITH_STRONG_EVIDENCE", "AMBIGUOUS", "NOT_FOUND"
#: The confidence of a state (others: 0), and the kinds of employment.
CONFIDENCE = {STRONG: 0.95, FOUND: 0.80, INFERRED: 0.70}
EMPLOYMENT = {"Full-time": "FULL_TIME", "Part-time": "PART_TIME", "Internship": "INTERNSHIP", "Contract": "CONTRACT", "Temporary": "TEMPORARY", "Freelance": "CONTRACT"}
#: Signs that an employer is hidden on purpose, that a third party posts, and names of posters that recruit.
HIDDEN_RX = [r"not\s+to\s+disclose", r"company\s+not\s+disclosed", r"name\s+(?:withheld|not\s+disclosed)", r"\bconfidential\b[^.\n]{0,30}\b(?:company|employer|client)\b", r"\bstealth\b[^.\n]{0,30}\b(?:startup|company|mode)\b", r"undisclosed\s+(?:company|employer|client)"]
THIRD_PARTY_RX = [r"agreement\s+with\s+(?:our\s+)?client", r"for\s+our\s+client", r"on\s+behalf\s+of\s+(?:our\s+)?client", r"vendor\s+partner", r"staffing\s+(?:agency|firm|partner)", r"recruitment\s+agency", r"\bi\s+am\s+not\s+hiring\b", r"share\s+job\s+to\s+help\s+job\s+seekers", r"for\s+regular\s+.*job\s+updates"]
RECRUITER_NAME_RX = [r"staffing", r"recruit(?:ment|ing|er)", r"hiring\s*hub", r"job\s*hub", r"\btalent\b", r"refer\s*me", r"pagaar"]
AT_HIRING_RX = r"\bAt\s+([A-Z][A-Za-z0-9&\.\-]*(?:[ \t]+[A-Z][A-Za-z0-9&\.\-]*){0,3}),?\s+we\s+are\s+hiring\b"
ROLE_LABEL_RX = r"(?i)(?:role|position|job\s+title|title|opening|vacancy|designation)\s*[:|\-–—]\s*"


def first_of_patterns(d: Dialect, col: str, patterns: list[str]) -> str:
    """The text that the first pattern that is met finds, 120 characters at most; '' if none is."""
    found = ", ".join(f"nullif(trim({d.extract(col, '(?i)' + p)}), '')" for p in patterns)
    return f"substring(coalesce({found}, ''), 1, 120)"


def company(d: Dialect) -> tuple[str, str, str]:
    """Columns to prepare, the state and the evidence of a company; a name that the post does not state is kept as extracted."""
    name = lambda candidate: R.first_of(d, R.companies(d, [candidate]))
    card = f"CASE WHEN job_card_company <> 'Unclear' THEN {name('job_card_company')} ELSE '' END"
    known = d.extract("t", r"\b" + R.alternation(L.KNOWN_EMPLOYERS) + r"\b")
    columns = f"{name(d.extract('text', L.JOIN_COMPANY_RX, 1))} AS joined, {name(R.first_of(d, d.all_rx('text', L.IS_HIRING_RX, 1)))} AS hirer, {name(d.extract('text', AT_HIRING_RX, 1))} AS at_name, {card} AS card_name, {known} AS known_name"
    told = d.case([("joined <> ''", "joined"), ("hirer <> ''", "hirer"), ("at_name <> ''", "at_name"), ("card_name <> ''", "card_name")], "''")
    hiring = R.first_of(d, d.filter(d.all_rx("text", L.IS_HIRING_RX, 0), "x", "contains(x, hirer)"))
    shown = d.case(
        [("joined <> ''", "'Join ' || joined"), ("hirer <> ''", f"coalesce(nullif(substring({hiring}, CAST(greatest(1, instr({hiring}, hirer)) AS INT), 120), ''), hirer || ' is hiring')"), ("at_name <> ''", f"substring(trim({d.extract('text', AT_HIRING_RX)}), 1, 120)"), ("card_name <> ''", "'job card company: ' || card_name")],
        "''",
    )
    state = d.case([("company_name <> 'Unclear' AND told = company_name", f"'{STRONG}'"), ("company_name <> 'Unclear'", f"'{FOUND}'"), ("known_name <> ''", f"'{INFERRED}'"), ("hidden <> '' OR third_party <> ''", f"'{MISSING}'"), (f"{d.size(R.employers(d))} >= 2", f"'{AMBIGUOUS}'")], f"'{MISSING}'")
    evidence = d.case([("company_name <> 'Unclear' AND told = company_name", "shown"), ("company_name <> 'Unclear'", "'company kept as found'"), ("known_name <> ''", "'known employer named (not attributed): ' || known_name"), ("hidden <> '' OR third_party <> ''", "coalesce(nullif(hidden, ''), third_party)")], "'no employer evidence'")
    return f"{columns}, company_name AS unresolved", f"{told} AS told, {shown} AS shown", f"{state} AS company_state, {evidence} AS company_evidence"


def role(d: Dialect) -> tuple[str, str]:
    """State and evidence of a role: in the words of a label, or found in the text."""
    value = "lower(substring(exact_role, 1, 30))"
    label = d.all_rx("text", "(" + ROLE_LABEL_RX.replace("(?i)", "(?i:", 1) + r").{0,70})", 1)
    at = f"instr(lower(x), {value})"
    labels = d.filter(label, "x", f"{at} > 0 AND {at} - length({d.extract('x', ROLE_LABEL_RX)}) <= 41")
    shown = f"substring({R.first_of(d, d.transform(labels, 'x', f'trim(substring(x, 1, CAST({at} + length({value}) - 1 AS INT)))'))}, 1, 120)"
    fused = d.rx("exact_role", r"https?://|lnkd\.in|📍|📌")
    state = d.case([("exact_role = 'Unclear'", f"'{MISSING}'"), (fused, f"'{AMBIGUOUS}'"), ("role_label <> ''", f"'{STRONG}'")], f"'{FOUND}'")
    evidence = d.case([("exact_role = 'Unclear'", "'no role extracted'"), (fused, "'link or sign fused into the title'"), ("role_label <> ''", "role_label")], "'verbatim title in post'")
    return f"{shown} AS role_label", f"{state} AS role_state, {evidence} AS role_evidence"


def manager(d: Dialect) -> tuple[str, str, str]:
    """State, evidence and relation of a manager: only what the post shows resolves."""
    person = "(contains(lower(author_profile_url), '/in/') AND NOT contains(lower(author_profile_url), '/company/'))"
    itself = f"{person} AND lower(trim(manager_name)) = lower(trim(author_name))"
    hires = d.rx("text", r"(?i)\b(?:i['’]?m|we['’]?re)\s+hiring\b")
    ev = "manager_evidence"
    recruiter = f"CASE WHEN {d.any_rx('author_name', RECRUITER_NAME_RX, '(?i)')} OR third_party <> '' THEN 'AGENCY_RECRUITER' ELSE 'RECRUITER' END"
    rules = [
        (f"manager_name = '' AND {hires} AND NOT {person}", MISSING, "'hiring-side post, author not a person'", "'POSTER_ONLY'"),
        ("manager_name = ''", MISSING, "'no hiring-side evidence'", "'NOT_FOUND'"),
        (f"{ev} LIKE 'named in post:%'", STRONG, ev, "'DIRECT_HIRING_PERSON'"),
        (f"{ev} LIKE 'recruiter signature%'", STRONG, ev, recruiter),
        (f"{ev} LIKE 'author states hiring side%' AND {itself}", STRONG, ev, "'DIRECT_HIRING_PERSON'"),
        (f"{ev} LIKE 'author states hiring side%'", AMBIGUOUS, "'name and evidence do not match'", "'AMBIGUOUS'"),
        (f"{ev} <> ''", INFERRED, ev, "'HIRING_TEAM_MEMBER'"),
    ]
    pick = lambda k, other: d.case([(r[0], f"'{r[1]}'" if k == 1 else r[k]) for r in rules], other)
    return pick(1, f"'{AMBIGUOUS}'"), f"substring({pick(2, chr(39) + 'name without evidence' + chr(39))}, 1, 120)", pick(3, "'AMBIGUOUS'")


def resolved(d: Dialect) -> str:
    """(ingest_seq, field, value, state, evidence, confidence, detail): six rows a post, made in one pass over its fields."""
    prepared, told, company_label = company(d)
    label, role_label = role(d)
    hm_state, hm_evidence, hm_detail = manager(d)
    unclear = d.case([("company_name <> 'Unclear'", "'EXPLICIT_EMPLOYER'"), ("third_party <> ''", "'INTERMEDIARY_CLIENT_UNDISCLOSED'"), ("hidden <> '' AND known_name = ''", "'EMPLOYER_UNDISCLOSED'")], "'EXTRACTION_UNRESOLVED'")
    place_state = d.case([("location = 'Not Specified'", f"'{MISSING}'"), ("job_card_location <> '' AND contains(lower(job_card_location), lower(location))", f"'{STRONG}'"), ("geo_evidence <> 'none'", f"'{STRONG}'")], f"'{FOUND}'")
    place_evidence = d.case([("location = 'Not Specified'", "'no location evidence'"), ("job_card_location <> '' AND contains(lower(job_card_location), lower(location))", "'job card: ' || substring(trim(job_card_location), 1, 120)"), ("geo_evidence <> 'none'", "substring(trim(geo_evidence), 1, 120)")], "'post text'")
    kind = d.case([(f"employment_type = {d.lit(k)}", f"'{v}'") for k, v in EMPLOYMENT.items()], "'UNKNOWN'")
    years = d.extract("text", r"(?i)\d+\s*(?:\+|-|–)?\s*\d*\s*(?:years?|yrs?)|fresher")
    rows = [
        ("company", "company_name", "company_state", "company_evidence", unclear),
        ("role", "exact_role", "role_state", "role_evidence", "''"),
        ("location", "location", place_state, place_evidence, "''"),
        ("employment_type", "employment_type", f"CASE WHEN {kind} = 'UNKNOWN' THEN '{MISSING}' ELSE '{STRONG}' END", f"CASE WHEN {kind} = 'UNKNOWN' THEN 'employment unstated' ELSE 'explicit employment token: ' || employment_type END", kind),
        ("experience", "experience", f"CASE WHEN experience = 'Not Specified' THEN '{MISSING}' ELSE '{FOUND}' END", f"CASE WHEN experience = 'Not Specified' THEN 'no experience stated' ELSE coalesce(nullif(substring(trim({years}), 1, 60), ''), 'post text') END", "''"),
        ("hiring_manager", "coalesce(nullif(manager_name, ''), 'Unclear')", hm_state, hm_evidence, hm_detail),
    ]
    made = d.array([d.struct(field=f"'{f}'", value=v, state=s, evidence=e, detail=x) for f, v, s, e, x in rows])
    confidence = d.case([("r.field = 'company' AND r.value = 'Unclear'", "CAST(0 AS DOUBLE)"), *((f"r.state = '{s}'", f"CAST({c} AS DOUBLE)") for s, c in CONFIDENCE.items())], "CAST(0 AS DOUBLE)")
    third = f"coalesce(nullif({first_of_patterns(d, 'text', THIRD_PARTY_RX)}, ''), CASE WHEN {d.any_rx('author_name', RECRUITER_NAME_RX, '(?i)')} THEN 'agency-shaped poster: ' || substring(trim(author_name), 1, 80) ELSE '' END)"
    source = f"SELECT *, {company_label}, {role_label} FROM (SELECT *, {told} FROM (SELECT *, {prepared}, {label}, {first_of_patterns(d, 'text', HIDDEN_RX)} AS hidden, {third} AS third_party FROM fields) a) b"
    return f"SELECT ingest_seq, r.field AS field, r.value AS value, r.state AS state, r.evidence AS evidence, {confidence} AS confidence, r.detail AS detail FROM ({d.explode(f'({source}) c', made, 'ingest_seq', 'r')}) e"
