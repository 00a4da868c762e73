"""The relations that queries are built on, as named SQL: each adds columns to the one before, and no post ever disappears."""

from __future__ import annotations

from signalforge.functions import lexicon as L
from signalforge.functions.dialect import Dialect, alternation
from signalforge.sources import posts as P

TITLES = [*L.DATA_ANALYST, *L.DATA_SCIENTIST]
#: The hiring terms to which a role must be near.
SIGNALS = [*L.HIRING_SIGNALS, *L.VACANCY_LABELS]


def q(d: Dialect, s: str) -> str:
    return d.lit(s)


NEVER = "1000000000"


def employer_context(d: Dialect) -> str:
    """Whether a text speaks for an employer, not for someone who seeks work."""
    opening = d.rx("t", r"\b(?:interested|share|refer)\s+.*\bopening\b")
    return f"({d.any_rx('t', L.EMPLOYER_STRONG_RX)} OR ({d.any_rx('t', L.EMPLOYER_SUPPORT_RX)} AND {opening}))"


#: Words of which each pattern of a family needs one: looked for first, as that is cheap.
FO_FAMILY, DATA_FAMILY = ["founder", "chief"], ["analyst", "scientist", "analytics associate"]


def signals(d: Dialect) -> str:
    """Role, hiring and framing signals of each post's normalised text.

    Of data titles, conditional titles and framed fields the earliest in the text counts, of those the longest.
    """
    t = "t"
    analyst = f"{d.has(t, 'business analyst')} AND ({d.any_of(t, L.STRONG_DATA_EVIDENCE)} OR ({d.any_of(t, L.BUSINESS_ANALYST_EVIDENCE)} AND NOT {d.any_of(t, L.BUSINESS_ANALYST_NEGATIVE)}))"
    applied = f"{d.has(t, 'applied scientist')} AND {d.any_of(t, L.APPLIED_SCIENTIST_EVIDENCE)}"
    framed = f"data_strong AND field_first <> '' AND NOT {d.rx(t, L.FRAMED_OTHER_TITLE_RX)}"
    at = lambda test, word: f"CASE WHEN {test} THEN instr(t, {word}) ELSE {NEVER} END"
    keyword = d.case(
        [
            (f"title_at < {NEVER} AND title_at <= least(analyst_at, applied_at, field_at)", "data_first"),
            (f"analyst_at < {NEVER} AND analyst_at <= least(applied_at, field_at)", q(d, "business analyst")),
            (f"applied_at < {NEVER} AND applied_at <= field_at", q(d, "applied scientist")),
            (f"field_at < {NEVER}", "field_first"),
        ],
        q(d, ""),
    )
    category = d.case([(d.isin("data_keyword", [*L.DATA_SCIENTIST, "applied scientist", "data science"]), q(d, "Data Scientist")), ("data_keyword <> ''", q(d, "Data Analyst"))], q(d, ""))
    return f"""SELECT *, {category} AS data_category
 FROM (SELECT *, {keyword} AS data_keyword
 FROM (SELECT *, {at("data_first <> ''", "data_first")} AS title_at, {at(analyst, q(d, "business analyst"))} AS analyst_at, {at(applied, q(d, "applied scientist"))} AS applied_at,
 {at(framed, "field_first")} AS field_at
 FROM (SELECT *, {d.first_word(t, L.FOUNDERS_OFFICE)} AS fo_keyword, {d.first_word(t, L.CHIEF_OF_STAFF)} AS cos_keyword, {d.extract(t, alternation(TITLES))} AS data_first,
 {d.extract(t, alternation(L.DATA_FIELDS))} AS field_first,
 {employer_context(d)} AS employer_context,
 ({d.any_of(t, FO_FAMILY)} AND {d.any_rx(t, L.FO_STRONG_RX)}) AS fo_strong, {d.any_rx(t, L.FO_WEAK_RX)} AS fo_weak,
 ({d.any_of(t, DATA_FAMILY)} AND {d.any_rx(t, L.DATA_STRONG_RX)}) AS data_strong, {d.any_rx(t, L.DATA_WEAK_RX)} AS data_weak,
 {d.first_word(t, L.HIRING_SIGNALS)} AS hiring_signal, {d.first_word(t, L.VACANCY_LABELS)} AS vacancy_label FROM posts) p) a) k"""


def roles(d: Dialect) -> str:
    """One role category a post; where both families are named, data wins only if it alone is framed as the vacancy."""
    fo = "(fo_keyword <> '' OR cos_keyword <> '')"
    data = f"(data_category <> '' AND (NOT {fo} OR (data_strong AND NOT fo_strong)))"
    return f"""SELECT *, CASE WHEN {data} THEN data_category WHEN fo_keyword <> '' THEN {q(d, "Founder's Office")} WHEN cos_keyword <> '' THEN 'Chief of Staff' ELSE 'None' END AS major_category,
 CASE WHEN {data} THEN data_keyword WHEN fo_keyword <> '' THEN fo_keyword ELSE cos_keyword END AS role_keyword FROM signals"""


def near(d: Dialect) -> str:
    """The least gap between the post's own role word and any hiring signal, and that signal.

    Ties: the earliest role, then the first signal in list and place order. All places of a post are made and compared
    within its row, so nothing is joined or moved. Spark finds the places of all signals by one automaton; the checking
    engine makes all pairs of places in SQL.
    """
    if d.name == "spark":
        return "SELECT * EXCEPT (best), best.gap AS gap, best.term AS nearest_signal FROM (SELECT *, nearest_term(t, role_keyword) AS best FROM roles) n"
    signals = d.array([q(d, w) for w in SIGNALS])
    one = d.struct(p="p", ord=d.place_in(signals, "w"), word="w")
    found = f"flatten({d.transform(d.filter(signals, 'w', 'contains(t, w)'), 'w', d.transform(d.places('t', 'w'), 'p', one))})"
    gap = "CAST(greatest(0, s.p - r - length(role_keyword), r - s.p - length(s.word)) AS BIGINT)"
    pairs = f"flatten({d.transform('role_places', 'r', d.transform('signal_places', 's', d.struct(gap=gap, r='r', ord='s.ord', p='s.p', word='s.word')))})"
    return f"""SELECT *, best.gap AS gap, best.word AS nearest_signal
 FROM (SELECT *, CASE WHEN {d.size('signal_places')} > 0 THEN {d.get(d.sort(pairs), 0)} END AS best
 FROM (SELECT *, CASE WHEN role_keyword <> '' THEN {d.places('t', 'role_keyword')} END AS role_places, CASE WHEN role_keyword <> '' THEN {found} END AS signal_places FROM roles) r) n"""


def gaps(d: Dialect) -> str:
    """Posts with a role and a signal: the gap, the signal and the role."""
    return "SELECT ingest_seq, gap, nearest_signal, role_keyword AS nearest_role FROM near WHERE gap IS NOT NULL"


def _geo_marks(d: Dialect, col: str) -> tuple[str, str, str, str]:
    """Decisive marker, place, company form, and a neighbouring country, in a text without misleading names."""
    body = d.replace(col, L.GEO_TRAPS_RX, " ")
    return d.extract(body, L.GEO_DECISIVE_RX, 1), d.extract(body, L.GEO_PLACES_RX, 1), d.extract(body, L.GEO_COMPANY_FORM_RX, 1), d.rx(body, L.GEO_NEIGHBOURS_RX)


def geo(d: Dialect) -> str:
    """India or not, by the job card first and the text after it, with the evidence."""
    card = d.replace("job_card_location", L.GEO_TRAPS_RX, " ")
    marker, place, form, neighbour = _geo_marks(d, "text")
    city = d.rx("t", r"(^|[^a-z])" + alternation([c for c in L.INDIA_CITIES if "india" not in c]) + r"(?:jobs?)?($|[^a-z])")
    evidence = d.case(
        [
            ("card_says = 'foreign'", "'job location outside India: ' || job_card_location"),
            ("card_says = 'india'", "'job location: ' || job_card_location"),
            ("job_card_location <> ''", "'job location not recognised as India: ' || job_card_location"),
            ("geo_marker <> ''", "'marker: ' || trim(geo_marker)"),
            ("geo_place <> ''", "'place: ' || trim(geo_place)"),
            ("geo_form <> '' AND NOT geo_neighbour", "'company form: ' || trim(geo_form)"),
        ],
        "'none'",
    )
    return f"""SELECT *, CASE WHEN job_card_location <> '' THEN card_says = 'india' ELSE geo_marker <> '' OR geo_place <> '' OR (geo_form <> '' AND NOT geo_neighbour) END AS is_india,
 {evidence} AS geo_evidence
 FROM (SELECT *, CASE WHEN job_card_location = '' THEN '' WHEN {d.rx(card, L.GEO_FOREIGN_RX)} THEN 'foreign' WHEN {d.rx(card, L.GEO_PLACES_RX)} THEN 'india' ELSE 'unknown' END AS card_says,
 {marker} AS geo_marker, {place} AS geo_place, {form} AS geo_form, {neighbour} AS geo_neighbour,
 {city} OR {d.rx('t', r'{b}india(?:n|s)?{b}|remote - india|remote india'.format(b=chr(92) + 'b'))} AS has_city,
 {d.any_rx('t', [chr(92) + 'b' + alternation(L.NON_INDIA) + chr(92) + 'b', *L.NON_INDIA_RX])} AS has_foreign,
 {d.rx('t', r'remote|(^|{s})wfh($|{s})'.format(s=chr(92) + 's'))} AS has_remote, {d.rx('t', 'global|worldwide')} AS has_global FROM near) g"""


def markets(d: Dialect) -> str:
    """The market of each post, '' where India is not established: card and text first, then author and card company, then known employers."""
    known = d.rx("t", r"\b" + alternation(L.KNOWN_EMPLOYERS) + r"\b")
    marker, place, form, neighbour = _geo_marks(d, "(lower(author_name) || ' ' || CASE WHEN job_card_company = 'Unclear' THEN '' ELSE lower(job_card_company) END)")
    context = f"({marker} <> '' OR {place} <> '' OR ({form} <> '' AND NOT {neighbour}))"
    here = "(has_city OR card_says = 'india')"
    return f"""SELECT *, CASE WHEN card_says = 'foreign' THEN '' WHEN {here} AND (has_global OR has_foreign) THEN 'India + Global' WHEN {here} AND has_remote THEN 'Remote - India' WHEN {here} THEN 'India'
 WHEN has_foreign THEN '' WHEN {context} OR {known} THEN 'India' ELSE '' END AS market FROM geo"""


def employers(d: Dialect) -> str:
    """The different names of which a text says that they hire: of a name that runs over a sentence's end, what follows it."""
    name = d.replace(d.replace("x", r"^.*\.\s+", ""), r"\.+$", "")
    names = d.transform(d.all_rx("text", L.EMPLOYER_SUBJECT_RX, 1), "x", f"lower(trim({d.replace(name, chr(92) + 's+', ' ')}))")
    return d.distinct(d.filter(names, "x", f"x <> '' AND NOT {d.isin('x', L.MULTI_EMPLOYER_STOPWORDS)}"))


def gated(d: Dialect) -> str:
    """The first gate that each post fails, in the order of the gates; '' for posts that pass.

    Patterns that few posts reach stand in the gates themselves, so that they are not run on all posts as columns would be.
    """
    t = "t"
    target = "major_category <> 'None'"
    data = "major_category IN ('Data Analyst', 'Data Scientist')"
    entry = d.replace(t, L.NOT_DATA_ENTRY_RX, "")
    seeker = f"{d.size(d.filter(d.all_rx(t, '(?:i am|i.m) looking for a ([^' + chr(92) + 'n]*)', 1), 'x', 'contains(x, role_keyword)'))} > 0"
    # Of "career opportunities" one place outside a promotion is enough.
    spaced = d.replace(t, r"career\s+opportunities", "career opportunities")
    window = f"substring({spaced}, CAST(greatest(1, p - 119) AS INT), CAST(p - greatest(0, p - 120) + 100 AS INT))"
    career = f"({d.has(t, 'career')} AND {d.size(d.filter(d.places(spaced, q(d, 'career opportunities')), 'p', 'NOT ' + d.rx(window, L.PROMO_RX)))} > 0)"
    gates = [
        (f"{d.rx(t, L.INTERNSHIP_RX)} AND NOT ({target})", "internship"),
        (d.any_rx(t, L.PAY_TO_APPLY_RX), "pay to apply"),
        (d.any_of(t, L.JOB_SEEKER), "job seeker phrase"),
        (d.any_rx(t, L.ALWAYS_REJECT_RX), "job seeker always"),
        (f"{d.any_rx(t, L.JOB_SEEKER_RX)} AND NOT {employer_context(d)}", "job seeker pattern"),
        (d.any_of(t, L.CONGRATULATORY), "congratulatory"),
        (d.any_of(t, L.INFORMATIONAL), "informational"),
        (f"NOT ({target}) AND {d.rx(t, r'(^|{s})fo($|{s})'.format(s=chr(92) + 's'))}", "no target role (fo without proof)"),
        (f"NOT ({target})", "no target role"),
        (f"{data} AND {d.rx(entry, L.DATA_ENTRY_RX)}", "data entry"),
        ("gap IS NULL", "no hiring signal"),
        ("gap > 300", "signal too far"),
        (f"{seeker} AND NOT {employer_context(d)}", "first person seeker"),
        (d.any_rx(t, L.AGGREGATOR_RX), "aggregator"),
        (career, "aggregator (career opportunities)"),
        (f"{d.count_rx(t, 'company' + chr(92) + 's*:')} >= 3", "company labels"),
        (f"{d.size(employers(d))} >= 2", "several employers"),
        (f"NOT fo_strong AND {d.any_rx(t, L.FO_WEAK_RX)}", "role context"),
        (f"{data} AND NOT data_strong AND {d.any_rx(t, L.DATA_WEAK_RX)}", "data context"),
        (f"{data} AND NOT data_strong AND {d.isin('role_keyword', [*L.DATA_FIELDS, 'business analyst'])}", "data context (not framed)"),
        ("card_says = 'foreign'", "india relevance (job card)"),
        ("market = '' AND has_foreign", "india relevance (abroad)"),
        ("market = ''", "india relevance (unclear)"),
    ]
    return f"SELECT *, {d.case([(c, q(d, r)) for c, r in gates], q(d, ''))} AS reject_reason FROM markets"


def sentences(d: Dialect, col: str) -> str:
    """col cut after sentence ends and at line ends."""
    return d.split(d.replace(col, r"([.!?])\s+", "$1" + chr(1)), chr(1) + r"|\n+")


def first_of(d: Dialect, array: str, otherwise: str = "''") -> str:
    return f"coalesce({d.get(array, 0)}, {otherwise})"


def companies(d: Dialect, candidates: list[str]) -> str:
    """The valid company names of some candidates, in order: leading capitalised words and connectors, not generic ones."""
    connectors = "(?i:" + "|".join(L.NAME_CONNECTORS) + ")"
    word = r"[^A-Za-z0-9 ]*[A-Z0-9][^ ]*"
    one_line = f"trim({d.replace(d.replace('x', chr(92) + 'n' + '(?s:.*)$'), chr(92) + 's+', ' ')})"
    kept = d.replace(d.extract(one_line, f"^{word}(?: (?:{word}|{connectors}))*"), f"(?: {connectors})+$")
    cut = d.transform(d.filter(d.array(candidates), "x", "x <> '' AND length(x) < 40"), "x", d.replace(kept, r"^[.,:;!?\"']+|[.,:;!?\"']+$"))
    generic = "^(?:[^a-z0-9]*(?:" + "|".join(L.GENERIC_DESCRIPTORS) + ")(?:[^a-z0-9]+|$))+$"
    return d.filter(cut, "x", f"length(x) > 1 AND NOT {d.isin('lower(x)', [*L.NON_COMPANY, *L.PLACEHOLDER_COMPANIES])} AND NOT {d.rx('lower(x)', generic)}")


def title_of(d: Dialect) -> tuple[str, str]:
    """For the words after a role: the numbers of those that end the title, and the words before the first of them."""
    stop = f"{d.isin('w', [',', ')', '(', '|', ':', ';'])} OR {d.rx('w', '^#|^http|://')} OR {d.rx('lower(w)', '^(?:lnkd.in|forms.gle|bit.ly|tinyurl.com)')} OR {d.rx('w', '^[0-9]+(?:[.][0-9]+)?(?:-?[0-9]+)?$')} OR {d.isin('lower(w)', ['lpa', 'inr', 'ctc', 'apply', 'applynow', 'please'])} OR (NOT {d.rx('w', '[A-Za-z0-9]')} AND (nth > 0 OR NOT {d.isin('w', ['-', '–', '—', '|', '/', ':'])}))"
    stops = d.filter(d.indexed("tail_words", "w", "nth", f"CASE WHEN {stop} THEN nth END"), "x", "x IS NOT NULL")
    tail = f"CASE WHEN title_stop = 1 AND {d.get('tail_words', 0)} = '-' THEN '' ELSE {d.replace(d.join(d.head('tail_words', 'title_stop'), ' '), '^[ ,:;]+|[ ,:;]+$')} END"
    return stops, tail


def passing(d: Dialect) -> str:
    """Every post, with its text only where it passed the gates: what follows looks at no rejected text."""
    return f"SELECT {d.without('text', 't')}, CASE WHEN reject_reason = '' THEN text ELSE '' END AS text, CASE WHEN reject_reason = '' THEN t ELSE '' END AS t FROM gated"


def fields(d: Dialect, source: str = "gated") -> str:
    """The fields extracted from each post's text and card, and the confidence in hundredths."""
    mails = d.transform(d.all_rx("text", L.EMAIL_RX), "x", d.rtrim("x", ".,;:!?)]}'\""))
    real = d.filter("emails", "x", f"NOT {d.isin('lower(split_part(x, ' + q(d, '@') + ', 1))', L.NON_CONTACT_LOCALS)}")
    personal = d.rx("lower(split_part(x, '@', 2))", r"(?:^|\.)" + alternation(L.PERSONAL_DOMAINS) + "$")
    around = "substring(text, CAST(greatest(1, instr(text, x) - 250) AS INT), CAST(least(instr(text, x) - 1, 250) + 80 AS INT))"
    cold = f"coalesce({d.get('business_emails', 0)}, {d.get(d.filter('real_emails', 'x', d.rx(around, L.APPLICATION_PURPOSE_RX)), 0)}, 'Not Available')"
    ctc = d.extract("text", r"(?i)(₹?\d+[\-\s]?\d*\s*(?:LPA|lpa|Cr|cr|lakhs?|k|K)|CTC\s*[:=]?\s*₹?\d+)", 1)
    experience = d.extract("text", r"(?i)(\d+[\-\+]?\d*\s*(?:years?|yrs?|yr)|fresher|freshers welcome)", 1)
    form = d.rtrim(d.extract("text", L.GOOGLE_FORM_RX), L.URL_TAIL)
    links = d.filter(d.transform(d.all_rx("text", L.URL_RX), "x", d.rtrim("x", L.URL_TAIL)), "x", f"NOT {d.has('lower(x)', 'linkedin.com')}")
    before = "substring(text, CAST(greatest(1, instr(text, x) - 200) AS INT), CAST(least(instr(text, x) - 1, 200) AS INT))"
    after = f"{d.replace('substring(text, CAST(instr(text, x) + length(x) AS INT), 120)', '(?s)[.!?].*$')}"
    told = lambda window: d.get(d.filter("links", "x", d.rx(window, L.APPLY_CUE_RX)), 0)
    kind = d.case(
        [("job_card_employment_type NOT IN ('Unclear', 'job')", "job_card_employment_type"), (d.rx("t", "full-time|full time|permanent"), "'Full-time'"), (d.has("t", "contract"), "'Contract'"), (d.rx("t", "part-time|part time"), "'Part-time'"), (d.has("t", "internship"), "'Internship'"), (d.has("t", "freelance"), "'Freelance'"), (d.has("t", "temporary"), "'Temporary'")],
        "'Unclear'",
    )
    hirers = d.filter(d.all_rx("text", L.IS_HIRING_RX, 1), "x", f"NOT {d.rx('x', '^(?:We|I|It|They|You|He|She|Who|What|Which|That)(?:[^A-Za-z]|$)')}")
    named = companies(d, [d.extract("text", L.JOIN_COMPANY_RX, 1), first_of(d, hirers), d.extract("text", L.AT_COMPANY_RX, 1), d.extract("text", L.HIRING_AT_RX, 1), d.extract("text", L.HIRING_FOR_RX, 1)])
    company = f"coalesce({d.get('named_companies', 0)}, {d.get(companies(d, [d.case([('job_card_company <> ' + q(d, 'Unclear'), 'job_card_company')], q(d, ''))]), 0)}, 'Unclear')"

    named_in = lambda col: d.transform(d.all_rx(col, r"(?:^|[^a-z])" + alternation([c for c in L.INDIA_CITIES if "india" not in c]).replace("(?:", "(", 1) + r"(?:jobs?)?(?:$|[^a-z])", 1), "x", "replace(x, 'bangalore', 'bengaluru')")

    def places(found: str) -> str:
        """The names of the list, in its order, that the found ones are or hold. (Named twice, `found` is computed once a row.)"""
        held = d.size(d.filter(found, "f", "contains(' ' || f || ' ', ' ' || c || ' ')"))
        return f"CASE WHEN {d.size(found)} > 0 THEN {d.filter(d.array([q(d, c) for c in L.PLACE_NAMES]), 'c', f'{held} > 0')} ELSE {found} END"

    cities = d.filter("all_places", "x", f"NOT {d.isin('x', L.INDIA_STATES)}")
    shown = d.transform(f"CASE WHEN {d.size('all_places')} > 1 AND {d.size(cities)} > 0 THEN {cities} ELSE all_places END", "x", d.title("x"))
    location = f"CASE WHEN {d.size('all_places')} > 0 THEN location_raw WHEN {d.size('card_places')} > 0 THEN {d.title(d.get('card_places', 0))} WHEN has_remote THEN 'Remote' ELSE 'Not Specified' END"
    stops, tail = title_of(d)
    role_at = "substring(text, CAST(instr(text, role_words) + length(role_words) AS INT))"
    sentence = d.replace(d.replace(f"trim({role_at})", r"(?s)([.;:!?])\s.*$", "$1"), r"\.\s*$")
    tail_text = f"trim({d.replace(sentence, r'(?s)(?:^|{s})(?:in|at|based{s}+in|located{s}+in|for|across|within)(?:{s}.*|$)'.format(s=chr(92) + 's'))})"
    rank = d.extract("rtrim(substring(text, 1, CAST(greatest(0, instr(text, role_words) - 1) AS INT)))", L.SENIORITY_RX, 1)
    good_tail = f"title_tail <> '' AND NOT {d.rx('title_tail', '(?i)^(?:is|are|we|apply|please|[0-9]|hiring|join|and)')}"
    role = f"CASE WHEN role_words = '' THEN 'Unclear' ELSE rtrim(substring(trim({rank} || ' ' || role_words || CASE WHEN {good_tail} THEN ' ' || title_tail ELSE '' END), 1, 120)) END"
    context = first_of(d, d.filter(d.transform(d.all_rx("text", L.MANAGER_CONTEXT_RX, 1), "x", d.replace("x", r"\s+", " ")), "x", f"length(x) > 3 AND x <> upper(x) AND NOT {d.rx('x', L.COMPANY_LIKE_RX)}"))
    founder = d.extract("text", L.NAMED_LEADER_RX, 1)
    # A signature block with what follows it; a sign-off at the end of the text with what stands around it.
    blocks = d.filter(d.all_rx("text", "(" + L.SIGNATURE_RX + r"[\s\S]{0,120})", 1), "x", f"{d.rx(d.extract('x', '[|｜]([^|' + chr(92) + 'n]*)', 1), L.SIGNATURE_TITLE_RX)} AND {d.rx(d.replace('x', '^[^' + chr(92) + 'n]*'), L.SIGNATURE_CONTACT_RX)} AND {d.rx(d.extract('x', L.SIGNATURE_RX, 1), L.PROPER_NAME_RX)}")
    ends = d.filter(d.all_rx("substring(text, CAST(greatest(1, length(text) - 599) AS INT))", r"([\s\S]{0,60}?" + L.SIGNOFF_RX + r"[\s\S]{0,140})", 1), "x", f"{d.rx('x', L.SIGNATURE_CONTACT_RX)} AND {d.rx(d.extract('x', L.SIGNOFF_RX, 1), L.PROPER_NAME_RX)}")
    # Most texts have neither a bar nor a sign-off line; the wide patterns run on the others only.
    blocks = f"CASE WHEN {d.rx('text', '[|｜]')} THEN {blocks} END"
    ends = f"CASE WHEN {d.has('text', chr(10))} AND {d.rx('text', L.SIGNOFF_RX)} THEN {ends} END"
    signed = f"coalesce({d.extract(d.get(blocks, 0), L.SIGNATURE_RX, 1)}, {d.extract(d.get(ends, 0), L.SIGNOFF_RX, 1)}, '')"
    author = f"CASE WHEN contains(lower(author_profile_url), '/in/') AND NOT contains(lower(author_profile_url), '/company/') AND {d.any_of('t', L.AUTHOR_HIRING)} THEN author_name ELSE '' END"
    tier = d.case([("manager_context <> ''", "'CONTEXT'"), ("manager_founder <> ''", "'FOUNDER'"), ("manager_signature <> ''", "'SIGNATURE'"), ("manager_author <> ''", "'AUTHOR'")], "'NONE'")
    own_link = first_of(d, d.filter(d.transform(d.filter(sentences(d, "text"), "x", "contains(x, manager_context)"), "x", d.extract("x", L.PROFILE_RX)), "x", "x <> ''"))
    link = d.case([("manager_tier = 'CONTEXT'", own_link), ("manager_tier = 'AUTHOR'", "author_profile_url")], "''")
    evidence = d.case([("manager_tier = 'CONTEXT'", "manager_context"), ("manager_tier = 'FOUNDER'", "'named in post: ' || manager_founder"), ("manager_tier = 'SIGNATURE'", "'recruiter signature in post: ' || manager_signature"), ("manager_tier = 'AUTHOR'", "'author states hiring side: ' || " + d.first_word("t", L.AUTHOR_HIRING))], "''")
    one = lambda test, n: f"CASE WHEN {test} THEN {n} ELSE 0 END"
    score = f"least(100, 60 + CASE WHEN gap <= 100 THEN 15 WHEN gap <= 300 THEN 10 ELSE 0 END + {one('market <> ' + q(d, ''), 10)} + {one('company_name <> ' + q(d, 'Unclear'), 5)} + {one('ctc <> ' + q(d, 'Not Disclosed'), 5)} + {one('cold_email <> ' + q(d, 'Not Available') + ' OR ' + d.has('t', 'dm') + ' OR ' + d.has('t', 'apply'), 5)} + {one('experience <> ' + q(d, 'Not Specified'), 2)})"
    return f"""SELECT *, CAST({score} AS DOUBLE) / 100 AS confidence, {link} AS manager_link, {evidence} AS manager_evidence
 FROM (SELECT *, {tier} AS manager_tier, coalesce(nullif(manager_context, ''), nullif(manager_founder, ''), nullif(manager_signature, ''), manager_author) AS manager_name,
 {location} AS location, {cold} AS cold_email, {company} AS company_name, {role} AS exact_role,
 CASE WHEN google_form <> '' THEN google_form ELSE coalesce({told(before)}, {told(after)}, '') END AS apply_link
 FROM (SELECT *, {d.filter('real_emails', 'x', 'NOT ' + personal)} AS business_emails, {d.join(shown, ' / ')} AS location_raw, {tail} AS title_tail
 FROM (SELECT *, {real} AS real_emails, CAST(least(8, coalesce({d.get(stops, 0)}, 8)) AS INT) AS title_stop
 FROM (SELECT *, {mails} AS emails, {d.split(tail_text, chr(92) + 's+')} AS tail_words, {places('found_in_text')} AS all_places, {places('found_in_card')} AS card_places, {named} AS named_companies, {links} AS links,
 coalesce(nullif(trim({ctc}), ''), 'Not Disclosed') AS ctc, coalesce(nullif(trim({experience}), ''), 'Not Specified') AS experience, {form} AS google_form, {kind} AS employment_type,
 {context} AS manager_context, {founder} AS manager_founder, {signed} AS manager_signature, {author} AS manager_author
 FROM (SELECT *, {d.extract('text', L.EXACT_ROLE_RX, 1)} AS role_words, {named_in('t')} AS found_in_text, {named_in('lower(job_card_location)')} AS found_in_card FROM {source}) a) b) c) e) f"""


def posters(d: Dialect, source: str = "fields") -> str:
    """What kind of author posted, and the sourcing score."""
    ad, lead = d.rx("author_name", L.AD_RX), d.rx("split_part(trim(author_name), ' ', 1)", L.AD_RX)
    person = "(contains(lower(author_profile_url), '/in/') AND NOT contains(lower(author_profile_url), '/company/'))"
    page = "contains(lower(author_profile_url), '/company/')"
    aggregator = d.any_rx("t", L.AGGREGATOR_RX)
    agency = f"({d.rx('author_name', L.AGENCY_RX)} OR {d.rx('text', L.CLIENT_RX)})"
    same = f"(lower(author_name) = lower(company_name) OR contains(' ' || lower(author_name) || ' ', ' ' || lower(company_name) || ' '))"
    kind = d.case([("aggregator_text", "'AGGREGATOR'"), ("ad_poster", "'JOB_ADVERTISING_PAGE'"), (f"company_page AND {same} AND NOT {d.isin('lower(company_name)', L.MISSING_COMPANY)}", "'DIRECT_COMPANY'"), ("company_page AND agency", "'AGENCY'"), ("company_page", "'JOB_ADVERTISING_PAGE'"), ("agency", "'AGENCY'"), (f"person_profile AND manager_name <> '' AND lower(manager_name) = lower(author_name) AND {d.rx('text', L.POSTER_SINGULAR_RX)}", "'HIRING_MANAGER'"), (f"person_profile AND {d.rx('text', L.RECRUITER_RX)}", "'RECRUITER_FOR_COMPANY'"), (f"person_profile AND ({d.rx('text', L.POSTER_PLURAL_RX)} OR {d.rx('text', L.POSTER_SINGULAR_RX)})", "'EMPLOYEE'")], "'UNKNOWN'")
    one = lambda c, n: f"CASE WHEN {c} THEN {n} ELSE 0 END"
    score = f"CASE WHEN {d.rx('text', L.SINGULAR_VOICE_RX)} THEN 2 WHEN {d.rx('text', L.PLURAL_VOICE_RX)} THEN 1 ELSE 0 END + {one('person_profile OR company_page', 1)} + {one(d.rx('text', L.NAMED_CUE_RX), 1)} - {one('aggregator_text', 3)} - {one('ad_poster', 3)} - {one('agency', 2)}"
    return f"""SELECT *, {kind} AS poster_type, CAST({score} AS BIGINT) AS sourcing_score FROM (SELECT *, {aggregator} AS aggregator_text, {ad} AND ({lead} OR {page} OR (NOT {person} AND {d.rx('author_name', L.GENERIC_MODIFIERS_RX)})) AS ad_poster, {agency} AS agency, {person} AS person_profile, {page} AS company_page FROM {source}) p"""


#: What a verdict is made of. Values are read as text, since numbers and flags may come as either.
VERDICT_FIELDS = ["decision", "confidence", "is_current_job", "is_genuine_hiring", "is_aggregator", "major_category", "india_relevance", "employment_type", "company", "reason"]


def judged(d: Dialect, verdicts: str = "verdicts") -> str:
    """Verdicts parsed and coerced: unknown values take their defaults, numbers may be text, confidence stays in [0, 1].

    Each text is parsed once, by a schema; one that is no object keeps its text in `malformed`.
    """
    if d.name == "spark":
        schema = ", ".join(f"{f} STRING" for f in [*VERDICT_FIELDS, "malformed"])
        read = f"from_json(verdict_json, '{schema}', map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', 'malformed'))"
        source = f"SELECT *, CASE WHEN found.malformed IS NULL THEN found END AS v, found IS NOT NULL AND found.malformed IS NULL AS parsed FROM (SELECT *, {read} AS found FROM {verdicts}) r"
        j = lambda k: f"v.{k}"
    else:
        source = "SELECT *, CASE WHEN json_valid(verdict_json) THEN verdict_json ELSE '{}' END AS safe_json, coalesce(json_valid(verdict_json), false) AS parsed FROM verdicts"
        j = lambda k: d.json("safe_json", k)
    flag = lambda k, v: f"coalesce({j(k)}, '{v}') = 'true'"
    inside = lambda k, options, other: d.case([(d.isin(j(k), options), j(k))], q(d, other))
    columns = [
        ("ingest_seq", "ingest_seq"), ("llm_status", "llm_status"), ("provider", "provider"), ("attempts", "attempts"), ("parsed", "parsed"),
        ("malformed", "CASE WHEN parsed THEN '' ELSE verdict_json END"),
        ("decision", f"upper(coalesce({j('decision')}, 'REVIEW'))"),
        ("llm_confidence", f"least(1.0, greatest(0.0, coalesce(TRY_CAST({j('confidence')} AS DOUBLE), 0.0)))"),
        ("is_current", flag("is_current_job", "true")), ("is_genuine", flag("is_genuine_hiring", "true")), ("llm_aggregator", flag("is_aggregator", "false")),
        ("llm_category", inside("major_category", ["Founder's Office", "Chief of Staff", "Data Analyst", "Data Scientist"], "None")),
        ("llm_india", inside("india_relevance", ["India", "Remote - India", "India + Global"], "Unclear")),
        ("llm_employment", inside("employment_type", ["Full-time", "Contract", "Part-time", "Internship", "Freelance", "Temporary"], "Unclear")),
        ("llm_company", f"coalesce(nullif({j('company')}, ''), 'Unclear')"),
        ("llm_reason", f"substring(trim({d.replace(f"coalesce({j('reason')}, '')", ' +', ' ')}), 1, 300)"),
    ]
    return "SELECT " + ", ".join(f"{value} AS {name}" for name, value in columns) + f" FROM ({source}) v"


def decided(d: Dialect, judged: str = "judged") -> str:
    """The hard rules over a verdict: reasons as text, and ACCEPT, REVIEW or REJECT."""
    rules = [("decision = 'REJECT'", "verdict rejects"), ("llm_aggregator", "aggregator"), ("NOT is_current", "not current"), ("NOT is_genuine", "not genuine"), ("llm_category = 'None'", "no category"), ("llm_employment = 'Internship'", "internship"), ("llm_india = 'Unclear'", "india unclear"), ("llm_confidence < 0.75", "low confidence")]
    reasons = "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, r in rules) + ")"
    return f"""SELECT *, CASE WHEN NOT parsed OR llm_status <> 'OK' THEN 'REVIEW' WHEN reasons <> '' THEN 'REJECT' WHEN llm_confidence < 0.9 OR llm_employment IN ('Contract', 'Part-time', 'Freelance', 'Temporary') OR decision <> 'ACCEPT' THEN 'REVIEW' ELSE 'ACCEPT' END AS gate, parsed AND llm_status = 'OK' AS evaluated FROM (SELECT *, {reasons} AS reasons FROM {judged}) j"""


def asked(d: Dialect) -> str:
    """The relation of the verdicts that posts which pass the gates ask for; others are not parsed by Spark."""
    return "asked_decided" if d.name == "spark" else "decided"


def flow(d: Dialect) -> str:
    """Every post, with its verdict where it passed the gates; a verdict's field wins where it says something, else the text's."""
    return f"""SELECT p.*, v.gate, v.evaluated, v.reasons, v.llm_status, v.provider, v.attempts, v.llm_confidence, v.llm_india,
 CASE WHEN v.evaluated AND v.llm_category <> 'None' THEN v.llm_category ELSE p.major_category END AS final_category,
 CASE WHEN v.evaluated AND v.llm_company <> 'Unclear' AND contains(lower(p.text), lower(v.llm_company)) THEN v.llm_company ELSE p.company_name END AS final_company,
 CASE WHEN v.evaluated AND v.llm_employment <> 'Unclear' THEN v.llm_employment ELSE p.employment_type END AS final_employment
 FROM passing_posters p LEFT JOIN {asked(d)} v ON p.ingest_seq = v.ingest_seq AND p.reject_reason = ''"""


def weighed(d: Dialect) -> str:
    """Every post with the production gate: ELIGIBLE, HOLD or REJECT with its reasons, its status and its table; null where no verdict was asked for."""
    hold = [
        (d.isin("lower(final_company)", L.MISSING_COMPANY), "company not evidenced"),
        ("manager_name = ''", "hiring manager unverified"),
        ("poster_type = 'UNKNOWN'", "unrecognised source"),
        (f"poster_type = 'AGENCY' AND {d.rx('text', L.UNDISCLOSED_RX)}", "undisclosed client"),
        (f"{d.isin('lower(exact_role)', L.MISSING_ROLE)} OR {d.rx('substring(text, 1, 400)', L.VAGUE_ROLE_RX)}", "role missing or vague"),
        ("llm_india = 'Unclear'", "india not established"),
        (f"{d.size(d.split('trim(text)', chr(92) + 's+'))} > 600", "description too long"),
    ]
    reasons = "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, r in hold) + ")"
    return f"""SELECT *, CASE WHEN gate IS NULL THEN NULL WHEN gate <> 'ACCEPT' OR NOT evaluated THEN 'HOLD' WHEN llm_confidence < 0.6 OR poster_type IN ('AGGREGATOR', 'JOB_ADVERTISING_PAGE') THEN 'REJECT' WHEN hold_reasons <> '' THEN 'HOLD' ELSE 'ELIGIBLE' END AS disposition,
 CASE gate WHEN 'ACCEPT' THEN 'New' WHEN 'REVIEW' THEN 'Review' ELSE '' END AS status,
 CASE WHEN final_category IN ('Data Analyst', 'Data Scientist') THEN 'DATA' WHEN final_category = 'None' THEN 'HOLD' ELSE 'MAIN' END AS destination FROM (SELECT *, {reasons} AS hold_reasons FROM flow) m"""


def merged(d: Dialect) -> str:
    """Posts that pass the gates, with their verdicts."""
    return "SELECT * FROM flow WHERE gate IS NOT NULL"


def produced(d: Dialect) -> str:
    """Posts that pass the gates, through the production gate."""
    return "SELECT * FROM weighed WHERE gate IS NOT NULL"


def barrier(d: Dialect, row: str = "") -> str:
    """Why a row must not be written, '' if nothing speaks against it: the eight checks, each from the row alone."""
    missing = ["unclear", "n/a", "na", "none", "unknown", "", "undisclosed", "our client", "confidential", "stealth"]
    low = lambda c: f"lower(trim({row}{c}))"
    checks = [
        (f"{row}destination NOT IN ('MAIN', 'DATA')", "non-production destination"),
        (d.isin(low("status"), ["review", "reject", "rejected", "hold", "unavailable", "error", "not_run", "malformed", ""]), "status blocked"),
        (f"{row}llm_confidence < 0.6", "confidence under 0.60"),
        (f"{row}llm_status <> 'OK' OR NOT {row}evaluated", "verdict not evaluated"),
        (d.isin(low("final_company"), missing), "company missing"),
        (d.isin(low("manager_name"), missing), "hiring manager missing"),
        (d.isin(low("exact_role"), missing), "role missing"),
        (f"({row}destination = 'DATA') <> ({row}final_category IN ('Data Analyst', 'Data Scientist'))", "category in the wrong table"),
    ]
    return d.case([(c, q(d, r)) for c, r in checks], q(d, ""))


def batch(d: Dialect) -> str:
    """A write batch with what keeps each row from being written ('' if nothing).

    Rows are gated again first: only eligible ones go on. Then one address is written once, the eight checks must pass,
    and addresses that either table already holds are left alone.
    """
    return f"""SELECT *, CASE WHEN disposition <> 'ELIGIBLE' THEN 'not eligible' WHEN copy_in_batch > 1 THEN 'duplicate in batch' WHEN checks <> '' THEN checks
 WHEN EXISTS (SELECT 1 FROM sinks s WHERE s.source_link = r.post_url) THEN 'already stored' ELSE '' END AS barrier
 FROM (SELECT *, {barrier(d)} AS checks, row_number() OVER (PARTITION BY post_url, disposition = 'ELIGIBLE' ORDER BY ingest_seq) AS copy_in_batch FROM produced) r"""


#: Each relation and what it reads.
RELATIONS = {
    "raw_items": (P.raw_items, ()),
    "raw_posts": (P.raw_posts, ("raw_items",)),
    "posts": (P.posts, ("raw_posts",)),
    "verdicts": (P.verdicts, ()),
    "sinks": (P.sinks, ("posts",)),
    "signals": (signals, ("posts",)),
    "roles": (roles, ("signals",)),
    "near": (near, ("roles",)),
    "gaps": (gaps, ("near",)),
    "geo": (geo, ("near",)),
    "markets": (markets, ("geo",)),
    "gated": (gated, ("markets",)),
    "fields": (fields, ("gated",)),
    "posters": (posters, ("fields",)),
    "judged": (judged, ("verdicts",)),
    "decided": (decided, ("judged",)),
    "passing": (passing, ("gated",)),
    "passing_fields": (lambda d: fields(d, "passing"), ("passing",)),
    "passing_posters": (lambda d: posters(d, "passing_fields"), ("passing_fields",)),
    "flow": (flow, ("passing_posters", "decided")),
    "merged": (merged, ("flow",)),
    "weighed": (weighed, ("flow",)),
    "produced": (produced, ("weighed",)),
    "batch": (batch, ("produced", "sinks")),
}


#: What Spark reads instead: first copies by their numbers, and only the verdicts that are asked for.
SPARK_RELATIONS = {
    "firsts": (P.firsts, ("raw_posts",)),
    "posts": (P.posts, ("raw_posts", "firsts")),
    "asked_verdicts": (lambda d: P.verdicts(d, "(SELECT * FROM orders LEFT SEMI JOIN (SELECT ingest_seq FROM gated WHERE reject_reason = '') g ON CAST(o_orderkey AS BIGINT) = g.ingest_seq) o"), ("gated",)),
    "asked_judged": (lambda d: judged(d, "asked_verdicts"), ("asked_verdicts",)),
    "asked_decided": (lambda d: decided(d, "asked_judged"), ("asked_judged",)),
    "flow": (flow, ("passing_posters", "asked_decided")),
}


def link(d: Dialect, name: str) -> tuple:
    """A relation's SQL and what it reads, in a dialect."""
    text, needs = SPARK_RELATIONS.get(name, RELATIONS.get(name)) if d.name == "spark" else RELATIONS[name]
    return text(d), needs


def assemble(d: Dialect, body: str, needs: tuple[str, ...], given: tuple[str, ...] = ()) -> str:
    """body with the relations that it needs, each once, in order; those given are tables already."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in given or name in order:
            return
        for x in link(d, name)[1]:
            add(x)
        order.append(name)

    for name in needs:
        add(name)
    return ("WITH " + ", ".join(f"{n} AS ({link(d, n)[0]})" for n in order) + " " if order else "") + body
