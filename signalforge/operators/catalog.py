"""One query for each operator: (name, relations it reads, SQL of a dialect)."""

from __future__ import annotations

from collections.abc import Callable

from signalforge.functions import lexicon as L
from signalforge.functions.dialect import Dialect
from signalforge.operators import contacts, recovery, resolution
from signalforge.operators import relations as R
from signalforge.sources.posts import normalize

Body = Callable[[Dialect], str]
CATALOG: dict[str, tuple[tuple[str, ...], Body]] = {}


#: The relations that a query's SQL for Spark reads, where they differ.
SPARK_NEEDS = {"join_left_verdict": ("gated", "asked_decided")}


def add(name: str, needs: str, body: Body | str) -> None:
    CATALOG[name] = (tuple(needs.split()), body if callable(body) else lambda d: body)


N = "CAST(count(*) AS BIGINT)"


def total(condition: str) -> str:
    return f"CAST(count(CASE WHEN {condition} THEN 1 END) AS BIGINT)"


def share(condition: str) -> str:
    """The mean of a condition, to three digits."""
    return f"round(avg(CASE WHEN {condition} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 3)"


#: What a post can lack, and how its column says so.
LACKS = {
    "company": "company_name = 'Unclear'", "role": "exact_role = 'Unclear'", "location": "location = 'Not Specified'", "employment": "employment_type = 'Unclear'", "experience": "experience = 'Not Specified'", "ctc": "ctc = 'Not Disclosed'",
    "manager": "manager_name = ''", "manager_link": "manager_link = ''", "manager_evidence": "manager_evidence = ''", "email": "cold_email = 'Not Available'", "apply_link": "apply_link = ''", "google_form": "google_form = ''", "market": "market = ''",
}


def column(name: str, relation: str, value: Body | str, alias: str = "value") -> None:
    """A query of one computed column over a relation of posts."""
    add(name, relation, lambda d: f"SELECT ingest_seq, {value(d) if callable(value) else value} AS {alias} FROM {relation}")


# Sources and sinks
add("src_item_map", "raw_posts", "SELECT ingest_seq, post_url, text, author_name, author_profile_url, post_date FROM raw_posts")
add("src_error_split", "raw_items", f"SELECT CASE WHEN error IS NULL THEN 'item' ELSE error END AS kind, {N} AS n FROM raw_items GROUP BY 1")
column("src_strip_query", "raw_items", "split_part(post_url, '?', 1)")
column("src_epoch_ts", "raw_items", lambda d: f"coalesce({d.utc('posted_ms')}, '')")
add("src_job_card", "raw_posts", "SELECT ingest_seq, job_card_location, job_card_company, job_card_employment_type, job_card_experience FROM raw_posts")
column("src_card_company", "raw_posts", "job_card_company")
add("src_card_fields", "raw_posts", "SELECT ingest_seq, job_card_employment_type, job_card_experience FROM raw_posts")
column("src_activity_id", "raw_posts", "activity_id")
add("src_flat_adapter", "raw_items", "SELECT ingest_seq, coalesce(nullif(post_url, ''), 'missing') AS url, coalesce(nullif(card_subtitle, ''), nullif(author_name, ''), 'Unclear') AS company, coalesce(nullif(card_experience, ''), 'Unclear') AS experience FROM raw_items")
add("src_sheet_row", "sinks posts", "SELECT s.destination, p.post_url, p.author_name, p.text FROM sinks s JOIN posts p ON p.post_url = s.source_link")
add("src_log_parse", "", lambda d: f"SELECT q AS source_query, CAST(sum(CAST(n AS BIGINT)) AS BIGINT) AS n FROM (SELECT {d.extract('line', 'query=([a-z]+)', 1)} AS q, {d.extract('line', 'n=([0-9]+)', 1)} AS n FROM (SELECT 'run query=' || event_type || ' n=' || CAST(user_id % 7 AS STRING) AS line FROM events) e) x WHERE q <> '' GROUP BY q")


def key_points(d: Dialect) -> str:
    """Up to four sentences that say most about role, company, hiring and details, in the text's order; none with an address."""
    clean = d.replace(d.replace(d.replace(d.replace("x", "#[A-Za-z0-9_]+"), r"^\s*(?:[•*▪●○◦►✅❌🔹🔸📌📍💼🏢🎓⚡🤝📩📞🚀🔥⭐✓·0-9-]+[.)\s]*)+"), r"\s+", " "), r"^[ –—|•,;:-]+|[ –—|•,;:-]+$")
    kept = d.filter(d.transform(d.filter(R.sentences(d, "text"), "x", f"NOT {d.has('x', '@')} AND NOT (google_form <> '' AND contains(x, google_form) AND length(trim(x)) < length(google_form) + 40)"), "x", clean), "x", "length(x) >= 25 AND length(x) <= 280")
    score = f"(CASE WHEN {d.rx('x', L.ROLE_CUE_RX)} THEN 3 ELSE 0 END + CASE WHEN company_name <> 'Unclear' AND contains(lower(x), lower(company_name)) THEN 2 ELSE 0 END + CASE WHEN {d.rx('x', L.HIRING_CUE_RX)} THEN 1 ELSE 0 END + CASE WHEN {d.rx('x', L.DETAIL_CUE_RX)} THEN 1 ELSE 0 END)"
    scored = d.filter(d.indexed(kept, "x", "nth", d.struct(low=f"0 - {score}", place="nth", s="x")), "y", "y.low < 0")
    best = d.sort(d.transform(d.head(d.sort(scored), 4), "y", d.struct(place="y.place", s="y.s")))
    bare = "trim(CASE WHEN google_form <> '' THEN replace(z.s, google_form, '') ELSE z.s END)"
    return d.join(d.transform(best, "z", f"'• ' || {bare}"), "\n")


def description(d: Dialect) -> str:
    """The whole text on one line, without its e-mail addresses and form."""
    bare = f"CASE WHEN google_form <> '' THEN replace(text, google_form, '') ELSE text END"
    return f"trim({d.replace(d.replace(bare, L.EMAIL_RX), chr(92) + 's+', ' ')})"


SENTINELS = "('', 'unclear', 'n/a', 'na', 'none', 'unknown', 'not available', 'not specified', 'not disclosed', 'undisclosed', '-')"


def row(d: Dialect) -> str:
    """The 23 cells of a stored row."""
    cells = [
        ("company_name", "final_company"), ("major_category", "final_category"), ("exact_role", "exact_role"), ("ctc", "ctc"), ("cold_email", "cold_email"),
        ("hiring_manager_name", f"CASE WHEN lower(trim(manager_name)) IN {SENTINELS} THEN '' ELSE manager_name END"), ("hiring_manager_linkedin", "manager_link"),
        ("source_link", "post_url"), ("description", description(d)), ("confidence", "confidence"), ("location", "location"), ("type", "final_employment"),
        ("experience", "experience"), ("market", "market"), ("india_relevance", "llm_india"), ("post_date", "post_date"), ("scraped_at", "'2024-03-15T00:00:00+00:00'"),
        ("classification_reason", "geo_evidence"), ("status", "status"), ("hiring_manager_evidence", "manager_evidence"), ("google_form", "google_form"), ("apply_link", "apply_link"), ("key_points", key_points(d)),
    ]
    return ", ".join(f"{value} AS {name}" for name, value in cells)


add("snk_row_build", "produced", lambda d: f"SELECT {row(d)} FROM produced")
add("snk_split_tab", "produced", f"SELECT destination, final_category, {N} AS n FROM produced GROUP BY destination, final_category")
add("snk_existing_keys", "sinks", "SELECT source_link FROM sinks WHERE destination = 'MAIN' UNION SELECT source_link FROM sinks WHERE destination = 'DATA'")
add("snk_write_production", "batch", "SELECT destination, post_url, final_category, gate, disposition FROM batch WHERE barrier = ''")
add("snk_write_counts", "batch", f"SELECT barrier, destination, {N} AS n FROM batch GROUP BY barrier, destination")
add("snk_reason_artifacts", "gated produced", "SELECT post_url, 'REJECT' AS disposition, reject_reason AS reason FROM gated WHERE reject_reason <> '' UNION ALL SELECT post_url, disposition, CASE WHEN hold_reasons <> '' THEN hold_reasons ELSE reasons END FROM produced")
add("srv_leads", "produced", f"""SELECT r.*, k.total, k.status_new, k.with_email FROM (SELECT ingest_seq, post_url, final_company, exact_role, cold_email, status FROM produced WHERE disposition <> 'REJECT' AND trim(post_url || final_company || exact_role) <> '' ORDER BY ingest_seq DESC LIMIT 200) r
 CROSS JOIN (SELECT {N} AS total, {total("lower(status) = 'new'")} AS status_new, {total("contains(cold_email, '@')")} AS with_email FROM produced WHERE disposition <> 'REJECT' AND trim(post_url || final_company || exact_role) <> '') k""")
add("flt_rejudge", "gated", f"SELECT CASE WHEN reject_reason = '' THEN 'kept' ELSE 'dropped' END AS outcome, reject_reason, {N} AS n FROM gated GROUP BY 1, 2")
add("flt_market_legacy", "posts", lambda d: f"SELECT ingest_seq, CASE WHEN {d.rx('t', 'remote|wfh|work from home')} THEN 'Remote - India' ELSE 'India' END AS market FROM posts")

# Text functions
column("txt_normalize", "posts", "t")
add("txt_normalize_documents", "", lambda d: f"SELECT doc_id, {normalize(d, 'text')} AS value FROM documents")
add("txt_fold_math", "posts", "SELECT ingest_seq, t, CAST(length(text) AS BIGINT) AS n_text, CAST(length(t) AS BIGINT) AS n_t FROM posts WHERE length(text) = length(t)")
add("txt_ws_collapse", "", lambda d: f"SELECT doc_id, trim({d.replace('text', '[ \\t\\n]+', ' ')}) AS value FROM documents")
column("txt_redact", "fields", lambda d: f"trim({d.replace(d.replace('text', L.EMAIL_RX + '|' + L.URL_RX), chr(92) + 's+', ' ')})")
column("txt_description", "fields", description)
column("txt_strip_url", "posts", lambda d: d.rtrim(d.extract("text", "https?://[^ ]+"), ".,;:!?*)]\"'"))
add("txt_sentence_split", "", lambda d: f"SELECT doc_id, {d.size(R.sentences(d, 'text'))} AS n_sentences, {R.first_of(d, R.sentences(d, 'text'))} AS first_sentence FROM documents")
column("txt_bullet_strip", "posts", lambda d: d.replace("text", r"(^|\n)[•*-]+ +", "$1"))
column("txt_hashtag_strip", "posts", lambda d: f"trim({d.replace('text', '#[A-Za-z0-9_]+', '')})")
column("txt_token_in", "posts", lambda d: d.rx("t", r"(^|\s)fo($|\s)"))
column("txt_contains_any", "signals", "hiring_signal")
column("txt_regex_any", "posts", lambda d: d.case([(d.any_rx("t", L.PAY_TO_APPLY_RX), "'pay'"), (d.any_rx("t", L.ALWAYS_REJECT_RX), "'seeker'"), (d.any_rx("t", L.AGGREGATOR_RX), "'aggregator'"), (d.any_rx("t", L.EMPLOYER_STRONG_RX), "'employer'")], "''"))
column("txt_city_match", "geo", "has_city")
column("txt_count_labels", "posts", lambda d: d.count_rx("t", r"company\s*:"))
column("txt_window_slice", "near", "CASE WHEN gap IS NULL THEN '' ELSE substring(text, CAST(greatest(1, instr(t, nearest_signal) - 120) AS INT), CAST(least(instr(t, nearest_signal) - 1, 120) + length(nearest_signal) + 80 AS INT)) END")
column("txt_sanitize_error", "raw_items", lambda d: f"substring({d.replace(d.replace('coalesce(error, ' + d.lit('call failed:  Bearer abc.DEF key=sk-12345') + ')', '(?i)bearer +[^ ]+', 'Bearer [redacted]'), '(?i)key=[^ ]+', 'key=[redacted]')}, 1, 300)")
column("txt_hm_display", "fields", f"CASE WHEN lower(trim(manager_name)) IN {SENTINELS} THEN '' ELSE manager_name END")
column("txt_names_match", "fields", "contains(' ' || lower(author_name) || ' ', ' ' || lower(company_name) || ' ') OR contains(' ' || lower(company_name) || ' ', ' ' || lower(author_name) || ' ')")
column("txt_name_contains", "fields", lambda d: f"contains({d.replace('lower(author_name)', '[^a-z]', '')}, {d.replace('lower(company_name)', '[^a-z]', '')})")
column("txt_profile_kind", "posters", "CASE WHEN person_profile THEN 'person' WHEN company_page THEN 'company' ELSE 'other' END")
column("txt_domain", "fields", "lower(split_part(cold_email, '@', 2))")
column("txt_quote_cap", "posts", lambda d: f"substring(trim({d.replace('text', '\\s+', ' ')}), 1, 300)")
column("txt_snippet", "near", lambda d: f"CASE WHEN role_keyword = '' THEN '' ELSE substring(trim({d.replace('substring(text, CAST(greatest(1, instr(t, role_keyword) - 40) AS INT), 160)', chr(92) + 's+', ' ')}), 1, 160) END")
FUNDING = [("unicorn", "$1.2B"), ("series d", "$100M"), ("series c", "$45M"), ("series b", "$12M"), ("series a", "$5M"), ("pre-series a", "$800K"), ("seed", "$500K"), ("bootstrapped", "undisclosed")]


def priority(d: Dialect) -> str:
    """A start-up's priority from stage, amount, city and industry, 100 at most."""
    digits = d.extract("amount", "[0-9]+(?:[.][0-9]+)?")
    number = f"coalesce(TRY_CAST(nullif({digits}, '') AS DOUBLE), 0) * CASE WHEN {d.rx('amount', '(?i)m')} THEN 1000000 WHEN {d.rx('amount', '(?i)b')} THEN 1000000000 ELSE 1 END"
    stage = d.case([(d.rx("stage", "unicorn|series d|series e|ipo"), "40"), (d.has("stage", "series c"), "35"), (d.has("stage", "series b"), "30"), (d.has("stage", "series a"), "25"), (d.has("stage", "pre-series"), "20"), (d.has("stage", "seed"), "15")], "5")
    place, field = d.rx("lower(city)", "india|bengaluru|bangalore|mumbai|delhi|hyderabad|pune|chennai"), d.rx("lower(industry)", "ai|deeptech|fintech|healthtech|robotics")
    return f"CAST(least(100, {stage} + CASE WHEN number >= 50000000 THEN 30 WHEN number >= 10000000 THEN 20 WHEN number >= 1000000 THEN 10 WHEN number > 0 THEN 5 ELSE 0 END + CASE WHEN {place} THEN 15 ELSE 0 END + CASE WHEN {field} THEN 10 ELSE 0 END) AS BIGINT)", number


def startups(d: Dialect) -> str:
    """A start-up for each supplier."""
    pick = lambda i: d.case([(f"s_suppkey % {len(FUNDING)} = {k}", d.lit(v[i])) for k, v in enumerate(FUNDING)])
    return f"SELECT s_suppkey, {pick(0)} AS stage, {pick(1)} AS amount, CASE WHEN s_suppkey % 3 = 0 THEN 'Bengaluru' WHEN s_suppkey % 3 = 1 THEN 'Berlin' ELSE n_name END AS city, CASE s_suppkey % 4 WHEN 0 THEN 'AI' WHEN 1 THEN 'FinTech' ELSE 'Logistics' END AS industry FROM supplier JOIN nation ON s_nationkey = n_nationkey"


add("txt_price_rank", "", lambda d: f"SELECT s_suppkey, {priority(d)[0]} AS score FROM (SELECT *, {priority(d)[1]} AS number FROM ({startups(d)}) s) n")
column("txt_valid_name", "posts", lambda d: d.rx("author_name", r"^[a-zA-Z0-9\s.&'-]{1,60}$"))

# Gates: how many posts each one rejects, and what each sees by itself
column("gate_employer_ctx", "signals", "employer_context")
for gate, reason in (("internship", "internship"), ("pay_to_apply", "pay to apply"), ("seeker_sub", "job seeker phrase"), ("always_reject", "job seeker always"), ("seeker_rx", "job seeker pattern"), ("congrats", "congratulatory"), ("info", "informational"), ("role", "no target role"), ("data_entry", "data entry"), ("proximity", "signal too far"), ("no_signal", "no hiring signal"), ("first_person", "first person seeker"), ("aggregator", "aggregator"), ("company_labels", "company labels"), ("multi_employer", "several employers"), ("role_context", "role context"), ("data_context", "data context"), ("india", "india relevance")):
    add(f"gate_{gate}", "gated", f"SELECT ingest_seq, post_url, reject_reason = '{reason}' OR reject_reason LIKE '{reason} (%' AS rejected_here FROM gated")
add("gate_threshold", "fields", "SELECT ingest_seq, confidence, confidence >= 0.7 AS passes FROM fields WHERE reject_reason = ''")
add("proj_invalid", "fields", "SELECT ingest_seq, post_url, author_name, post_date, " + ", ".join(f"CASE WHEN reject_reason = '' THEN {c} ELSE 'N/A' END AS {a}" for a, c in (("company", "company_name"), ("role", "exact_role"), ("ctc", "ctc"), ("email", "cold_email"), ("place", "location"), ("kind", "employment_type"), ("market", "market"))) + ", CASE WHEN reject_reason = '' THEN text ELSE substring(text, 1, 100) || '...' END AS description, reject_reason FROM fields")

# Classification
column("cls_fo_cos", "signals", "CASE WHEN fo_keyword <> '' THEN fo_keyword ELSE cos_keyword END")
add("cls_data_role", "signals", "SELECT ingest_seq, data_category, data_keyword FROM signals")
column("cls_conflict", "roles", "major_category")
column("cls_poster", "posters", "poster_type")
column("cls_ad_poster", "posters", "ad_poster")
column("cls_agency", "posters", "agency")
add("cls_page_kind", "", contacts.page_kinds)
ERR = [("unauthorized|401|invalid api key", "AUTH"), ("429|rate limit|too many", "RATE_LIMITED"), ("getaddrinfo|name resolution", "DNS"), ("timed? ?out", "TIMEOUT"), ("certificate|ssl|tls", "TLS")]
ERRS = ["401 unauthorized", "HTTP 429 too many requests", "getaddrinfo failed", "read timed out", "certificate verify failed", "boom"]
add("cls_llm_error", "", lambda d: "SELECT event_id, " + d.case([(d.rx("lower(msg)", p), d.lit(k)) for p, k in ERR], d.lit("PROVIDER_ERROR")) + " AS kind FROM (SELECT event_id, " + d.case([(f"event_id % 6 = {i}", d.lit(m)) for i, m in enumerate(ERRS)]) + " AS msg FROM events) e")
add("cls_write_error", "", lambda d: "SELECT event_id, CASE WHEN " + d.rx("msg", "timed out|429|getaddrinfo") + " THEN 'UNKNOWN' ELSE 'FAILED' END AS outcome FROM (SELECT event_id, " + d.case([(f"event_id % 6 = {i}", d.lit(m)) for i, m in enumerate(ERRS)]) + " AS msg FROM events) e")
add("cls_old_record", "raw_items weighed", lambda d: recovery.old_records(d, description(d)))
add("cls_availability", "raw_items weighed", lambda d: f"SELECT ingest_seq, availability FROM ({recovery.recovery(d, description(d))}) r")
add("cls_verdict_for", "decided", "SELECT ingest_seq, CASE gate WHEN 'ACCEPT' THEN 'ACCEPT' WHEN 'REJECT' THEN 'REJECT' ELSE 'REVIEW' END AS verdict FROM decided")
add("cls_field_verified", "fields", "SELECT ingest_seq, field, value, CASE WHEN value = '' THEN 'NOT_FOUND' WHEN contains(lower(text), lower(value)) THEN 'VERIFIED' ELSE 'PARTIALLY' END AS state, CASE WHEN value = '' THEN CAST(0 AS DOUBLE) WHEN contains(lower(text), lower(value)) THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS confidence FROM (" + " UNION ALL ".join(f"SELECT ingest_seq, text, '{f}' AS field, CASE WHEN {LACKS[f]} THEN '' ELSE {c} END AS value FROM fields" for f, c in (("company", "company_name"), ("role", "exact_role"), ("location", "location"), ("ctc", "ctc"), ("experience", "experience"), ("manager", "manager_name"), ("email", "cold_email"), ("apply_link", "apply_link"))) + ") x")
add("cls_guessed_email", "fields", lambda d: f"SELECT ingest_seq, {d.isin('lower(split_part(cold_email, ' + d.lit('@') + ', 2))', L.PERSONAL_DOMAINS)} OR contains(split_part(cold_email, '@', 1), '.') AS guessed FROM fields WHERE cold_email <> 'Not Available'")
add("cls_hm_tier", "fields", "SELECT ingest_seq, manager_tier AS tier, manager_evidence FROM fields")
add("lbl_resolution", "fields", resolution.resolved)
add("lbl_pattern_evidence", "geo", "SELECT ingest_seq, substring(geo_evidence, 1, 120) AS evidence FROM geo")

# Geography
add("geo_is_india", "geo", "SELECT ingest_seq, is_india, geo_evidence FROM geo")
column("geo_card_decision", "geo", "CASE card_says WHEN 'india' THEN 'india' WHEN 'foreign' THEN 'not_india' END")
column("geo_market", "markets", "market")
column("geo_location_field", "fields", "location")
column("geo_canon", "fields", contacts.canonical_place)
column("geo_in_location", "fields", lambda d: d.rx("lower(location)", r"\b(?:" + "|".join(L.PLACE_NAMES) + r"|india)\b"))

# Joins
add("join_interval_prox", "gaps", "SELECT ingest_seq, gap, nearest_signal, nearest_role FROM gaps")
add("join_anti_sink", "posts sinks", "SELECT ingest_seq, post_url FROM posts p WHERE NOT EXISTS (SELECT 1 FROM sinks s WHERE s.source_link = p.post_url)")
add("join_anti_prod_pre_llm", "gated sinks", "SELECT ingest_seq, post_url FROM gated g WHERE reject_reason = '' AND NOT EXISTS (SELECT 1 FROM sinks s WHERE s.source_link = g.post_url)")
add("join_left_query", "raw_posts posts", lambda d: f"SELECT p.post_url, q.source_query FROM posts p LEFT JOIN (SELECT post_url, {d.arg_min('source_query', 'ingest_seq')} AS source_query FROM raw_posts GROUP BY post_url) q ON q.post_url = p.post_url")
add("join_left_verdict", "gated decided", lambda d: f"SELECT g.ingest_seq, CASE WHEN d.ingest_seq IS NULL THEN 'MISS' WHEN NOT d.evaluated THEN 'RE-EVALUATE' WHEN d.gate = 'ACCEPT' THEN 'REHYDRATE' ELSE 'HIT' END AS action FROM gated g LEFT JOIN {R.asked(d)} d ON d.ingest_seq = g.ingest_seq AND d.attempts > 0 WHERE g.reject_reason = ''")
add("join_inner_index", "merged", "SELECT ingest_seq, post_url, gate FROM merged WHERE gate = 'ACCEPT'")
add("join_left_before_after", "sinks gated", "SELECT s.source_link, coalesce(g.reject_reason, 'NOT_REPROCESSABLE') AS outcome FROM (SELECT source_link FROM sinks UNION ALL SELECT 'https://www.linkedin.com/posts/gone-' || CAST(r_regionkey AS STRING) FROM region) s LEFT JOIN gated g ON g.post_url = s.source_link")
add("join_legacy_lookup", "raw_posts", lambda d: f"SELECT r.ingest_seq, l.author_name AS legacy_author FROM raw_posts r LEFT JOIN (SELECT post_url, {d.arg_max('author_name', 'ingest_seq')} AS author_name FROM raw_posts GROUP BY post_url) l ON l.post_url = r.post_url")
add("join_email_prov", "fields", "SELECT f.ingest_seq, f.cold_email, e.provider, e.confidence FROM (SELECT * FROM fields WHERE cold_email <> 'Not Available') f JOIN (SELECT lower(cold_email) AS email, min(CASE WHEN job_card_company <> 'Unclear' THEN 'company_site' ELSE 'post_text' END) AS provider, max(confidence) AS confidence FROM fields WHERE cold_email <> 'Not Available' GROUP BY lower(cold_email)) e ON e.email = lower(f.cold_email)")
def hosts(d: Dialect) -> str:
    """The host and its main label of each page, without blocked and government hosts."""
    label = d.replace("CASE WHEN host LIKE '%.co.%' THEN split_part(host, '.co.', 1) ELSE " + d.replace("host", r"(?:[.]example)?[.][a-z]+$") + " END", r"^.*[.]")
    return f"SELECT page_id, host, {d.replace(label, '[^a-z0-9]')} AS label FROM (SELECT page_id, {d.replace('lower(split_part(split_part(url, ' + d.lit('//') + ', 2), ' + d.lit('/') + ', 1))', '^www[.]')} AS host FROM pages) h WHERE NOT {d.rx('host', '(?:linkedin|facebook|twitter|instagram|youtube|google)[.]com$|[.]gov([.][a-z]+)?$|[.]nic[.]in$|[.]edu$|[.]ac[.](?:in|uk)$')}"


def fuzzy_domains(d: Dialect) -> str:
    """Companies whose slug holds a host's label or is held by it, three letters at least: all pairs share a run of three
    letters, so they are joined by such runs first, each label by its first run and by all, and then tested."""
    grams = lambda x: d.transform(f"sequence(1, CAST(length({x}) AS INT) - 2)" if d.name == "spark" else f"range(1, CAST(length({x}) AS INT) - 1)", "i", f"substring({x}, i, 3)")
    names = f"SELECT DISTINCT slug FROM (SELECT {d.replace('lower(company_name)', '[^a-z0-9]')} AS slug FROM fields WHERE company_name <> 'Unclear' UNION ALL SELECT {d.replace('lower(name)', '[^a-z0-9]')} FROM ({d.values([['Cheap Pills Pharma'], ['Spam Farm'], ['Therin'], ['Ththre Labs'], ['Th']], 'name')}) v) n WHERE length(slug) >= 3"
    labels = f"SELECT DISTINCT label FROM ({hosts(d)}) h WHERE length(label) >= 3"
    inside = f"SELECT c.slug, h.label FROM ({d.explode('(' + names + ') a', d.distinct(grams('slug')), 'slug', 'gram')}) c JOIN (SELECT label, substring(label, 1, 3) AS gram FROM ({labels}) l) h ON c.gram = h.gram WHERE contains(c.slug, h.label)"
    around = f"SELECT c.slug, h.label FROM (SELECT slug, substring(slug, 1, 3) AS gram FROM ({names}) a) c JOIN ({d.explode('(' + labels + ') l', d.distinct(grams('label')), 'label', 'gram')}) h ON c.gram = h.gram WHERE contains(h.label, c.slug)"
    return f"SELECT DISTINCT slug, label FROM ({inside} UNION ALL {around}) x"


add("join_domain_fuzzy", "fields", fuzzy_domains)
add("join_semi_frozen", "raw_posts", "SELECT ingest_seq, source_query FROM raw_posts WHERE source_query IN ('query 1', 'query 2', 'query 5')")
add("join_row_pos", "sinks posts", """SELECT a.destination, a.source_link, a.source_link = b.post_url AS same FROM (SELECT destination, source_link, row_number() OVER (PARTITION BY destination ORDER BY source_link) AS rn FROM sinks) a
 JOIN (SELECT CASE WHEN ingest_seq % 2 = 0 THEN 'MAIN' ELSE 'DATA' END AS destination, post_url, row_number() OVER (PARTITION BY CASE WHEN ingest_seq % 2 = 0 THEN 'MAIN' ELSE 'DATA' END ORDER BY post_url) AS rn FROM posts WHERE ingest_seq % 9 = 0) b ON a.destination = b.destination AND a.rn = b.rn""")

# Aggregations
add("agg_funnel", "raw_items weighed", f"""SELECT r.scraped, r.usable, w.* FROM (SELECT {N} AS scraped, {total("error IS NULL AND trim(text) <> '' AND post_url <> ''")} AS usable FROM raw_items) r CROSS JOIN
 (SELECT {N} AS unique_posts, {total("reject_reason = ''")} AS candidates, {total("reject_reason <> ''")} AS excluded, {total("gate IS NOT NULL")} AS sent, {total("evaluated")} AS evaluated, {total("gate = 'ACCEPT'")} AS accepted, {total("gate = 'REVIEW'")} AS in_review,
 {total("gate = 'REJECT'")} AS rejected, {total("llm_status = 'UNAVAILABLE'")} AS unavailable, {total("llm_status = 'ERROR'")} AS errors, {total("disposition = 'ELIGIBLE'")} AS eligible, {total("disposition = 'HOLD'")} AS held, {total("disposition = 'REJECT'")} AS refused,
 {total("disposition = 'ELIGIBLE' AND destination = 'MAIN'")} AS to_main, {total("disposition = 'ELIGIBLE' AND destination = 'DATA'")} AS to_data, {total("cold_email <> 'Not Available'")} AS with_email, {total("manager_name <> ''")} AS with_manager FROM weighed) w""")
add("agg_reason_hist", "gated", f"SELECT split_part(reject_reason, ' (', 1) AS reason, {N} AS n FROM gated WHERE reject_reason <> '' GROUP BY 1")
add("agg_outcome_counts", "produced", f"SELECT disposition, {N} AS n FROM produced GROUP BY disposition")
add("agg_query_yield", "raw_posts gated", f"SELECT r.source_query, {N} AS raw, {total('g.reject_reason = ' + chr(39) * 2)} AS candidates FROM raw_posts r LEFT JOIN gated g ON g.ingest_seq = r.ingest_seq GROUP BY r.source_query")
#: The searches that a run is set up with: one for each size of parts; some find nothing.
CONFIGURED = "SELECT DISTINCT 'query ' || CAST(p_size AS STRING) AS source_query FROM part"
add("agg_yield_status", "raw_posts", f"""SELECT coalesce(q, 'TOTAL') AS source_query, CAST(sum(n) AS BIGINT) AS n, CASE WHEN q IS NULL THEN 'TOTAL' WHEN sum(n) > 0 THEN 'EXECUTED' ELSE 'ZERO_YIELD' END AS status
 FROM (SELECT coalesce(c.source_query, r.source_query) AS q, coalesce(r.n, 0) AS n FROM ({CONFIGURED}) c FULL OUTER JOIN (SELECT source_query, count(*) AS n FROM raw_posts GROUP BY source_query) r ON r.source_query = c.source_query) x GROUP BY ROLLUP (q)""")
add("agg_category_rollup", "produced", f"SELECT coalesce(final_category, 'TOTAL') AS category, {N} AS n, {total("gate = 'ACCEPT'")} AS accepted, {total("gate = 'REVIEW'")} AS in_review, {total("gate = 'REJECT'")} AS rejected, {total("disposition = 'ELIGIBLE'")} AS eligible, {total("disposition = 'HOLD'")} AS held, {total("disposition = 'REJECT'")} AS refused, {total("cold_email <> 'Not Available'")} AS with_email, {total("company_name <> 'Unclear'")} AS with_company, {total("manager_name <> ''")} AS with_manager FROM produced GROUP BY ROLLUP (final_category)")
add("agg_cohort_impact", "weighed", f"SELECT CASE WHEN source_query < 'query 3' THEN 'A' ELSE 'B' END AS cohort, {N} AS n, {total("reject_reason = ''")} AS candidates, {total("gate = 'ACCEPT'")} AS accepted, {total("disposition = 'ELIGIBLE'")} AS eligible, {share("company_name <> 'Unclear'")} AS company_known, {share("manager_name <> ''")} AS manager_known FROM weighed GROUP BY 1")
add("agg_dq_report", "fields", f"SELECT CASE WHEN reject_reason = '' THEN 'after' ELSE 'before' END AS stage, {N} AS n, " + ", ".join(f"{total(f'NOT ({c})')} AS {k}, {total(c)} AS no_{k}" for k, c in LACKS.items()) + " FROM fields GROUP BY 1")
add("agg_missing_rate", "fields", "SELECT " + ", ".join(f"{share(c)} AS {k}" for k, c in LACKS.items()) + " FROM fields")
add("agg_fp_flags", "produced", f"SELECT {total('agency')} AS agency, {total('ad_poster')} AS ads, {total('aggregator_text')} AS aggregators, {total("poster_type = 'UNKNOWN'")} AS unknown_posters, {total("manager_name = ''")} AS no_manager, {total("company_name = 'Unclear'")} AS no_company, {total("exact_role = 'Unclear'")} AS no_role, {total('llm_confidence < 0.6')} AS unsure FROM produced WHERE gate = 'ACCEPT'")
add("agg_enrich_status", "fields", lambda d: f"SELECT e.status, CAST(count(f.ingest_seq) AS BIGINT) AS n FROM ({d.values([['READY'], ['READY_WITHOUT_CONTACT'], ['REVIEW'], ['UNUSED']], 'status')}) e LEFT JOIN (SELECT ingest_seq, CASE WHEN company_name = 'Unclear' OR exact_role = 'Unclear' THEN 'REVIEW' WHEN cold_email <> 'Not Available' THEN 'READY' WHEN is_india THEN 'READY_WITHOUT_CONTACT' ELSE 'REVIEW' END AS status FROM fields) f ON f.status = e.status GROUP BY e.status")
add("agg_kpis", "produced", f"SELECT {N} AS total, {total('gate = ' + chr(39) + 'ACCEPT' + chr(39))} AS status_new, {total('cold_email <> ' + chr(39) + 'Not Available' + chr(39))} AS with_email FROM produced")
add("agg_provider", "decided", f"SELECT provider, {N} AS attempted, {total('evaluated')} AS success, {total("llm_status = 'UNAVAILABLE'")} AS unavailable, {total("llm_status = 'ERROR'")} AS errors, {total("llm_status = 'UNAVAILABLE' AND attempts < 3")} AS rate_limited, {total('attempts = 0')} AS cache_hits FROM decided GROUP BY provider")
add("agg_destinations", "batch", f"SELECT destination, {N} AS n FROM batch WHERE barrier = '' GROUP BY destination")
column("agg_distinct_employers", "posts", lambda d: d.size(R.employers(d)))
add("agg_best_contact", "fields", lambda d: f"SELECT author_name, {d.arg_max('cold_email', 'confidence', 'ingest_seq')} AS best_email FROM fields WHERE cold_email <> 'Not Available' GROUP BY author_name")
add("agg_bool_all_any", "gated", "SELECT source_query, bool_and(has_city) AS all_city, bool_or(employer_context) AS any_employer FROM gated GROUP BY source_query")
add("agg_hm_metrics", "fields", f"SELECT manager_tier, {N} AS n, {total("manager_name <> ''")} AS named, {total("manager_link <> ''")} AS linked, {total("manager_name <> '' AND lower(manager_name) = lower(author_name)")} AS is_author FROM fields GROUP BY manager_tier")
add("agg_cost", "raw_posts", "SELECT CAST(count(DISTINCT source_query) AS BIGINT) AS queries, round(CAST(count(DISTINCT source_query) AS DOUBLE) * greatest(max(wanted), 10) * 0.00155, 6) AS cost, CAST(count(DISTINCT source_query) AS DOUBLE) * greatest(max(wanted), 10) * 0.00155 > 5.0 AS over_budget FROM (SELECT source_query, 4 AS wanted FROM raw_posts) r")

# Windows, dedup, sort, limit
add("win_first_dedup", "posts", "SELECT ingest_seq, post_url FROM posts")
add("win_batch_dedup", "batch", "SELECT ingest_seq, activity_id, copy_in_batch = 1 AS kept FROM batch")
add("win_stable_order", "posters", """SELECT p.ingest_seq, p.sourcing_score, CAST(p.place + b.before AS BIGINT) AS place
 FROM (SELECT ingest_seq, sourcing_score, part, row_number() OVER (PARTITION BY sourcing_score, part ORDER BY ingest_seq) AS place FROM (SELECT *, CAST(floor(ingest_seq / 10000) AS BIGINT) AS part FROM posters) x) p
 JOIN (SELECT sourcing_score, part, coalesce(sum(n) OVER (ORDER BY sourcing_score DESC, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT sourcing_score, CAST(floor(ingest_seq / 10000) AS BIGINT) AS part, count(*) AS n FROM posters GROUP BY 1, 2) c) b ON p.sourcing_score = b.sourcing_score AND p.part = b.part""")
add("win_budget_stop", "decided", "SELECT d.ingest_seq, CASE WHEN f.first_failure IS NULL OR d.ingest_seq <= f.first_failure THEN 'PROCESSED' ELSE 'PENDING' END AS state FROM decided d CROSS JOIN (SELECT min(CASE WHEN llm_status = 'UNAVAILABLE' AND attempts = 3 THEN ingest_seq END) AS first_failure FROM decided) f")
column("win_topk_reorder", "fields", key_points, "key_points")
add("win_best_per_key", "fields", lambda d: f"SELECT lower(cold_email) AS email, {d.arg_max('post_url', 'confidence', 'ingest_seq')} AS post_url, max(confidence) AS confidence FROM fields WHERE cold_email <> 'Not Available' GROUP BY lower(cold_email)")
add("win_email_rank", "fields", lambda d: "SELECT ingest_seq, " + d.case([(f"split_part(lower(cold_email), '@', 1) = '{m}'", str(i)) for m, i in L.MAILBOX_RANKS.items()], "99") + " AS mailbox_rank FROM fields WHERE cold_email <> 'Not Available'")
add("win_newest_first", "posts", "SELECT ingest_seq, post_url FROM posts ORDER BY ingest_seq DESC LIMIT 100")
add("win_max_per_run", "produced", "SELECT ingest_seq, cold_email FROM produced WHERE cold_email <> 'Not Available' ORDER BY ingest_seq LIMIT 10")
add("win_cum_attempts", "", "SELECT event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS attempts FROM events")
add("win_latest_verdict", "raw_posts verdicts", lambda d: f"SELECT r.post_url, {d.arg_max('v.verdict_json', 'v.ingest_seq')} AS verdict FROM verdicts v JOIN raw_posts r ON r.ingest_seq = v.ingest_seq GROUP BY r.post_url")
add("lim_caps", "fields", lambda d: f"SELECT ingest_seq, substring(exact_role, 1, 120) AS role, substring(text, 1, 400) AS reason, substring(manager_evidence, 1, 160) AS evidence, substring(company_name, 1, 40) AS company, {d.size(d.split('trim(text)', chr(92) + 's+'))} <= 600 AS short_enough FROM fields")

# Scores, merge, routes
column("scr_confidence", "fields", "confidence")
column("scr_sourcing", "posters", "sourcing_score")
_KNOWN = {
    "company": "company_name NOT IN ('Unclear', '', 'N/A')", "role": "exact_role NOT IN ('Unclear', '')", "location": "location NOT IN ('Not Specified', '')", "employment": "employment_type NOT IN ('Unclear', '')",
    "experience": "experience NOT IN ('Not Specified', '')", "ctc": "ctc NOT IN ('Not Disclosed', '')", "source": "post_url <> ''", "manager": "manager_name <> ''", "link": "manager_link <> ''", "email": "cold_email <> 'Not Available'",
    "india": "market <> ''", "current": "reject_reason = ''",
}


def points(weights: dict[str, int], more: str = "") -> str:
    """Hundredths for what a post has."""
    return "CAST(least(100, " + " + ".join(f"CASE WHEN {_KNOWN[k]} THEN {w} ELSE 0 END" for k, w in weights.items()) + more + ") AS DOUBLE) / 100"


#: The weights of the two scores.
ENRICHMENT = {"company": 20, "role": 20, "location": 12, "employment": 10, "experience": 8, "ctc": 8, "source": 10, "manager": 4, "email": 2}
QUALITY = {"company": 15, "role": 15, "india": 15, "current": 10, "location": 8, "experience": 5, "ctc": 5, "manager": 4, "link": 4, "email": 4}
EVIDENCE = ("company", "role", "location", "employment", "experience", "ctc", "manager", "email")
_filled = "(" + " + ".join(f"CASE WHEN {_KNOWN[k]} THEN 1 ELSE 0 END" for k in EVIDENCE) + ")"
column("scr_enrichment", "fields", points(ENRICHMENT))


def data_quality(d: Dialect) -> str:
    """Hundredths counted in whole eighths, as the evidence share of 5 points is a multiple of 5/8, and rounded half up once."""
    whole = " + ".join(f"CASE WHEN {_KNOWN[k]} THEN {w} ELSE 0 END" for k, w in QUALITY.items())
    kind = "CASE WHEN employment_type = 'Full-time' THEN 10 WHEN employment_type IN ('Unclear', 'Not Specified', '') THEN 5 ELSE 0 END"
    return f"CAST(floor((least(800, 8 * ({whole} + {kind}) + 5 * {_filled}) + 4) / 8) AS DOUBLE) / 100"


column("scr_data_quality", "fields", data_quality)
column("scr_evidence_complete", "fields", "round(CAST(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in _KNOWN.values()) + f" AS DOUBLE) / {len(_KNOWN)}, 3)")
add("scr_state_conf", "fields", lambda d: f"SELECT ingest_seq, field, confidence FROM ({resolution.resolved(d)}) r")
add("gte_verdict", "decided", "SELECT ingest_seq, gate, reasons FROM decided")
add("llm_malformed", "judged", "SELECT ingest_seq, malformed FROM judged WHERE NOT parsed")
add("gte_status", "decided", "SELECT ingest_seq, CASE gate WHEN 'ACCEPT' THEN 'New' WHEN 'REVIEW' THEN 'Review' ELSE '' END AS status, llm_status FROM decided")
add("mrg_enriched_post", "merged", "SELECT ingest_seq, final_category, final_company, final_employment, exact_role, location, ctc, experience, market, cold_email, apply_link, google_form, manager_name, manager_link, manager_evidence, confidence, llm_confidence, llm_india, gate, llm_status FROM merged")
add("gte_production", "produced", "SELECT ingest_seq, disposition, hold_reasons, poster_type FROM produced")
add("rte_final_category", "produced", "SELECT ingest_seq, final_category FROM produced")
add("rte_category", "produced", "SELECT ingest_seq, destination FROM produced")
add("rte_post", "produced", "SELECT ingest_seq, CASE WHEN gate = 'REJECT' OR disposition = 'REJECT' THEN 'REJECT' WHEN disposition = 'HOLD' THEN 'HOLD' ELSE destination END AS route FROM produced")
add("gte_barrier", "batch", "SELECT ingest_seq, barrier FROM batch")
add("gte_enrich_status", "fields", "SELECT ingest_seq, CASE WHEN company_name = 'Unclear' OR exact_role = 'Unclear' THEN 'REVIEW' WHEN cold_email <> 'Not Available' THEN 'READY' WHEN is_india THEN 'READY_WITHOUT_CONTACT' ELSE 'REVIEW' END AS status FROM fields")
add("gte_row_invariants", "produced", "SELECT ingest_seq, concat_ws('; ', CASE WHEN post_url = '' THEN 'no key' END, CASE WHEN confidence > 1 OR confidence < 0 THEN 'confidence' END, CASE WHEN destination = 'HOLD' THEN 'no route' END, CASE WHEN disposition = 'ELIGIBLE' AND gate <> 'ACCEPT' THEN 'eligible without acceptance' END, CASE WHEN disposition = 'ELIGIBLE' AND manager_name = '' THEN 'eligible without manager' END, CASE WHEN reject_reason <> '' THEN 'rejected post' END, CASE WHEN manager_link LIKE '%/company/%' THEN 'company page as manager' END) AS violations FROM produced")
add("gte_post_write", "batch sinks", lambda d: f"""SELECT 'no stored key twice' AS name, (SELECT {N} FROM batch b JOIN sinks s ON s.source_link = b.post_url WHERE b.barrier = '') = 0 AS ok UNION ALL SELECT 'one row a key', (SELECT {N} FROM (SELECT post_url FROM batch WHERE barrier = '' GROUP BY post_url HAVING count(*) > 1) x) = 0
 UNION ALL SELECT 'every row passes the checks', (SELECT {N} FROM batch WHERE barrier = '' AND checks <> '') = 0 UNION ALL SELECT 'only eligible rows', (SELECT {N} FROM batch WHERE barrier = '' AND disposition <> 'ELIGIBLE') = 0
 UNION ALL SELECT 'category in its table', (SELECT {N} FROM batch WHERE barrier = '' AND (destination = 'DATA') <> (final_category IN ('Data Analyst', 'Data Scientist'))) = 0 UNION ALL SELECT 'every row has a key', (SELECT {N} FROM batch WHERE barrier = '' AND coalesce(post_url, '') = '') = 0""")
add("dsp_recovery", "raw_items weighed", lambda d: recovery.recovery(d, description(d)))

# Extraction
column("ext_emails", "fields", lambda d: d.join(d.filter(d.indexed("real_emails", "x", "nth", f"CASE WHEN {d.place_in(d.transform('real_emails', 'y', 'lower(y)'), 'lower(x)')} = nth + 1 THEN x END"), "z", "z IS NOT NULL"), ","))
column("ext_cold_email", "fields", "cold_email")
column("ext_google_form", "fields", "google_form")
column("ext_apply_link", "fields", "apply_link")
column("ext_exact_role", "fields", "exact_role")
column("ext_company", "fields", "company_name")
column("ext_clean_company", "fields", lambda d: R.first_of(d, R.companies(d, ["company_name"])))
column("ext_join_company", "posts", lambda d: R.first_of(d, R.companies(d, [d.extract("text", L.JOIN_COMPANY_RX, 1)])))
column("ext_is_hiring", "posts", lambda d: R.first_of(d, R.companies(d, [d.extract("text", L.IS_HIRING_RX, 1)])))
column("ext_company_header", "posts", lambda d: d.extract("text", r"Company: ([A-Z][A-Za-z0-9]*)", 1))
add("ext_company_resolve", "fields", lambda d: f"SELECT ingest_seq, value AS company_name, state, evidence, confidence, detail AS employer FROM ({resolution.resolved(d)}) r WHERE field = 'company'")
column("ext_ctc", "fields", "ctc")
column("ext_experience", "fields", "experience")
column("ext_employment", "fields", "employment_type")
add("ext_hm_context", "fields", "SELECT ingest_seq, manager_context AS value, CASE WHEN manager_tier = 'CONTEXT' THEN manager_evidence ELSE '' END AS evidence FROM fields")
column("ext_named_founder", "fields", "manager_founder")
column("ext_signature", "fields", "manager_signature")
column("ext_linkedin", "fields", "manager_link")
add("ext_hm_cascade", "fields", "SELECT ingest_seq, coalesce(nullif(manager_name, ''), 'Unclear') AS manager, manager_tier, manager_link, manager_evidence FROM fields")
add("ext_hm_resolve", "fields", lambda d: f"SELECT ingest_seq, value AS manager, state, evidence, confidence, detail AS relation FROM ({resolution.resolved(d)}) r WHERE field = 'hiring_manager'")
column("ext_email_resolve", "fields", "CASE WHEN cold_email = 'Not Available' THEN 'NOT_FOUND' ELSE 'FOUND' END")
add("ext_role_resolve", "fields", lambda d: f"SELECT ingest_seq, value AS role, state, evidence, confidence FROM ({resolution.resolved(d)}) r WHERE field = 'role'")
add("html_text", "", lambda d: f"SELECT page_id, trim({d.replace(d.replace(d.replace('html', '(?is)<(script|style|noscript|template)[^>]*>.*?</(script|style|noscript|template)>', ' '), '(?s)<[^>]*>', ' '), '[ \\t\\r\\n]+', ' ')}) AS visible FROM pages")
add("html_mailto", "", lambda d: f"SELECT page_id, {d.join(d.all_rx('html', 'href=.mailto:([^?>' + chr(34) + chr(39) + ']+)', 1), ',')} AS mails FROM pages")
add("html_emails", "", contacts.page_emails)
add("fn_compose_message", "produced", contacts.message)
column("fn_location_from_reason", "geo", lambda d: d.title(f"lower({d.extract('geo_evidence', 'job location: ([A-Za-z]+)', 1)})"))
column("fn_na_placeholder", "fields", "CASE WHEN lower(company_name) IN ('', 'n/a', 'unclear') THEN 'Not Available' ELSE company_name END")
column("fn_role_source", "fields", "CASE WHEN exact_role <> 'Unclear' THEN exact_role ELSE substring(text, 1, 200) END")

# Sets
add("set_union_keys", "sinks", "SELECT source_link FROM sinks WHERE destination = 'MAIN' UNION SELECT source_link FROM sinks WHERE destination = 'DATA'")
add("set_intersect_tabs", "batch", "SELECT final_company FROM batch WHERE destination = 'MAIN' INTERSECT SELECT final_company FROM batch WHERE destination = 'DATA'")
add("set_equal", "sinks posts", f"SELECT (SELECT {N} FROM (SELECT source_link FROM sinks EXCEPT SELECT post_url FROM posts) a) = 0 AS all_known, (SELECT {N} FROM (SELECT post_url FROM posts EXCEPT SELECT source_link FROM sinks) b) AS not_stored")


def zero_yield(d: Dialect) -> str:
    """Queries without posts, and those of whose posts none passed. Spark joins each side of EXCEPT row by row, so it is given the few names only."""
    names = "SELECT DISTINCT source_query" if d.name == "spark" else "SELECT source_query"
    return f"SELECT source_query FROM ({CONFIGURED}) a EXCEPT {names} FROM raw_posts UNION ALL ({names} FROM raw_posts EXCEPT {names} FROM gated WHERE reject_reason = '')"


add("set_zero_yield", "raw_posts gated", zero_yield)
add("set_union_accept_review", "produced", "SELECT ingest_seq, gate FROM produced WHERE gate = 'ACCEPT' UNION ALL SELECT ingest_seq, gate FROM produced WHERE gate = 'REVIEW'")

# Helpers, contacts, ledger, reports
column("ext_clean_candidate2", "fields", lambda d: f"CASE WHEN {d.isin('lower(company_name)', ['we', 'our', 'us', 'the team', 'unclear'])} OR company_name = lower(company_name) THEN '' ELSE company_name END")
column("ext_is_person", "posters", lambda d: f"person_profile AND {d.rx('author_name', '^[A-Z][a-z]+ [A-Z][a-z]+$')}")


def discovered(d: Dialect) -> str:
    """Each resolvable company once, with the first site whose name fits, its best public address, a status and a confidence.

    Sites and addresses are those of the table of pages, which stands for what a search and a fetch would bring.
    """
    names = f"SELECT company_name, slug, min(post_url) AS first_post FROM (SELECT company_name, post_url, {d.replace('lower(company_name)', '[^a-z0-9]')} AS slug FROM fields WHERE NOT {d.isin('lower(company_name)', L.MISSING_COMPANY)}) n GROUP BY company_name, slug"
    sites = f"SELECT f.slug, {d.arg_min('h.host', 'h.page_id')} AS host FROM ({fuzzy_domains(d)}) f JOIN ({hosts(d)}) h ON h.label = f.label GROUP BY f.slug"
    mails = f"SELECT h.host, {d.arg_max('m.best', 'm.confidence', '0 - m.page_id')} AS best, max(m.confidence) AS confidence FROM ({contacts.page_emails(d)}) m JOIN ({hosts(d)}) h ON h.page_id = m.page_id WHERE m.best <> '' GROUP BY h.host"
    status = "CASE WHEN m.best IS NOT NULL THEN 'FOUND' WHEN s.host IS NOT NULL THEN 'PARTIAL' ELSE 'NOT_FOUND' END"
    return f"""SELECT c.company_name, c.first_post, coalesce(s.host, '') AS domain, coalesce(m.best, '') AS email, {status} AS status, greatest(coalesce(m.confidence, CAST(0 AS DOUBLE)), CASE WHEN s.host IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(0.85 AS DOUBLE) END) AS confidence
 FROM ({names}) c LEFT JOIN ({sites}) s ON s.slug = c.slug LEFT JOIN ({mails}) m ON m.host = s.host"""


add("cnt_discover", "fields", discovered)
add("cnt_domain_resolve", "fields", lambda d: f"SELECT company_name, domain, CASE WHEN domain = '' THEN CAST(0 AS DOUBLE) ELSE CAST(0.85 AS DOUBLE) END AS confidence FROM ({discovered(d)}) x")
add("cnt_candidate_pages", "", contacts.candidate_pages)
add("cnt_status", "fields", lambda d: f"SELECT status, {N} AS companies, max(confidence) AS best FROM ({discovered(d)}) x GROUP BY status")


def provider_order(d: Dialect) -> str:
    """For each state and number of attempts, the providers in order of their first verdict, each once, known ones only."""
    gather = "collect_list" if d.name == "spark" else "list"
    met = d.transform(d.sort(f"{gather}({d.struct(first='first', provider='provider')})"), "x", "x.provider")
    known = d.filter("met", "x", d.isin("x", ["provider0", "provider2"]))
    return f"SELECT llm_status, attempts, {d.join(known, ',')} AS chain FROM (SELECT llm_status, attempts, {met} AS met FROM (SELECT llm_status, attempts, provider, min(ingest_seq) AS first FROM verdicts GROUP BY 1, 2, 3) f GROUP BY 1, 2) g"


add("llm_order", "verdicts", provider_order)


def changed_fields(d: Dialect) -> str:
    """The nine compared fields and the confidence of each post that was judged: as they were known from its card before, as they are now, and why."""
    hundredths = lambda c: f"CAST(CAST(round({c} * 100) AS BIGINT) AS STRING)"
    literal = "'literal in the post'"
    rows = [
        ("company", "job_card_company", "final_company", "CASE WHEN final_company <> company_name THEN 'named by the verdict' ELSE '' END"),
        ("role", "coalesce(nullif(role_keyword, ''), 'Unclear')", "exact_role", "'verbatim title in post'"),
        ("location", "coalesce(nullif(job_card_location, ''), 'Not Specified')", "location", "geo_evidence"),
        ("employment_type", "job_card_employment_type", "final_employment", "''"),
        ("experience", "CASE WHEN job_card_experience = 'Unclear' THEN 'Not Specified' ELSE job_card_experience END", "experience", "''"),
        ("hiring_manager", "'Unclear'", "coalesce(nullif(manager_name, ''), 'Unclear')", "manager_evidence"),
        ("apply_link", "''", "apply_link", literal), ("google_form", "''", "google_form", literal), ("email", "'Not Available'", "cold_email", literal),
        ("confidence", hundredths("confidence"), f"CASE WHEN evaluated THEN {hundredths('llm_confidence')} ELSE '' END", "CASE WHEN evaluated THEN 'model evaluated' ELSE 'not evaluated' END"),
    ]
    made = d.array([d.struct(field=f"'{f}'", old=o, new=n, why=f"substring({w}, 1, 200)") for f, o, n, w in rows])
    return f"SELECT ingest_seq, c.field AS field, c.old AS old_value, c.new AS new_value, c.why AS reason FROM ({d.explode('merged', made, 'ingest_seq', 'c')}) x WHERE c.old <> c.new"


add("rec_diff_fields", "merged", changed_fields)
add("rec_markers", "decided", "SELECT ingest_seq, contains(lower(concat_ws(' ', llm_status, provider)), 'unavailable') AS failed, provider AS hint FROM decided")
add("fmt_enrichment_row", "fields", lambda d: f"SELECT {row(d).replace('final_company', 'company_name').replace('final_category', 'major_category').replace('final_employment', 'employment_type').replace('llm_india AS', 'market AS').replace('status AS status', chr(39) + 'New' + chr(39) + ' AS status')}, ingest_seq FROM fields WHERE reject_reason = ''")
column("snk_err_text", "posts", lambda d: f"substring({d.replace('text', '\\s+', ' ')}, 1, 300)")
add("rpt_stored_fields", "raw_items", "SELECT ingest_seq, coalesce(nullif(card_employment, ''), nullif(card_experience, ''), nullif(card_subtitle, ''), '') AS stored FROM raw_items")
add("rpt_capture_audit", "gated", "SELECT ingest_seq, post_url, major_category, reject_reason FROM gated")
add("rpt_gate_record", "weighed", "SELECT ingest_seq, post_url, activity_id, author_name, author_profile_url, post_date, source_query, major_category, role_keyword, data_category, data_keyword, fo_keyword, cos_keyword, employer_context, fo_strong, fo_weak, data_strong, data_weak, hiring_signal, nearest_signal, gap, card_says, is_india, geo_evidence, market, reject_reason, gate, reasons, llm_status, llm_confidence, provider, attempts, final_category, final_company, final_employment, poster_type, sourcing_score, confidence, hold_reasons, disposition, destination, status, location FROM weighed")
add("rpt_validate_contact", "produced", "SELECT * FROM (SELECT ingest_seq, cold_email, manager_name, manager_tier, manager_evidence FROM produced WHERE gate <> 'REJECT' ORDER BY ingest_seq LIMIT 24) x ORDER BY ingest_seq DESC LIMIT 20")
add("rpt_baseline_join", "gated sinks", "SELECT g.post_url, s.source_link IS NOT NULL AND g.reject_reason = '' AS recovered FROM gated g LEFT JOIN sinks s ON s.source_link = g.post_url")
add("rpt_funnel_check", "weighed", f"""SELECT {N} = {total("reject_reason = ''")} + {total("reject_reason <> ''")} AS gates_add_up, {total("gate IS NOT NULL")} = {total("gate = 'ACCEPT'")} + {total("gate = 'REVIEW'")} + {total("gate = 'REJECT'")} AS verdicts_add_up,
 {total("gate IS NOT NULL")} = {total("disposition = 'ELIGIBLE'")} + {total("disposition = 'HOLD'")} + {total("disposition = 'REJECT'")} AS dispositions_add_up, {total("reject_reason = ''")} >= {total("gate IS NOT NULL")} AS no_verdict_from_nowhere FROM weighed""")
add("led_compact", "raw_posts verdicts", lambda d: f"SELECT r.activity_id, {d.arg_max('v.llm_status', 'v.ingest_seq')} AS llm_status, CAST(max(v.ingest_seq) AS BIGINT) AS version FROM verdicts v JOIN raw_posts r ON r.ingest_seq = v.ingest_seq GROUP BY r.activity_id")
add("led_select", "decided", "SELECT ingest_seq, attempts FROM decided WHERE NOT evaluated AND attempts < 3 ORDER BY ingest_seq LIMIT 200")
add("led_breaker", "", "SELECT event_type, CAST(sum(CASE WHEN open_before > 0 THEN 1 ELSE 0 END) AS BIGINT) AS avoided, CAST(count(*) AS BIGINT) AS calls FROM (SELECT event_type, coalesce(max(CASE WHEN value > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS open_before FROM events) e GROUP BY event_type")
add("led_tranche", "decided", "SELECT ingest_seq FROM decided WHERE NOT evaluated ORDER BY ingest_seq LIMIT 3")
add("led_rehydrate", "decided", "SELECT ingest_seq, gate, llm_category, llm_confidence FROM decided WHERE parsed")
add("ops_preflight", "sinks", f"SELECT destination, {N} AS n, CAST(count(DISTINCT source_link) AS BIGINT) AS keys FROM sinks GROUP BY destination")
add("inc_retry_budget", "decided", f"SELECT attempts, {total('NOT evaluated AND attempts < 3')} AS retryable, {N} AS n FROM decided GROUP BY attempts")
add("fn_json_props", "", lambda d: f"SELECT event_id, TRY_CAST({d.json('props', 'k')} AS BIGINT) AS k FROM events")

# Outreach, search results, budgets, guards
REAL_EMAIL = "^[^@\\s]+@[^@\\s]+[.][A-Za-z]{2,}$"
PLACEHOLDERS = ["", "-", "na", "n/a", "none", "not available", "tbd"]


def real_email(d: Dialect, col: str) -> str:
    return f"(NOT {d.isin(f'lower(trim({col}))', PLACEHOLDERS)} AND {d.rx(f'trim({col})', REAL_EMAIL)})"


column("out_real_email", "fields", lambda d: real_email(d, "cold_email"))
add("out_candidates", "produced", lambda d: f"SELECT ingest_seq, final_company, exact_role, manager_name, trim(cold_email) AS email, post_url FROM produced WHERE lower(status) = 'new' AND {real_email(d, 'cold_email')}")
add("out_send", "produced", lambda d: f"SELECT ingest_seq, trim(cold_email) AS recipient, 'Contacted' AS next_status FROM produced WHERE lower(status) = 'new' AND {real_email(d, 'cold_email')} ORDER BY ingest_seq LIMIT 10")


def search_results(d: Dialect) -> str:
    """Title and unwrapped address of each result link of composed result pages, five a page at most."""
    page = "'<div><a rel=\"x\" class=\"result__a\" href=\"//duckduckgo.com/l/?uddg=' || replace(replace(url, ':', '%3A'), '/', '%2F') || '&rut=1\"><b>Page</b> ' || CAST(page_id AS STRING) || '</a><a class=\"result__a\" href=\"' || url || '\">Direct</a></div>'"
    links = d.all_rx("result_page", r'class="result__a"[^>]*href="([^"]+)"[^>]*>', 1)
    titles = d.all_rx("result_page", r'class="result__a"[^>]*>(.*?)</a>', 1)
    target = f"CASE WHEN contains(x, 'uddg=') THEN replace(replace(split_part(split_part(x, 'uddg=', 2), '&', 1), '%3A', ':'), '%2F', '/') ELSE x END"
    return f"SELECT page_id, {d.join(d.transform(d.head(links, 5), 'x', target), '|')} AS urls, {d.join(d.transform(d.head(titles, 5), 'x', 'trim(' + d.replace('x', '<[^>]+>') + ')'), '|')} AS titles FROM (SELECT page_id, url, {page} AS result_page FROM pages) p"


add("cnt_search_parse", "", search_results)
add("inc_request_budget", "", "SELECT event_id, CASE WHEN requests > 20 THEN 'OVER_BUDGET' WHEN found_before > 0 THEN 'STOPPED_EARLY' ELSE 'SENT' END AS state FROM (SELECT event_id, CAST(count(*) OVER w AS BIGINT) AS requests, CAST(coalesce(sum(CASE WHEN value > 95 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS found_before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) e")
add("inc_run_lock", "", "SELECT event_id, CASE WHEN before IS NULL OR ts >= before + INTERVAL 15 MINUTES THEN 'RUN' ELSE 'SKIPPED' END AS state FROM (SELECT event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) e")
add("ops_spend", "decided", f"SELECT provider, CAST(sum(attempts) AS BIGINT) AS calls, round(CAST(sum(attempts) AS DOUBLE) * 0.00155, 6) AS spent, CAST(sum(attempts) AS DOUBLE) * 0.00155 >= 5.0 AS refused FROM decided GROUP BY provider")
add("gte_run_guard", "produced", f"SELECT mode, live, CASE WHEN live AND NOT gated AND NOT allowed THEN 'GATE_REQUIRED' WHEN live THEN 'WRITE' ELSE 'DRY_RUN' END AS outcome, CASE WHEN live AND (gated OR allowed) THEN (SELECT {N} FROM produced WHERE NOT gated OR disposition = 'ELIGIBLE') ELSE 0 END AS n FROM (VALUES ('gated', true, true, false), ('legacy', true, false, false), ('maintenance', true, false, true), ('dry', false, false, false)) AS m(mode, live, gated, allowed)")
add("rec_guard", "decided", f"SELECT CASE WHEN count(DISTINCT provider) > 1 THEN 'REFUSED' ELSE 'OK' END AS outcome, CAST(count(DISTINCT provider) AS BIGINT) AS providers, {N} AS n FROM decided WHERE NOT evaluated")
add("fn_json_dumps", "posts", lambda d: "SELECT ingest_seq, " + ("to_json(named_struct('url', post_url, 'n', ingest_seq, 'ok', ingest_seq % 2 = 0))" if d.name == "spark" else "CAST(json_object('url', post_url, 'n', ingest_seq, 'ok', ingest_seq % 2 = 0) AS VARCHAR)") + " AS json FROM posts")
