"""Contacts on a company's pages: kinds of pages, pages to look at, addresses by rank, and the message that goes out."""

from __future__ import annotations

from signalforge.functions import lexicon as L
from signalforge.functions.dialect import Dialect, alternation

HOST = "split_part(split_part(url, '//', 2), '/', 1)"


def page_kinds(d: Dialect) -> str:
    """Kind, source label and tier of each page, by its address."""
    pick = lambda k: d.case([(d.any_of("lower(url)", marks), f"'{row[k]}'" if isinstance(row[k], str) else str(row[k])) for row in L.PAGE_KINDS if (marks := row[1])], f"'{L.PAGE_KINDS[-1][k]}'" if isinstance(L.PAGE_KINDS[-1][k], str) else str(L.PAGE_KINDS[-1][k]))
    return f"SELECT page_id, {pick(0)} AS kind, {pick(2)} AS source, CAST({pick(3)} AS BIGINT) AS tier FROM pages"


def candidate_pages(d: Dialect) -> str:
    """Nine addresses of a page's site: the one it came from, and those that may name a contact; each once, in order."""
    paths = d.array([d.lit(p) for p in L.CONTACT_PATHS])
    others = d.filter(d.transform(paths, "p", "'https://' || domain || p"), "u", "u <> url")
    made = d.chain(d.array(["CASE WHEN url LIKE 'http%' THEN url ELSE 'https://' || domain END"]), others)
    return f"SELECT page_id, candidate FROM ({d.explode(f'(SELECT page_id, url, {HOST} AS domain FROM pages) p', made, 'page_id, domain', 'candidate')}) x WHERE domain <> ''"


def core(d: Dialect, domain: str) -> str:
    """The second-level name of a domain."""
    return d.extract(domain, "([^.]+)[.][^.]+$", 1)


def page_emails(d: Dialect) -> str:
    """Addresses that literally stand on a page, in the order of their rank, and the best with its confidence.

    Public mailboxes of any business domain count; an address of a person counts only in the domain of the page's own site.
    """
    personal = lambda host: d.rx(host, r"(?:^|\.)" + alternation(L.PERSONAL_DOMAINS) + "$")
    found = d.chain(d.all_rx("html", "href=.mailto:([^?>\"']+)", 1), d.all_rx("html", L.EMAIL_RX))
    clean = d.filter(d.transform(found, "x", d.replace("trim(x)", "^[.;),}]+|[.;),}]+$")), "x", d.rx("x", r"^[\w.+#-]+@[\w.-]+\.[A-Za-z]{2,}$"))
    first = d.filter(d.indexed("clean", "x", "nth", f"CASE WHEN {d.place_in('lowered', 'lower(x)')} = nth + 1 THEN x END"), "x", f"x IS NOT NULL AND NOT {personal('lower(split_part(x, ' + d.lit('@') + ', 2))')}")
    rank = d.case([(f"lower(split_part(x, '@', 1)) = '{m}'", str(r)) for m, r in L.MAILBOX_RANKS.items()], "99")
    own = f"(site <> '' AND {core(d, 'lower(split_part(x, ' + d.lit('@') + ', 2))')} = site)"
    worth = f"CASE WHEN {rank} = 99 THEN 60 WHEN {own} THEN 95 ELSE 85 END"
    ranked = d.sort(d.filter(d.indexed("firsts", "x", "nth", d.struct(rank=rank, less=f"0 - {worth}", place="nth", own=own, email="x")), "y", "y.rank < 99 OR y.own"))
    return f"""SELECT page_id, {d.join(d.transform('ranked', 'y', 'y.email'), ',')} AS emails, coalesce({d.get(d.transform('ranked', 'y', 'y.email'), 0)}, '') AS best, CAST(0 - coalesce({d.get(d.transform('ranked', 'y', 'y.less'), 0)}, 0) AS DOUBLE) / 100 AS confidence
 FROM (SELECT page_id, {ranked} AS ranked FROM (SELECT page_id, CASE WHEN {personal('host')} THEN '' ELSE {core(d, 'host')} END AS site, {first} AS firsts
 FROM (SELECT page_id, host, clean, {d.transform('clean', 'y', 'lower(y)')} AS lowered FROM (SELECT page_id, lower({HOST}) AS host, {clean} AS clean FROM pages) a) b) c) e"""


CLOSING = "May I send my resume, or would a short call suit you this week?"


def message(d: Dialect, sender: str = "The applicant") -> str:
    """Subject and body of the message to a lead; what a lead lacks is said in general words."""
    company, role = "coalesce(nullif(final_company, ''), 'your team')", f"coalesce(nullif(exact_role, ''), {d.lit("Founder's Office / Chief of Staff")})"
    said = " || ".join([d.lit("your post about the "), role, d.lit(" role at "), company, d.lit(" caught my eye, and I would like to apply.")])
    body = " || chr(10) || ".join(["CASE WHEN manager_name <> '' THEN 'Hi ' || manager_name || ',' ELSE 'Hi,' END", "''", said, d.lit(CLOSING), "''", d.lit("Best regards,"), d.lit(sender)])
    return f"SELECT ingest_seq, 'Application for ' || {role} || ' at ' || {company} AS subject, {body} AS body FROM produced"


def canonical_place(d: Dialect) -> str:
    """A post's place as it is written in tables; remote work is India's only where the post shows it."""
    low = "lower(text || ' ' || location || ' ' || job_card_location)"
    remote = d.rx(low, r"\b(?:remote|wfh|work\s+from\s+home)\b")
    named = d.case([(d.has(low, key), d.lit(name)) for key, name in L.CANONICAL_PLACES], "'Not Specified'")
    return f"CASE WHEN {remote} AND {d.any_of(low, L.REMOTE_INDIA_MARKS)} THEN 'Remote - India' WHEN {remote} THEN 'Remote' ELSE {named} END"
