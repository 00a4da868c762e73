"""Literal pages and posts: kinds of pages, addresses by rank, pages to look at, canonical places, in both engines."""

import duckdb
import pytest

from signalforge.functions.dialect import Checker, Dialect
from signalforge.operators import contacts
from signalforge.sources.posts import normalize


def both(spark, make, pages, columns="page_id, url, html"):
    out = []
    for d, run in ((Dialect(), lambda s: [r.asDict() for r in spark.sql(s).collect()]), (Checker(), lambda s: duckdb.sql(s).df().to_dict("records"))):
        out.append(run(f"WITH pages AS ({d.values(pages, columns)}) {make(d)}"))
    key = lambda r: tuple(map(str, r.values()))
    assert sorted(out[0], key=key) == sorted(out[1], key=key)
    return out[0]


PAGES = [
    [1, "https://acme.com/Careers/now", "Mail jobs@acme.com, info@acme.com; <a href='mailto:careers@beta.co'>x</a> careers@BETA.co rohit.gupta@acme.com rohit@other.org x@gmail.com"],
    [2, "https://www.beta.co.in/contact-us", "no address"],
    [3, "https://gmail.com/team", "someone@gmail.com anna.rao@gmail.com hr@zylo.in."],
    [4, "", "(hello@x.org)"],
    [5, "https://zylo.in/", "named.person@zylo.in"],
]


def test_addresses_by_rank(spark):
    got = {r["page_id"]: r for r in both(spark, contacts.page_emails, PAGES)}
    assert got[1]["emails"] == "careers@beta.co,jobs@acme.com,info@acme.com,rohit.gupta@acme.com" and (got[1]["best"], got[1]["confidence"]) == ("careers@beta.co", 0.85)
    assert (got[2]["emails"], got[2]["confidence"]) == ("", 0)
    assert got[3]["emails"] == "hr@zylo.in" and got[4]["best"] == "hello@x.org"
    assert (got[5]["emails"], got[5]["confidence"]) == ("named.person@zylo.in", 0.6)


def test_kinds_of_pages(spark):
    got = {r["page_id"]: (r["kind"], r["source"], r["tier"]) for r in both(spark, contacts.page_kinds, PAGES)}
    assert got == {1: ("careers", "company_careers_page", 1), 2: ("contact", "company_contact_page", 1), 3: ("about", "company_site_page", 2), 4: ("site", "company_website", 2), 5: ("site", "company_website", 2)}


def test_pages_to_look_at(spark):
    got = both(spark, contacts.candidate_pages, [[1, "https://acme.com/careers", ""], [2, "acme", ""], [3, "http://b.co", ""]])
    first = [r["candidate"] for r in got if r["page_id"] == 1]
    assert len(first) == len(set(first)) == 8 and "https://acme.com/contact-us" in first
    assert not [r for r in got if r["page_id"] == 2] and len([r for r in got if r["page_id"] == 3]) == 9


@pytest.mark.parametrize("text, place, card, want", [("Hiring in Bangalore", "Bengaluru", "", "Bengaluru, Karnataka, India"), ("wfh, 10 LPA", "Remote", "", "Remote - India"), ("remote", "Remote", "", "Remote"), ("x", "Not Specified", "", "Not Specified"), ("x", "Not Specified", "Tiruppur", "Tirupur, Tamil Nadu, India"), ("New Delhi and Pune", "Delhi / Pune", "", "New Delhi, India")])
def test_canonical_places(spark, text, place, card, want):
    make = lambda d: f"SELECT {contacts.canonical_place(d)} AS place FROM pages"
    assert both(spark, make, [[text, place, card]], "text, location, job_card_location") == [{"place": want}]


@pytest.mark.parametrize("text, want", [("𝑫𝒂𝒕𝒂 𝔸𝕟𝕒𝕝𝕪𝕤𝕥 𝟚𝟘", "data analyst 20"), ("𝒞𝒽𝒾𝑒𝒻 𝚘𝚏", "chi𝑒f of".replace("𝑒", "e"))])
def test_mathematical_letters_are_folded(spark, text, want):
    d, c = Dialect(), Checker()
    assert spark.sql(f"SELECT {normalize(d, d.lit(text))} AS t").first()["t"] == want
    assert duckdb.sql(f"SELECT {normalize(c, c.lit(text))} AS t").fetchall()[0][0] == want
