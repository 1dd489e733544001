"""Operators on literal inputs: payloads, pages, lists, snapshots, streams."""

from __future__ import annotations

import gzip
import json
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quarrystone import catalog, sinks, streaming
from quarrystone.functions import numbers as fn
from quarrystone.operators import audit, brief, connectors, reconcile, registry, report, sampling, site, synthesis
from quarrystone.plans import engine, projection
from quarrystone.sources import captured

ORG, OTHER = "923609016", "914778271"  # two numbers with right check digits


def rows(df, *names):
    return sorted(tuple(r[n] for n in names or df.columns) for r in df.collect())


def one(spark, **columns):
    return spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} string" for k in columns))


def test_numbers(spark):
    df = spark.createDataFrame([("923 609 016",), ("923609017",), (None,), ("12",), ("000000000",)], "x string")
    assert [tuple(r) for r in df.select(fn.is_valid(F.col("x")), fn.shown(F.col("x"))).collect()] == [(True, "923 609 016"), (False, "923 609 017"), (False, ""), (False, "12"), (True, "000 000 000")]


@pytest.mark.parametrize(
    ("text", "label", "others"),
    [
        (f"Org.nr: {ORG[:3]}.{ORG[3:6]}.{ORG[6:]} MVA", "org_number_labelled_on_page", []),
        (f"x {ORG} y", "org_number_on_page", []),
        (f"x {ORG[:3]} {ORG[3:6]} {ORG[6:]} y", "org_number_on_page", []),
        (f"1{ORG}", "", []),
        ("92360 9016 and 9 2 3", "", []),
        (f"Foretaksregisteret {OTHER}", "", [OTHER]),
        (f"{OTHER} and {ORG}", "org_number_on_page", [OTHER]),
        (None, "", []),
    ],
)
def test_proof(spark, text, label, others):
    got = one(spark, t=text, o=ORG).select(fn.proof(F.col("t"), F.col("o")).alias("p"), fn.conflicts(F.col("t"), F.col("o")).alias("c")).first()
    assert (got.p, got.c) == (label, others)


def test_names_money_and_titles(spark):
    df = one(spark, a="Bjørn & Sønner Ærlig Café AS", b="nord-aurdal o'neil")
    got = df.select(fn.name_tokens(F.col("a")), fn.titled(F.col("b")), fn.money(F.lit(1234567.0), F.lit("")), fn.money(F.lit(999.0), F.lit("EUR")), fn.money(F.lit(-2.5e9), F.lit(None).cast("string"))).first()
    assert list(got) == [["bjorn", "sonner", "aerlig", "cafe"], "Nord-Aurdal O'Neil", "NOK 1.2m", "EUR 999", "NOK -2.5bn"]
    assert fn.employee_band is not None
    bands = one(spark, x="0").select(*(fn.employee_band(F.lit(v)) for v in ("4", "5", "20", "100", "x")), fn.employee_band(F.lit(None).cast("string"))).first()
    assert list(bands) == ["1-4", "5-19", "20-99", "100+", "missing", "missing"]


ENTITY = {"organisasjonsnummer": ORG, "navn": "NORD DRIFT AS", "organisasjonsform": {"kode": "AS", "beskrivelse": "Aksjeselskap"}, "naeringskode1": {"kode": "50.2", "beskrivelse": "Skip"},
          "forretningsadresse": {"adresse": ["Gata 1", ""], "postnummer": "0150", "poststed": "OSLO", "kommune": "OSLO", "land": "Norge"}, "hjemmeside": "www.nord.no", "telefon": "22 33 44 55",
          "harRegistrertAntallAnsatte": False, "antallAnsatte": 0, "konkurs": False, "erIKonsern": True}


def payload(spark, body, org=ORG, ok=True, blocked=False, status=200):
    return spark.createDataFrame([(org, ok, blocked, status, body if body is None else json.dumps(body))], "org string, ok boolean, blocked boolean, status int, body string")


def test_entity_claims(spark):
    got = {r.field: r for r in registry.entity_claims(payload(spark, ENTITY)).collect()}
    assert len(got) == 12 and got["legal_form"].value == "AS - Aksjeselskap" and got["business_address"].value == "Gata 1, 0150 OSLO, Norge"
    assert got["registry_website"].value == "https://www.nord.no" and got["employees_registered"].availability == "not_available" and "not zero" in got["employees_registered"].note
    assert json.loads(got["operating_status"].value)["in_group"] is True and got["postal_address"].value is None
    for args, state in (({"ok": False, "blocked": True, "status": 403}, "blocked"), ({"ok": False, "status": 404}, "not_available"), ({"ok": False, "status": 500}, "failed"), ({}, "not_available")):
        assert rows(registry.entity_claims(payload(spark, None, **args)), "field", "availability") == [("legal_name", state)]
    assert rows(registry.entity_claims(payload(spark, ENTITY, org=OTHER)), "field") == [("legal_name",)]
    assert list(registry.identity(payload(spark, ENTITY)).first())[1:] == ["NORD DRIFT AS", "0150", "OSLO", "22334455"]


def test_roles(spark):
    role = lambda code, last, **k: {"type": {"kode": code}, "person": {"navn": {"fornavn": "Kari", "etternavn": last}}, **k}
    body = {"rollegrupper": [{"roller": [role("LEDE", "A"), role("MEDL", "B", avregistrert=True), role("REVI", "C")]}, {"roller": [role("DAGL", "D"), {"type": {"kode": "MEDL"}, "enhet": {"navn": "EIER AS"}}]}]}
    got = registry.leadership(registry.roles(payload(spark, body))).first()
    assert (got.leadership, got.managing_director, got.board_chair) == ("LEDE=Kari A;DAGL=Kari D;MEDL=EIER AS", "Kari D", "Kari A")


def test_accounts(spark):
    filing = lambda kind, until, revenue: {"regnskapstype": kind, "valuta": "NOK", "regnskapsperiode": {"fraDato": until[:4] + "-01-01", "tilDato": until}, "resultatregnskapResultat": {"driftsresultat": {"driftsinntekter": {"sumDriftsinntekter": revenue}}}}
    held = registry.filings(payload(spark, [filing("KONSERN", "2024-12-31", 9), filing("SELSKAP", "2022-12-31", 5), filing("SELSKAP", "2023-12-31", 0)]))
    got = {r.field: r for r in registry.financial_claims(registry.latest_filing(held)).collect()}
    revenue = got["financials.revenue"]
    assert (revenue.value, revenue.filed_zero, revenue.period, revenue.statement) == (0.0, True, "2023-01-01/2023-12-31", "SELSKAP")
    assert got["financials.equity"].availability == "not_available" and rows(registry.filing_years(held)) == [(ORG, "2024,2023,2022")]


def test_locations(spark):
    body = {"_embedded": {"underenheter": [{"organisasjonsnummer": "1", "navn": "x", "forretningsadresse": {"adresse": ["A"], "poststed": "B"}}]}, "page": {"totalElements": 7}}
    assert rows(registry.locations(payload(spark, body)), "item_key", "address", "registered_subunits") == [("1", "A, B", 7)]


def gated(spark, body, **identity):
    page = f"<html><head><title>Nord Drift</title></head><body><p>{body}</p></body></html>"
    facts = {"legal_name": "NORD DRIFT AS", "postcode": "0150", "city": "OSLO S", "phone": "4722334455"} | identity
    df = one(spark, org=ORG, url="https://nord.no", html=page, **facts)
    return site.gate(site.parsed(df)).first()


def test_gate(spark):
    filler = "vi driver skip og havn langs kysten " * 5
    assert gated(spark, f"Org.nr {ORG}").proof == "org_number_labelled_on_page"
    assert gated(spark, filler + "tlf 22 33 44 55").proof == "registry_site_corroborated"
    assert gated(spark, filler + "0150 Oslo").proof == "registry_site_corroborated"
    assert (gated(spark, filler).proof, gated(spark, filler).state) == ("", "ambiguous")
    assert gated(spark, filler + f"tlf 22 33 44 55, org.nr {OTHER}").proof == ""
    assert gated(spark, filler + "22334455 this domain may be for sale").proof == ""
    assert gated(spark, filler + "22334455", legal_name="ANNEN DRIFT AS").proof == ""
    assert gated(spark, "22334455", legal_name="NORD AS").proof == ""


def page(spark, html, url="https://x.no/"):
    return one(spark, html=html, url=url)


def posts(spark, html):
    return [r.post.asDict() for r in site.dated_posts(page(spark, html)).orderBy("pos").collect()]


def test_pages_and_posts(spark):
    body = '<title> T </title><meta name="description" content=" D "><script type="application/ld+json">{"x":1}</script><style>no</style><p>a<p>b<div id=footer>F <a href="/n">n</a></div>'
    got = site.parsed(page(spark, body)).first().page
    assert (got["title"], got["description"], got["identity_excerpt"], got["links"]) == ("T", "D", "F n", ["/n"]) and "no" not in got["body_text"].split()
    html = '<article><h2>A</h2><time datetime="2024-05-06T00:00">x</time> some longer text here</article><article><h2>B</h2> publisert 14. september 2025 her</article><article><h2>C</h2>den 31.02.2024 var det ingen</article><article>uten dato men lang nok tekst</article>'
    assert [(p["title"], p["date"]) for p in posts(spark, html)] == [("B", "2025-09-14"), ("A", "2024-05-06")]
    ld = '<script type="application/ld+json">[{"@type":"NewsArticle","headline":"L","datePublished":"2023-01-02T03","url":"/l"},{"@type":"Thing"}]</script>' + html
    assert posts(spark, ld) == [{"title": "L", "date": "2023-01-02", "url": "https://x.no/l"}]
    assert posts(spark, '<script type="application/ld+json">{broken</script><li>kort 1.2.2024</li><li>en lengre tekst om noe 7.3.2024</li>') == [{"title": "en lengre tekst om noe 7.3.2024", "date": "2024-03-07", "url": None}]
    news = site.candidates(page(spark, '<a href="/Nyheter/">x</a><a href="https://y.no/news">y</a><a href="/om">Presse</a><a href="/om#a">presse</a><a href="http://[x/news">n</a>', "https://www.x.no/"), most=9)
    found = [r.candidate for r in news.orderBy("pos").collect()]
    assert found[:2] == ["https://www.x.no/Nyheter/", "https://www.x.no/om"] and "https://www.x.no/aktuelt" in found and "https://www.x.no/nyheter" not in found and len(found) == 7


def test_compatibility_characters(spark):
    df = one(spark, t="Org.nr " + "".join(chr(ord(c) + 0xFEE0) for c in ORG) + " her", n="Ñandú Façade ﹏ Ǻlesund Ｗide ÆRLIG ŁÓDŹ Kołata Café\u0301s")
    got = df.select(fn.proof(F.col("t"), F.lit(ORG)), fn.name_tokens(F.col("n"))).first()
    fi = one(spark, n="ﬁsk ⑩ ½ Ĳmuiden ㎏ ㏂").select(fn.name_tokens(F.col("n")), fn.flat(F.col("n"))).first()
    assert fi[0] == ["fisk", "10", "12", "ijmuiden", "kg"]
    assert fi[1] == unicodedata.normalize("NFKC", "ﬁsk ⑩ ½ Ĳmuiden ㎏ ㏂")
    assert got[0] == "org_number_labelled_on_page" and got[1] == ["nandu", "facade", "alesund", "wide", "aerlig", "odz", "koata", "cafes"]


def test_feed_places_and_wikidata(spark):
    feed = {"items": [{"url": "/1", "_feed_entry": {"status": "ACTIVE", "businessName": "Nord Drift Bergen AS", "sistEndret": "2"}}, {"url": "/2", "_feed_entry": {"status": "INACTIVE", "businessName": "Nord Drift"}}]}
    entries = connectors.feed_entries(spark.createDataFrame([(0, json.dumps(feed))], "page_no int, body string")).withColumn("entry_id", F.col("pos").cast("long"))
    companies = spark.createDataFrame([(OTHER, 0, "SKIP AS"), (ORG, 1, "NORD DRIFT AS"), ("1", 2, "NORD AS"), ("2", 3, "AS")], "org string, pos int, name string")
    assert rows(connectors.contained(entries, companies), "url", "org", "exact") == [("/1", ORG, False)]
    ad = {"ad_content": {"uuid": "u", "title": "", "jobtitle": "J", "employer": {"orgnr": "923 609 016"}, "workLocations": [{"city": "C"}]}}
    details = spark.createDataFrame([("/1", json.dumps(ad), "t", "h"), ("/9", json.dumps({"ad_content": {"employer": {"orgnr": "5"}}}), "t", "h")], "url string, body string, retrieved_at string, sha string")
    ads = connectors.resolved_ads(details, companies)
    assert rows(ads, "org", "title", "municipality") == [(ORG, "J", "C")]
    assert (ORG, 1, "available") in rows(connectors.job_counts(companies, ads, True)) and {r[2] for r in rows(connectors.job_counts(companies, ads, False))} == {"failed"}
    entity = {"claims": {"P2333": [{"mainsnak": {"snaktype": "value", "datavalue": {"value": ORG}}}], "P571": [{"mainsnak": {"snaktype": "value", "datavalue": {"value": {"time": "+2004-01-01T00:00:00Z"}}}}], "P1128": [{"mainsnak": {"snaktype": "value", "datavalue": {"value": {"amount": "+120"}}}}], "P856": [{"mainsnak": {"snaktype": "novalue"}}], "P2002": [{"mainsnak": {"snaktype": "value", "datavalue": {"value": "nord"}}}]}, "labels": {"nb": {"value": "Nord"}}, "sitelinks": {"nowiki": {"title": "Nord Drift"}}}
    got = connectors.wikidata(spark.createDataFrame([(0, "Q1", json.dumps(entity))], "pos int, qid string, entity string"), companies).first()
    assert (got.qid, got.inception, got.employees, got.website, got.wikipedia_no, got.handle_x) == ("Q1", "2004-01-01", "120", None, "https://no.wikipedia.org/wiki/Nord_Drift", "https://x.com/nord")


def test_sources_and_sinks(spark, tmp_path):
    listed = tmp_path / "orgs.txt"
    listed.write_text(f'{ORG}\n{{"organisasjonsnummer": "{OTHER}", "navn": "A"}}\nbad\n{{"organisation_number": "{OTHER}", "name": "B"}}\n\n{ORG}\n{{broken\n')
    assert rows(captured.organisations(spark, str(listed)), "pos", "org") == [(0, ORG), (1, OTHER)]
    assert captured.lines(spark, str(listed)).count() == 6
    assert rows(captured.company_names(spark, str(listed))) == [(OTHER, "B")]
    with gzip.open(tmp_path / "u.jsonl.gz", "wt") as f:
        f.write('{"organisation_number": "1", "employees": 7}\n')
    assert rows(captured.universe(spark, str(tmp_path / "u.jsonl.gz")), "org", "employees") == [("1", "7")]
    claim = {"field": "f", "value": {"b": [1], "a": 1.0}, "availability": "available", "evidence_ids": ["gone", "e"], "qualifiers": {"currency": "NOK"}}
    source = {"id": "e", "source_url": "u", "source_class": "c", "retrieved_at": "t", "content_sha256": "h"}
    seen = dict.fromkeys(("id", "organisation_number", "platform", "signal_type", "source_url", "retrieved_at", "content_sha256", "identity_proof", "acquisition_mode", "rights_status"), "o") | {"exact_entity": True}
    run = dict.fromkeys(("run_id", "started_at", "completed_at", "terminal_status"), "r")
    line = {"organisation_number": ORG, "run": run, "claims": [claim], "evidence": [source], "observations": [seen]}
    snap = tmp_path / "snap.jsonl"
    snap.write_text("\n".join([json.dumps(line | {"claims": []}), json.dumps(line), json.dumps(line | {"odd": 1}), "{"]))
    held = captured.envelopes(spark, str(snap))
    got = captured.claims_of(held).first()
    assert (got.value, got.evidence_id, got.url, got.currency) == ('{"a":1,"b":[1]}', "e", "u", "NOK") and captured.observations_of(held).count() == 1
    order = one(spark, a="[3, 1]", b="[1,3.0]").select(captured.canonical(F.col("a")), captured.canonical(F.col("b"))).first()
    assert order[0] == order[1]
    deep = one(spark, a='{"k":[{"z":[2,1]},{"b":1.0,"a":2}],"x":1}', b='{"x":1,"k":[{"a":2,"b":1},{"z":[1,2.0]}]}', c="plain [text").select(*(captured.canonical(F.col(k)) for k in "abc")).first()
    assert deep[0] == deep[1] == '{"k":[{"a":2,"b":1},{"z":[1,2]}],"x":1}' and deep[2] == "plain [text"
    people = spark.createDataFrame([("b", 1), ("a", None)], "org string, n int")
    digest = sinks.write_snapshot(people, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2 and digest.first().rows == 2
    assert sinks.write_snapshot(people.repartition(3), str(tmp_path / "out2")).first().sha256 == digest.first().sha256
    stored = str(tmp_path / "blobs")
    sinks.write_blobs(spark.createDataFrame([("x",), ("x",)], "content string"), stored)
    sinks.write_blobs(spark.createDataFrame([("x",), ("y",)], "content string"), stored)
    assert rows(captured.blobs(spark, stored), "content") == [("x",), ("y",)]
    sinks.write_viewer(spark.createDataFrame([("1", "</script>", "m", ["x"])], "org string, name string, municipality string, platforms array<string>"), str(tmp_path / "v"))
    assert "<\\/script>" in "".join(r.value for r in spark.read.text(str(tmp_path / "v")).collect())


def test_payload_digests_and_pages(spark, tmp_path):
    import hashlib

    people = spark.createDataFrame([(f"{n:03}", n) for n in range(9)], "org string, n int")
    got = sinks.write_snapshot(people, str(tmp_path / "s")).first()
    files = {f.name: f.read_bytes() for f in (tmp_path / "s").glob("part-*")}
    assert got.rows == 9 and {x.file: (x.bytes, x.sha256) for x in got.payloads} == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in files.items()}
    told = sinks.manifest("r", spark.createDataFrame([(0, "000")], "pos int, org string"), spark.createDataFrame([got])).first()
    assert told["count"] == 9 and told.payloads == got.payloads
    claims = [(f"{n}", "legal_name", f"N{n}", "available") for n in range(7)] + [("1", "places.rating", "4.5", "available")]
    seen = spark.createDataFrame([("1", "brreg"), ("1", "x")], "org string, platform string")
    engine.viewer(spark.createDataFrame(claims, "org string, field string, value string, availability string"), seen, str(tmp_path / "v"))
    page = "".join(r.value for r in spark.read.text(str(tmp_path / "v")).collect())
    assert '"companies":7,"two_platforms":14,"rating":14' in page and page.index('"name":"N1"') < page.index('"name":"N0"') and '"rating":true' in page
    profiles = spark.createDataFrame([(f"{n}", "n", "m", ["x"]) for n in range(25)], "org string, name string, municipality string, platforms array<string>")
    sinks.write_viewer(profiles, str(tmp_path / "w"), page_rows=10)
    pages = [r.value for r in spark.read.text(str(tmp_path / "w")).collect()]
    assert 2 <= len(pages) <= 3 and sum(p.count('"municipality":"m"') for p in pages) == 25


def test_reviews_go_on_where_labels_end(spark):
    o = lambda i, signal, org: (i, org, "company_site", signal, "org_number_on_page", "u", "t", "h")
    queued = spark.createDataFrame([o("a", "profile_handle", "1"), o("b", "company_profile", "2"), o("c", "company_profile", "1"), o("d", "company_profile", "3")], "id string, organisation_number string, platform string, signal_type string, identity_proof string, source_url string, retrieved_at string, content_sha256 string")
    labels = spark.createDataFrame([("d", True), ("b", True)], "id string, exact_entity boolean")
    left, kept = engine.audit_review(queued, labels, relabel=spark.createDataFrame([("b",)], "id string"))
    assert [r.id for r in left.collect()] == ["c", "b", "a"] and [r.id for r in kept.collect()] == ["d"] and "company" in left.first().block
    assert engine.audit_review(queued, labels, ("inferred",))[0].count() == 0


def test_readers_of_the_audit_and_settings(spark, tmp_path):
    (tmp_path / "q").write_text('{"id": "a", "platform": "x"}\n{"id": "b"}\n')
    (tmp_path / "d").write_text('{"id": "a", "verdict": "y"}\n{"org": "1", "verdict": "m", "basis": "seen"}\n')
    (tmp_path / "b").write_text('{"id": "a", "n": 1}\n{"id": "a", "n": 2}\n{"n": 3}\n')
    (tmp_path / "e").write_text("# no\nA = 'x=y'\nB=\"2\"\nA=z\n=3\nC=\nD\n")
    assert [r.id for r in captured.queue(spark, str(tmp_path / "q")).orderBy("pos").collect()] == ["a", "b"]
    assert [(r.id, r.org, r.verdict, r.basis) for r in captured.decisions(spark, str(tmp_path / "d")).orderBy("decision_no").collect()] == [("a", None, "y", None), (None, "1", "m", "seen")]
    assert rows(captured.briefs(spark, str(tmp_path / "b"))) == [("a", '{"id": "a", "n": 2}')]
    assert captured.settings(spark, str(tmp_path / "e")) == {"A": "x=y", "B": "2"}


def test_verdicts_on_values_and_unverified_retries(spark):
    o = lambda i, platform, signal, proof: (i, "1", platform, signal, proof)
    queued = spark.createDataFrame([o("s", "company_site", "company_profile", "org_number_on_page"), o("h", "x", "profile_handle", "declared_on_verified_company_site:p"), o("w", "news", "public_post", "")], "id string, organisation_number string, platform string, signal_type string, identity_proof string")
    d = spark.createDataFrame([(0, None, "1", "n"), (1, "s", None, "m"), (2, "h", None, "y")], "decision_no int, id string, org string, verdict string")
    old = engine.audit_label(d.where("false"), queued).unionByName(spark.createDataFrame([("w", True, True, None, "machine", None, None, None, None, None)], "id string, exact_entity boolean, metric_correct boolean, sentiment_correct boolean, labelled_by string, labelled_at string, reviewer string, basis string, risk_tier string, derived_from string"))
    got = rows(engine.audit_label(d, queued, old), "id", "exact_entity", "metric_correct", "labelled_by", "derived_from")
    assert got == [("h", True, True, "human", None), ("s", True, False, "human", None), ("w", True, True, "machine", None)]
    first = rows(engine.audit_label(d.where("decision_no < 2"), queued), "id", "exact_entity", "derived_from")
    assert first == [("h", True, "s"), ("s", True, None)]
    tries = [("a", 0, "GET", None, 0, "CERTIFICATE_VERIFY_FAILED", True), ("a", 1, "GET", 200, 1, None, False), ("b", 0, "GET", None, 0, "CERTIFICATE_VERIFY_FAILED", True), ("b", 1, "GET", 404, 0, None, False), ("c", 0, "GET", 200, 0, None, None)]
    out = brief.fetch_outcomes(spark.createDataFrame(tries, "url string, attempt int, method string, status int, redirects int, error string, verified boolean"))
    assert rows(out, "url", "state", "tls_verified") == [("a", "ok", False), ("b", "failed", True), ("c", "ok", True)]


def test_changes_to_itself_are_none_and_samples_are_stable(spark, sf):
    from quarrystone.plans import projection as px

    current = px.snapshot(spark, sf, True)
    assert reconcile.changes(current, current).count() == 0
    c = px.companies(spark, sf)
    picks = [rows(sampling.representative(c.repartition(n), 40, "s"), "org") for n in (1, 7)]
    assert picks[0] == picks[1] and len(picks[0]) == 40
    assert len(rows(sampling.risk_weighted(c, 40, "s"), "org")) == 40


def test_quotas_redistribute(spark):
    def take(count, have):
        sizes = spark.createDataFrame(list(have.items()), "risk_tier string, have long")
        return {r.risk_tier: r["take"] for r in audit.quotas(sizes, count).collect()}

    assert take(100, {"primary_key": 500}) == {"inferred": 0, "declared": 0, "corroborated": 0, "proven_on_page": 0, "primary_key": 100}
    assert sum(take(100, dict.fromkeys(audit.WEIGHTS, 500)).values()) == 100
    assert take(100, {"inferred": 10, "declared": 500, "corroborated": 25, "proven_on_page": 500, "primary_key": 500}) == {"inferred": 10, "declared": 35, "corroborated": 25, "proven_on_page": 20, "primary_key": 10}


def test_lists_change_by_item_and_only_for_present_companies(spark):
    schema = f"org string, field string, value string, availability string, period string, currency string, statement string, evidence_id string, url string, retrieved_at string, sha string, first_seen string, items {reconcile.ITEMS}"
    people = lambda *names: [(f"DAGL|{n}", n, n, "managing_director", None) for n in names]
    row = lambda org, items, state="available", field="leadership": (org, field, json.dumps([x[1] for x in items]) if items else None, state, None, None, None, "e", "u", "t", "h", None, items)
    before = spark.createDataFrame([row("1", people("A", "B")), row("2", people("A")), row("3", people("A")), row("4", people("A")), row("5", None, "not_available")], schema)
    after = spark.createDataFrame([row("1", people("B", "C")), row("2", None, "blocked"), row("3", None, "not_available"), row("5", people("A"))], schema)
    got = rows(reconcile.changes(before, after), "org", "change_type", "old_value", "new_value", "item_name")
    assert got == [("1", "departed_role", "A", None, "A"), ("1", "new_role", None, "C", "C"), ("2", "source_unavailable", '["A"]', '["A"]', None), ("3", "became_unavailable", '["A"]', None, None), ("5", "became_available", None, '["A"]', None)]
    assert rows(reconcile.claims(before, after), "org", "value", "stale") == [("1", '["B", "C"]', False), ("2", '["A"]', True), ("3", None, False), ("5", '["A"]', False)]
    report_ = reconcile.refresh_report(before, after).first()
    assert (report_.dropped, report_.self_changes, report_.passed) == (1, 0, False)


def test_silent_companies_fail_whatever_was_known(spark):
    claim = "org string, field string, value string, availability string, period string, currency string, statement string, evidence_id string, url string, retrieved_at string, sha string, first_seen string"
    row = lambda org, value: (org, "legal_name", value, "available", None, None, None, f"e{org}", "u", "t", "h", None)
    orgs = spark.createDataFrame([("1", 0), ("2", 1), ("3", 2)], "org string, pos int")
    out = engine.run(orgs, spark.createDataFrame([row("1", "A"), row("3", "C")], claim), spark.createDataFrame([row("1", "A"), row("2", "B")], claim), spark.createDataFrame([("1", "x")], "org string, platform string"), anchors=orgs.where("org = '1'"))
    got = {r.org: r for r in out.envelopes.collect()}
    assert {k: r.status for k, r in got.items()} == {"1": "completed", "2": "failed", "3": "completed_without_registry_anchor"}
    lost = got["2"]
    assert [(c.field, c.value, c.availability) for c in lost.claims] == [("legal_name", None, "failed")] and lost.claims[0].note == engine.NO_RESULT and lost.changes == [] and lost.legal_identity.legal_name is None
    assert got["1"].legal_identity.legal_name == "A" and got["1"].platforms == ["x"] and got["1"].summary.evidence_ids == ["e1"] and "A is a registered entity" in got["1"].summary.text
    total = out.totals("r", 3, 10).first()
    assert (total.emitted_envelopes, total.terminal_states["failed"], total.observations, total.passed) == (3, 1, 1, True)


def test_run_has_every_input(spark, sf):
    from quarrystone.plans import projection as px

    c = px.companies(spark, sf)
    claims = px.snapshot(spark, sf, True).withColumn("note", F.lit(None).cast("string")).where(F.substring("org", 8, 1) != "3")
    seen = c.select("org", F.lit("brreg").alias("platform"))
    out = engine.run(c, claims, px.snapshot(spark, sf, False).withColumn("note", F.lit(None).cast("string")).limit(0), seen)
    states = dict(rows(out.report))
    assert sum(states.values()) == c.count() and states["failed"] > 0
    text = engine.summarise(claims, seen, out.changes)
    assert all("rests on official records alone" in r.text for r in text.collect())


def test_people_presence_and_activity(spark):
    f = F.create_map(F.lit("managing_director"), F.lit("Kari"), F.lit("board_chair"), F.lit("Kari"), F.lit("official_website"), F.lit("https://x"), F.lit("places.rating"), F.lit("4.5"), F.lit("places.rating_count"), F.lit("9"))
    got = spark.range(1).select(synthesis.people(f, F.lit(3)), synthesis.presence(f, F.lit("org_number_on_page"), F.array(F.lit("a"), F.lit("b"))), synthesis.activity(F.lit(0), F.lit(1), F.lit("2024-01-01"))).first()
    assert got[0] == "Kari is both registered managing director and board chair. The board has 3 registered members."
    assert "from 9 ratings" in got[1] and got[1].endswith("Confirmed presence on a and b.") and "1 dated post of its own" in got[2]


def test_streams(spark, tmp_path):
    d = tmp_path / "feed"
    rows_ = [("a", "ACTIVE", "2024-01-01 00:00:00"), ("a", "ACTIVE", "2024-01-02 00:00:00"), ("b", "INACTIVE", "2024-01-01 00:00:00"), ("c", "ACTIVE", "2024-01-03 00:00:00")]
    spark.createDataFrame(rows_, "uuid string, status string, changed string").withColumn("changed", F.to_timestamp("changed")).write.parquet(str(d))
    stream = spark.readStream.schema("uuid string, status string, changed timestamp").parquet(str(d))
    q = streaming.feed_entries(stream).writeStream.format("memory").queryName("feed_out").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination()
    assert rows(spark.table("feed_out"), "uuid") == [("a",), ("c",)]


def test_report_edges(spark):
    df = spark.createDataFrame([("a", v) for v in (4, 1, 3, 2)] + [("b", None)], "g string, v long")
    assert rows(report.percentiles(df, ["g"], "v"), "g", "p50", "p95") == [("a", 3, 4)]
    assert rows(report.upper_median(df, ["g"], "v")) == [("a", 3)]


def test_briefs_and_fetches(spark):
    from quarrystone.operators import brief

    pages = spark.createDataFrame([(ORG, "a", f"Org.nr {ORG} her"), (ORG, "b", "intet"), (OTHER, "c", f"Org.nr {ORG}"), ("1", "d", "x")], "org string, url string, text string")
    found = brief.page_findings(pages)
    assert [r.span for r in found.where("url = 'a'").collect()] == [f"Org.nr {ORG} her"]
    held = spark.createDataFrame([("1", True)], "org string, corroborated boolean")
    got = {r.org: r.hint.split(" - ")[0] for r in brief.site_briefs(found, held).collect()}
    assert got == {ORG: "likely YES", OTHER: "CHECK CAREFULLY", "1": "likely YES"}
    tries = [("a", 0, "GET", 503, 0), ("a", 1, "GET", 200, 2), ("b", 0, "GET", 403, 0), ("c", 0, "GET", 429, 0), ("c", 1, "GET", None, 0), ("c", 2, "GET", 500, 0), ("d", 0, "POST", 429, 0), ("e", 0, "GET", None, 0)]
    out = brief.fetch_outcomes(spark.createDataFrame([(*t, None) for t in tries], "url string, attempt int, method string, status int, redirects int, error string"))
    assert rows(out, "url", "state", "requests") == [("a", "ok", 4), ("b", "blocked", 1), ("c", "failed", 3), ("d", "blocked", 1), ("e", "failed", 1)]
    linked = brief.contact_candidates(spark.createDataFrame([(ORG, "https://x.no/", '<a href="/Om-oss#top">vi</a><a href="//y.no/kontakt">y</a>')], "org string, url string, html string"))
    assert [r.candidate for r in linked.orderBy("pos").collect()] == ["https://x.no/Om-oss", "https://x.no/kontakt", "https://x.no/contact"]


def test_observations_pass_the_gate(spark):
    from quarrystone.operators import observe

    sha = "a" * 64
    site_rows = spark.createDataFrame([(ORG, "https://x.no", "2024", sha, "org_number_on_page", "s", ("T",)), (OTHER, "https://y.no", "2024", sha, "", None, ("U",))], "org string, url string, retrieved_at string, sha string, proof string, span string, page struct<title:string>")
    linked = spark.createDataFrame([(ORG, 0, "x", "https://x.com/a", "https://x.no", "2024", sha, "org_number_on_page")], "org string, place int, platform string, url string, site_url string, retrieved_at string, sha string, proof string")
    entity = spark.createDataFrame([(ORG, "Q1", "L", None, "https://no.wikipedia.org/wiki/A", None, "https://x.com/a", None, None, None, None, "2024", sha)], "org string, qid string, label string, website string, wikipedia_no string, wikipedia_en string, handle_x string, handle_facebook string, handle_instagram string, handle_youtube string, handle_linkedin string, retrieved_at string, sha string")
    dated = spark.createDataFrame([(ORG, 0, ("t", "2024-01-02", None), "https://x.no/n", "2024", sha, "org_number_on_page"), (ORG, 1, ("", "2024-01-01", None), "https://x.no/n", "2024", sha, "org_number_on_page")], "org string, pos int, post struct<title:string,date:string,url:string>, page_url string, retrieved_at string, sha string, proof string")
    every = observe.sites(site_rows).unionByName(observe.handles(linked)).unionByName(observe.knowledge(entity)).unionByName(observe.posts(dated))
    got = {r.id.removeprefix(ORG): r.tier for r in observe.published(every).withColumn("tier", audit.risk_tier()).collect()}
    assert got == {"-company_site-home": "proven_on_page", "-x-handle-0": "declared", "-wikidata-entity": "proven_on_page", "-wikipedia-no": "declared", "-x-wikidata-0": "declared", "-company_site-post-0": "declared"}
    assert rows(observe.activity_claims(dated)) == [(ORG, "2024-01-02", 2)]


def test_every_part_is_a_company_and_the_first_of_equal_names_wins(spark, sf):
    companies = spark.createDataFrame([("b", 2, "DRIFT NORD"), ("a", 1, "NORD DRIFT"), ("c", 0, "SKIP"), ("d", 3, "NORD DRIFT BERGEN")], "org string, pos int, name string")
    entries = spark.createDataFrame([(1, "Nord Drift Bergen"), (2, "Drift Nord"), (3, "Nord")], "entry_id int, name string")
    assert sorted(rows(connectors.contained(entries, companies), "entry_id", "org", "exact")) == [(1, "a", False), (2, "a", True)]
    p = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_name", "p_type", projection.org_of(F.col("p_partkey")).alias("org")).orderBy("p_partkey").collect()
    tokens = lambda t: {x for x in re.findall("[a-z0-9]+", t.lower()) if len(x) > 1 and x not in fn.LEGAL_WORDS}
    want = []
    for r in p:
        have = tokens(f"{r.p_name} {r.p_type}")
        org, own = next((c.org, own) for c in p if (own := tokens(c.p_type)) and own <= have)
        want.append((r.p_partkey, org, len(own) == len(have)))
    assert sorted(rows(catalog.token_containment(spark, sf), "entry_id", "org", "exact")) == want
