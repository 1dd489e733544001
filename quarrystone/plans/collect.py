"""From captured responses to claims, evidence and observations of every source.

Responses are rows (org, kind, url, final_url, ok, blocked, status, error, body,
retrieved_at, sha); kind is entity, roles, accounts, subunits, website, places or
news, news with a column ``rank``. Each source is one DataFrame keyed by
organisation; every organisation gets each field of a source, with a state that
says why a value is missing. Sources other than the registry's own record speak
only of organisations that the registry knows (those with an anchor).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as fn
from ..operators import connectors, observe, registry, site
from ..operators.reconcile import FINANCIAL, ITEMS
from ..sources import captured

WEBSITE = ("official_website", "website_title", "website_description", "social_handles")
PLACES = ("places.rating", "places.rating_count", "places.address")
JOBS = ("jobs.active_count", "jobs.postings")
ACTIVITY = ("activity.latest_post_date", "activity.posts")
KNOWLEDGE = ("wikidata.qid", *connectors.VALUE_PROPERTIES.values(), "wikidata.wikipedia")
CAPTURED = ("url", "final_url", "status", "retrieved_at", "sha")


@dataclass
class Collected:
    """What one run has captured, in normal form."""

    claims: DataFrame  # (org, field, value, availability, confidence, period, ..., evidence_id, url, retrieved_at, sha, note, items)
    evidence: DataFrame  # (org, evidence_id, url, source_class, retrieved_at, sha, http_status, method)
    observations: DataFrame  # as operators.observe builds them, published ones only
    errors: DataFrame  # (org, stage, message)
    anchors: DataFrame  # (org): organisations with a registry record


def _claim(field: str, value: Column | None, state: Column | str | None = None, note: Column | str | None = None, confidence: Column | float = 1.0, items: Column | None = None, **more: Column) -> Column:
    """A claim as a struct; without a state it is available where there is a value."""
    text = F.lit(None).cast("string") if value is None else F.nullif(value.cast("string"), F.lit(""))
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    there = text.isNotNull()
    own = F.when(there, "available").otherwise("not_available") if state is None else column(state)
    extra = [more.get(k, F.lit(None)).cast("string").alias(k) for k in ("period", "currency", "statement", "identity_proof")]
    return F.struct(
        F.lit(field).alias("field"), text.alias("value"), own.alias("availability"), F.when(there, column(confidence)).otherwise(0.0).cast("double").alias("confidence"), *extra,
        F.when(~there | (F.lit(state is not None)), column(note)).cast("string").alias("note"), (F.lit(None) if items is None else F.when(there, items)).cast(ITEMS).alias("items"),
    )


def _missing(fields: tuple[str, ...], state: Column | str, note: Column | str) -> list[Column]:
    return [_claim(f, None, state, note) for f in fields]


def _told(rows: DataFrame, claims: list[Column] | Column, evidence: str | None) -> DataFrame:
    """One row for each claim, with its evidence where there is any; rows bring the captured columns."""
    every = claims if isinstance(claims, Column) else F.array(*claims)
    kept = rows.select("org", *(F.col(c) if evidence and c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("url", "retrieved_at", "sha")), F.inline(every))
    return kept.select(
        "org", "field", "value", "availability", "confidence", "period", "currency", "statement", "identity_proof",
        F.lit(evidence).cast("string").alias("evidence_id"), "url", "retrieved_at", "sha", F.lit(None).cast("string").alias("first_seen"), "note", "items",
    )


def _cited(rows: DataFrame, evidence: str, source_class: str, method: str, url: str = "url") -> DataFrame:
    """Evidence of rows with the captured columns."""
    return rows.select("org", F.lit(evidence).alias("evidence_id"), F.col(url).alias("url"), F.lit(source_class).alias("source_class"), "retrieved_at", "sha", (F.col("status") if "status" in rows.columns else F.lit(None)).cast("int").alias("http_status"), F.lit(method).alias("method"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _json_of(body: Column, opening: str) -> Column:
    """The body if it is JSON that begins so; else null."""
    return F.when(F.ltrim(body).startswith(opening) & F.try_parse_json(body).isNotNull(), body)


def _number(x: Column) -> Column:
    """A figure as text; whole numbers without a fraction."""
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))


def _entity(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    base = registry.entity_claims(rows.select("org", "ok", "blocked", "status", "body"))
    counted = rows.select("org", *CAPTURED, F.from_json("body", registry.ENTITY)["registreringsdatoAntallAnsatteEnhetsregisteret"].alias("counted"), (F.from_json("body", registry.ENTITY)["organisasjonsnummer"] == F.col("org")).alias("mine"))
    mine = F.coalesce(F.col("mine"), F.lit(False))
    told = base.join(counted, "org").select(
        "org", "field", "value", "availability", "confidence", F.when((F.col("field") == "employees_registered") & F.col("value").isNotNull(), F.col("counted")).alias("period"),
        *(F.lit(None).cast("string").alias(c) for c in ("currency", "statement", "identity_proof")),
        *(F.when(mine, x).cast("string").alias(n) for n, x in (("evidence_id", F.lit("ev-registry")), ("url", F.col("url")), ("retrieved_at", F.col("retrieved_at")), ("sha", F.col("sha")))),
        F.lit(None).cast("string").alias("first_seen"), "note", F.lit(None).cast(ITEMS).alias("items"),
    )
    return told, _cited(counted.where(mine), "ev-registry", "official_registry", "json_field")


def _roles(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    body = _json_of(F.col("body"), "{")
    every = F.flatten(F.transform(F.from_json(body, registry.ROLES)["rollegrupper"], lambda g: F.coalesce(g["roller"], F.array())))
    label = F.create_map(*(F.lit(x) for kv in registry.ROLE_LABELS.items() for x in kv))
    current = F.filter(F.coalesce(every, F.array()), lambda r: ~F.coalesce(r["avregistrert"], F.lit(False)) & r["type"]["kode"].isin(*registry.ROLE_LABELS) & registry.holder(r).isNotNull())
    people = F.transform(current, lambda r: F.struct(label[r["type"]["kode"]].alias("role"), r["type"]["kode"].alias("role_code"), registry.holder(r).alias("name")))
    held = rows.select("org", "url", "status", "ok", "blocked", "retrieved_at", "sha", body.isNotNull().alias("usable"), people.alias("people"))
    p = F.col("people")
    items = F.transform(p, lambda x: F.struct(F.to_json(F.struct(x["role_code"], x["name"])).alias("key"), F.to_json(x).alias("item"), x["name"].alias("name"), x["role"].alias("role"), F.lit(None).cast("string").alias("place")))
    first = lambda code: F.get(F.filter(p, lambda x: x["role_code"] == code), F.lit(0))["name"]
    some, none = held.where(F.col("usable") & (F.size("people") > 0)), held.where(F.col("usable") & (F.size("people") == 0))
    told = [
        _told(held.where("not usable"), _missing(("leadership",), registry.missing_state(), "roles endpoint returned no usable payload"), None),
        _told(none, _missing(("leadership",), "not_available", "no current registered leadership roles of a published type"), "ev-roles"),
        _told(some, [_claim("leadership", F.to_json(F.array_sort(p)), items=items), _claim("managing_director", first("DAGL")), _claim("board_chair", first("LEDE"))], "ev-roles"),
    ]
    return _union(told), _cited(held.where("usable"), "ev-roles", "official_registry", "json_roles")


def _accounts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    filings = F.from_json(_json_of(F.col("body"), "["), registry.FILING)
    held = rows.select("org", "url", "status", "ok", "blocked", "retrieved_at", "sha", filings.alias("filings"))
    until = lambda x: F.coalesce(x["regnskapsperiode"]["tilDato"], F.lit(""))
    ranked = F.transform("filings", lambda x, i: F.struct((x["regnskapstype"] == "SELSKAP").alias("company"), until(x).alias("until"), (-i).alias("place"), x.alias("filing")))
    years = F.array_distinct(F.filter(F.transform("filings", lambda x: F.substring(until(x), 1, 4)), lambda y: y != ""))
    usable = F.coalesce(F.size("filings") > 0, F.lit(False))
    own = held.where(usable).select("org", "url", "status", "retrieved_at", "sha", F.array_max(ranked)["filing"].alias("f"), F.sort_array(years, asc=False).alias("years"))
    f = F.col("f")
    r = f["resultatregnskapResultat"]
    figures = (r["driftsresultat"]["driftsinntekter"]["sumDriftsinntekter"], r["driftsresultat"]["driftsresultat"], r["ordinaertResultatFoerSkattekostnad"], r["aarsresultat"], f["eiendeler"]["sumEiendeler"], f["egenkapitalGjeld"]["egenkapital"]["sumEgenkapital"])
    period = F.concat_ws("/", F.coalesce(f["regnskapsperiode"]["fraDato"], F.lit("None")), F.coalesce(f["regnskapsperiode"]["tilDato"], F.lit("None")))
    claims = [
        _claim(k, _number(v), note="line item not present in the filed statement; not zero", period=F.when(v.isNotNull(), period), currency=F.when(v.isNotNull(), f["valuta"]), statement=F.when(v.isNotNull(), f["regnskapstype"]))
        for k, v in zip(FINANCIAL, figures, strict=True)
    ]
    claims.append(_claim("financial_history.years", F.when(F.size("years") > 0, F.to_json("years"))))
    missing = _missing((*FINANCIAL, "financial_history.years"), registry.missing_state(), "no annual accounts filed or returned for this entity; not zero")
    return _told(held.where(~usable), missing, None).unionByName(_told(own, claims, "ev-accounts")), _cited(own, "ev-accounts", "official_registry", "json_accounts")


def _subunits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    body = _json_of(F.col("body"), "{")
    units = F.coalesce(F.from_json(body, registry.SUBUNITS)["_embedded"]["underenheter"], F.array())
    place = lambda u: F.struct(u["organisasjonsnummer"].alias("organisation_number"), u["navn"].alias("name"), fn.address(F.coalesce(u["beliggenhetsadresse"], u["forretningsadresse"])).alias("address"), u["beliggenhetsadresse"]["kommune"].alias("municipality"))
    held = rows.select("org", "url", "status", "ok", "blocked", "retrieved_at", "sha", body.isNotNull().alias("usable"), F.transform(units, place).alias("units"))
    items = F.transform("units", lambda u: F.struct(u["organisation_number"].alias("key"), F.to_json(u).alias("item"), u["name"].alias("name"), F.lit(None).cast("string").alias("role"), u["municipality"].alias("place")))
    listed = F.when(F.size("units") > 0, F.to_json(F.array_sort("units")))
    told = _told(held.where("usable"), [_claim("locations", listed, note="no registered subunits; the company has no separate registered workplaces", items=items)], "ev-subunits")
    lost = _told(held.where("not usable"), _missing(("locations",), registry.missing_state(), "subunit endpoint returned no usable payload"), None)
    return told.unionByName(lost), _cited(held.where("usable"), "ev-subunits", "official_registry", "json_subunits")


def _website(anchored: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Claims, evidence and observations of declared sites, and the proven ones (org, url, html, proof)."""
    asked = anchored.join(rows.select("org", F.coalesce("final_url", "url").alias("url"), "status", "ok", "blocked", "error", "retrieved_at", "sha", F.col("body").alias("html")), "org", "left")
    ok = F.col("seed").isNotNull() & F.coalesce(F.col("ok"), F.lit(False))
    undeclared = _told(asked.where("seed is null"), _missing(WEBSITE, "not_available", "no website registered in Enhetsregisteret and search discovery is not enabled in v1"), None)
    state = F.when(F.col("blocked"), "blocked").otherwise("failed")
    unread = _told(asked.where(F.col("seed").isNotNull() & ~ok), _missing(WEBSITE, state, F.concat(F.lit("registry website could not be retrieved: "), F.coalesce("error", F.lit("None")))), None)
    gated = site.gate(site.parsed(asked.where(ok)))
    page = F.col("page")
    proven, open_ = gated.where("proof != ''"), gated.where("proof = ''")
    doubt = "registry-declared site lacks exact-entity evidence; not published as verified"
    unproven = _told(open_, [_claim("official_website", F.col("url"), "ambiguous", doubt, 0.5), *_missing(WEBSITE[1:], "ambiguous", doubt)], "ev-website")
    links = proven.select("org", F.posexplode("page.links").alias("pos", "href"))
    found = site.handle_rows(links.withColumn("href", F.when(F.col("href").startswith("//"), F.concat(F.lit("https:"), "href")).otherwise(F.col("href"))))
    by_org = found.groupBy("org").agg(F.array_sort(F.collect_list(F.struct("pos", "platform", "url"))).alias("handles"))
    linked = proven.join(by_org, "org", "left")
    handles = F.transform("handles", lambda h: F.struct(h["platform"].alias("platform"), h["url"].alias("url")))
    empty = F.lit(None).cast("string")
    items = F.transform("handles", lambda h: F.struct(h["platform"].alias("key"), F.to_json(F.struct(h["platform"].alias("platform"), h["url"].alias("url"))).alias("item"), empty.alias("name"), empty.alias("role"), empty.alias("place")))
    sure = F.col("confidence")
    claims = [
        _claim("official_website", F.col("url"), confidence=sure, identity_proof=F.col("proof")),
        _claim("website_title", page["title"], confidence=sure),
        _claim("website_description", page["description"], confidence=sure),
        _claim("social_handles", F.to_json(F.array_sort(handles)), note="no social profiles linked from the verified company site", confidence=sure, items=items),
    ]
    told = _union([undeclared, unread, unproven, _told(linked.drop("final_url"), claims, "ev-website")])
    spans = proven.withColumn("span", fn.span(F.concat_ws(" ", page["title"], page["description"], page["identity_excerpt"], page["structured_names"], page["body_text"]), F.col("org")))
    declared = linked.select("org", F.col("url").alias("site_url"), "retrieved_at", "sha", "proof", F.posexplode("handles").alias("place", "h")).select("*", "h.platform", "h.url")
    seen = observe.sites(spans).unionByName(observe.handles(declared))
    return told, _cited(gated, "ev-website", "company_owned", "html_identity_gate_v1"), seen, proven.select("org", "url", "html", "proof")


def _activity(anchored: DataFrame, proven: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    pages = rows.where("ok").select("org", "rank", F.coalesce("final_url", "url").alias("url"), "status", "retrieved_at", "sha", F.col("body").alias("html"))
    dated = site.dated_posts(pages.join(proven.select("org", "proof"), "org"))
    by_page = dated.groupBy("org", "rank", "url", "status", "retrieved_at", "sha", "proof").agg(F.count(F.lit(1)).alias("n_posts"), F.array_sort(F.collect_list(F.struct("pos", "post"))).alias("posts"))
    first = captured.first_with_posts(by_page)
    post = lambda x: x["post"]
    listed = F.to_json(F.transform(F.slice("posts", 1, 10), post))
    claims = [_claim("activity.latest_post_date", F.get("posts", F.lit(0))["post"]["date"], confidence=0.9), _claim("activity.posts", listed, confidence=0.9)]
    unseen = anchored.join(first.select("org"), "org", "left_anti").join(proven.select("org", F.lit(True).alias("proven")), "org", "left")
    why = F.when(F.col("proven"), "verified company site has no dated news, press or blog page we could read").otherwise("no verified company website, so no company-owned activity can be attributed")
    told = _told(first, claims, "ev-activity").unionByName(_told(unseen, _missing(ACTIVITY, "not_available", why), None))
    each = first.select("org", F.col("url").alias("page_url"), "retrieved_at", "sha", "proof", F.explode("posts").alias("x")).select("*", "x.pos", "x.post")
    return told, _cited(first, "ev-activity", "company_owned", "company_news_page_v1"), observe.posts(each)


def _places(anchored: DataFrame, rows: DataFrame | None) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    if rows is None:
        return _told(anchored, _missing(PLACES, "not_available", "place search is not configured"), None), None, None
    asked = anchored.join(rows.select("org", "status", "ok", "blocked", "error", "body", "retrieved_at", "sha"), "org", "left")
    every = connectors.places(asked.where("ok").select("org", "body"))
    chosen = connectors.place_match(every, anchored.select("org", F.col("seed").alias("domain"), "phone"))
    met = every.join(chosen, ["org", "pos"]).join(asked.select("org", "status", "retrieved_at", "sha"), "org")
    span = F.when(F.col("proof") == "places_website_matches_verified_domain", F.concat(F.lit("place website "), "website", F.lit(" matches the verified company domain"))).otherwise(F.concat(F.lit("place phone "), F.coalesce("national", "international"), F.lit(" matches the registry switchboard")))
    met = met.select("*", F.col("maps_url").alias("url"), span.alias("span"))
    claims = [
        _claim("places.rating", F.col("rating"), note="place found but Google holds no rating for it", confidence=0.95, identity_proof=F.when(F.col("rating").isNotNull(), F.col("proof"))),
        _claim("places.rating_count", F.col("ratings"), confidence=0.95),
        _claim("places.address", F.col("address"), confidence=0.95),
    ]
    rest = asked.join(met.select("org"), "org", "left_anti")
    payload = F.from_json("body", connectors.PLACES)["places"]
    skipped, ok = F.col("ok").isNull(), F.coalesce(F.col("ok"), F.lit(False))
    usable = F.try_parse_json("body").isNotNull()
    state = F.when(skipped, "not_available").when(~ok & F.col("blocked"), "blocked").when(~ok | ~usable, "failed").when(F.size(payload) > 0, "ambiguous").otherwise("not_available")
    why = (
        F.when(skipped, "place search skipped: the budget of this run admits no more")
        .when(~ok, F.concat(F.lit("Places search failed: "), F.coalesce("error", F.lit("None"))))
        .when(~usable, "Places returned an unusable payload")
        .when(F.size(payload) > 0, "no Places result could be tied to this legal entity by domain, phone or address")
        .otherwise("Places returned no candidate for this company")
    )
    told = _told(met, claims, "ev-places").unionByName(_told(rest, _missing(PLACES, state, why), None))
    return told, _cited(met, "ev-places", "customer_review", "places_text_search_v1"), observe.places(met)


def _knowledge(anchored: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """entities: (pos, qid, entity, retrieved_at, sha)."""
    found = connectors.wikidata(entities, anchored).withColumn("url", F.concat(F.lit("https://www.wikidata.org/wiki/"), F.col("qid")))
    pages = F.array_compact(F.array(*(F.when(F.col(f"wikipedia_{g}").isNotNull(), F.struct(F.lit(g).alias("lang"), F.col(f"wikipedia_{g}").alias("url"))) for g in connectors.WIKIPEDIAS.values())))
    claims = [
        _claim("wikidata.qid", F.col("qid"), identity_proof=F.lit("wikidata_p2333_organisation_number")),
        *(_claim(f, F.col(f.split(".")[1]), note="not recorded on the Wikidata entity", confidence=0.9) for f in connectors.VALUE_PROPERTIES.values()),
        _claim("wikidata.wikipedia", F.when(F.size(pages) > 0, F.to_json(pages)), confidence=0.9),
    ]
    rest = anchored.join(found.select("org"), "org", "left_anti")
    told = _told(found, claims, "ev-wikidata").unionByName(_told(rest, _missing(KNOWLEDGE, "not_available", "no Wikidata entity carries this organisation number"), None))
    return told, _cited(found, "ev-wikidata", "public_mention", "wikidata_wbgetentities_v1"), observe.knowledge(found)


def _jobs(anchored: DataFrame, details: DataFrame | None) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """details: adverts (url, body, retrieved_at, sha) of a feed that was read; None where it could not be."""
    if details is None:
        return _told(anchored, _missing(JOBS, "failed", "NAV vacancy feed unavailable: not primed"), None), None, None
    ads = connectors.resolved_ads(details, anchored)
    listed = F.array_sort(F.collect_list(F.struct("url", "title", "published", "expires", "municipality", "positions", "retrieved_at", "sha")))
    by_org = ads.groupBy("org").agg(listed.alias("ads"))
    held = anchored.select("org").join(by_org, "org", "left")
    head = F.get("ads", F.lit(0))
    held = held.select("org", "ads", head["url"].alias("url"), head["retrieved_at"].alias("retrieved_at"), head["sha"].alias("sha"))
    n = F.coalesce(F.size("ads"), F.lit(0))
    some, none = held.where("ads is not null"), held.where("ads is null")
    told = _told(some, [_claim("jobs.active_count", n), _claim("jobs.postings", F.to_json("ads"))], "ev-job-0").unionByName(
        _told(none, [_claim("jobs.active_count", F.lit(0), "available", "NAV vacancy feed was read; no active advert carries this organisation number"), _claim("jobs.postings", None)], None)
    )
    each = some.select("org", F.posexplode("ads").alias("place", "a")).select("org", "place", "a.*")
    cited = each.select("org", F.concat(F.lit("ev-job-"), F.col("place").cast("string")).alias("evidence_id"), "url", F.lit("public_mention").alias("source_class"), "retrieved_at", "sha", F.lit(None).cast("int").alias("http_status"), F.lit("nav_stilling_feed_v1").alias("method"))
    return told, cited, observe.ads(each)


def collect(organisations: DataFrame, responses: DataFrame, places: bool = False, entities: DataFrame | None = None, feed: bool = False, details: DataFrame | None = None) -> Collected:
    """All claims of organisations (org, pos).

    places: the place search is configured; entities: knowledge-base records, None
    where that source is off; feed: the vacancy feed is on; details: its adverts,
    None where it could not be read.
    """
    mine = responses.join(organisations.select("org").distinct(), "org", "left_semi")
    of = lambda kind: mine.where(F.col("kind") == kind)
    known = _json_of(F.col("body"), "{").isNotNull()
    anchors = of("entity").where(known).select("org")
    seed = fn.site_url(F.from_json("body", registry.ENTITY)["hjemmeside"])
    anchored = registry.identity(of("entity").where(known)).join(of("entity").where(known).select("org", seed.alias("seed")), "org")
    with_anchor = lambda kind: of(kind).join(anchors, "org", "left_semi")
    claims, evidence, seen = [], [], []

    def add(told: DataFrame, cited: DataFrame | None, found: DataFrame | None = None) -> None:
        claims.append(told)
        evidence.extend([] if cited is None else [cited])
        seen.extend([] if found is None else [found])

    add(*_entity(of("entity")), observe.registry(of("entity").where(known)))
    add(*_roles(with_anchor("roles")))
    add(*_accounts(with_anchor("accounts")))
    add(*_subunits(with_anchor("subunits")))
    *web, proven = _website(anchored, of("website"))
    add(*web)
    add(*_activity(anchored, proven, with_anchor("news")))
    add(*_places(anchored, with_anchor("places") if places else None))
    if entities is not None:
        add(*_knowledge(anchored, entities))
    if feed:
        add(*_jobs(anchored, details))
    lost = of("entity").where(~F.coalesce(known, F.lit(False))).select("org", F.lit("registry_entity").alias("stage"), F.coalesce("error", F.lit("entity not found in Enhetsregisteret")).alias("message"))
    return Collected(_union(claims), _union(evidence), observe.published(_union(seen)), lost, anchors)
