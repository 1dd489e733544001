"""Observations of each source as rows of the audit's form; only what passes the gate is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import audit
from .connectors import HANDLE_PROPERTIES, WIKIPEDIAS

COLUMNS = [x.split()[0] for x in audit.OBSERVATION.split(", ")]


def _rows(df: DataFrame, **values: Column | str | bool) -> DataFrame:
    """All columns of an observation; those not given are null, or as every published source has them."""
    given = {"exact_entity": True, "rights_status": "approved", "organisation_number": F.col("org"), "retrieved_at": F.col("retrieved_at"), "content_sha256": F.col("sha")} | values
    kinds = dict(x.split() for x in audit.OBSERVATION.split(", "))
    column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(*(column(given.get(c)).cast(kinds[c]).alias(c) for c in COLUMNS))


def _id(*parts: Column | str) -> Column:
    return F.concat(F.col("org"), *(p if isinstance(p, Column) else F.lit(p) for p in parts))


def published(observations: DataFrame) -> DataFrame:
    return observations.where(audit.publishable())


def registry(entities: DataFrame) -> DataFrame:
    """entities: (org, url, retrieved_at, sha)."""
    return _rows(entities, id=_id("-brreg-entity"), platform="brreg", signal_type="company_profile", source_url=F.col("url"), identity_proof="organisation_number_primary_key", acquisition_mode="official_api", source_class="official_registry")


def sites(gated: DataFrame) -> DataFrame:
    """Proven sites: (org, url, retrieved_at, sha, proof, span, page)."""
    title = F.when(F.col("page.title") != "", F.to_json(F.struct(F.substring("page.title", 1, 200).alias("title"))))
    return _rows(gated.where("proof != ''"), id=_id("-company_site-home"), platform="company_site", signal_type="company_profile", source_url=F.col("url"), identity_proof=F.col("proof"), acquisition_mode="permitted_public_page", source_class="company_owned", evidence_span=F.col("span"), metrics=title)


def handles(declared: DataFrame) -> DataFrame:
    """Profiles that a proven site links to: (org, place, platform, url, site_url, retrieved_at, sha, proof); place counts from 0 by platform."""
    return _rows(declared, id=_id("-", F.col("platform"), "-handle-", F.col("place").cast("string")), platform=F.col("platform"), signal_type="profile_handle", source_url=F.col("site_url"), identity_proof=F.concat(F.lit("declared_on_verified_company_site:"), F.col("proof")), acquisition_mode="permitted_public_page", source_class="company_owned", evidence_span=F.col("url"), metrics=F.to_json(F.struct(F.col("url").alias("declared_url"))))


def ads(resolved: DataFrame) -> DataFrame:
    """Adverts: (org, place, url, title, published, expires, municipality, positions, retrieved_at, sha)."""
    facts = F.to_json(F.struct("published", "expires", "municipality", "positions"))
    return _rows(resolved, id=_id("-job_board-posting-", F.col("place").cast("string")), platform="job_board", signal_type="job_posting", source_url=F.col("url"), identity_proof="employer_org_number_in_official_feed", acquisition_mode="official_api", source_class="public_mention", evidence_span=F.substring("title", 1, 300), observed_at=F.col("published"), metrics=facts)


def places(matched: DataFrame) -> DataFrame:
    """Matched places: (org, proof, span, maps_url, rating, ratings, place_id, retrieved_at, sha)."""
    facts = F.to_json(F.struct("rating", F.col("ratings").alias("rating_count"), "place_id"))
    return _rows(matched, id=_id("-google_places-place"), platform="google_places", signal_type="place_summary", source_url=F.col("maps_url"), identity_proof=F.col("proof"), acquisition_mode="official_api", source_class="customer_review", evidence_span=F.col("span"), metrics=facts)


def knowledge(entities: DataFrame) -> DataFrame:
    """The entity, its encyclopedia pages and its handles, of rows as connectors.wikidata gives them with retrieved_at and sha."""
    url = F.concat(F.lit("https://www.wikidata.org/wiki/"), F.col("qid"))
    common = {"acquisition_mode": "official_api", "source_class": "public_mention"}
    out = _rows(entities, id=_id("-wikidata-entity"), platform="wikidata", signal_type="company_profile", source_url=url, identity_proof="wikidata_p2333_organisation_number", metrics=F.to_json(F.struct("qid", "label")), **common)
    for lang in WIKIPEDIAS.values():
        page = F.col(f"wikipedia_{lang}")
        out = out.unionByName(_rows(entities.where(page.isNotNull()), id=_id(f"-wikipedia-{lang}"), platform="wikipedia", signal_type="company_profile", source_url=page, identity_proof=F.concat(F.lit("wikidata_p2333_sitelink:"), F.col("qid")), metrics=F.to_json(F.struct(F.lit(lang).alias("language"))), **common))
    every = F.array_compact(F.array(*(F.when(F.col(f"handle_{name}").isNotNull(), F.struct(F.lit(name).alias("platform"), F.lit(p).alias("property"), F.col(f"handle_{name}").alias("url"))) for p, (name, _) in HANDLE_PROPERTIES.items())))
    each = entities.select("org", "qid", "retrieved_at", "sha", F.posexplode(every).alias("place", "h"))
    return out.unionByName(_rows(each, id=_id("-", F.col("h.platform"), "-wikidata-", F.col("place").cast("string")), platform=F.col("h.platform"), signal_type="profile_handle", source_url=url, identity_proof=F.concat(F.lit("wikidata_p2333_statement:"), F.col("h.property")), evidence_span=F.col("h.url"), metrics=F.to_json(F.struct(F.col("h.url").alias("declared_url"), F.col("h.property").alias("property"))), **common))


def posts(dated: DataFrame) -> DataFrame:
    """Dated posts of proven sites: (org, pos, post, page_url, retrieved_at, sha, proof), ten for each organisation at most."""
    p = F.col("post")
    return _rows(dated.where("pos < 10"), id=_id("-company_site-post-", F.col("pos").cast("string")), platform="company_site", signal_type="public_post", source_url=F.coalesce(p["url"], F.col("page_url")), identity_proof=F.concat(F.lit("published_on_verified_company_site:"), F.col("proof")), acquisition_mode="permitted_public_page", source_class="company_owned", evidence_span=F.substring(p["title"], 1, 300), observed_at=p["date"], metrics=F.to_json(F.struct(p["date"].alias("published"))))


def activity_claims(dated: DataFrame) -> DataFrame:
    """(org, latest, n_posts) from the same rows."""
    return dated.where("pos < 10").groupBy("org").agg(F.max("post.date").alias("latest"), F.count(F.lit(1)).alias("n_posts"))


def source_stats(observations: DataFrame) -> DataFrame:
    """By platform: observations, organisations, and how many of them pass the gate."""
    return observations.groupBy("platform").agg(F.count(F.lit(1)).alias("observations"), F.count_distinct("organisation_number").alias("organisations"), F.count_if(audit.publishable()).alias("published"))
