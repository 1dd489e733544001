"""Verification briefs for reviewers, fetch outcomes, and the projection that a viewer needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as fn
from . import site

#: The places of contact pages, and statuses by their meaning.
CONTACT_HINT = r"kontakt|om.?oss|about|contact|personvern|impressum"
CONTACT_PATHS = ("/kontakt", "/om-oss", "/contact", "/about")
REFUSED = (401, 403, 451)
TRANSIENT = (429, 500, 502, 503, 504)
VIEWER_FIELDS = (
    "legal_name", "business_address", "employees_registered", "operating_status", "managing_director", "board_chair", "leadership", "locations",
    "official_website", "website_description", "social_handles", "financials.revenue", "financials.operating_profit", "financials.net_result",
    "financials.total_assets", "financials.equity", "financial_history.years", "places.rating", "places.rating_count", "places.address",
    "wikidata.qid", "wikidata.website", "wikidata.employees", "wikidata.wikipedia", "jobs.active_count", "activity.latest_post_date", "activity.posts",
)


def contact_candidates(pages: DataFrame, most: int = 3) -> DataFrame:
    """(org, pos, candidate): pages of the same host that may name the organisation."""
    rows = site.parsed(pages)
    return rows.select("org", F.posexplode(F.slice(site.linked_pages(F.col("page"), F.col("url"), CONTACT_HINT, CONTACT_PATHS), 1, most)).alias("pos", "candidate"))


def page_findings(pages: DataFrame) -> DataFrame:
    """What each page (org, url, text) says: our number, others, and the span of ours."""
    labelled = F.filter(F.regexp_extract_all("text", F.lit(fn.LABELLED), F.lit(0)), lambda x: fn.digits(x).endswith(F.col("org")))
    bare = F.filter(F.regexp_extract_all("text", F.lit(fn.BARE), F.lit(1)), lambda x: fn.digits(x) == F.col("org"))
    rows = pages.withColumn("proof", fn.proof(F.col("text"), F.col("org"))).withColumn("others", fn.conflicts(F.col("text"), F.col("org")))
    found = F.coalesce(F.get(labelled, F.lit(0)), F.get(bare, F.lit(0)), F.lit(""))
    return rows.select("org", "url", "proof", "others", F.when(F.col("proof") != "", fn.span(F.col("text"), found)).alias("span"))


def site_briefs(findings: DataFrame, corroboration: DataFrame) -> DataFrame:
    """(org, ours, others, corroborated, hint): all pages of an organisation taken together; corroboration: (org, corroborated)."""
    every = findings.groupBy("org").agg(F.bool_or(F.col("proof") != "").alias("ours"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("others")))).alias("others"))  # a row for each fetched page, three at most
    return every.join(corroboration, "org", "left").select("org", "ours", "others", F.coalesce("corroborated", F.lit(False)).alias("corroborated")).withColumn("hint", hint())


def hint() -> Column:
    """A suggestion to a reviewer, never a label."""
    return (
        F.when(F.col("ours"), "likely YES - the organisation number appears on the site")
        .when(F.size("others") > 0, "CHECK CAREFULLY - the site shows a different organisation number")
        .when(F.col("corroborated"), "likely YES - a registry address or phone matches, no conflict found")
        .otherwise("UNCLEAR - only the registry declaration and the name match")
    )


def hint_counts(briefs: DataFrame) -> DataFrame:
    return briefs.groupBy(F.substring_index("hint", " - ", 1).alias("hint")).agg(F.count(F.lit(1)).alias("n"))


def knowledge_briefs(entities: DataFrame, registered: DataFrame) -> DataFrame:
    """Entities (org, label, website) against registry facts (org, name, site): shared name tokens, or the same site."""
    shared = F.array_sort(F.array_distinct(F.array_intersect(fn.name_tokens(F.col("label")), fn.name_tokens(F.col("name")))))
    same = F.coalesce((F.coalesce(F.col("website"), F.lit("")) != "") & (F.coalesce(F.col("site"), F.lit("")) != "") & (fn.bare_url(F.col("website")) == fn.bare_url(F.col("site"))), F.lit(False))
    rows = entities.join(registered, "org", "left").select("org", "label", shared.alias("shared"), same.alias("same_site"))
    return rows.select("org", F.array_join("shared", ",").alias("shared"), "same_site", ((F.size("shared") > 0) | F.col("same_site")).alias("corroborated"))


def fetch_outcomes(attempts: DataFrame, retries: int = 2) -> DataFrame:
    """One row for each url of attempts (url, attempt, method, status, redirects, error): what came of it.

    A GET goes on after a transient status or an error while retries are left;
    a POST never does, and there a 429 is a refusal, too. Where attempts tell
    whether they were ``verified``, one that was not counts only if it succeeded,
    and the row says so in tls_verified.
    """
    if "verified" in attempts.columns:
        attempts = attempts.where(F.coalesce("verified", F.lit(True)) | (F.col("status") < 400))
    checked = [F.coalesce("verified", F.lit(True)).alias("verified")] if "verified" in attempts.columns else []
    get = F.col("method") == "GET"
    settled = F.col("status").isNotNull() & (~get | ~F.col("status").isin(*TRANSIENT))
    last = F.struct((~settled).alias("open"), F.when(settled, F.col("attempt")).otherwise(-F.col("attempt")).alias("n"))
    tried = attempts.where(get & (F.col("attempt") <= retries) | ~get & (F.col("attempt") == 0))
    known = F.max_by("status", F.when(F.col("status").isNotNull(), F.col("attempt"))).alias("known")  # an error leaves the status that was seen before
    end = tried.groupBy("url").agg(F.min_by(F.struct("attempt", "method", "status", "error", *checked), last).alias("e"), known)
    used = tried.join(end, "url").where(F.col("attempt") <= F.col("e.attempt")).groupBy("url").agg((F.count(F.lit(1)) + F.sum(F.when(F.col("status").isNotNull(), F.coalesce("redirects", F.lit(0))).otherwise(0))).alias("requests"))
    status = F.coalesce("e.status", "known")
    refused = status.isin(*REFUSED) | ((F.col("e.method") == "POST") & (status == 429))
    state = F.when(status < 400, "ok").when(refused, "blocked").otherwise("failed")
    return end.join(used, "url").select("url", status.alias("status"), state.alias("state"), "requests", *([F.col("e.verified").alias("tls_verified")] if checked else []))


def viewer_profiles(claims: DataFrame, observations: DataFrame) -> DataFrame:
    """(org, name, municipality, platforms, fields): available values of the shown fields, and platforms with their signals."""
    shown = claims.where(F.col("field").isin(*VIEWER_FIELDS, "municipality"))
    there = F.col("availability") == "available"
    facts = shown.groupBy("org").agg(
        F.max(F.when((F.col("field") == "legal_name") & there, F.col("value"))).alias("name"),
        F.max(F.when((F.col("field") == "municipality") & there, F.col("value"))).alias("municipality"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(there & F.col("field").isin(*VIEWER_FIELDS), F.struct("field", "value"))))).alias("fields"),
    )
    seen = observations.groupBy("org").agg(F.array_sort(F.collect_set("platform")).alias("platforms"))
    return facts.join(seen, "org", "left").select("org", F.coalesce("name", "org").alias("name"), "municipality", F.coalesce("platforms", F.array()).alias("platforms"), "fields")
