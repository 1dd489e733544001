"""Third-party sources: vacancy feed, places, knowledge base. Candidates are found by name, published by number only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numbers as fn

FEED_PAGE = "items ARRAY<STRUCT<url: STRING, _feed_entry: STRUCT<uuid: STRING, status: STRING, businessName: STRING, sistEndret: STRING>>>, next_url STRING"
AD = "ad_content STRUCT<uuid: STRING, title: STRING, jobtitle: STRING, employer: STRUCT<name: STRING, orgnr: STRING>, published: STRING, expires: STRING, positioncount: INT, link: STRING, workLocations: ARRAY<STRUCT<municipal: STRING, city: STRING>>>"
PLACES = "places ARRAY<STRUCT<id: STRING, websiteUri: STRING, nationalPhoneNumber: STRING, internationalPhoneNumber: STRING, formattedAddress: STRING, rating: DOUBLE, userRatingCount: BIGINT, googleMapsUri: STRING, primaryTypeDisplayName: STRUCT<text: STRING>>>"
#: Properties of the knowledge base.
VALUE_PROPERTIES = {"P856": "wikidata.website", "P571": "wikidata.inception", "P1128": "wikidata.employees"}
HANDLE_PROPERTIES = {"P2002": ("x", "https://x.com/{}"), "P2013": ("facebook", "https://www.facebook.com/{}"), "P2003": ("instagram", "https://www.instagram.com/{}"), "P2397": ("youtube", "https://www.youtube.com/channel/{}"), "P4264": ("linkedin", "https://www.linkedin.com/company/{}")}
WIKIPEDIAS = {"nowiki": "no", "enwiki": "en"}


def feed_entries(pages: DataFrame) -> DataFrame:
    """Active entries of feed pages: (page_no, pos, url, name, changed)."""
    rows = pages.select("page_no", F.posexplode(F.from_json("body", FEED_PAGE)["items"]).alias("pos", "i"))
    return rows.where(F.col("i._feed_entry.status") == "ACTIVE").select("page_no", "pos", F.col("i.url").alias("url"), F.col("i._feed_entry.businessName").alias("name"), F.coalesce("i._feed_entry.sistEndret", F.lit("")).alias("changed"))


def contained(entries: DataFrame, companies: DataFrame) -> DataFrame:
    """entries with the first company (by pos) whose name tokens are all in the entry's: org, exact.

    A company's tokens can only be contained where its rarest token stands, so
    the join is an equi-join on that anchor; no pair is formed without it. Of
    companies with the same tokens only the first can win, so only it is matched.
    entries: (entry_id, name, ...), companies: (org, pos, name).
    """
    named = companies.select("org", F.col("pos").alias("company_pos"), F.array_sort(F.array_distinct(fn.name_tokens(F.col("name")))).alias("want")).where(F.size("want") > 0)
    want = named.groupBy("want").agg(F.min_by(F.struct("org", "company_pos"), "company_pos").alias("m")).select("m.org", "m.company_pos", "want")
    have = entries.withColumn("have", F.array_distinct(fn.name_tokens(F.col("name")))).where(F.size("have") > 0)
    rare = have.select(F.explode("have").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    spread = want.select("org", "company_pos", "want", F.explode("want").alias("token")).join(rare, "token", "left")
    anchor = spread.groupBy("org", "company_pos", "want").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    met = have.select("entry_id", "have", F.explode("have").alias("token")).join(anchor, "token").where(F.size(F.array_except("want", "have")) == 0)
    first = met.groupBy("entry_id").agg(F.min_by(F.struct("org", (F.size("want") == F.size("have")).alias("exact")), "company_pos").alias("m"))
    return entries.join(first, "entry_id").select(*entries.columns, "m.org", "m.exact")


def best_candidates(found: DataFrame, most: int = 150) -> DataFrame:
    """Distinct by url, the best score first: exact names, then the latest change; then the best of all."""
    own = Window.partitionBy("url").orderBy(F.desc("exact"), F.desc("changed"), "entry_id")
    return found.where("url is not null").withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n").orderBy(F.desc("exact"), F.desc("changed"), "entry_id").limit(most)


def resolved_ads(details: DataFrame, companies: DataFrame) -> DataFrame:
    """Adverts whose employer number is one of ours; details: (url, body, retrieved_at, sha)."""
    a = F.col("a")
    rows = details.select("url", "retrieved_at", "sha", F.from_json("body", AD)["ad_content"].alias("a")).withColumn("org", fn.digits(a["employer"]["orgnr"]))
    place = F.get(a["workLocations"], F.lit(0))
    mine = rows.join(companies.select("org").distinct(), "org", "left_semi")
    return mine.select("org", "url", a["uuid"].alias("uuid"), fn.or_else(a["title"], a["jobtitle"]).alias("title"), a["published"].alias("published"), a["expires"].alias("expires"), fn.or_else(place["municipal"], place["city"]).alias("municipality"), a["positioncount"].alias("positions"), "retrieved_at", "sha")


def job_counts(companies: DataFrame, ads: DataFrame, feed_ok: bool) -> DataFrame:
    """A checked zero is available; an unread feed is failed for everyone."""
    if not feed_ok:
        return companies.select("org", F.lit(None).cast("long").alias("value"), F.lit("failed").alias("availability"))
    n = ads.groupBy("org").agg(F.count(F.lit(1)).alias("n"))
    return companies.select("org").join(n, "org", "left").select("org", F.coalesce("n", F.lit(0)).alias("value"), F.lit("available").alias("availability"))


def place_match(places: DataFrame, companies: DataFrame) -> DataFrame:
    """The place of each company: the first with its host, else the first whose phone ends as its own.

    places: (org, pos, website, national, international), companies: (org, domain, phone).
    """
    c = companies.select("org", F.when(fn.host(F.col("domain")) != "", fn.host(F.col("domain"))).alias("own_host"), F.when(F.length(fn.digits(F.col("phone"))) >= 8, F.right(fn.digits(F.col("phone")), F.lit(8))).alias("tail"))
    ends = lambda k: F.right(fn.digits(F.col(k)), F.lit(8)) == F.col("tail")
    rank = F.when(fn.host(F.col("website")) == F.col("own_host"), 0).when(ends("national") | ends("international"), 1)
    met = places.join(c, "org").withColumn("rank", rank).where("rank is not null")
    proof = F.when(F.col("rank") == 0, "places_website_matches_verified_domain").otherwise("places_phone_matches_registry")
    return met.groupBy("org").agg(F.min_by(F.struct("pos", proof.alias("proof")), F.struct("rank", "pos")).alias("m")).select("org", "m.pos", "m.proof")


def places(responses: DataFrame) -> DataFrame:
    """Place results as rows: (org, pos, place_id, website, national, international, address, rating, ratings, maps_url)."""
    rows = responses.select("org", F.posexplode(F.from_json("body", PLACES)["places"]).alias("pos", "p"))
    return rows.select("org", "pos", F.col("p.id").alias("place_id"), F.col("p.websiteUri").alias("website"), F.col("p.nationalPhoneNumber").alias("national"), F.col("p.internationalPhoneNumber").alias("international"), F.col("p.formattedAddress").alias("address"), "p.rating", F.col("p.userRatingCount").alias("ratings"), fn.or_else(F.col("p.googleMapsUri"), F.concat(F.lit("https://maps.google.com/?cid="), F.col("p.id"))).alias("maps_url"))


def snak(entity: Column, prop: str) -> Column:
    """The first value of a property of a parsed entity (VARIANT): a time's date, an amount's number, or a plain string; null for other kinds."""
    at = f"$.claims.{prop}[0].mainsnak"
    said = lambda path: F.try_variant_get(entity, f"{at}{path}", "string")
    value = F.try_variant_get(entity, f"{at}.datavalue.value", "variant")
    time, amount = said(".datavalue.value.time"), said(".datavalue.value.amount")
    plain = F.when(~F.schema_of_variant(value).startswith("OBJECT") & ~F.schema_of_variant(value).startswith("ARRAY"), F.try_variant_get(value, "$", "string"))
    return F.when(said(".snaktype") == "value", F.when(time.isNotNull(), F.substring(F.ltrim(time, F.lit("+")), 1, 10)).when(amount.isNotNull(), F.ltrim(amount, F.lit("+"))).otherwise(plain))


def wikidata(entities: DataFrame, companies: DataFrame) -> DataFrame:
    """The entity of each company by organisation number, a later one replaces an earlier; entities: (pos, qid, entity).

    An entity is parsed once; only what is read from it is exchanged.
    """
    v = F.col("v")
    told = lambda path: F.try_variant_get(v, path, "string")
    label = F.coalesce(told("$.labels.nb.value"), told("$.labels.en.value"))
    wiki = lambda site, lang: F.concat(F.lit(f"https://{lang}.wikipedia.org/wiki/"), F.replace(told(f"$.sitelinks.{site}.title"), F.lit(" "), F.lit("_")))
    handle = lambda p, url: F.replace(F.lit(url), F.lit("{}"), F.nullif(snak(v, p), F.lit("")))
    kept = [c for c in ("retrieved_at", "sha") if c in entities.columns]
    read = {"label": label} | {f.split(".")[1]: snak(v, p) for p, f in VALUE_PROPERTIES.items()} | {f"wikipedia_{g}": wiki(s, g) for s, g in WIKIPEDIAS.items()} | {f"handle_{name}": handle(p, url) for p, (name, url) in HANDLE_PROPERTIES.items()}
    parsed = entities.select("pos", "qid", *kept, F.try_parse_json("entity").alias("v"))
    rows = parsed.select("pos", "qid", *kept, fn.digits(snak(v, "P2333")).alias("org"), *(c.alias(n) for n, c in read.items()))
    mine = rows.join(companies.select("org").distinct(), "org", "left_semi")
    names = ["qid", *kept, *read]
    return mine.groupBy("org").agg(F.max_by(F.struct(*names), "pos").alias("m")).select("org", *(f"m.{n}" for n in names))


def chunks(rows: DataFrame, order: str, size: int = 50) -> DataFrame:
    """(chunk, members): rows in chunks of a size, for sources that take many keys at once; the numbering goes by range, not in one task."""
    from ..storage import materialize

    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    laid = materialize(rows.repartitionByRange(n, order).select(order, F.spark_partition_id().alias("part")), "chunk-rows")
    counts = laid.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = laid.withColumn("own", F.row_number().over(Window.partitionBy("part").orderBy(order))).join(F.broadcast(before), "part")
    return placed.groupBy(F.floor((F.col("own") + F.col("before") - 1) / size).alias("chunk")).agg(F.array_sort(F.collect_list(order)).alias("members"))
