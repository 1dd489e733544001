"""Companies, snapshots and observations projected from the test tables, the same for queries and their SQL.

A company is a customer: eight digits from its key and a check digit (0 where none
is valid, so some numbers are wrong by design). Snapshots are twelve-month windows
over orders; a claim's value is the price of the last order in cents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers as fn
from ..operators.reconcile import ITEMS
from ..storage import table

PREVIOUS, CURRENT = ("1999-01-01", "2000-01-01"), ("1999-07-01", "2000-07-01")


def org_of(key: Column) -> Column:
    with_check = lambda base: F.concat(base, fn.once(fn.check_remainder(base), lambda rest: F.when(rest <= 1, "0").otherwise((11 - rest).cast("string"))))
    return fn.once((F.lit(80_000_000) + key).cast("string"), with_check)


def org_sql(key: str) -> str:
    rest = "(" + " + ".join(f"substr(CAST(80000000 + {key} AS VARCHAR), {i + 1}, 1)::INT * {w}" for i, w in enumerate(fn.WEIGHTS)) + ") % 11"
    return f"CAST(80000000 + {key} AS VARCHAR) || CASE WHEN {rest} <= 1 THEN '0' ELSE CAST(11 - {rest} AS VARCHAR) END"


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(org, pos, name, legal_form, employees, industry_code, website, key)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        org_of(F.col("c_custkey")).alias("org"),
        F.col("c_custkey").alias("pos"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("legal_form"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 50)).cast("string").alias("employees"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("industry_code"),
        F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit("https://c"), F.col("c_custkey").cast("string"), F.lit(".example.com"))).alias("website"),
        F.col("c_custkey").alias("key"),
    )


COMPANIES_SQL = f"""companies AS (
  SELECT {org_sql('c_custkey')} AS org, c_custkey AS pos, c_name AS name, c_mktsegment AS legal_form,
    CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 50) AS BIGINT) END AS employees,
    lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS industry_code, c_custkey % 9 = 0 AS has_web, c_custkey AS key
  FROM customer)"""


def _last_orders(spark: SparkSession, sf_dir: str, window: tuple[str, str]) -> DataFrame:
    o = table(spark, sf_dir, "orders").where((F.col("o_orderdate") >= F.lit(window[0]).cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit(window[1]).cast("timestamp_ntz")))
    last = o.groupBy("o_custkey").agg(F.max_by(F.struct("o_totalprice", "o_orderdate", "o_orderkey", "o_orderpriority"), F.struct("o_orderdate", "o_orderkey")).alias("o"))
    return last.select(F.col("o_custkey").alias("key"), "o.*")


def snapshot(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """Claims of one field, financials.revenue, with evidence."""
    rows = companies(spark, sf_dir).select("org", "key").join(_last_orders(spark, sf_dir, CURRENT if current else PREVIOUS), "key", "left")
    there = F.col("o_orderkey").isNotNull()
    state = F.when(there, "available").otherwise("not_available")
    if current:
        state = F.when(F.col("key") % 17 == 0, "failed").when(F.col("key") % 19 == 0, "blocked").otherwise(state)
    value = F.when(state == "available", F.round(F.col("o_totalprice") * 100).cast("long").cast("string"))
    has = state == "available"
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd")
    return rows.select(
        "org", F.lit("financials.revenue").alias("field"), value.alias("value"), state.alias("availability"),
        F.when(has, F.substring(stamp, 1, 4)).alias("period"),
        F.lit("NOK").alias("currency"), F.lit("SELSKAP").alias("statement"),
        F.when(has, F.concat(F.lit("ev-"), F.col("o_orderkey").cast("string"))).alias("evidence_id"),
        F.when(has, F.concat(F.lit("https://orders.example/"), F.col("o_orderkey").cast("string"))).alias("url"),
        F.when(has, stamp).alias("retrieved_at"),
        F.when(has, F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("sha"),
        (F.when(has, stamp) if not current else F.lit(None).cast("string")).alias("first_seen"),
    )


def _snapshot_sql(name: str, window: tuple[str, str], current: bool) -> str:
    state = "CASE WHEN o.o_orderkey IS NOT NULL THEN 'available' ELSE 'not_available' END"
    if current:
        state = f"CASE WHEN c.key % 17 = 0 THEN 'failed' WHEN c.key % 19 = 0 THEN 'blocked' ELSE {state} END"
    return f"""{name}_o AS (
  SELECT o_custkey AS key, o_totalprice, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS stamp FROM orders
  WHERE o_orderdate >= TIMESTAMP '{window[0]}' AND o_orderdate < TIMESTAMP '{window[1]}'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
{name}_s AS (SELECT c.org, c.key, o.o_orderkey AS okey, o.o_totalprice AS price, o.stamp, {state} AS availability FROM companies c LEFT JOIN {name}_o o USING (key)),
{name} AS (
  SELECT org, 'financials.revenue' AS field, availability,
    CASE WHEN availability = 'available' THEN CAST(CAST(round(price * 100) AS BIGINT) AS VARCHAR) END AS value,
    CASE WHEN availability = 'available' THEN substr(stamp, 1, 4) END AS period,
    CASE WHEN availability = 'available' THEN 'ev-' || okey END AS evidence_id,
    CASE WHEN availability = 'available' THEN 'https://orders.example/' || okey END AS url,
    CASE WHEN availability = 'available' THEN stamp END AS retrieved_at,
    CASE WHEN availability = 'available' THEN sha256(CAST(okey AS VARCHAR)) END AS sha
  FROM {name}_s)"""


SNAPSHOTS_SQL = ",\n".join([COMPANIES_SQL, _snapshot_sql("p", PREVIOUS, False), _snapshot_sql("c", CURRENT, True)])


#: Sides of the snapshots of all fields: when they were retrieved.
STAMPS = {False: "1999-12-31", True: "2000-06-30"}


def _in_window(spark: SparkSession, sf_dir: str, window: tuple[str, str]) -> DataFrame:
    """(key, supplier, status, priority, flag) of the lines of a window's orders."""
    o = table(spark, sf_dir, "orders").where((F.col("o_orderdate") >= F.lit(window[0]).cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit(window[1]).cast("timestamp_ntz")))
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    return o.join(line, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("key"), F.col("l_suppkey").cast("string").alias("supplier"), F.col("o_orderstatus").alias("status"), F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("l_returnflag").alias("flag")
    )


def snapshots(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """Claims of seven fields, of which three are lists: every type of change occurs, and companies come and go."""
    c = companies(spark, sf_dir).where(F.col("key") % 53 != 0 if current else F.col("key") % 59 != 0)
    lines = _in_window(spark, sf_dir, CURRENT if current else PREVIOUS)
    kinds = {
        "leadership": (F.concat_ws("|", "priority", "status"), F.concat(F.lit("person "), "status"), F.concat(F.lit("role_"), "priority"), F.lit(None).cast("string")),
        "locations": (F.col("supplier"), F.concat(F.lit("shop "), "supplier"), F.lit(None).cast("string"), F.concat(F.lit("place "), "supplier")),
        "social_handles": (F.col("flag"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")),
    }
    item = lambda key, name, role, place: F.struct(key.alias("key"), key.alias("item"), name.alias("name"), role.alias("role"), place.alias("place"))
    held = lines.groupBy("key").agg(*(F.array_sort(F.collect_set(item(*v))).alias(f) for f, v in kinds.items()))
    rows = c.join(held, "key", "left")
    k = F.col("key")
    now = lambda n: F.lit(current) & (k % n == 0)
    none = F.lit(None).cast("string")
    plain = lambda field, value, state, items=None: F.struct(F.lit(field).alias("field"), F.when(state == "available", value).alias("value"), state.alias("availability"), F.when(state == "available", F.lit(None).cast(ITEMS) if items is None else items).cast(ITEMS).alias("items"))
    there = lambda value: F.when(value.isNotNull(), "available").otherwise("not_available")
    listed = lambda f: plain(f, F.to_json(F.transform(f, lambda x: x["key"])), F.when(now(17), "failed").otherwise(there(F.col(f))), F.col(f))
    staff = F.when(~now(14), (F.col("employees").cast("long") + F.when(now(11), 1).otherwise(0)).cast("string"))
    fields = rows.select("org", "key", F.inline(F.array(
        plain("legal_name", F.concat("name", F.when(now(23), " AS").otherwise("")), F.lit("available")),
        plain("website_description", F.concat(F.when(now(13), "e").otherwise("d"), "industry_code"), F.when(now(31), "blocked").otherwise(there(F.col("website")))),
        plain("employees_registered", staff, there(staff)),
        *(listed(f) for f in kinds),
    )))
    has = F.col("availability") == "available"
    stamp = STAMPS[current]
    told = fields.select(
        "org", "field", "value", "availability", none.alias("period"), none.alias("currency"), none.alias("statement"),
        F.when(has, F.concat(F.lit("ev-"), "field", F.lit(f"-{stamp}-"), "org")).alias("evidence_id"),
        F.when(has & (F.col("key") % 37 != 0), F.concat(F.lit(f"https://registry.example/{stamp}/"), "org")).alias("url"),
        F.when(has, F.lit(stamp)).alias("retrieved_at"),
        F.when(has, F.sha2(F.concat_ws("|", "field", F.lit(stamp), "org"), 256)).alias("sha"),
        (F.lit(None).cast("string") if current else F.when(has, F.lit("1998-01-01"))).alias("first_seen"),
        "items",
    )
    money = snapshot(spark, sf_dir, current).join(c.select("org"), "org", "left_semi").withColumn("items", F.lit(None).cast(ITEMS))
    return told.unionByName(money)


def _full_sql(name: str, window: tuple[str, str], current: bool) -> str:
    now = lambda n: f"key % {n} = 0" if current else "false"
    stamp = STAMPS[current]
    state = lambda v: f"CASE WHEN {v} IS NULL THEN 'not_available' ELSE 'available' END"
    staff = f"CASE WHEN {now(14)} THEN NULL ELSE CAST(employees + CASE WHEN {now(11)} THEN 1 ELSE 0 END AS VARCHAR) END"
    return f"""{name}_companies AS (SELECT * FROM companies WHERE key % {53 if current else 59} <> 0),
{name}_lists AS (SELECT o_custkey AS key, list_sort(list(DISTINCT substr(o_orderpriority, 1, 1) || '|' || o_orderstatus)) AS leadership, list_sort(list(DISTINCT CAST(l_suppkey AS VARCHAR))) AS locations, list_sort(list(DISTINCT l_returnflag)) AS social_handles
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '{window[0]}' AND o_orderdate < TIMESTAMP '{window[1]}' GROUP BY 1),
{name}_rows AS (SELECT c.*, leadership, locations, social_handles FROM {name}_companies c LEFT JOIN {name}_lists USING (key)),
{name}_fields AS (
  SELECT org, key, 'legal_name' AS field, name || CASE WHEN {now(23)} THEN ' AS' ELSE '' END AS value, 'available' AS availability, CAST(NULL AS VARCHAR[]) AS items FROM {name}_rows
  UNION ALL SELECT org, key, 'website_description', CASE WHEN {now(13)} THEN 'e' ELSE 'd' END || industry_code, CASE WHEN {now(31)} THEN 'blocked' WHEN has_web THEN 'available' ELSE 'not_available' END, NULL FROM {name}_rows
  UNION ALL SELECT org, key, 'employees_registered', {staff}, {state(f'({staff})')}, NULL FROM {name}_rows
  {' '.join(f"UNION ALL SELECT org, key, '{f}', '[' || list_aggregate(list_transform({f}, lambda x: chr(34) || x || chr(34)), 'string_agg', ',') || ']', CASE WHEN {now(17)} THEN 'failed' WHEN {f} IS NULL THEN 'not_available' ELSE 'available' END, {f} FROM {name}_rows" for f in ('leadership', 'locations', 'social_handles'))}),
{name}_all AS (
  SELECT org, field, CASE WHEN availability = 'available' THEN value END AS value, availability, NULL AS period, CASE WHEN availability = 'available' THEN items END AS items,
    CASE WHEN availability = 'available' THEN 'ev-' || field || '-{stamp}-' || org END AS evidence_id, CASE WHEN availability = 'available' AND key % 37 <> 0 THEN 'https://registry.example/{stamp}/' || org END AS url,
    CASE WHEN availability = 'available' THEN '{stamp}' END AS retrieved_at, CASE WHEN availability = 'available' THEN sha256(field || '|{stamp}|' || org) END AS sha, {"NULL" if current else "CASE WHEN availability = 'available' THEN '1998-01-01' END"} AS first_seen FROM {name}_fields
  UNION ALL SELECT org, field, value, availability, period, NULL, evidence_id, url, retrieved_at, sha, {"NULL" if current else "retrieved_at"} FROM {name} SEMI JOIN {name}_companies USING (org))"""


FULL_SQL = ",\n".join([SNAPSHOTS_SQL, _full_sql("p", PREVIOUS, False), _full_sql("c", CURRENT, True)])


def items(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """List items by company: suppliers of the window's orders stand for workplaces."""
    lo, hi = CURRENT if current else PREVIOUS
    o = table(spark, sf_dir, "orders").where((F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz")))
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return o.join(line, F.col("o_orderkey") == F.col("l_orderkey")).select(org_of(F.col("o_custkey")).alias("org"), F.lit("locations").alias("field"), F.col("l_suppkey").cast("string").alias("item_key"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: every kind of proof and several kinds of fault occur."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    pick = lambda by, *xs: F.element_at(F.array(*(F.lit(x) for x in xs)), (k % by % len(xs) + 1).cast("int"))
    platform = pick(7, *(x[0] for x in KINDS))
    return e.select(
        F.concat(F.lit("o"), k.cast("string")).alias("id"), org_of(F.col("user_id") + 1).alias("organisation_number"), platform.alias("platform"),
        pick(7, *(x[1] for x in KINDS)).alias("signal_type"),
        F.when(k % 31 == 0, "nowhere").otherwise(F.concat(F.lit("https://s.example/enheter/"), org_of(F.col("user_id") + 1))).alias("source_url"),
        F.date_format("ts", "yyyy-MM-dd").alias("retrieved_at"), F.sha2(k.cast("string"), 256).alias("content_sha256"),
        (k % 37 != 0).alias("exact_entity"), pick(7, *(x[2] for x in KINDS)).alias("identity_proof"), F.lit("official_api").alias("acquisition_mode"),
        F.when(k % 41 == 0, "unknown").otherwise("approved").alias("rights_status"), F.lit("public_mention").alias("source_class"),
        F.when(k % 3 != 0, F.col("event_type")).alias("evidence_span"), F.lit(None).cast("string").alias("observed_at"),
        F.when(k % 43 == 0, "happy").alias("sentiment_label"), F.lit(None).cast("string").alias("sentiment_model_version"), F.col("props").alias("metrics"),
        k.alias("pos"), F.lit(0).alias("file_no"), F.concat(F.lit("https://www.p.example/"), (k % 50).cast("string"), F.lit("/")).alias("declared_url"),
    )


#: Platform, signal and proof by event_id % 7.
KINDS = (
    ("brreg", "company_profile", "organisation_number_primary_key"),
    ("company_site", "company_profile", "org_number_on_page"),
    ("linkedin", "profile_handle", "declared_on_verified_company_site:org_number_on_page"),
    ("wikidata", "company_profile", "wikidata_p2333_organisation_number"),
    ("wikipedia", "company_profile", "wikidata_p2333_sitelink:Q1"),
    ("google_places", "place_summary", "places_phone_matches_registry"),
    ("news", "public_post", "name"),
)


def _kind_sql(i: int) -> str:
    return "CASE event_id % 7 " + " ".join(f"WHEN {n} THEN '{x[i]}'" for n, x in enumerate(KINDS)) + " END"


OBSERVATIONS_SQL = f"""observations AS (
  SELECT 'o' || event_id AS id, {org_sql('(user_id + 1)')} AS organisation_number, {_kind_sql(0)} AS platform, {_kind_sql(1)} AS signal_type, {_kind_sql(2)} AS identity_proof,
    event_id % 31 <> 0 AS url_ok, event_id % 37 <> 0 AS exact_entity, event_id % 41 <> 0 AS rights_ok, event_id % 3 <> 0 AS has_span, event_id % 43 = 0 AS bad_sentiment, event_id AS pos,
    'p.example/' || (event_id % 50) AS profile FROM events),
gated AS (
  SELECT *, list_filter([CASE WHEN NOT url_ok THEN 'missing or invalid source URL' END, CASE WHEN NOT exact_entity THEN 'exact legal entity is not verified' END,
    CASE WHEN NOT rights_ok THEN 'source rights are not approved' END, CASE WHEN signal_type = 'public_post' AND NOT has_span THEN 'missing evidence span' END,
    CASE WHEN bad_sentiment THEN 'unsupported sentiment label' END, CASE WHEN bad_sentiment THEN 'missing sentiment model version' END], lambda x: x IS NOT NULL) AS reasons,
    CASE event_id_7 WHEN 0 THEN 'primary_key' WHEN 1 THEN 'proven_on_page' WHEN 2 THEN 'declared' WHEN 3 THEN 'proven_on_page' WHEN 4 THEN 'declared' WHEN 5 THEN 'corroborated' ELSE 'inferred' END AS tier
  FROM (SELECT *, pos % 7 AS event_id_7 FROM observations))"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured responses about every company, of all kinds and states, with payloads in the forms of their sources."""
    c = companies(spark, sf_dir)
    k, org = F.col("key"), F.col("org")
    o = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    filing = F.struct(
        F.when(F.col("o_orderstatus") == "F", "SELSKAP").otherwise("KONSERN").alias("regnskapstype"), F.lit("NOK").alias("valuta"),
        F.struct(F.concat(F.substring(day, 1, 4), F.lit("-01-01")).alias("fraDato"), day.alias("tilDato")).alias("regnskapsperiode"),
        F.struct(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("aarsresultat"), F.struct(F.struct(F.round(F.col("o_totalprice") * 100).cast("long").alias("sumDriftsinntekter")).alias("driftsinntekter")).alias("driftsresultat")).alias("resultatregnskapResultat"),
    )
    filed = o.groupBy(F.col("o_custkey").alias("key")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", filing.alias("f")))).alias("fs"))
    rows = c.join(filed, "key", "left")
    place = F.struct(F.array(F.col("name")).alias("adresse"), F.lit("0150").alias("postnummer"), F.lit("OSLO").alias("poststed"), F.concat(F.lit("K"), "industry_code").alias("kommune"), F.lit("Norge").alias("land"))
    entity = F.struct(
        F.when(k % 41 == 0, "0").otherwise(org).alias("organisasjonsnummer"), F.col("name").alias("navn"), F.struct(F.lit("AS").alias("kode"), F.col("legal_form").alias("beskrivelse")).alias("organisasjonsform"), place.alias("forretningsadresse"),
        F.col("website").alias("hjemmeside"), F.when(k % 2 == 0, F.concat(F.lit(" 22"), k.cast("string"))).alias("telefon"), F.col("employees").isNotNull().alias("harRegistrertAntallAnsatte"), F.col("employees").cast("long").alias("antallAnsatte"), (k % 10 == 0).alias("konkurs"),
    )
    role = lambda code, gone, name: F.struct(F.struct(F.lit(code).alias("kode")).alias("type"), gone.alias("avregistrert"), F.struct(F.struct(F.lit("Kari").alias("fornavn"), name.alias("etternavn")).alias("navn")).alias("person"))
    roles = F.struct(F.array(F.struct(F.array(role("REVI", F.lit(False), F.lit("R")), role("DAGL", k % 3 == 0, F.col("name")), role("LEDE", k % 4 != 0, F.lit("L"))).alias("roller"))).alias("rollegrupper"))
    unit = lambda n: F.struct(F.concat(org, F.lit(f"-{n}")).alias("organisasjonsnummer"), F.lit(f"shop {n}").alias("navn"), place.alias("beliggenhetsadresse"))
    units = F.struct(F.struct(F.when(k % 5 == 0, F.array().cast("array<string>")).alias("underenheter")).alias("_embedded"), F.struct(F.lit(2).alias("totalElements")).alias("page"))
    shops = F.struct(F.struct(F.array(unit(1), unit(2)).alias("underenheter")).alias("_embedded"))
    number = F.when(k % 2 == 0, F.concat(F.lit("Org.nr "), org)).otherwise("")
    html = F.concat(F.lit("<html><head><title>"), "name", F.lit('</title></head><body><a href="https://www.linkedin.com/company/c"></a><a href="//x.com/c"></a><a href="/om"></a><p>'), number, F.lit("</p></body></html>"))
    found = F.struct(F.array(F.struct(F.lit("p").alias("id"), F.when(k % 4 == 0, F.col("website")).alias("websiteUri"), F.when(k % 8 != 0, F.lit(4.5)).alias("rating"), k.alias("userRatingCount"))).alias("places"))
    news = F.lit("<article><h2>Nytt</h2><p>Vi flyttet den 14. september 2026 til nye lokaler</p></article>")
    kinds = (  # kind, rank, status, body
        ("entity", 0, F.when(k % 38 == 0, 403).when(k % 19 == 0, 404).otherwise(200), F.to_json(entity)),
        ("roles", 0, F.when(k % 23 == 0, 500).otherwise(200), F.to_json(roles)),
        ("accounts", 0, F.when(k % 29 == 0, 451).otherwise(200), F.to_json(F.transform("fs", lambda x: x["f"]))),
        ("subunits", 0, F.lit(200), F.when(k % 5 == 0, F.to_json(units)).when(k % 7 == 0, F.lit("not json")).otherwise(F.to_json(shops))),
        ("website", 0, F.when(k % 27 == 0, 403).otherwise(200), html),
        ("news", 0, F.lit(200), F.lit("<p>nothing dated here</p>")),
        ("news", 1, F.lit(200), news),
        ("places", 0, F.when(k % 16 == 0, 500).otherwise(200), F.when(k % 10 == 0, F.lit('{"places": []}')).otherwise(F.to_json(found))),
    )
    each = rows.select("org", "key", "website", F.inline(F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), status.cast("int").alias("status"), body.alias("body")) for kind, rank, status, body in kinds))))
    ok = F.col("status") == 200
    asked = each.where((F.col("kind") != "website") | F.col("website").isNotNull())
    url = F.when(F.col("kind") == "website", F.col("website")).otherwise(F.concat(F.lit("https://s.example/"), "kind", F.lit("/"), "org"))
    return asked.select("org", "kind", "rank", url.alias("url"), F.lit(None).cast("string").alias("final_url"), ok.alias("ok"), F.col("status").isin(401, 403, 451).alias("blocked"), "status", F.when(~ok, F.concat(F.lit("HTTP "), F.col("status").cast("string"))).alias("error"), F.when(ok, F.col("body")).alias("body"), F.lit("2026-01-02T03:04:05Z").alias("retrieved_at"), F.sha2(F.concat_ws("|", "kind", "org"), 256).alias("sha"))


def knowledge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the knowledge base: (pos, qid, entity, retrieved_at, sha).

    It knows one company in six, so the other states of these fields occur, too: what is missing is the feature.
    """
    k = F.col("key")
    value = lambda text: F.array(F.struct(F.struct(F.lit("value").alias("snaktype"), F.struct(text.alias("value")).alias("datavalue")).alias("mainsnak")))
    entity = F.struct(F.struct(value(F.col("org")).alias("P2333"), value(F.col("website")).alias("P856")).alias("claims"), F.struct(F.struct(F.col("name").alias("value")).alias("en")).alias("labels"), F.struct(F.struct(F.col("name").alias("title")).alias("enwiki")).alias("sitelinks"))
    rows = companies(spark, sf_dir).where("key % 6 = 0")
    return rows.select(k.alias("pos"), F.concat(F.lit("Q"), k.cast("string")).alias("qid"), F.to_json(entity).alias("entity"), F.lit("2026-01-02").alias("retrieved_at"), F.sha2("org", 256).alias("sha"))


def adverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adverts with the number of their employer: (url, body, retrieved_at, sha).

    One company in eight has two; that the others have none is what a checked zero is made of.
    """
    c = companies(spark, sf_dir).where("key % 8 = 0").select("org", "name", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    body = F.to_json(F.struct(F.struct(F.concat("org", F.lit("-"), F.col("n").cast("string")).alias("uuid"), F.col("name").alias("title"), F.struct(F.col("org").alias("orgnr")).alias("employer"), F.lit("2026-01-01").alias("published")).alias("ad_content")))
    return c.select(F.concat(F.lit("https://ads.example/"), "org", F.lit("/"), F.col("n").cast("string")).alias("url"), body.alias("body"), F.lit("2026-01-02").alias("retrieved_at"), F.sha2("org", 256).alias("sha"))


def with_repeats(claims: DataFrame, current: bool) -> DataFrame:
    """claims with their places, and a second claim of the same field behind some of two fields' claims."""
    key = F.substring("org", 1, 8).cast("long") - 80_000_000
    again = claims.where(F.col("field").isin("website_description", "employees_registered", "locations") & (key % (7 if current else 5) == 0))
    told = F.when(F.col("field") == "locations", F.col("value")).otherwise(F.concat("value", F.lit("-n" if current else "-p")))
    return claims.withColumn("pos", F.lit(0)).unionByName(again.withColumn("value", told).withColumn("pos", F.lit(1)))


def _repeats_sql(name: str, current: bool) -> str:
    told = f"CASE WHEN field = 'locations' THEN value ELSE value || '-{'n' if current else 'p'}' END"
    return f"""{name}_rep AS (SELECT *, 0 AS pos FROM {name}_all UNION ALL BY NAME SELECT * REPLACE ({told} AS value), 1 AS pos FROM {name}_all
  WHERE field IN ('website_description', 'employees_registered', 'locations') AND (CAST(substr(org, 1, 8) AS BIGINT) - 80000000) % {7 if current else 5} = 0)"""


REPEATS_SQL = f"""{FULL_SQL}, {_repeats_sql('p', False)}, {_repeats_sql('c', True)},
p_last AS (SELECT * FROM p_rep QUALIFY row_number() OVER (PARTITION BY org, field ORDER BY pos DESC) = 1),
c_last AS (SELECT * FROM c_rep QUALIFY row_number() OVER (PARTITION BY org, field ORDER BY pos DESC) = 1)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims over many runs: a customer's last order of each priority in each of ten stretches of time.

    A third of all customers' orders are told of one organisation, each in a run of its own.
    """
    o = table(spark, sf_dir, "orders")
    hot = F.col("o_custkey") % 3 == 0
    run = F.when(hot, F.col("o_orderkey")).otherwise(F.floor(F.datediff("o_orderdate", F.lit("1992-01-01")) / 250))
    rows = o.select(org_of(F.when(hot, 1).otherwise(F.col("o_custkey"))).alias("org"), F.concat(F.lit("orders."), F.substring("o_orderpriority", 1, 1)).alias("field"), run.cast("long").alias("run"), F.struct("o_orderdate", "o_orderkey", "o_totalprice").alias("o"))
    last = rows.groupBy("org", "field", "run").agg(F.max("o").alias("o")).select("org", "field", "run", "o.*")
    k = F.col("o_orderkey")
    state = F.when(k % 7 == 0, "failed").when(k % 11 == 0, "not_available").when(k % 13 == 0, "blocked").otherwise("available")
    has = state == "available"
    none = F.lit(None).cast("string")
    return last.select(
        "org", "field", "run", F.when(has, F.floor(F.col("o_totalprice") / 150_000).cast("string")).alias("value"), state.alias("availability"), F.when(has & (k % 5 == 0), "half").alias("period"),
        none.alias("currency"), none.alias("statement"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/"), k.cast("string")).alias("retrieved_at"),
    )


RUNS_SQL = f"""runs AS (
  SELECT org, field, run, CASE WHEN has THEN CAST(CAST(floor(o_totalprice / 150000) AS BIGINT) AS VARCHAR) END AS value, availability, CASE WHEN has AND k % 5 = 0 THEN 'half' END AS period, strftime(o_orderdate, '%Y-%m-%d') || '/' || k AS retrieved_at
  FROM (SELECT *, availability = 'available' AS has FROM (SELECT {org_sql('(CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE o_custkey END)')} AS org, 'orders.' || substr(o_orderpriority, 1, 1) AS field,
    CASE WHEN o_custkey % 3 = 0 THEN o_orderkey ELSE CAST(floor(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 250) AS BIGINT) END AS run, o_orderkey AS k, o_orderdate, o_totalprice,
    CASE WHEN o_orderkey % 7 = 0 THEN 'failed' WHEN o_orderkey % 11 = 0 THEN 'not_available' WHEN o_orderkey % 13 = 0 THEN 'blocked' ELSE 'available' END AS availability FROM orders)
    QUALIFY row_number() OVER (PARTITION BY org, field, run ORDER BY o_orderdate DESC, k DESC) = 1))"""


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as questions about organisations at days: a third of them are about one."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(k.alias("probe_id"), org_of(F.when(k % 3 == 0, 1).otherwise(F.col("user_id") + 1)).alias("org"), F.date_add(F.lit("1992-01-01").cast("date"), (k * 7919 % 2700).cast("int")).alias("at"))


def dated_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as claims about organisations from their days on; a third of them are about one, and a day can have several."""
    o = table(spark, sf_dir, "orders")
    return o.select(org_of(F.when(F.col("o_custkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))).alias("org"), F.col("o_orderdate").cast("date").alias("at"), F.col("o_orderkey").alias("claim_id"))


AS_OF_SQL = f"""probes AS (SELECT event_id AS probe_id, {org_sql('(CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id + 1 END)')} AS org, DATE '1992-01-01' + CAST(event_id * 7919 % 2700 AS INTEGER) AS at FROM events),
held AS (SELECT {org_sql('(CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE o_custkey END)')} AS org, CAST(o_orderdate AS DATE) AS at, max(o_orderkey) AS claim_id FROM orders GROUP BY ALL)"""


FAULTS = 3  # kinds of fault in lines of a snapshot; the other four of seven events make good ones


def snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of a snapshot, each of an organisation of its own: an unknown key in a claim, claims that are no list, evidence without an id, or none of these."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    text = lambda x: F.lit(x)
    run = F.struct(*(text("x").alias(n) for n in ("run_id", "started_at", "completed_at", "terminal_status")))
    claim = F.struct(text("event_type").alias("field"), F.col("event_type").alias("value"), text("available").alias("availability"), F.lit(1.0).alias("confidence"), F.array(F.concat(text("e"), k.cast("string"))).alias("evidence_ids"))
    source = F.struct(F.concat(text("e"), k.cast("string")).alias("id"), F.concat(text("https://e.example/"), k.cast("string")).alias("source_url"), text("official_registry").alias("source_class"), F.date_format("ts", "yyyy-MM-dd").alias("retrieved_at"), F.sha2(k.cast("string"), 256).alias("content_sha256"))
    line = F.to_json(F.struct(org_of(k).alias("organisation_number"), run.alias("run"), F.array(claim).alias("claims"), F.array(source).alias("evidence")))
    faulty = F.when(k % 7 == 0, F.regexp_replace(line, '"field":', '"odd":1,"field":')).when(k % 7 == 1, F.regexp_replace(line, r'"claims":\[.*?\}\]', '"claims":"nonsense"')).when(k % 7 == 2, F.regexp_replace(line, '"id":"[^"]*",', "")).otherwise(line)
    return e.select("event_id", "user_id", org_of(F.col("user_id") + 1).alias("user_org"), faulty.alias("line"), org_of(k).alias("org"))


def strict_envelopes(claims: DataFrame) -> DataFrame:
    """(org, organisation_number, run, claims, evidence) of claims, in the shape of a snapshot's lines."""
    run = F.struct(*(F.lit("x").alias(n) for n in ("run_id", "started_at", "completed_at", "terminal_status")))
    claim = F.struct("field", "value", "availability", F.col("period").alias("reporting_period"), F.array_compact(F.array("evidence_id")).alias("evidence_ids"), F.struct("currency", F.col("statement").alias("statement_type")).alias("qualifiers"))
    source = F.when(F.col("url").isNotNull(), F.struct(F.col("evidence_id").alias("id"), F.col("url").alias("source_url"), F.lit("official_registry").alias("source_class"), "retrieved_at", F.col("sha").alias("content_sha256")))
    held = claims.groupBy("org").agg(F.array_sort(F.collect_list(claim)).alias("claims"), F.array_sort(F.collect_list(source)).alias("evidence"))
    return held.select("org", F.struct(F.col("org").alias("organisation_number"), run.alias("run"), "claims", "evidence").alias("envelope"))
