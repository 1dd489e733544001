"""DuckDB SQL for the registered queries, written from the semantics, not from the plans."""

from __future__ import annotations

from ..functions import numbers as fn
from ..operators.reconcile import FINANCIAL
from . import collect
from . import projection as px

def _changes_of(previous: str, current: str) -> str:
    """Changes between two tables of claims, of which the first has one for each field."""
    return f"""paired AS (SELECT org, field, p.org IS NOT NULL AS was, c.org IS NOT NULL AS now_, p.availability AS pa, c.availability AS ca, p.value AS pv, c.value AS cv, p.period AS pp, c.period AS cp, p.items AS pi, c.items AS ci,
    p.url AS purl, c.url AS curl, p.retrieved_at AS prt, c.retrieved_at AS crt, p.sha AS psha, c.sha AS csha, p.evidence_id AS pev, c.evidence_id AS cev, p.first_seen AS pfirst
  FROM (SELECT * FROM {previous} WHERE org IN (SELECT org FROM {current})) p FULL JOIN {current} c USING (org, field)),
typed AS (SELECT *, CASE
    WHEN NOT was OR NOT now_ THEN NULL
    WHEN ca IN ('failed', 'blocked') AND pa = 'available' THEN 'source_unavailable'
    WHEN pv IS NOT DISTINCT FROM cv AND pp IS NOT DISTINCT FROM cp AND pa = ca THEN NULL
    WHEN pa <> 'available' AND ca = 'available' THEN 'became_available'
    WHEN pa = 'available' AND ca = 'not_available' THEN 'became_unavailable'
    WHEN pv IS NULL AND cv IS NULL THEN 'availability_changed'
    WHEN field IN ('leadership', 'locations', 'social_handles') AND (len(list_filter(ci, lambda x: NOT list_contains(pi, x))) > 0 OR len(list_filter(pi, lambda x: NOT list_contains(ci, x))) > 0) THEN 'items'
    WHEN field = 'financials.revenue' THEN 'new_filing'
    WHEN field = 'legal_name' THEN 'changed_identity'
    WHEN field = 'website_description' THEN 'changed_description'
    ELSE 'value_changed' END AS kind FROM paired),
came AS (SELECT *, unnest(list_filter(ci, lambda x: NOT list_contains(pi, x))) AS item FROM typed WHERE kind = 'items'),
went AS (SELECT *, unnest(list_filter(pi, lambda x: NOT list_contains(ci, x))) AS item FROM typed WHERE kind = 'items'),
told AS (
  SELECT * EXCLUDE (kind), kind AS change_type, pv AS old_value, CASE kind WHEN 'source_unavailable' THEN pv WHEN 'became_unavailable' THEN NULL ELSE cv END AS new_value, NULL AS item FROM typed WHERE kind <> 'items'
  UNION ALL BY NAME SELECT * EXCLUDE (kind), CASE field WHEN 'leadership' THEN 'new_role' WHEN 'locations' THEN 'new_location' ELSE 'new_handle' END AS change_type, NULL AS old_value, item AS new_value FROM came
  UNION ALL BY NAME SELECT * EXCLUDE (kind), CASE field WHEN 'leadership' THEN 'departed_role' WHEN 'locations' THEN 'closed_location' ELSE 'removed_handle' END AS change_type, item AS old_value, NULL AS new_value FROM went),
changes AS (SELECT org, field, change_type,
    CASE WHEN change_type IN ('source_unavailable', 'availability_changed') OR field IN ('website_description', 'social_handles') THEN 'minor' ELSE 'material' END AS materiality,
    old_value, new_value,
    pa AS old_availability, ca AS new_availability, purl AS old_url, CASE WHEN change_type <> 'source_unavailable' THEN curl END AS new_url,
    prt AS old_retrieved_at, CASE WHEN change_type <> 'source_unavailable' THEN crt END AS new_retrieved_at,
    psha AS old_sha, CASE WHEN change_type <> 'source_unavailable' THEN csha END AS new_sha,
    CASE WHEN change_type <> 'source_unavailable' THEN cp END AS reporting_period,
    CASE WHEN change_type = 'source_unavailable' THEN 'source could not be re-read; last supported value preserved'
      WHEN change_type = 'became_unavailable' THEN 'source was read successfully and no longer reports this value'
      WHEN change_type = 'availability_changed' THEN 'no value on either side; source state moved from ' || pa || ' to ' || ca
      WHEN change_type = 'new_filing' AND pv IS NOT DISTINCT FROM cv AND pp IS DISTINCT FROM cp THEN 'value unchanged; reporting period ' || coalesce(pp, 'None') || ' -> ' || coalesce(cp, 'None') END AS note,
    CASE WHEN item IS NULL THEN NULL WHEN field = 'leadership' THEN 'person ' || substr(item, 3) WHEN field = 'locations' THEN 'shop ' || item END AS item_name,
    CASE WHEN item IS NOT NULL AND field = 'leadership' THEN 'role_' || substr(item, 1, 1) END AS item_role,
    CASE WHEN item IS NOT NULL AND field = 'locations' THEN 'place ' || item END AS item_place
  FROM told)"""


_CHANGES = f"{px.FULL_SQL}, {_changes_of('p_all', 'c_all')}"
_AGAIN = f"{px.REPEATS_SQL}, {_changes_of('p_last', 'c_rep')}"
_FALSE = f"{px.REPEATS_SQL}, {_changes_of('c_last', 'c_rep')}"
_REPORT = """count(*) AS changes, count_if(materiality = 'material') AS material, count_if(change_type = 'source_unavailable') AS preserved,
        coalesce(bool_and((new_value IS NULL OR old_url IS NOT NULL OR new_url IS NOT NULL) AND (old_value IS NULL OR change_type = 'became_available' OR old_url IS NOT NULL OR new_url IS NOT NULL)), true) AS evidence_complete"""

_ITEMS = f"""items AS (SELECT {px.org_sql('o_custkey')} AS org, CAST(l_suppkey AS VARCHAR) AS item_key, o_orderdate AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
was AS (SELECT DISTINCT org, item_key FROM items WHERE d >= TIMESTAMP '{px.PREVIOUS[0]}' AND d < TIMESTAMP '{px.PREVIOUS[1]}'),
now_ AS (SELECT DISTINCT org, item_key FROM items WHERE d >= TIMESTAMP '{px.CURRENT[0]}' AND d < TIMESTAMP '{px.CURRENT[1]}')"""

_RANKED = f"""{px.COMPANIES_SQL},
strata AS (SELECT *, concat_ws('|', legal_form, CASE WHEN employees IS NULL THEN 'missing' WHEN employees < 5 THEN '1-4' WHEN employees < 20 THEN '5-19' WHEN employees < 100 THEN '20-99' ELSE '100+' END,
    industry_code, CASE WHEN has_web THEN 'web' ELSE 'no-web' END) AS stratum, sha256('seed-1:' || org) AS rank FROM companies),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY rank, org) AS place FROM strata)"""
_ROBIN = f"{_RANKED}, robin AS (SELECT * FROM ranked ORDER BY place, stratum LIMIT 100)"

_TEXTS = f"""texts AS (SELECT doc_id, {px.org_sql('(doc_id % 150 + 1)')} AS org, regexp_replace(coalesce(text, ''), '[0-9]', 'x', 'g') AS body, {px.org_sql('(doc_id % 140 + 7)')} AS other FROM documents)"""
_VALID = "(CASE WHEN ({r}) % 11 = 0 THEN 0 ELSE 11 - ({r}) % 11 END) = substr({x}, 9, 1)::INT AND ({r}) % 11 <> 1"


def _valid(x: str) -> str:
    r = " + ".join(f"substr({x}, {i + 1}, 1)::INT * {w}" for i, w in enumerate(fn.WEIGHTS))
    return f"({_VALID.format(r=r, x=x)})"


_FILINGS = f"filings AS (SELECT {px.org_sql('o_custkey')} AS org, o_orderkey AS pos, CASE WHEN o_orderstatus = 'F' THEN 'SELSKAP' ELSE 'KONSERN' END AS kind, strftime(o_orderdate, '%Y-%m-%d') AS until, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"

_ROOTS = f"""{px.OBSERVATIONS_SQL},
heads AS (SELECT organisation_number AS org, platform, min_by(id, pos) AS root_id FROM gated WHERE platform IN ('company_site', 'wikidata') GROUP BY ALL)"""

_LABELS = "lab AS (SELECT 'o' || doc_id AS id, quality = 1 AS exact, toxic = 0 AS metric, CASE doc_id % 5 WHEN 0 THEN 'machine' WHEN 1 THEN 'assisted' ELSE 'human' END AS labelled_by FROM labels)"

_CLAIM_VALUES = {
    "legal_name": "name",
    "legal_form": "CASE key % 3 WHEN 0 THEN 'AS - Aksjeselskap' WHEN 1 THEN 'ENK - Foretak' ELSE 'XX - Annet' END",
    "municipality": "CASE WHEN key % 2 = 0 THEN 'NORD-AURDAL' END",
    "registration_date": "'2001-02-03'",
    "industry_code": "industry_code || ' Drift av Skip'",
    "employees_registered": "CAST(employees AS VARCHAR)",
    "official_website": "CASE WHEN has_web THEN 'https://c' || key || '.example.com' END",
    "places.rating": "CASE WHEN key % 4 = 0 THEN '4.5' END",
    "financials.revenue": "CASE WHEN key % 5 <> 0 THEN CAST(key * 1250 AS VARCHAR) END",
    "financials.net_result": "CASE WHEN key % 10 < 7 THEN CAST(key * 100 AS VARCHAR) END",
}
_CLAIMS = px.COMPANIES_SQL + ", claims AS (" + " UNION ALL ".join(f"SELECT org, '{f}' AS field, {v} AS value FROM companies" for f, v in _CLAIM_VALUES.items()) + ")"


def _has(field: str, name: str) -> str:
    return f"coalesce(bool_or(field = '{field}' AND value IS NOT NULL), false) AS {name}"


def _money(x: str) -> str:
    return f"'NOK ' || replace(CASE WHEN {x} >= 1000000000 THEN format('{{:,.1f}}bn', {x} / 1e9) WHEN {x} >= 1000000 THEN format('{{:,.1f}}m', {x} / 1e6) WHEN {x} >= 1000 THEN format('{{:,.1f}}k', {x} / 1e3) ELSE format('{{:,.0f}}', CAST({x} AS DOUBLE)) END, ',', ' ')"


_WORDS = ", ".join(f"'{w}'" for w in fn.LEGAL_WORDS)
_BRIEFS = f"""{_TEXTS}, {px.COMPANIES_SQL},
said AS (SELECT org, doc_id % 4 = 0 OR (doc_id % 4 = 1 AND {_valid('org')}) OR (doc_id % 4 = 2 AND org = other AND {_valid('org')}) AS ours, CASE WHEN doc_id % 4 = 2 AND other <> org AND {_valid('other')} THEN other END AS other FROM texts),
both_ AS (SELECT org, bool_or(ours) AS ours, coalesce(string_agg(DISTINCT other, ',' ORDER BY other), '') AS others FROM said GROUP BY 1),
briefs AS (SELECT org, ours, others, coalesce(key % 2 = 0, false) AS corroborated, CASE WHEN ours THEN 'likely YES - the organisation number appears on the site' WHEN others <> '' THEN 'CHECK CAREFULLY - the site shows a different organisation number'
  WHEN key % 2 = 0 THEN 'likely YES - a registry address or phone matches, no conflict found' ELSE 'UNCLEAR - only the registry declaration and the name match' END AS hint FROM both_ LEFT JOIN companies USING (org))"""


def _one(source: str, field: str, value: str, evidence: str | None, *, state: str | None = None, note: str = "NULL", sure: str = "1.0", period: str = "NULL", statement: str = "NULL") -> str:
    """A claim of each row of source; without a state it is available where it has a value, and only else tells a note."""
    state, note = (state, note) if state else ("CASE WHEN v IS NULL THEN 'not_available' ELSE 'available' END", f"CASE WHEN v IS NULL THEN {note} END")
    cited = f"'{evidence}'" if evidence else "NULL"
    return f"SELECT org, '{field}' AS field, v AS value, {state} AS availability, CAST(CASE WHEN v IS NULL THEN 0 ELSE {sure} END AS DOUBLE) AS confidence, {period} AS period, {statement} AS statement, {cited} AS evidence_id, {note} AS note FROM (SELECT *, CAST({value} AS VARCHAR) AS v FROM {source})"


def _lost(source: str, fields: tuple[str, ...], state: str, note: str, evidence: str | None = None) -> list[str]:
    return [_one(source, f, "NULL", evidence, state=state, note=note) for f in fields]


_WEB, _KNOWN = collect.WEBSITE, collect.KNOWLEDGE
_NO_ENTITY, _NO_UNITS = "'registry entity not returned for this organisation number'", "'no registered subunits; the company has no separate registered workplaces'"
_NO_ACCOUNTS, _NO_LINE = "'no annual accounts filed or returned for this entity; not zero'", "'line item not present in the filed statement; not zero'"
_DOUBT = "'registry-declared site lacks exact-entity evidence; not published as verified'"
_FILED = f"""known AS (SELECT * FROM companies WHERE key % 19 <> 0), mine AS (SELECT * FROM known WHERE key % 41 <> 0),
filed AS (SELECT o_custkey AS key, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS company, '[' || string_agg(DISTINCT '"' || year(o_orderdate) || '"', ',' ORDER BY '"' || year(o_orderdate) || '"' DESC) || ']' AS years FROM orders GROUP BY 1),
newest AS (SELECT o_custkey AS key, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CASE WHEN o_orderstatus = 'F' THEN 'SELSKAP' ELSE 'KONSERN' END AS kind, strftime(o_orderdate, '%Y-%m-%d') AS until FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey) = 1),
accounts AS (SELECT * FROM known JOIN filed USING (key) JOIN newest USING (key) WHERE key % 29 <> 0),
unfiled AS (SELECT * FROM known WHERE key % 29 = 0 OR key NOT IN (SELECT key FROM filed)),
proven AS (SELECT * FROM known WHERE has_web AND key % 27 <> 0 AND key % 2 = 0),
placed AS (SELECT * FROM known WHERE has_web AND key % 4 = 0 AND key % 16 <> 0 AND key % 10 <> 0),
unplaced AS (SELECT *, CASE WHEN key % 16 = 0 THEN 'failed' WHEN key % 10 = 0 THEN 'not_available' ELSE 'ambiguous' END AS state, CASE WHEN key % 16 = 0 THEN 'Places search failed: HTTP 500' WHEN key % 10 = 0 THEN 'Places returned no candidate for this company' ELSE 'no Places result could be tied to this legal entity by domain, phone or address' END AS why FROM known WHERE key NOT IN (SELECT key FROM placed))"""
_ENTITY_FIELDS = {
    "legal_name": "name", "legal_form": "'AS - ' || legal_form", "registration_date": "NULL", "industry_code": "NULL", "business_address": "name || ', 0150 OSLO, Norge'", "postal_address": "NULL", "municipality": "'K' || industry_code",
    "latest_submitted_accounts": "NULL", "registry_website": "CASE WHEN has_web THEN 'https://c' || key || '.example.com' END", "registry_phone": "CASE WHEN key % 2 = 0 THEN '22' || key END", "operating_status": "key % 10 = 0",
}
_COLLECTED = [
    *(_one("mine", f, v, "ev-registry") for f, v in _ENTITY_FIELDS.items()),
    _one("mine", "employees_registered", "employees", "ev-registry", note="'no employee count registered in Enhetsregisteret; not zero employees'"),
    _one("(SELECT * FROM companies WHERE key % 19 = 0 OR key % 41 = 0)", "legal_name", "NULL", None, state="CASE WHEN key % 38 = 0 THEN 'blocked' ELSE 'not_available' END", note=_NO_ENTITY),
    _one("(SELECT * FROM known WHERE key % 23 = 0)", "leadership", "NULL", None, state="'failed'", note="'roles endpoint returned no usable payload'"),
    _one("(SELECT * FROM known WHERE key % 23 <> 0 AND key % 3 = 0 AND key % 4 <> 0)", "leadership", "NULL", "ev-roles", state="'not_available'", note="'no current registered leadership roles of a published type'"),
    *(
        _one("(SELECT * FROM known WHERE key % 23 <> 0 AND (key % 3 <> 0 OR key % 4 = 0))", f, v, "ev-roles")
        for f, v in (("leadership", "(key % 3 <> 0)::INT + (key % 4 = 0)::INT"), ("managing_director", "CASE WHEN key % 3 <> 0 THEN 'Kari ' || name END"), ("board_chair", "CASE WHEN key % 4 = 0 THEN 'Kari L' END"))
    ),
    *_lost("unfiled", (*FINANCIAL, "financial_history.years"), "CASE WHEN key % 29 = 0 THEN 'blocked' ELSE 'not_available' END", _NO_ACCOUNTS),
    *(
        _one("accounts", f, v, "ev-accounts", note=_NO_LINE, period="CASE WHEN v IS NOT NULL THEN substr(until, 1, 4) || '-01-01/' || until END", statement="CASE WHEN v IS NOT NULL THEN kind END")
        for f, v in ((f, {"financials.revenue": "cents", "financials.net_result": "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END"}.get(f, "NULL")) for f in FINANCIAL)
    ),
    _one("accounts", "financial_history.years", "years", "ev-accounts"),
    _one("(SELECT * FROM known WHERE key % 5 = 0 OR key % 7 <> 0)", "locations", "CASE WHEN key % 5 <> 0 THEN 2 END", "ev-subunits", note=_NO_UNITS),
    _one("(SELECT * FROM known WHERE key % 5 <> 0 AND key % 7 = 0)", "locations", "NULL", None, state="'not_available'", note="'subunit endpoint returned no usable payload'"),
    *_lost("(SELECT * FROM known WHERE NOT has_web)", _WEB, "'not_available'", "'no website registered in Enhetsregisteret and search discovery is not enabled in v1'"),
    *_lost("(SELECT * FROM known WHERE has_web AND key % 27 = 0)", _WEB, "'blocked'", "'registry website could not be retrieved: HTTP 403'"),
    _one("(SELECT * FROM known WHERE has_web AND key % 27 <> 0 AND key % 2 = 1)", "official_website", "'https://c' || key || '.example.com'", "ev-website", state="'ambiguous'", note=_DOUBT, sure="0.5"),
    *_lost("(SELECT * FROM known WHERE has_web AND key % 27 <> 0 AND key % 2 = 1)", _WEB[1:], "'ambiguous'", _DOUBT, "ev-website"),
    *(_one("proven", f, v, "ev-website") for f, v in (("official_website", "'https://c' || key || '.example.com'"), ("website_title", "name"), ("website_description", "NULL"), ("social_handles", "2"))),
    *(_one("proven", f, v, "ev-activity", sure="0.9") for f, v in (("activity.latest_post_date", "'2026-09-14'"), ("activity.posts", "1"))),
    *_lost("(SELECT * FROM known WHERE key NOT IN (SELECT key FROM proven))", collect.ACTIVITY, "'not_available'", "'no verified company website, so no company-owned activity can be attributed'"),
    _one("placed", "places.rating", "CASE WHEN key % 8 <> 0 THEN '4.5' END", "ev-places", note="'place found but Google holds no rating for it'", sure="0.95"),
    *(_one("placed", f, v, "ev-places", sure="0.95") for f, v in (("places.rating_count", "key"), ("places.address", "NULL"))),
    *_lost("unplaced", collect.PLACES, "state", "why"),
    *(_one("(SELECT * FROM known WHERE key % 6 = 0)", f, v, "ev-wikidata", sure=sure) for f, v, sure in (("wikidata.qid", "'Q' || key", "1.0"), ("wikidata.wikipedia", "1", "0.9"))),
    *(_one("(SELECT * FROM known WHERE key % 6 = 0)", f, "CASE WHEN has_web THEN 'https://c' || key || '.example.com' END" if f == "wikidata.website" else "NULL", "ev-wikidata", sure="0.9", note="'not recorded on the Wikidata entity'") for f in _KNOWN[1:-1]),
    *_lost("(SELECT * FROM known WHERE key % 6 <> 0)", _KNOWN, "'not_available'", "'no Wikidata entity carries this organisation number'"),
    *(_one("(SELECT * FROM known WHERE key % 8 = 0)", f, "2", "ev-job-0") for f in collect.JOBS),
    _one("(SELECT * FROM known WHERE key % 8 <> 0)", "jobs.active_count", "0", None, state="'available'", note="'NAV vacancy feed was read; no active advert carries this organisation number'"),
    _one("(SELECT * FROM known WHERE key % 8 <> 0)", "jobs.postings", "NULL", None),
]
_COLLECTED_SQL = f"{px.COMPANIES_SQL}, {_FILED}, claims AS ({' UNION ALL '.join(_COLLECTED)})"

_SEEN = f"""{px.COMPANIES_SQL}, {_FILED}, seen AS (
  SELECT org || '-brreg-entity' AS id, org, 'brreg' AS platform, 'company_profile' AS signal_type, 'https://s.example/entity/' || org AS source_url, 'organisation_number_primary_key' AS identity_proof, NULL AS observed_at FROM known
  UNION ALL SELECT org || '-company_site-home', org, 'company_site', 'company_profile', 'https://c' || key || '.example.com', 'org_number_labelled_on_page', NULL FROM proven
  UNION ALL SELECT org || '-' || p.platform || '-handle-' || p.n, org, p.platform, 'profile_handle', 'https://c' || key || '.example.com', 'declared_on_verified_company_site:org_number_labelled_on_page', NULL FROM proven, (VALUES ('linkedin', 0), ('x', 1)) p(platform, n)
  UNION ALL SELECT org || '-company_site-post-0', org, 'company_site', 'public_post', 'https://s.example/news/' || org, 'published_on_verified_company_site:org_number_labelled_on_page', '2026-09-14' FROM proven
  UNION ALL SELECT org || '-google_places-place', org, 'google_places', 'place_summary', 'https://maps.google.com/?cid=p', 'places_website_matches_verified_domain', NULL FROM placed
  UNION ALL SELECT org || '-wikidata-entity', org, 'wikidata', 'company_profile', 'https://www.wikidata.org/wiki/Q' || key, 'wikidata_p2333_organisation_number', NULL FROM known WHERE key % 6 = 0
  UNION ALL SELECT org || '-wikipedia-en', org, 'wikipedia', 'company_profile', 'https://en.wikipedia.org/wiki/' || replace(name, ' ', '_'), 'wikidata_p2333_sitelink:Q' || key, NULL FROM known WHERE key % 6 = 0
  UNION ALL SELECT org || '-job_board-posting-' || n, org, 'job_board', 'job_posting', 'https://ads.example/' || org || '/' || (n + 1), 'employer_org_number_in_official_feed', '2026-01-01' FROM known, (VALUES (0), (1)) t(n) WHERE key % 8 = 0)"""


_ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def _shown(markup: str, collapsed: bool = True) -> str:
    """What a reader sees of markup: no comments, scripts and styles, no tags, entities spelt out, blanks as one space."""
    x = f"regexp_replace(regexp_replace({markup}, '(?s)<!--.*?-->|<(script|style|noscript|svg)[ >].*?</(script|style|noscript|svg)>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
    for name, char in _ENTITIES:
        x = f"regexp_replace({x}, '{name}?', '{char}', 'g')"  # references are read without their semicolon, too
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))" if collapsed else f"trim({x})"


_PAGES = f"""seen AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
parts AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<body>(.*?)(</body>|$)', 1) AS body, regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1) AS foot FROM seen),
page AS (SELECT page_id, substr({_shown('title')}, 1, 300) AS title, substr({_shown('body')}, 1, 200000) AS body_text, substr({_shown('foot', False)}, 1, 4000) AS identity_excerpt FROM parts)"""
_CORE = f"list_distinct(list_filter(regexp_extract_all(lower(strip_accents(array_to_string(string_split(title, ' ')[1:2], ' '))), '[a-z0-9]+'), lambda t: len(t) > 1 AND NOT list_contains([{_WORDS}], t)))"


_FETCHED = """WITH a AS (SELECT CAST(event_id // 3 AS VARCHAR) AS url, event_id % 3 AS attempt, event_id // 3 % 4 <> 0 AS get, [200, 503, 404, 403, 429, NULL][event_id * 7 % 11 % 6 + 1] AS status, event_id % 2 AS redirects FROM events),
        t AS (SELECT *, status IS NOT NULL AND (NOT get OR status NOT IN (429, 500, 502, 503, 504)) AS settled FROM a WHERE get OR attempt = 0),
        e AS (SELECT url, attempt AS last, status, get FROM t QUALIFY row_number() OVER (PARTITION BY url ORDER BY settled DESC, CASE WHEN settled THEN attempt ELSE -attempt END) = 1),
        s AS (SELECT url, max_by(status, attempt) AS seen FROM t WHERE status IS NOT NULL GROUP BY url)
        SELECT e.url, coalesce(e.status, s.seen) AS status, CASE WHEN e.status < 400 THEN 'ok' WHEN e.status IN (401, 403, 451) OR (NOT e.get AND e.status = 429) THEN 'blocked' ELSE 'failed' END AS state, CAST(count(*) + sum(CASE WHEN t.status IS NULL THEN 0 ELSE redirects END) AS BIGINT) AS requests
        FROM e LEFT JOIN s USING (url) JOIN t ON t.url = e.url AND t.attempt <= e.last GROUP BY ALL"""


SQL: dict[str, str] = {
    "reconcile_changes": f"WITH {_CHANGES} SELECT * FROM changes",
    "reconcile_claims": f"""WITH {_CHANGES} SELECT org, field, CASE WHEN k THEN pv ELSE cv END AS value, CASE WHEN k THEN pa ELSE ca END AS availability,
        CASE WHEN k THEN pp ELSE cp END AS period, CASE WHEN k THEN pev ELSE cev END AS evidence_id,
        CASE WHEN k THEN pfirst WHEN was AND kind IS NULL THEN coalesce(pfirst, crt) ELSE crt END AS first_observed_at,
        CASE WHEN k THEN prt ELSE crt END AS last_observed_at, kind IS NOT DISTINCT FROM 'source_unavailable' AS stale, CASE WHEN kind = 'source_unavailable' THEN ca END AS refresh_status, CASE WHEN kind = 'source_unavailable' THEN prt END AS last_confirmed_at
        FROM (SELECT *, kind IS NOT DISTINCT FROM 'source_unavailable' OR NOT now_ AS k FROM typed)""",
    "carried_evidence": f"WITH {_CHANGES} SELECT DISTINCT org, pev AS evidence_id, purl AS url, psha AS sha FROM typed t WHERE (kind = 'source_unavailable' OR NOT now_) AND pev IS NOT NULL AND NOT EXISTS (SELECT 1 FROM c_all c WHERE c.org = t.org AND c.evidence_id = t.pev)",
    "list_item_changes": f"""WITH {_ITEMS} SELECT org, 'locations' AS field, item_key, 'new_location' AS change_type, 'material' AS materiality FROM now_ ANTI JOIN was USING (org, item_key)
        UNION ALL SELECT org, 'locations', item_key, 'closed_location', 'material' FROM was ANTI JOIN now_ USING (org, item_key)""",
    "dropped_and_new_orgs": f"""WITH {px.FULL_SQL}, a AS (SELECT DISTINCT org FROM p_all), b AS (SELECT DISTINCT org FROM c_all)
        SELECT org, 'dropped' AS membership FROM a ANTI JOIN b USING (org) UNION ALL SELECT org, 'new' FROM b ANTI JOIN a USING (org)""",
    "refresh_report": f"""WITH {_CHANGES}, n AS (SELECT {_REPORT} FROM changes), lost AS (SELECT count(DISTINCT org) AS dropped FROM p_all WHERE org NOT IN (SELECT org FROM c_all))
        SELECT changes, material, preserved, evidence_complete, 0 AS self_changes, dropped, evidence_complete AND dropped = 0 AS passed FROM n, lost""",
    "repeated_changes": f"WITH {_AGAIN} SELECT org, field, change_type, materiality, old_value, new_value, note FROM changes",
    "repeated_report": f"""WITH n AS (WITH {_AGAIN} SELECT {_REPORT} FROM changes), again AS (WITH {_FALSE} SELECT count(*) AS self_changes FROM changes), lost AS (WITH {px.FULL_SQL} SELECT count(DISTINCT org) AS dropped FROM p_all WHERE org NOT IN (SELECT org FROM c_all))
        SELECT changes, material, preserved, evidence_complete, self_changes, dropped, evidence_complete AND self_changes = 0 AND dropped = 0 AS passed FROM n, again, lost""",
    "observed_intervals": f"""WITH {px.RUNS_SQL},
        m AS (SELECT *, availability IN ('failed', 'blocked') AND last_value(CASE WHEN availability NOT IN ('failed', 'blocked') THEN availability END IGNORE NULLS) OVER w IS NOT DISTINCT FROM 'available' AS missing FROM runs WINDOW w AS (PARTITION BY org, field ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        c AS (SELECT *, value IS NOT DISTINCT FROM lag(value) OVER w AND availability = lag(availability) OVER w AND period IS NOT DISTINCT FROM lag(period) OVER w AS goes_on FROM m WHERE NOT missing WINDOW w AS (PARTITION BY org, field ORDER BY run)),
        i AS (SELECT *, count_if(NOT coalesce(goes_on, false)) OVER (PARTITION BY org, field ORDER BY run) AS island FROM c),
        s AS (SELECT org, field, island, any_value(value) AS value, any_value(availability) AS availability, any_value(period) AS period, min_by(retrieved_at, run) AS first_observed_at, max_by(retrieved_at, run) AS last_observed_at, count(*) AS runs, min(run) AS since FROM i GROUP BY ALL),
        g AS (SELECT m.org, m.field, max(s.since) AS since, m.run FROM m JOIN s ON s.org = m.org AND s.field = m.field AND s.since < m.run WHERE missing GROUP BY m.org, m.field, m.run),
        n AS (SELECT org, field, since, count(*) AS missed FROM g GROUP BY ALL)
        SELECT org, field, value, availability, period, first_observed_at, last_observed_at, runs, coalesce(missed, 0) AS missed, since FROM s LEFT JOIN n USING (org, field, since)""",
    "claims_as_of": f"WITH {px.AS_OF_SQL} SELECT probe_id, probes.org, probes.at, claim_id, held.at AS since FROM probes ASOF LEFT JOIN held ON probes.org = held.org AND probes.at >= held.at",
    "changes_by_type": f"WITH {_CHANGES} SELECT change_type, materiality, count(*) AS n FROM changes GROUP BY ALL",
    "select_representative": f"""WITH {_RANKED}, s AS (SELECT stratum, count(*) AS n FROM ranked GROUP BY 1), t AS (SELECT sum(n) AS total FROM s),
        e AS (SELECT stratum, n, least(n, CAST(floor(CAST(n AS DOUBLE) * 100 / total) AS BIGINT)) AS base, CAST(n AS DOUBLE) * 100 / total - floor(CAST(n AS DOUBLE) * 100 / total) AS rest FROM s, t),
        g AS (SELECT *, base + CASE WHEN base < n AND sum(CASE WHEN base < n THEN 1 ELSE 0 END) OVER (ORDER BY rest DESC, stratum) <= 100 - sum(base) OVER () THEN 1 ELSE 0 END AS got FROM e),
        f AS (SELECT *, 100 - sum(got) OVER () AS short, coalesce(sum(n - got) OVER (ORDER BY n DESC, stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
        SELECT org, stratum, rank FROM ranked JOIN f USING (stratum) WHERE place <= got + least(n - got, greatest(0, short - before))""",
    "select_risk_weighted": f"""WITH {_RANKED.rsplit('ranked AS', 1)[0]} ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY rank, org) AS place FROM strata),
        n AS (SELECT least(count_if(has_web), 60) AS web FROM companies),
        w AS (SELECT *, row_number() OVER (PARTITION BY has_web ORDER BY place, stratum) AS turn FROM ranked)
        SELECT org, stratum, rank FROM w, n WHERE turn <= CASE WHEN has_web THEN web ELSE 100 - web END""",
    "round_robin_sample": f"WITH {_ROBIN} SELECT org, stratum, rank FROM robin",
    "sample_splits": f"WITH {_ROBIN}, o AS (SELECT org, row_number() OVER (ORDER BY rank) AS n FROM robin) SELECT org, CASE WHEN n <= 60 THEN 'train' WHEN n <= 85 THEN 'dev' ELSE 'test' END AS split FROM o WHERE n <= 95",
    "sample_coverage": f"WITH {_ROBIN} SELECT count(*) AS selected, count(DISTINCT stratum) AS strata, round(avg(CASE WHEN has_web THEN 1.0 ELSE 0.0 END), 4) AS website_share FROM robin",
    "org_checksum": f"WITH {px.COMPANIES_SQL} SELECT org, {_valid('org')} AS valid, substr(org, 1, 3) || ' ' || substr(org, 4, 3) || ' ' || substr(org, 7, 3) AS shown FROM companies",
    "suspect_orgs": f"WITH {px.COMPANIES_SQL} SELECT org, name FROM companies WHERE NOT {_valid('org')}",
    "org_number_proof": f"""WITH {_TEXTS}, t AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'org_number_labelled_on_page' WHEN doc_id % 4 = 1 AND {_valid('org')} THEN 'org_number_on_page'
        WHEN doc_id % 4 = 2 AND org = other AND {_valid('org')} THEN 'org_number_on_page' ELSE '' END AS proof FROM texts)
        SELECT doc_id, proof, CASE proof WHEN 'org_number_labelled_on_page' THEN 1.0 WHEN 'org_number_on_page' THEN 0.97 ELSE 0.0 END::DOUBLE AS confidence FROM t""",
    "conflicting_numbers": f"WITH {_TEXTS} SELECT doc_id, CASE WHEN doc_id % 4 = 2 AND other <> org AND {_valid('other')} THEN other ELSE '' END AS numbers FROM texts",
    "name_tokens": "SELECT p_partkey, array_to_string(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda t: len(t) > 1 AND NOT list_contains([" + ", ".join(f"'{w}'" for w in fn.LEGAL_WORDS) + "], t)), ',') AS tokens FROM part",
    "latest_filing": f"WITH {_FILINGS} SELECT org, pos, kind, until, cents FROM filings QUALIFY row_number() OVER (PARTITION BY org ORDER BY (kind = 'SELSKAP') DESC, until DESC, pos) = 1",
    "filing_years": f"WITH {_FILINGS} SELECT org, string_agg(DISTINCT substr(until, 1, 4), ',' ORDER BY substr(until, 1, 4) DESC) AS years FROM filings GROUP BY org",
    "observation_gate": f"WITH {px.OBSERVATIONS_SQL} SELECT id, array_to_string(reasons, '; ') AS reasons, len(reasons) = 0 AS publishable FROM gated",
    "risk_tier_counts": f"WITH {px.OBSERVATIONS_SQL} SELECT tier, len(reasons) = 0 AS publishable, count(*) AS n FROM gated GROUP BY ALL",
    "observation_pool": f"WITH {px.OBSERVATIONS_SQL} SELECT id, CASE WHEN pos % 2 = 0 THEN platform ELSE 'news' END AS platform, CAST(pos % 2 AS INT) AS file_no FROM observations",
    "audit_queue": f"""WITH {_ROOTS}, able AS (SELECT *, sha256('audit-1:' || id) AS rank FROM gated WHERE len(reasons) = 0),
        turn AS (SELECT *, row_number() OVER (PARTITION BY platform, signal_type, tier ORDER BY rank, id) AS place FROM able),
        cells AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY place, concat_ws('|', platform, signal_type, tier)) AS k FROM turn),
        have AS (SELECT tier, count(*) AS n FROM able GROUP BY 1),
        q AS (SELECT tier, w, CAST(coalesce(n, 0) AS BIGINT) AS n, least(coalesce(n, 0), w) AS base, t FROM (VALUES ('inferred', 25, 1), ('corroborated', 20, 2), ('proven_on_page', 10, 3), ('primary_key', 10, 4), ('declared', 35, 5)) v(tier, w, t) LEFT JOIN have USING (tier)),
        s AS (SELECT *, 100 - sum(base) OVER () AS short, coalesce(sum(n - base) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q),
        quota AS (SELECT tier, base + CASE WHEN tier = 'declared' THEN 0 ELSE least(n - base, greatest(0, short - before)) END AS take FROM s),
        chosen AS (SELECT cells.* FROM cells JOIN quota USING (tier) WHERE k <= take),
        heads_able AS (SELECT organisation_number AS org, platform, min_by(id, pos) AS root_id FROM able WHERE platform IN ('company_site', 'wikidata') GROUP BY ALL),
        more AS (SELECT DISTINCT root_id AS id FROM chosen JOIN heads_able h ON h.org = organisation_number AND h.platform = CASE chosen.platform WHEN 'linkedin' THEN 'company_site' WHEN 'wikipedia' THEN 'wikidata' END)
        SELECT id, tier AS risk_tier, rank FROM able WHERE id IN (SELECT id FROM chosen UNION SELECT id FROM more)""",
    "inherited_roots": f"WITH {_ROOTS} SELECT id, root_id FROM gated g JOIN heads h ON h.org = g.organisation_number AND h.platform = CASE g.platform WHEN 'linkedin' THEN 'company_site' WHEN 'wikipedia' THEN 'wikidata' END",
    "audit_score": f"""WITH {px.OBSERVATIONS_SQL}, {_LABELS}, m AS (SELECT *, len(reasons) = 0 AS ok, tier <> 'primary_key' AS risky FROM gated JOIN lab USING (id)),
        s AS (SELECT count(*) AS audited_observations, count_if(ok) AS published_audited, count_if(ok AND NOT exact) AS wrong_entity_publications, count_if(ok AND NOT metric) AS wrong_metric_publications,
          count_if(ok AND risky) AS risky_published, count_if(ok AND risky AND labelled_by = 'human') AS risky_human_labelled FROM m),
        p AS (SELECT *, (SELECT count(*) FROM lab) AS labelled, CASE WHEN published_audited > 0 THEN round((published_audited - wrong_entity_publications) / published_audited, 5) ELSE 0.0 END AS entity_precision,
          CASE WHEN published_audited > 0 THEN round((published_audited - wrong_metric_publications) / published_audited, 5) ELSE 0.0 END AS metric_precision FROM s)
        SELECT *, labelled >= 100 AS audit_size_gate, published_audited > 0 AND wrong_entity_publications = 0 AND entity_precision >= 0.995 AND metric_precision >= 0.98 AS precision_gate,
          risky_published > 0 AND risky_published = risky_human_labelled AS independence_gate, labelled >= 100 AND published_audited > 0 AND wrong_entity_publications = 0 AND entity_precision >= 0.995 AND metric_precision >= 0.98 AND risky_published > 0 AND risky_published = risky_human_labelled AS qualification_passed FROM p""",
    "label_cascade": f"""WITH {px.OBSERVATIONS_SQL}, {_LABELS}, heads AS (SELECT l.id AS derived_from, o.organisation_number, o.platform, l.exact, o.pos FROM lab l JOIN observations o USING (id) WHERE o.platform IN ('company_site', 'wikidata')),
        low AS (SELECT o.id, min_by(struct_pack(e := h.exact, d := h.derived_from), h.pos) AS m FROM observations o JOIN heads h ON h.organisation_number = o.organisation_number AND h.derived_from <> o.id
          AND ((h.platform = 'company_site' AND contains(o.identity_proof, '_on_verified_company_site')) OR (h.platform = 'wikidata' AND contains(o.identity_proof, 'wikidata_p2333_'))) GROUP BY o.id)
        SELECT id, exact AS exact_entity, CAST(NULL AS VARCHAR) AS derived_from FROM lab UNION ALL SELECT id, m.e, m.d FROM low WHERE id NOT IN (SELECT id FROM lab)""",
    "label_provenance": f"WITH {_LABELS} SELECT labelled_by, count(*) AS n FROM lab GROUP BY 1",
    "decided_rows": f"""WITH {px.OBSERVATIONS_SQL} SELECT DISTINCT doc_id AS decision_no, id FROM labels JOIN observations ON (doc_id % 2 = 0 AND id = 'o' || doc_id) OR (doc_id % 2 = 1 AND organisation_number = {px.org_sql('(doc_id % 150 + 1)')} AND platform = 'company_site')""",
    "machine_labels": f"WITH {px.OBSERVATIONS_SQL} SELECT id FROM observations WHERE pos % 7 = 0 AND url_ok AND pos % 2 = 0",
    "token_containment": f"""WITH toks AS (SELECT p_partkey AS entry_id, list_distinct(list_filter(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]+'), lambda t: len(t) > 1 AND NOT list_contains([{", ".join(f"'{w}'" for w in fn.LEGAL_WORDS)}], t))) AS have,
          list_distinct(list_filter(regexp_extract_all(lower(p_type), '[a-z0-9]+'), lambda t: len(t) > 1 AND NOT list_contains([{", ".join(f"'{w}'" for w in fn.LEGAL_WORDS)}], t))) AS own FROM part),
        sets AS (SELECT min(entry_id) AS pos, list_sort(own) AS want FROM toks WHERE len(own) > 0 GROUP BY 2), want AS (SELECT pos, want, {px.org_sql('pos')} AS org FROM sets)
        SELECT entry_id, org, len(want) = len(have) AS exact FROM toks JOIN want ON list_has_all(have, want) QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY pos) = 1""",
    "job_candidates": "WITH c AS (SELECT p_partkey AS entry_id, p_brand AS url, p_size > 25 AS exact, lpad(CAST(p_size AS VARCHAR), 3, '0') AS changed FROM part), d AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY url ORDER BY exact DESC, changed DESC, entry_id) = 1) SELECT * FROM d ORDER BY exact DESC, changed DESC, entry_id LIMIT 20",
    "place_match": f"""WITH {px.COMPANIES_SQL}, n AS (SELECT org, key, has_web, CAST(unnest([0, 1, 2, 3]) AS INT) AS pos FROM companies), r AS (SELECT org, pos, CASE WHEN has_web AND pos = key % 5 THEN 0 WHEN pos = key % 7 OR pos = key % 6 THEN 1 END AS k FROM n)
        SELECT org, pos, CASE k WHEN 0 THEN 'places_website_matches_verified_domain' ELSE 'places_phone_matches_registry' END AS proof FROM r WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY org ORDER BY k, pos) = 1""",
    "stage_percentiles": """WITH e AS (SELECT event_type, list_sort(list(CAST(round(value * 100) AS BIGINT))) AS s, count(value) AS n FROM events WHERE value IS NOT NULL GROUP BY 1)
        SELECT event_type, s[CAST(round_even(0.5 * (n - 1), 0) AS BIGINT) + 1] AS p50, s[CAST(round_even(0.95 * (n - 1), 0) AS BIGINT) + 1] AS p95, n FROM e""",
    "upper_medians": "SELECT lang, list_sort(list(n_chars))[CAST(count(*) // 2 AS BIGINT) + 1] AS median FROM documents WHERE n_chars IS NOT NULL GROUP BY lang",
    "run_report": "SELECT CASE WHEN event_id % 13 = 0 THEN 'failed' ELSE 'complete' END AS status, count(*) AS n FROM events GROUP BY 1",
    "budget_admission": "WITH r AS (SELECT event_id, CAST(sum(1 + event_id % 3) OVER (ORDER BY ts, event_id) AS BIGINT) AS spent FROM events) SELECT * FROM r WHERE spent <= 1500",
    "provider_costs": "SELECT event_type AS provider, round(sum(event_id % 8 * 0.125::DOUBLE), 6) AS usd, count(*) AS requests FROM events GROUP BY 1",
    "merged_handles": f"WITH {px.OBSERVATIONS_SQL} SELECT organisation_number, platform, signal_type, profile, count(DISTINCT identity_proof) AS confirmed_by, string_agg(DISTINCT identity_proof, ',' ORDER BY identity_proof) AS proofs FROM (SELECT * REPLACE ('p.example/' || pos % 50 AS profile) FROM observations) GROUP BY 1, 2, 3, 4",
    "social_handles": f"""WITH l AS (SELECT {px.org_sql('c_custkey')} AS org, c_custkey AS k, CAST(unnest([0, 1, 2]) AS BIGINT) AS pos FROM customer),
        h AS (SELECT org, pos, ['www.linkedin.com/company', 'no.linkedin.com/in', 'fb.com', 'notx.com', 'twitter.com', 'x.com'][(k + pos * 2) % 6 + 1] AS host, ['linkedin', 'linkedin', 'facebook', NULL, 'x', 'x'][(k + pos * 2) % 6 + 1] AS platform, k FROM l)
        SELECT org, platform, min_by('https://' || host || '/c' || k, pos) AS url FROM h WHERE platform IS NOT NULL GROUP BY 1, 2""",
    "leadership_roles": """WITH t AS (SELECT CAST(conv_id AS VARCHAR) AS org, turn AS pos, CASE role WHEN 'system' THEN 'DAGL' WHEN 'user' THEN 'LEDE' ELSE 'MEDL' END AS code, 'n' || length(text) AS name FROM conversations)
        SELECT org, string_agg(code || '=' || name, ';' ORDER BY pos, code, name) AS leadership, min_by(name, pos) FILTER (code = 'DAGL') AS managing_director, min_by(name, pos) FILTER (code = 'LEDE') AS board_chair FROM t GROUP BY org""",
    "summaries": f"""WITH {px.COMPANIES_SQL} SELECT org, concat_ws(' ', name || ' is ' || CASE key % 3 WHEN 0 THEN 'a private limited company' WHEN 1 THEN 'a sole proprietorship' ELSE 'a registered entity' END || CASE WHEN key % 2 = 0 THEN ' in Nord-Aurdal' ELSE '' END || ', registered 2001-02-03. Its registered activity is drift av skip.',
        CASE WHEN key % 5 <> 0 THEN 'Accounts filed for 2023 report revenue of ' || {_money('key * 1250')} || CASE WHEN key % 10 < 7 THEN ' and a net result of ' || {_money('key * 100')} ELSE '' END || ' (company accounts).' END,
        CASE WHEN employees IS NOT NULL THEN employees || ' employees are registered.' END, CASE WHEN NOT has_web THEN 'No permitted external source could be tied to this entity, so the profile rests on official records alone.' END) AS text FROM companies""",
    "unknowns": f"""WITH {_CLAIMS} SELECT org, CAST(CASE field WHEN 'official_website' THEN 1 WHEN 'employees_registered' THEN 2 WHEN 'financials.revenue' THEN 3 ELSE 6 END AS BIGINT) AS place, field, 'not_available' AS state, CASE WHEN field = 'employees_registered' THEN 'not registered' ELSE 'no permitted source established this value' END AS reason
        FROM claims WHERE value IS NULL AND field IN ('official_website', 'employees_registered', 'financials.revenue', 'places.rating')""",
    "change_sentences": f"""WITH {_CHANGES}, w AS (SELECT org, field, change_type, translate(field, '_.', '  ') AS f, substr(coalesce(old_value, 'None'), 1, 40) AS o, substr(coalesce(new_value, 'None'), 1, 40) AS n, item_name, replace(item_role, '_', ' ') AS item_role, item_place FROM changes WHERE materiality = 'material'),
        s AS (SELECT org, field, change_type, CASE change_type WHEN 'new_role' THEN item_name || ' joined as ' || item_role WHEN 'departed_role' THEN item_name || ' left the role of ' || item_role WHEN 'new_location' THEN 'a workplace was registered in ' || item_place
          WHEN 'closed_location' THEN 'a registered workplace closed in ' || item_place WHEN 'new_filing' THEN f || ' moved from ' || o || ' to ' || n WHEN 'changed_identity' THEN f || ' changed from ' || o || ' to ' || n WHEN 'became_available' THEN f || ' became available'
          WHEN 'became_unavailable' THEN f || ' is no longer reported' ELSE f || ' changed' END AS said FROM w),
        r AS (SELECT *, row_number() OVER (PARTITION BY org ORDER BY field, change_type, said) AS place FROM s)
        SELECT org, 'Since the previous run: ' || string_agg(said, '; ' ORDER BY place) || '.' AS changes FROM r WHERE place <= 6 GROUP BY org""",
    "identity_summary": f"WITH {_CLAIMS} SELECT org, max(value) FILTER (field = 'legal_name') AS legal_name, max(value) FILTER (field = 'legal_form') AS legal_form, max(value) FILTER (field = 'municipality') AS municipality, max(value) FILTER (field = 'industry_code') AS industry_code FROM claims GROUP BY org",
    "coverage_flags": f"WITH {_CLAIMS} SELECT org, {_has('places.rating', 'rating')}, {_has('official_website', 'website')}, {_has('wikidata.qid', 'wikidata')}, {_has('financials.revenue', 'accounts')} FROM claims GROUP BY org",
    "snapshot_dedupe": f"""WITH g AS (SELECT user_id, event_id, event_type, ts FROM events WHERE event_id % 7 >= {px.FAULTS}), k AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN max(event_id) ELSE min(event_id) END AS event_id FROM g GROUP BY 1)
        SELECT {px.org_sql('(user_id + 1)')} AS org, event_type AS value, 'e' || event_id AS evidence_id, 'https://e.example/' || event_id AS url, strftime(ts, '%Y-%m-%d') AS retrieved_at FROM k JOIN g USING (user_id, event_id)""",
    "strict_lines": f"SELECT {px.org_sql('event_id')} AS org, 'event_type' AS field, event_type AS value, 'available' AS availability, 'e' || event_id AS evidence_id, 'https://e.example/' || event_id AS url, sha256(CAST(event_id AS VARCHAR)) AS sha FROM events WHERE event_id % 7 >= {px.FAULTS}",
    "snapshot_round_trip": f"""WITH {px.FULL_SQL} SELECT org, field, value, availability, period, CASE WHEN field = 'financials.revenue' THEN 'NOK' END AS currency, CASE WHEN field = 'financials.revenue' THEN 'SELSKAP' END AS statement,
        CASE WHEN url IS NOT NULL THEN evidence_id END AS evidence_id, url, CASE WHEN url IS NOT NULL THEN retrieved_at END AS retrieved_at, CASE WHEN url IS NOT NULL THEN sha END AS sha FROM c_all""",
    "organisation_lists": f"WITH {px.COMPANIES_SQL} SELECT org, CASE WHEN key % 3 <> 0 THEN name END AS name FROM companies",
    "universe_rows": f"WITH {px.COMPANIES_SQL} SELECT org, legal_form, CAST(employees AS VARCHAR) AS employees, industry_code, CASE WHEN has_web THEN 'https://c' || key || '.example.com' END AS website FROM companies",
    "stored_payloads": "SELECT DISTINCT sha256(html) AS sha, CAST(length(html) AS BIGINT) AS chars FROM pages WHERE html <> ''",
    "places_check": f"""WITH {_COLLECTED_SQL} SELECT c.org, c.name, availability AS state, value AS rating, CASE WHEN value IS NOT NULL THEN 'places_website_matches_verified_domain' END AS proof, note
        FROM companies c LEFT JOIN (SELECT * FROM claims WHERE field = 'places.rating') p ON p.org = c.org""",
    "lookup_chunks": f"WITH {px.COMPANIES_SQL}, n AS (SELECT org, (row_number() OVER (ORDER BY org) - 1) // 50 AS chunk FROM companies) SELECT chunk, count(*) AS n, min(org) AS first FROM n GROUP BY 1",
    "page_titles": f"WITH {_PAGES} SELECT page_id, title, CAST(len(regexp_extract_all(html, '<a [^>]*href')) AS BIGINT) AS n_links FROM page JOIN seen USING (page_id)",
    "site_briefs": f"""WITH {_BRIEFS} SELECT * FROM briefs""",
    "hint_counts": f"""WITH {_BRIEFS} SELECT split_part(hint, ' - ', 1) AS hint, count(*) AS n FROM briefs GROUP BY 1""",
    "knowledge_briefs": f"WITH t AS (SELECT {px.org_sql('p_partkey')} AS org, p_partkey % 5 = p_partkey % 7 AS same_site, p_partkey % 2 = 0 AND len(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda t: len(t) > 1 AND NOT list_contains([{_WORDS}], t))) > 0 AS named FROM part) SELECT org, same_site, same_site OR named AS corroborated FROM t",
    "fetch_outcomes": _FETCHED,
    "fetched_responses": _FETCHED,
    "viewer_profiles": f"""WITH {_CLAIMS}, {px.OBSERVATIONS_SQL}, o AS (SELECT organisation_number AS org, string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms FROM observations GROUP BY 1)
        SELECT org, max(value) FILTER (field = 'legal_name') AS name, max(value) FILTER (field = 'municipality') AS municipality, coalesce(any_value(platforms), '') AS platforms,
          count(value) FILTER (field IN ('legal_name', 'employees_registered', 'official_website', 'places.rating', 'financials.revenue', 'financials.net_result')) AS n_fields, max(value) FILTER (field = 'financials.revenue') AS revenue
        FROM claims LEFT JOIN o USING (org) GROUP BY org""",
    "envelopes": f"""WITH {px.FULL_SQL}, {px.OBSERVATIONS_SQL}, o AS (SELECT organisation_number AS org, string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms FROM observations GROUP BY 1),
        cc AS (SELECT * FROM c_all WHERE availability <> 'failed' AND substr(org, 8, 1) <> '7'), pp AS (SELECT * FROM p_all WHERE availability = 'available' AND org IN (SELECT org FROM cc)),
        x AS (SELECT org, field, pp.org IS NOT NULL AS was, cc.org IS NOT NULL AS now_, pp.value AS pv, cc.value AS cv, cc.availability AS ca, pp.period AS pper, cc.period AS cper, pp.evidence_id AS pe, cc.evidence_id AS ce, pp.items AS pi, cc.items AS ci FROM pp FULL JOIN cc USING (org, field)),
        k AS (SELECT *, was AND now_ AND ca = 'blocked' AS kept FROM x),
        n AS (SELECT org, count(*) AS n_claims, count(CASE WHEN kept OR NOT now_ THEN pe ELSE ce END) AS n_ev,
          sum(CASE WHEN NOT was OR NOT now_ THEN 0 WHEN kept THEN 1 WHEN ca = 'available' AND pv = cv AND pper IS NOT DISTINCT FROM cper THEN 0 WHEN ca = 'available' AND pi IS NOT NULL THEN len(list_filter(ci, lambda v: NOT list_contains(pi, v))) + len(list_filter(pi, lambda v: NOT list_contains(ci, v))) ELSE 1 END) AS n_changes,
          max(CASE WHEN field = 'legal_name' THEN CASE WHEN now_ THEN cv ELSE pv END END) AS legal_name FROM k GROUP BY org)
        SELECT org, CASE WHEN n.org IS NULL THEN 'failed' WHEN key % 7 = 0 THEN 'completed_without_registry_anchor' ELSE 'completed' END AS status, coalesce(n_claims, 1) AS n_claims, CAST(coalesce(n_changes, 0) AS BIGINT) AS n_changes, coalesce(n_ev, 0) AS n_evidence, legal_name, coalesce(platforms, '') AS platforms
        FROM companies LEFT JOIN n USING (org) LEFT JOIN o USING (org)""",
    "summary_sections": f"""WITH {px.COMPANIES_SQL}, {px.OBSERVATIONS_SQL},
        o AS (SELECT org, list_sort(list(DISTINCT platform)) AS p FROM (SELECT organisation_number AS org, platform FROM observations WHERE platform NOT IN ('news', 'brreg')) GROUP BY 1),
        c AS (SELECT *, {', '.join(f'{v} AS "{f}"' for f, v in (_CLAIM_VALUES | {"financials.revenue": "CASE WHEN key % 5 <> 0 OR key % 7 = 0 THEN CAST(CASE WHEN key % 7 = 0 THEN 0 ELSE key * 1250 END AS VARCHAR) END"}).items() if f not in ('legal_form', 'industry_code'))},
          CASE WHEN key % 4 <> 0 THEN 'Kari ' || key END AS director, CASE WHEN key % 8 = 1 THEN 'Kari ' || key WHEN key % 3 = 0 THEN 'Ola ' || key END AS chair FROM companies),
        s AS (SELECT org,
          legal_name || ' is ' || CASE key % 3 WHEN 0 THEN 'a private limited company' WHEN 1 THEN 'a sole proprietorship' ELSE 'a registered entity' END || CASE WHEN key % 2 = 0 THEN ' in Nord-Aurdal' ELSE '' END || ', registered 2001-02-03. Its registered activity is drift av skip.' AS identity,
          CASE WHEN key % 10 = 0 THEN 'The company is registered as bankrupt.' WHEN key % 11 = 0 THEN 'The company is under compulsory liquidation.' WHEN key % 13 = 0 THEN 'The company is being wound up.' WHEN key % 2 = 0 THEN 'The registry records this entity as part of a group.' END AS standing,
          nullif(concat_ws(' ', CASE WHEN "financials.revenue" IS NOT NULL THEN CASE WHEN key % 3 <> 0 THEN 'Accounts filed for 2023 report revenue of ' ELSE 'Filed accounts report revenue of ' END || {_money('CAST("financials.revenue" AS BIGINT)')}
            || CASE WHEN "financials.net_result" IS NOT NULL THEN ' and a net result of ' || {_money('CAST("financials.net_result" AS BIGINT)')} ELSE '' END || CASE WHEN key % 2 = 0 THEN ' (company accounts).' ELSE ' (group accounts).' END END,
            CASE WHEN "financials.revenue" = '0' THEN 'The filed revenue figure is zero, which is a reported value rather than a missing one.' END, CASE WHEN employees IS NOT NULL THEN employees || ' employees are registered.' END), '') AS scale,
          CASE WHEN director = chair THEN director || ' is both registered managing director and board chair.' WHEN director IS NOT NULL OR chair IS NOT NULL THEN concat_ws(' and ', director || ' is the registered managing director', chair || ' chairs the board') || '.' END
            || CASE WHEN key % 4 > 1 THEN ' The board has ' || (key % 4) || ' registered members.' ELSE '' END AS people,
          nullif(concat_ws(' ', 'Its verified website is ' || official_website || ', tied to this entity because ' || CASE WHEN key % 2 = 0 THEN 'the organisation number appears on the page' WHEN key % 3 = 0 THEN 'a registry address or phone number appears on the page' ELSE 'the registry declares it' END || '.',
            CASE WHEN key % 4 = 0 THEN 'Google records a rating of 4.5 out of 5' || CASE WHEN key % 8 = 0 AND key > 0 THEN ' from ' || key || ' ratings' ELSE '' END || '.' END,
            'Confirmed presence on ' || CASE WHEN len(p) > 1 THEN array_to_string(p[1 : len(p) - 1], ', ') || ' and ' || p[len(p)] ELSE p[1] END || '.'), '') AS presence,
          nullif(concat_ws(' ', CASE WHEN key % 5 = 4 THEN NULL WHEN key % 6 = 0 THEN 'No active job advert in the national vacancy feed carries this organisation number.' ELSE (key % 6) || ' active job adverts carry this organisation number.' END,
            CASE WHEN key % 9 = 0 THEN 'The company published ' || (key % 3 + 1) || ' dated ' || CASE WHEN key % 3 = 0 THEN 'post' ELSE 'posts' END || ' of its own, most recently on 2026-01-02.' END), '') AS activity,
          array_to_string(list_sort(list_filter([CASE WHEN key % 9 = 0 THEN 'ev-activity.latest_post_date' END, CASE WHEN key % 9 = 0 THEN 'ev-activity.posts' END, CASE WHEN chair IS NOT NULL THEN 'ev-board_chair' END, CASE WHEN employees IS NOT NULL THEN 'ev-employees_registered' END,
            CASE WHEN "financials.net_result" IS NOT NULL THEN 'ev-financials.net_result' END, CASE WHEN "financials.revenue" IS NOT NULL THEN 'ev-financials.revenue' END, 'ev-industry_code', CASE WHEN key % 5 <> 4 THEN 'ev-jobs.active_count' END, 'ev-leadership', 'ev-legal_form', 'ev-legal_name',
            CASE WHEN director IS NOT NULL THEN 'ev-managing_director' END, CASE WHEN key % 2 = 0 THEN 'ev-municipality' END, CASE WHEN has_web THEN 'ev-official_website' END, 'ev-operating_status', CASE WHEN key % 4 = 0 THEN 'ev-places.rating' END, CASE WHEN key % 4 = 0 THEN 'ev-places.rating_count' END,
            'ev-registration_date'], lambda x: x IS NOT NULL)), ',') AS evidence,
          (NOT has_web)::BIGINT + (employees IS NULL)::BIGINT + ("financials.revenue" IS NULL)::BIGINT + (director IS NULL)::BIGINT + (key % 4 <> 0)::BIGINT + (key % 5 = 4)::BIGINT + (key % 9 <> 0)::BIGINT AS n_unknowns, p IS NULL AS official_only FROM c LEFT JOIN o USING (org))
        SELECT * FROM s""",
    "adjudicated_labels": f"""WITH {px.OBSERVATIONS_SQL}, d AS (SELECT doc_id AS n, CASE WHEN doc_id % 2 = 0 THEN 'o' || doc_id END AS id, CASE WHEN doc_id % 2 = 1 THEN {px.org_sql('(doc_id % 150 + 1)')} END AS org, ['y', 'm', 'n'][doc_id % 3 + 1] AS verdict FROM labels),
        own AS (SELECT DISTINCT n, verdict, g.id, g.organisation_number AS org, g.platform, g.tier FROM d JOIN gated g ON g.id = d.id OR (g.organisation_number = d.org AND g.platform = 'company_site' AND g.signal_type = 'company_profile')),
        low AS (SELECT own.n, own.verdict, g.id, g.tier, own.id AS root, own.platform FROM own JOIN gated g ON g.organisation_number = own.org AND g.id <> own.id AND ((own.platform = 'company_site' AND contains(g.identity_proof, '_on_verified_company_site')) OR (own.platform = 'wikidata' AND contains(g.identity_proof, 'wikidata_p2333_')))),
        every AS (SELECT id, n, 0 AS step, verdict, CAST(NULL AS VARCHAR) AS basis, tier, CAST(NULL AS VARCHAR) AS root FROM own UNION ALL SELECT id, n, 1, verdict, 'inherited from the ' || platform || ' root adjudicated above', tier, root FROM low)
        SELECT id, verdict <> 'n' AS exact_entity, verdict = 'y' AS metric_correct, basis, tier AS risk_tier, root AS derived_from FROM every QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, step DESC, root DESC) = 1""",
    "site_parse": f"WITH {_PAGES} SELECT page_id, title, '' AS description, body_text, identity_excerpt FROM page",
    "site_gate": f"""WITH {_PAGES}, n AS (SELECT page_id, {px.org_sql('(page_id % 150 + 1)')} AS org, {px.org_sql('(page_id % 140 + 7)')} AS other, len({_CORE}) AS core, length(body_text) AS size,
          len(list_filter(list_transform(regexp_extract_all(body_text, '(?:^|[^0-9])([0-9]{{3}}[\\s. ]?[0-9]{{3}}[\\s. ]?[0-9]{{3}})(?:[^0-9]|$)', 1), lambda x: regexp_replace(x, '[^0-9]', '', 'g')), lambda x: {_valid('x')})) AS others FROM page),
        p AS (SELECT *, CASE WHEN page_id % 4 = 0 OR (page_id % 4 = 1 AND org = other) THEN 'org_number_labelled_on_page' WHEN page_id % 4 = 2 AND others = 0 AND core > 0 AND NOT (core = 1 AND size < 100) THEN 'registry_site_corroborated' ELSE '' END AS proof FROM n)
        SELECT page_id, org, proof, CAST(CASE proof WHEN 'org_number_labelled_on_page' THEN 1.0 WHEN 'registry_site_corroborated' THEN 0.93 ELSE 0.5 END AS DOUBLE) AS confidence, CASE WHEN proof <> '' THEN 'available' ELSE 'ambiguous' END AS state FROM p""",
    "activity_posts": """SELECT page_id, 0 AS pos, 'Nytt' AS title, ['2026-09-', '2026-03-', '2025-11-', '2025-04-'][page_id % 5 + 1] || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS date, regexp_extract(url, '^https?://[^/]+') || '/nytt/' || page_id AS url FROM pages WHERE page_id % 5 <> 4""",
    "listed_posts": """WITH t AS (SELECT page_id, lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS day, regexp_replace(url, '[^/]*$', '') AS base, regexp_extract(html, '<title>([A-Za-z ]*)', 1) AS words FROM pages)
        SELECT page_id, 0 AS pos, trim(regexp_replace('Andre publisert ' || (page_id % 28 + 1) || '. mai 2025 avsnitt ' || words, ' +', ' ', 'g')) AS title, '2025-05-' || day AS date, CAST(NULL AS VARCHAR) AS url FROM t
        UNION ALL SELECT page_id, 1, 'Sak ' || page_id, '2025-01-' || day, base || 'sak/' || page_id FROM t""",
    "viewer_stats": f"""WITH {_CLAIMS}, s AS (SELECT {px.org_sql('(user_id + 1)')} AS org, count(DISTINCT event_id % 7) > 1 AS several FROM events GROUP BY 1),
        f AS (SELECT org, {_has('places.rating', 'rating')}, {_has('official_website', 'website')}, {_has('wikidata.qid', 'wikidata')}, {_has('financials.revenue', 'accounts')} FROM claims GROUP BY 1)
        SELECT count(*) AS companies, {', '.join(f"CAST(floor(count_if({x}) * 100 / count(*) + 0.5) AS BIGINT) AS {n}" for x, n in (("coalesce(several, false)", "two_platforms"), ("rating", "rating"), ("website", "website"), ("wikidata", "wikidata"), ("accounts", "accounts")))} FROM f LEFT JOIN s USING (org)""",
    "pending_reviews": f"""WITH {px.OBSERVATIONS_SQL} SELECT id, tier AS risk_tier, signal_type <> 'company_profile' AS later, organisation_number FROM gated WHERE tier IN ('inferred', 'corroborated') AND id NOT IN (SELECT 'o' || doc_id FROM labels)""",
    "collected_claims": f"WITH {_COLLECTED_SQL} SELECT * FROM claims",
    "collected_observations": f"WITH {_SEEN} SELECT id, org AS organisation_number, platform, signal_type, source_url, identity_proof, observed_at FROM seen",
    "collected_evidence": f"""WITH {_COLLECTED_SQL}, e AS (SELECT DISTINCT org, evidence_id FROM claims WHERE evidence_id IS NOT NULL UNION SELECT org, 'ev-job-1' FROM known WHERE key % 8 = 0)
        SELECT evidence_id, CASE WHEN evidence_id IN ('ev-registry', 'ev-roles', 'ev-accounts', 'ev-subunits') THEN 'official_registry' WHEN evidence_id IN ('ev-website', 'ev-activity') THEN 'company_owned' WHEN evidence_id = 'ev-places' THEN 'customer_review' ELSE 'public_mention' END AS source_class,
          CASE evidence_id WHEN 'ev-registry' THEN 'json_field' WHEN 'ev-roles' THEN 'json_roles' WHEN 'ev-accounts' THEN 'json_accounts' WHEN 'ev-subunits' THEN 'json_subunits' WHEN 'ev-website' THEN 'html_identity_gate_v1' WHEN 'ev-activity' THEN 'company_news_page_v1'
          WHEN 'ev-places' THEN 'places_text_search_v1' WHEN 'ev-wikidata' THEN 'wikidata_wbgetentities_v1' ELSE 'nav_stilling_feed_v1' END AS method, count(*) AS n, count(DISTINCT org) AS orgs FROM e GROUP BY ALL""",
    "run_totals": f"""WITH {_SEEN}, ms AS (SELECT key % 97 * 10 AS ms, row_number() OVER (ORDER BY key % 97 * 10) - 1 AS place, count(*) OVER () AS n FROM companies)
        SELECT count(*) AS requested, count(*) AS emitted_envelopes, count(*) * 6 AS requests, CAST(round(count_if(key % 2 = 0) * 0.035, 3) AS DOUBLE) AS usd, (SELECT count(*) FROM seen) AS observations, 0 AS changes, 0 AS material_changes,
          (SELECT max(ms) FROM ms WHERE place = CAST(round_even(0.5 * (n - 1), 0) AS BIGINT)) AS p50_ms, (SELECT max(ms) FROM ms WHERE place = CAST(round_even(0.95 * (n - 1), 0) AS BIGINT)) AS p95_ms, count(*) * 6 <= 12000000 AS passed,
          count_if(key % 19 <> 0) AS completed, count_if(key % 19 = 0) AS completed_without_registry_anchor, 0 AS failed FROM companies""",
    "source_stats": f"WITH {px.OBSERVATIONS_SQL} SELECT platform, count(*) AS observations, count(DISTINCT organisation_number) AS organisations, count_if(len(reasons) = 0) AS published FROM gated GROUP BY 1",
    "registry_observations": f"WITH {px.COMPANIES_SQL} SELECT org || '-brreg-entity' AS id, 'https://r.example/' || org AS source_url, 'organisation_number_primary_key' AS identity_proof, 'primary_key' AS tier FROM companies WHERE key % 3 <> 0",
}
