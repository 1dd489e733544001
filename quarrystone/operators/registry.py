"""Registry payloads to claims.

Payloads are JSON strings in a captured-response table (org, kind, ok, blocked,
status, body, url, retrieved_at, sha). Each builder parses only what it needs and
returns claims in normal form (org, field, value, availability, confidence, note).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as fn
from .reconcile import FINANCIAL

ADDRESS = "STRUCT<adresse: ARRAY<STRING>, postnummer: STRING, poststed: STRING, kommune: STRING, land: STRING>"
CODE = "STRUCT<kode: STRING, beskrivelse: STRING>"
ENTITY = (
    f"organisasjonsnummer STRING, navn STRING, organisasjonsform {CODE}, registreringsdatoEnhetsregisteret STRING, naeringskode1 {CODE}, "
    f"forretningsadresse {ADDRESS}, postadresse {ADDRESS}, sisteInnsendteAarsregnskap STRING, hjemmeside STRING, telefon STRING, "
    "harRegistrertAntallAnsatte BOOLEAN, antallAnsatte BIGINT, registreringsdatoAntallAnsatteEnhetsregisteret STRING, "
    "konkurs BOOLEAN, underAvvikling BOOLEAN, underTvangsavviklingEllerTvangsopplosning BOOLEAN, erIKonsern BOOLEAN"
)
ROLES = (
    "rollegrupper ARRAY<STRUCT<roller: ARRAY<STRUCT<type: STRUCT<kode: STRING>, avregistrert: BOOLEAN, "
    "person: STRUCT<navn: STRUCT<fornavn: STRING, mellomnavn: STRING, etternavn: STRING>>, enhet: STRUCT<navn: STRING>>>>>"
)
FILING = (
    "ARRAY<STRUCT<regnskapstype: STRING, valuta: STRING, regnskapsperiode: STRUCT<fraDato: STRING, tilDato: STRING>, "
    "regnkapsprinsipper: STRUCT<regnskapsregler: STRING>, revisjon: STRUCT<ikkeRevidertAarsregnskap: BOOLEAN>, "
    "resultatregnskapResultat: STRUCT<aarsresultat: DOUBLE, ordinaertResultatFoerSkattekostnad: DOUBLE, driftsresultat: STRUCT<driftsresultat: DOUBLE, driftsinntekter: STRUCT<sumDriftsinntekter: DOUBLE>>>, "
    "eiendeler: STRUCT<sumEiendeler: DOUBLE>, egenkapitalGjeld: STRUCT<egenkapital: STRUCT<sumEgenkapital: DOUBLE>>>>"
)
SUBUNITS = f"_embedded STRUCT<underenheter: ARRAY<STRUCT<organisasjonsnummer: STRING, navn: STRING, beliggenhetsadresse: {ADDRESS}, forretningsadresse: {ADDRESS}>>>, page STRUCT<totalElements: BIGINT>"
#: The published role codes.
ROLE_LABELS = {"DAGL": "managing_director", "LEDE": "board_chair", "NEST": "board_deputy_chair", "MEDL": "board_member", "INNH": "proprietor"}


def missing_state() -> Column:
    """Why a response gave no value. Absence is a state, never a zero."""
    return F.when(F.col("blocked"), "blocked").when(F.col("status") == 404, "not_available").when(F.col("ok"), "not_available").otherwise("failed")


def _claims(rows: DataFrame, fields: dict[str, Column], note: Column | None = None) -> DataFrame:
    """Turn one row for each organisation into one for each field; a null or empty value is not available."""
    one = lambda k, v: F.struct(F.lit(k).alias("field"), F.when(v.cast("string") != "", v.cast("string")).alias("value"))
    out = rows.select("org", F.inline(F.array(*(one(k, v) for k, v in fields.items()))), *([note.alias("note")] if note is not None else []))
    out = out if note is not None else out.withColumn("note", F.lit(None).cast("string"))
    there = F.col("value").isNotNull()
    return out.select("org", "field", "value", F.when(there, "available").otherwise("not_available").alias("availability"), F.when(there, 1.0).otherwise(0.0).alias("confidence"), F.when(~there, F.col("note")).alias("note"))


def _coded(x: Column, by: str) -> Column:
    return F.when(F.coalesce(x["kode"], F.lit("")) != "", F.concat(x["kode"], F.lit(by), F.coalesce(x["beskrivelse"], F.lit("None"))))


def entity_claims(responses: DataFrame) -> DataFrame:
    """Twelve claims of each entity record; one, unavailable, where the record isn't that organisation's."""
    rows = responses.select("org", "ok", "blocked", "status", F.from_json("body", ENTITY).alias("e"))
    mine = F.coalesce(F.col("e.organisasjonsnummer") == F.col("org"), F.lit(False))
    e = F.col("e")
    flag = lambda k: F.coalesce(e[k], F.lit(False))
    status = F.to_json(F.struct(flag("konkurs").alias("bankruptcy"), flag("erIKonsern").alias("in_group"), flag("underTvangsavviklingEllerTvangsopplosning").alias("compulsory_liquidation"), flag("underAvvikling").alias("under_liquidation")))
    counted = flag("harRegistrertAntallAnsatte")
    found = _claims(rows.where(mine), {
        "legal_name": e["navn"], "legal_form": _coded(e["organisasjonsform"], " - "), "registration_date": e["registreringsdatoEnhetsregisteret"],
        "industry_code": _coded(e["naeringskode1"], " "), "business_address": fn.address(e["forretningsadresse"]), "postal_address": fn.address(e["postadresse"]),
        "municipality": fn.or_else(e["forretningsadresse"]["kommune"], e["postadresse"]["kommune"]), "latest_submitted_accounts": e["sisteInnsendteAarsregnskap"],
        "registry_website": fn.site_url(e["hjemmeside"]), "registry_phone": F.trim(e["telefon"]), "employees_registered": F.when(counted, e["antallAnsatte"]), "operating_status": status,
    })
    said = F.when((F.col("field") == "employees_registered") & F.col("value").isNull(), "no employee count registered in Enhetsregisteret; not zero employees")
    lost = rows.where(~mine).select("org", F.lit("legal_name").alias("field"), F.lit(None).cast("string").alias("value"), missing_state().alias("availability"), F.lit(0.0).alias("confidence"), F.lit("registry entity not returned for this organisation number").alias("note"))
    return found.withColumn("note", said).unionByName(lost)


def identity(responses: DataFrame) -> DataFrame:
    """(org, legal_name, postcode, city, phone): facts that a website is held against."""
    e = F.from_json("body", ENTITY)
    rows = responses.select("org", e.alias("e")).select("org", "e", F.coalesce("e.forretningsadresse", "e.postadresse").alias("a"))
    some = lambda x: F.when(F.trim(x) != "", F.trim(x))
    return rows.select("org", F.coalesce("e.navn", F.lit("")).alias("legal_name"), some(F.col("a.postnummer")).alias("postcode"), some(F.col("a.poststed")).alias("city"), some(fn.digits(F.col("e.telefon"))).alias("phone"))


def holder(r: Column) -> Column:
    """The name of a role's holder, a person or a unit; null if it has none."""
    n = r["person"]["navn"]
    person = F.array_join(F.filter(F.array(n["fornavn"], n["mellomnavn"], n["etternavn"]), lambda x: F.coalesce(x, F.lit("")) != ""), " ")
    return F.coalesce(F.when(person != "", person), F.when(r["enhet"]["navn"] != "", r["enhet"]["navn"]))


def roles(responses: DataFrame) -> DataFrame:
    """(org, pos, role, role_code, name) of current holders of published roles; all within the row's own payload."""
    every = F.flatten(F.transform(F.col("r.rollegrupper"), lambda g: F.coalesce(g["roller"], F.array())))
    rows = responses.select("org", F.from_json("body", ROLES).alias("r")).select("org", F.posexplode(every).alias("pos", "role"))
    label = F.create_map(*(F.lit(x) for kv in ROLE_LABELS.items() for x in kv))
    out = rows.select("org", "pos", F.col("role.type.kode").alias("role_code"), holder(F.col("role")).alias("name"), F.coalesce("role.avregistrert", F.lit(False)).alias("gone"))
    return out.where(~F.col("gone") & F.col("role_code").isin(*ROLE_LABELS) & F.col("name").isNotNull()).select("org", "pos", label[F.col("role_code")].alias("role"), "role_code", "name")


def leadership(held: DataFrame) -> DataFrame:
    """(org, leadership, managing_director, board_chair): all in payload order, and the first of either kind."""
    first = lambda code: F.min_by(F.when(F.col("role_code") == code, F.col("name")), F.when(F.col("role_code") == code, F.col("pos")))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "role_code", "name"))), lambda x: F.concat(x["role_code"], F.lit("="), x["name"])), ";")
    return held.groupBy("org").agg(listed.alias("leadership"), first("DAGL").alias("managing_director"), first("LEDE").alias("board_chair"))


def latest_filing(filings: DataFrame) -> DataFrame:
    """The latest filing of each organisation: company accounts if there are any, the first on a tie; filings: (org, pos, kind, until, ...)."""
    best = F.struct((F.col("kind") == "SELSKAP").alias("company"), F.coalesce("until", F.lit("")).alias("until"), (-F.col("pos")).alias("pos"))
    rest = [c for c in filings.columns if c != "org"]
    return filings.groupBy("org").agg(F.max_by(F.struct(*rest), best).alias("f")).select("org", "f.*")


def filing_years(filings: DataFrame) -> DataFrame:
    """(org, years): the years of all filings, the latest first."""
    year = F.when(F.coalesce("until", F.lit("")) != "", F.substring("until", 1, 4))
    return filings.groupBy("org").agg(F.array_join(F.sort_array(F.collect_set(year), asc=False), ",").alias("years"))


def filings(responses: DataFrame) -> DataFrame:
    """Annual accounts as rows: (org, pos, kind, since, until, currency, rules, audited, figures...)."""
    rows = responses.select("org", F.posexplode(F.from_json("body", FILING)).alias("pos", "f"))
    r = F.col("f.resultatregnskapResultat")
    figures = (r["driftsresultat"]["driftsinntekter"]["sumDriftsinntekter"], r["driftsresultat"]["driftsresultat"], r["ordinaertResultatFoerSkattekostnad"], r["aarsresultat"], F.col("f.eiendeler.sumEiendeler"), F.col("f.egenkapitalGjeld.egenkapital.sumEgenkapital"))
    return rows.select("org", "pos", F.col("f.regnskapstype").alias("kind"), F.col("f.regnskapsperiode.fraDato").alias("since"), F.col("f.regnskapsperiode.tilDato").alias("until"), F.col("f.valuta").alias("currency"), F.col("f.regnkapsprinsipper.regnskapsregler").alias("rules"), (~F.coalesce("f.revisjon.ikkeRevidertAarsregnskap", F.lit(False))).alias("audited"), *(v.alias(k.split(".")[1]) for k, v in zip(FINANCIAL, figures, strict=True)))


def financial_claims(latest: DataFrame) -> DataFrame:
    """Six figures of each latest filing, with period and qualifiers; a filed zero is a value."""
    figures = F.array(*(F.struct(F.lit(k).alias("field"), F.col(k.split(".")[1]).alias("number")) for k in FINANCIAL))
    rows = latest.select("org", "since", "until", "currency", "kind", F.inline(figures))
    there = F.col("number").isNotNull()
    return rows.select("org", "field", F.col("number").alias("value"), F.when(there, "available").otherwise("not_available").alias("availability"), F.when(there, F.concat_ws("/", F.coalesce("since", F.lit("None")), F.coalesce("until", F.lit("None")))).alias("period"), F.when(there, F.col("currency")).alias("currency"), F.when(there, F.col("kind")).alias("statement"), (there & (F.col("number") == 0)).alias("filed_zero"), F.when(~there, "line item not present in the filed statement; not zero").alias("note"))


def locations(responses: DataFrame) -> DataFrame:
    """(org, item_key, name, address, municipality, registered_subunits): registered workplaces."""
    rows = responses.select("org", F.from_json("body", SUBUNITS).alias("s")).select("org", F.coalesce("s.page.totalElements", F.size("s._embedded.underenheter").cast("long")).alias("registered_subunits"), F.explode("s._embedded.underenheter").alias("u"))
    return rows.select("org", F.col("u.organisasjonsnummer").alias("item_key"), F.col("u.navn").alias("name"), fn.address(F.coalesce("u.beliggenhetsadresse", "u.forretningsadresse")).alias("address"), F.col("u.beliggenhetsadresse.kommune").alias("municipality"), "registered_subunits")
