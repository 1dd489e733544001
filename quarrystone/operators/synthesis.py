"""Deterministic summaries: each section is null when no available claim feeds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as fn

#: Words for legal forms, and the fields whose absence is told.
FORM_WORDS = {
    "AS": "a private limited company",
    "ASA": "a public limited company",
    "ANS": "a general partnership",
    "DA": "a partnership with shared liability",
    "ENK": "a sole proprietorship",
    "NUF": "a Norwegian branch of a foreign company",
    "SA": "a cooperative",
    "STI": "a foundation",
    "BRL": "a housing cooperative",
    "ESEK": "a jointly owned property",
    "FLI": "a voluntary association",
    "IKS": "an inter-municipal company",
}
UNKNOWN_FIELDS = ("official_website", "employees_registered", "financials.revenue", "managing_director", "locations", "places.rating", "jobs.active_count", "activity.latest_post_date", "wikidata.qid")
PROOF_WORDS = {"org_number_labelled_on_page": "the organisation number appears on the page", "org_number_on_page": "the organisation number appears on the page", "registry_site_corroborated": "a registry address or phone number appears on the page"}
OFFICIAL_ONLY = "No permitted external source could be tied to this entity, so the profile rests on official records alone."


def facts(claims: DataFrame) -> DataFrame:
    """Available values of each organisation by field, in one row; claims: (org, field, value, availability, ...)."""
    there = (F.col("availability") == "available") & (F.coalesce(F.col("value"), F.lit("")) != "")
    pairs = F.collect_list(F.when(there, F.struct("field", "value")))
    return claims.groupBy("org").agg(F.map_from_entries(pairs).alias("f"))


def identity(f: Column, org: Column) -> Column:
    form = F.substring_index(F.coalesce(f["legal_form"], F.lit("")), " - ", 1)
    words = F.when(F.lit(False), "")
    for code, said in FORM_WORDS.items():
        words = words.when(F.trim(form) == code, said)
    industry = f["industry_code"]
    return F.concat(
        F.coalesce(f["legal_name"], org), F.lit(" is "), words.otherwise("a registered entity"),
        F.coalesce(F.concat(F.lit(" in "), fn.titled(f["municipality"])), F.lit("")),
        F.coalesce(F.concat(F.lit(", registered "), f["registration_date"]), F.lit("")),
        F.coalesce(F.when(F.instr(industry, " ") > 0, F.concat(F.lit(". Its registered activity is "), F.lower(F.substring(industry, F.instr(industry, " ") + 1, F.length(industry))))), F.lit("")),
        F.lit("."),
    )


def scale(f: Column, period: Column, currency: Column, statement: Column, filed_zero: Column) -> Column:
    money = lambda k: fn.money(f[k].try_cast("double"), currency)
    year = F.substring(F.substring_index(period, "/", -1), 1, 4)
    lead = F.when(F.coalesce(year, F.lit("")) != "", F.concat(F.lit("Accounts filed for "), year, F.lit(" report revenue of "))).otherwise("Filed accounts report revenue of ")
    kind = F.when(statement == "SELSKAP", " (company accounts).").otherwise(" (group accounts).")
    result = F.coalesce(F.concat(F.lit(" and a net result of "), money("financials.net_result")), F.lit(""))
    revenue = F.when(f["financials.revenue"].isNotNull(), F.concat(lead, money("financials.revenue"), result, kind))
    zero = F.when(revenue.isNotNull() & filed_zero, "The filed revenue figure is zero, which is a reported value rather than a missing one.")
    people = F.when(f["employees_registered"].isNotNull(), F.concat(f["employees_registered"], F.lit(" employees are registered.")))
    return _joined(revenue, zero, people)


def _joined(*parts: Column) -> Column:
    said = F.concat_ws(" ", *parts)
    return F.when(said != "", said)


def standing(f: Column) -> Column:
    """The gravest flag of the status, a JSON object of booleans, leads."""
    flag = lambda k: F.get_json_object(f["operating_status"], f"$.{k}") == "true"
    return (
        F.when(flag("bankruptcy"), "The company is registered as bankrupt.")
        .when(flag("compulsory_liquidation"), "The company is under compulsory liquidation.")
        .when(flag("under_liquidation"), "The company is being wound up.")
        .when(flag("in_group"), "The registry records this entity as part of a group.")
    )


def people(f: Column, board: Column) -> Column:
    director, chair = f["managing_director"], f["board_chair"]
    both = F.when(F.trim(director) == F.trim(chair), F.concat(director, F.lit(" is both registered managing director and board chair.")))
    parts = F.concat_ws(" and ", F.concat(director, F.lit(" is the registered managing director")), F.concat(chair, F.lit(" chairs the board")))
    said = F.coalesce(both, F.when(parts != "", F.concat(parts, F.lit("."))))
    return F.concat(said, F.when(board > 1, F.concat(F.lit(" The board has "), board.cast("string"), F.lit(" registered members."))).otherwise(""))


def presence(f: Column, proof: Column, platforms: Column) -> Column:
    """platforms: sorted distinct platforms of observations, the registry left out."""
    how = F.when(F.lit(False), "")
    for label, words in PROOF_WORDS.items():
        how = how.when(proof == label, words)
    site = F.concat(F.lit("Its verified website is "), f["official_website"], F.lit(", tied to this entity because "), how.otherwise("the registry declares it"), F.lit("."))
    tail = F.coalesce(F.concat(F.lit(" from "), F.nullif(f["places.rating_count"], F.lit("0")), F.lit(" ratings")), F.lit(""))
    rating = F.concat(F.lit("Google records a rating of "), f["places.rating"], F.lit(" out of 5"), tail, F.lit("."))
    n = F.size(platforms)
    named = F.when(n > 1, F.concat(F.array_join(F.slice(platforms, F.lit(1), n - 1), ", "), F.lit(" and "), F.element_at(platforms, -1))).when(n == 1, F.get(platforms, F.lit(0)))
    return _joined(site, rating, F.concat(F.lit("Confirmed presence on "), named, F.lit(".")))


def activity(jobs: Column, posts: Column, latest: Column) -> Column:
    """jobs: the count of adverts where the feed was read; posts and latest: dated posts of the company's own."""
    ads = F.when(jobs > 0, F.concat(jobs.cast("string"), F.lit(" active job adverts carry this organisation number."))).when(jobs == 0, "No active job advert in the national vacancy feed carries this organisation number.")
    own = F.concat(F.lit("The company published "), posts.cast("string"), F.lit(" dated "), F.when(posts == 1, "post").otherwise("posts"), F.lit(" of its own, most recently on "), latest, F.lit("."))
    return _joined(ads, own)


def change_phrase() -> Column:
    """A change in words; over change_type, field, old_value, new_value and the item's name, role and place."""
    c, said = F.col("change_type"), F.translate(F.col("field"), "_.", "  ")
    short = lambda k: F.substring(F.coalesce(F.col(k), F.lit("None")), 1, 40)
    name, role = fn.or_else(F.col("item_name"), F.lit("a person")), F.replace(fn.or_else(F.col("item_role"), F.lit("a role")), F.lit("_"), F.lit(" "))
    where = F.coalesce(F.nullif("item_place", F.lit("")), F.nullif("item_name", F.lit("")), F.lit("a new location"))
    return (
        F.when(c == "new_role", F.concat(name, F.lit(" joined as "), role))
        .when(c == "departed_role", F.concat(name, F.lit(" left the role of "), role))
        .when(c == "new_location", F.concat(F.lit("a workplace was registered in "), where))
        .when(c == "closed_location", F.concat(F.lit("a registered workplace closed in "), where))
        .when(c == "new_filing", F.concat(said, F.lit(" moved from "), short("old_value"), F.lit(" to "), short("new_value")))
        .when(c == "changed_identity", F.concat(said, F.lit(" changed from "), short("old_value"), F.lit(" to "), short("new_value")))
        .when(c == "changed_description", "the website description changed")
        .when(c == "became_available", F.concat(said, F.lit(" became available")))
        .when(c == "became_unavailable", F.concat(said, F.lit(" is no longer reported")))
        .when(c == "source_unavailable", F.concat(said, F.lit(" could not be re-read; the last known value is preserved")))
        .otherwise(F.concat(said, F.lit(" changed")))
    )


def change_sentence(changes: DataFrame, most: int = 6) -> DataFrame:
    """(org, changes): the first material changes of each organisation by field, in one sentence."""
    for k in ("item_name", "item_role", "item_place"):
        if k not in changes.columns:
            changes = changes.withColumn(k, F.lit(None).cast("string"))
    told = changes.where(F.col("materiality") == "material").select("org", F.struct("field", "change_type", change_phrase().alias("said")).alias("x"))
    first = F.slice(F.array_sort(F.collect_list("x")), 1, most)
    return told.groupBy("org").agg(F.concat(F.lit("Since the previous run: "), F.array_join(F.transform(first, lambda x: x["said"]), "; "), F.lit(".")).alias("changes"))


def unknowns(claims: DataFrame) -> DataFrame:
    """(org, place, field, state, reason) of what could not be established, in a fixed order of fields."""
    place = F.array_position(F.array(*(F.lit(x) for x in UNKNOWN_FIELDS)), F.col("field"))
    rows = claims.where(F.col("field").isin(*UNKNOWN_FIELDS) & (F.col("availability") != "available"))
    return rows.select("org", place.alias("place"), "field", F.col("availability").alias("state"), fn.or_else(F.col("note"), F.lit("no permitted source established this value")).alias("reason"))


def text(*sections: Column, external: Column) -> Column:
    """All sections that say something; without any external source, that is said, too."""
    return F.concat_ws(" ", *sections, F.when(~external, OFFICIAL_ONLY))


#: The fields that sections speak of, whose evidence goes with the summary; and its method.
TOLD_FIELDS = (
    "legal_name", "legal_form", "industry_code", "municipality", "registration_date", "operating_status", "financials.revenue", "financials.net_result", "employees_registered",
    "managing_director", "board_chair", "leadership", "official_website", "places.rating", "places.rating_count", "jobs.active_count", "activity.latest_post_date", "activity.posts",
)
METHOD = "deterministic_claim_template_v1"
BOARD = ("MEDL", "LEDE", "NEST")


def board_size(leadership: Column) -> Column:
    """Members of the board in a JSON list of roles."""
    held = F.from_json(leadership, "array<struct<role_code:string>>")
    return F.coalesce(F.size(F.filter(held, lambda x: x["role_code"].isin(*BOARD))), F.lit(0))


def build(claims: DataFrame, observations: DataFrame, changes: DataFrame) -> DataFrame:
    """(org, text, sections, unknowns, evidence_ids, method) of each organisation that has claims.

    claims: (org, field, value, availability, period, currency, statement, identity_proof, evidence_id, note),
    observations: (org, platform), changes as reconcile gives them. One exchange
    of claims by organisation; all sections are columns over its map of values.
    """
    there = (F.col("availability") == "available") & (F.coalesce(F.col("value"), F.lit("")) != "")
    place = F.array_position(F.array(*(F.lit(x) for x in UNKNOWN_FIELDS)), F.col("field"))
    reason = fn.or_else(F.col("note"), F.lit("no permitted source established this value"))
    of = lambda field, column: F.max(F.when(F.col("field") == field, F.col(column))).alias(column)
    rows = claims.groupBy("org").agg(
        F.map_from_entries(F.collect_list(F.when(there, F.struct("field", "value")))).alias("f"),
        F.array_sort(F.collect_set(F.when(there & F.col("field").isin(*TOLD_FIELDS), F.col("evidence_id")))).alias("evidence_ids"),
        F.array_sort(F.collect_list(F.when(F.col("field").isin(*UNKNOWN_FIELDS) & (F.col("availability") != "available"), F.struct(place.alias("place"), "field", F.col("availability").alias("state"), reason.alias("reason"))))).alias("unknown"),
        *(of("financials.revenue", k) for k in ("period", "currency", "statement")),
        of("official_website", "identity_proof"),
    )
    other = observations.where(F.col("platform") != "brreg").groupBy("org").agg(F.array_sort(F.collect_set("platform")).alias("platforms"))
    rows = rows.join(other, "org", "left").join(change_sentence(changes).withColumnRenamed("changes", "changed"), "org", "left")
    f = F.col("f")
    posts = F.size(F.from_json(f["activity.posts"], "array<string>"))
    sections = {
        "identity": identity(f, F.col("org")),
        "standing": standing(f),
        "scale": scale(f, F.col("period"), F.col("currency"), F.col("statement"), f["financials.revenue"].try_cast("double") == 0),
        "people": people(f, board_size(f["leadership"])),
        "presence": presence(f, F.col("identity_proof"), F.col("platforms")),
        "activity": activity(f["jobs.active_count"].try_cast("long"), F.coalesce(posts, F.lit(0)), f["activity.latest_post_date"]),
        "changes": F.col("changed"),
    }
    said = rows.select("org", "unknown", "evidence_ids", F.col("platforms").isNotNull().alias("external"), *(v.alias(k) for k, v in sections.items()))
    told = F.map_filter(F.create_map(*(x for k in sections for x in (F.lit(k), F.col(k)))), lambda _, v: v.isNotNull())
    return said.select(
        "org", text(*(F.col(k) for k in sections), external=F.col("external")).alias("text"), told.alias("sections"),
        F.transform("unknown", lambda u: F.struct(u["field"].alias("field"), u["state"].alias("state"), u["reason"].alias("reason"))).alias("unknowns"), "evidence_ids", F.lit(METHOD).alias("method"),
    )
