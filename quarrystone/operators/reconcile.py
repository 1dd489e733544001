"""Change capture between two snapshots of claims.

Claims are rows (org, field, value, availability, period, currency, statement,
evidence_id, url, retrieved_at, sha, first_seen): value is a canonical string, so
that order and number format never count as a change. List-valued claims can have
``items``, an array of (key, item, name, role, place), by which they are told
apart; a claim without it, or a table without the column, is compared as a whole.
One full outer join on (org, field) feeds every result here. Only organisations
that the current run has are reconciled; others are reported as dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields by the kind of their change.
FINANCIAL = ("financials.revenue", "financials.operating_profit", "financials.profit_before_tax", "financials.net_result", "financials.total_assets", "financials.equity")
IDENTITY = ("legal_name", "legal_form", "operating_status")
FILING = (*FINANCIAL, "latest_submitted_accounts", "financial_history.years")
DESCRIPTION = ("website_title", "website_description")
MINOR = (*DESCRIPTION, "social_handles")
LIST_TYPES = {"leadership": ("new_role", "departed_role"), "locations": ("new_location", "closed_location"), "social_handles": ("new_handle", "removed_handle")}


def materiality(field: Column) -> Column:
    return F.when(field.isin(*MINOR), "minor").otherwise("material")


ITEMS = "array<struct<key:string,item:string,name:string,role:string,place:string>>"


def _with_items(claims: DataFrame) -> DataFrame:
    return claims if "items" in claims.columns else claims.withColumn("items", F.lit(None).cast(ITEMS))


def _sides(claims: DataFrame, name: str) -> DataFrame:
    return claims.select("org", "field", F.struct(*(c for c in claims.columns if c not in ("org", "field"))).alias(name))


def _last(side: DataFrame, name: str) -> DataFrame:
    """The last claim of each field."""
    return side.groupBy("org", "field").agg(F.max_by(name, F.coalesce(F.col(name)["pos"], F.lit(0))).alias(name))


def paired(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(org, field, p, c): both sides as structs, for organisations that the current run has.

    If the current run tells its places, there is a third struct, s: the last claim
    that the current run itself has of a field that it tells of more than once.
    """
    previous, current = _with_items(previous), _with_items(current)
    mine = _sides(previous.join(current.select("org").distinct(), "org", "left_semi"), "p")
    if "pos" in previous.columns:
        mine = _last(mine, "p")
    now = _sides(current, "c")
    if "pos" in current.columns:
        own = Window.partitionBy("org", "field")  # dealt out as the join is
        last = F.max_by("c", F.coalesce(F.col("c")["pos"], F.lit(0))).over(own)
        now = now.withColumn("s", F.when(F.count(F.lit(1)).over(own) > 1, last))
    return mine.join(now, ["org", "field"], "full_outer")


def _comparable(p: Column, c: Column) -> Column:
    same = p["value"].eqNullSafe(c["value"])
    for k in ("period", "currency", "statement"):
        same = same & p[k].eqNullSafe(c[k])
    return same


def preserved() -> Column:
    """The source told nothing, and there is a value to keep."""
    return F.col("c.availability").isin("failed", "blocked") & (F.col("p.availability") == "available")


def change_type() -> Column:
    """The first rule that holds; null where nothing changed. Lists whose items differ are told apart by them after this."""
    p, c, field = F.col("p"), F.col("c"), F.col("field")
    return (
        F.when(p.isNull() | c.isNull(), None)
        .when(preserved(), "source_unavailable")
        .when(_comparable(p, c) & (p["availability"] == c["availability"]), None)
        .when((p["availability"] != "available") & (c["availability"] == "available"), "became_available")
        .when((p["availability"] == "available") & (c["availability"] == "not_available"), "became_unavailable")
        .when(p["value"].isNull() & c["value"].isNull(), "availability_changed")
        .when(field.isin(*FILING), "new_filing")
        .when(field.isin(*IDENTITY), "changed_identity")
        .when(field.isin(*DESCRIPTION), "changed_description")
        .otherwise("value_changed")
    )


_ONE = "struct<change_type:string,old_value:string,new_value:string,item_name:string,item_role:string,item_place:string>"


def _item_changes() -> Column:
    """One change for each item that only one side has: what came, then what went, in the order of the lists."""
    field = F.col("field")
    none = F.array().cast(f"array<{_ONE}>")
    items = lambda side: F.coalesce(F.col(side)["items"], F.array().cast(ITEMS))

    def only(side: str, other: str) -> Column:
        there = F.transform(items(other), lambda x: x["key"])
        own = F.filter(items(side), lambda x: ~F.array_contains(there, x["key"]))
        keys = F.transform(own, lambda x: x["key"])
        return F.filter(own, lambda x, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), x["key"]))  # the last of a key

    def told(kind: str, found: Column, came: bool) -> Column:
        empty = F.lit(None).cast("string")
        one = lambda x: F.struct(F.lit(kind).alias("change_type"), (empty if came else x["item"]).alias("old_value"), (x["item"] if came else empty).alias("new_value"), x["name"].alias("item_name"), x["role"].alias("item_role"), x["place"].alias("item_place"))
        return F.transform(found, one).cast(f"array<{_ONE}>")

    out = none
    for name, (added, removed) in LIST_TYPES.items():
        out = F.when(field == name, F.concat(told(added, only("c", "p"), True), told(removed, only("p", "c"), False))).otherwise(out)
    return out


def _note(kind: Column) -> Column:
    p, c = F.col("p"), F.col("c")
    text = lambda x: F.coalesce(x, F.lit("None"))
    moved = lambda label, k: F.when(~p[k].eqNullSafe(c[k]), F.concat(F.lit(f"{label} "), text(p[k]), F.lit(" -> "), text(c[k])))
    parts = F.concat_ws("; ", moved("currency", "currency"), moved("statement_type", "statement"), moved("reporting period", "period"))
    return (
        F.when(kind == "source_unavailable", "source could not be re-read; last supported value preserved")
        .when(kind == "became_unavailable", "source was read successfully and no longer reports this value")
        .when(kind == "availability_changed", F.concat(F.lit("no value on either side; source state moved from "), p["availability"], F.lit(" to "), c["availability"]))
        .when((kind != "became_available") & p["value"].eqNullSafe(c["value"]) & (parts != ""), F.concat(F.lit("value unchanged; "), parts))
    )


def changes_of(pairs: DataFrame, *more: str) -> DataFrame:
    p, c = F.col("p"), F.col("c")
    found = pairs.withColumn("kind", change_type()).where("kind is not null")
    kind = F.col("kind")
    kept = kind == "source_unavailable"
    empty = F.lit(None).cast("string")
    whole = F.struct(
        kind.alias("change_type"), p["value"].alias("old_value"), F.when(kept, p["value"]).when(kind == "became_unavailable", None).otherwise(c["value"]).alias("new_value"),
        empty.alias("item_name"), empty.alias("item_role"), empty.alias("item_place"),
    ).cast(_ONE)
    items = F.when(kind == "value_changed", _item_changes())
    told = found.select("org", "field", "p", "c", "kind", _note(kind).alias("note"), items.alias("items"), *more)
    by_item = F.size("items") > 0
    rows = told.select("org", "field", "p", "c", "kind", *more, F.when(~by_item | by_item.isNull(), F.col("note")).alias("note"), F.inline(F.when(by_item, F.col("items")).otherwise(F.array(whole))))
    return rows.select(
        "org", "field", "change_type",
        F.when(kept | (kind == "availability_changed"), "minor").otherwise(materiality(F.col("field"))).alias("materiality"),
        "old_value", "new_value",
        p["availability"].alias("old_availability"),
        c["availability"].alias("new_availability"),
        p["url"].alias("old_url"),
        F.when(~kept, c["url"]).alias("new_url"),
        p["retrieved_at"].alias("old_retrieved_at"),
        F.when(~kept, c["retrieved_at"]).alias("new_retrieved_at"),
        p["sha"].alias("old_sha"),
        F.when(~kept, c["sha"]).alias("new_sha"),
        F.when(~kept, c["period"]).alias("reporting_period"),
        "note", "item_name", "item_role", "item_place", *more,
    )


def changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """One row for each changed (org, field), or for each item that came or went."""
    return changes_of(paired(previous, current))


def claims(previous: DataFrame, current: DataFrame, *more: str) -> DataFrame:
    """The reconciled claims: stamped, kept although the source failed, or carried because they are missing now.

    more: further columns of both tables that go with the value. A kept claim tells
    when it was last confirmed: as the previous run's last_seen says, if it has the
    column, else when that was retrieved.
    """
    p, c = F.col("p"), F.col("c")
    old, silent = preserved(), c.isNull()
    confirmed = F.coalesce(p["last_seen"], p["retrieved_at"]) if "last_seen" in previous.columns else p["retrieved_at"]
    take = lambda k: F.when(old | silent, p[k]).otherwise(c[k])
    same = _comparable(p, c) & (p["availability"] == c["availability"])
    return paired(previous, current).select(
        "org", "field",
        take("value").alias("value"), take("availability").alias("availability"), take("period").alias("period"), take("evidence_id").alias("evidence_id"),
        F.when(old | silent, p["first_seen"]).when(same, F.coalesce(p["first_seen"], c["retrieved_at"])).otherwise(c["retrieved_at"]).alias("first_observed_at"),
        F.when(old | silent, confirmed).otherwise(c["retrieved_at"]).alias("last_observed_at"),
        F.coalesce(old, F.lit(False)).alias("stale"),
        F.when(old, c["availability"]).alias("refresh_status"),
        F.when(old, confirmed).alias("last_confirmed_at"),
        *(take(k).alias(k) for k in more),
    )


def carried_evidence(previous: DataFrame, current: DataFrame, evidence_now: DataFrame) -> DataFrame:
    """(org, evidence_id, url, sha) of kept claims that the current run's evidence lacks."""
    p, c = F.col("p"), F.col("c")
    kept = paired(previous, current).where(preserved() | c.isNull()).where(p["evidence_id"].isNotNull())
    rows = kept.select("org", p["evidence_id"].alias("evidence_id"), p["url"].alias("url"), p["sha"].alias("sha")).distinct()
    return rows.join(evidence_now.select("org", "evidence_id"), ["org", "evidence_id"], "left_anti")


def list_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """One row for each item (org, field, item_key) that only one side has; items are distinct by key."""
    side = lambda df, flag: df.select("org", "field", "item_key", F.lit(True).alias(flag)).distinct()
    both = side(previous, "was").join(side(current, "now"), ["org", "field", "item_key"], "full_outer")
    kind = F.when(F.lit(False), "")
    for field, (added, removed) in LIST_TYPES.items():
        kind = kind.when((F.col("field") == field) & F.col("was").isNull(), added).when((F.col("field") == field) & F.col("now").isNull(), removed)
    return both.withColumn("change_type", kind).where("change_type is not null").select("org", "field", "item_key", "change_type", materiality(F.col("field")).alias("materiality"))


def evidence_complete() -> Column:
    """A change with a value on a side can be traced to a source."""
    traced = F.col("old_url").isNotNull() | F.col("new_url").isNotNull()
    new_ok = F.col("new_value").isNull() | traced
    old_ok = F.col("old_value").isNull() | (F.col("change_type") == "became_available") | traced
    return new_ok & old_ok


def membership(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(org, membership): dropped and new organisations; one exchange of both lists."""
    side = lambda df, was: df.select("org", F.lit(was).alias("was"), F.lit(not was).alias("now"))
    orgs = side(previous, True).unionByName(side(current, False)).groupBy("org").agg(F.bool_or("was").alias("was"), F.bool_or("now").alias("now"))
    return orgs.where("not (was and now)").select("org", F.when(F.col("was"), "dropped").otherwise("new").alias("membership"))


def _against_itself(pairs: DataFrame) -> DataFrame:
    """Pairs of the claims of repeated fields and the last claim of their run."""
    if "s" not in pairs.columns:
        return pairs.limit(0)
    return pairs.where("s is not null").select("org", "field", F.col("s").alias("p"), "c")


def self_changes(current: DataFrame) -> DataFrame:
    """One row: the changes that a comparison of the run with itself reports, which ought to be none.

    Each claim is compared with the last one of its field, as the previous run's are.
    """
    return changes_of(_against_itself(paired(current.limit(0), current))).agg(F.count(F.lit(1)).alias("self_changes"))


def refresh_report(previous: DataFrame, current: DataFrame) -> DataFrame:
    """One row: counts of changes, completeness of evidence, dropped organisations, and whether the current run differs from itself.

    One join of the claims gives both comparisons; beside it only organisations are listed.
    """
    pairs = paired(previous, current)
    side = lambda x, own: F.struct(F.col(x).alias("p"), F.lit(own).alias("own"))
    if "s" in pairs.columns:  # both comparisons of a claim, from the same row
        sides = F.when(F.col("s").isNull(), F.array(side("p", False))).otherwise(F.array(side("p", False), side("s", True)))
    else:
        sides = F.array(side("p", False))
    found = changes_of(pairs.select("org", "field", "c", F.inline(sides)), "own").select("change_type", "materiality", "own", evidence_complete().alias("ok"))
    dropped = membership(previous, current).agg(F.count_if(F.col("membership") == "dropped").alias("dropped"))
    real = ~F.col("own")
    return (
        found.agg(
            F.count_if(real).alias("changes"),
            F.count_if(real & (F.col("materiality") == "material")).alias("material"),
            F.count_if(real & (F.col("change_type") == "source_unavailable")).alias("preserved"),
            F.coalesce(F.every(F.col("ok") | F.col("own")), F.lit(True)).alias("evidence_complete"),
            F.count_if(F.col("own")).alias("self_changes"),
        )
        .join(dropped, F.lit(True))
        .withColumn("passed", F.col("evidence_complete") & (F.col("self_changes") == 0) & (F.col("dropped") == 0))
        .select("changes", "material", "preserved", "evidence_complete", "self_changes", "dropped", "passed")
    )


#: What makes two claims of a field the same state, and what says that nothing was read.
_STATE = ("value", "availability", "period", "currency", "statement")


def _merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows that follow each other in the same state as one row each; rows: (org, field, run, state columns, first_at, last_at, runs, missed).

    A row that could not be read, behind a value, is a missed run of that value. One
    that has no row before it that was read stays: it may be one still.
    """
    ahead = Window.partitionBy("org", "field", *keys).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("org", "field", *keys).orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    silent = F.col("availability").isin("failed", "blocked")
    marked = rows.withColumn("before", F.last(F.when(~silent, F.col("availability")), ignorenulls=True).over(ahead))
    marked = marked.withColumn("missing", silent & F.coalesce(F.col("before") == "available", F.lit(False)))
    state = F.when(~F.col("missing"), F.struct(*_STATE))
    marked = marked.withColumn("was", F.last(state, ignorenulls=True).over(ahead))
    begins = ~F.col("missing") & (F.col("was").isNull() | ~F.col("was").eqNullSafe(F.struct(*_STATE)))
    placed = marked.withColumn("island", F.sum(begins.cast("long")).over(upto))
    held = ~F.col("missing")
    first = lambda c: F.min_by(c, F.when(held, F.col("run"))).alias(c)
    return placed.groupBy("org", "field", *keys, "island").agg(
        F.min("run").alias("run"),
        *(first(c) for c in _STATE),
        first("first_at"),
        F.max_by("last_at", F.when(held, F.col("run"))).alias("last_at"),
        F.coalesce(F.sum(F.when(held, F.col("runs"))), F.lit(0)).alias("runs"),
        F.sum(F.when(held, F.col("missed")).otherwise(F.col("runs") + F.col("missed"))).alias("missed"),
    ).drop("island")


def intervals(runs: DataFrame, stretch: int = 64) -> DataFrame:
    """When each state of a field was observed, over any number of runs at once.

    runs: claims with a column ``run``, a whole number that orders them; a field has
    one claim in a run. One row for each stretch of runs in which a field's state
    (value, availability, period, currency, statement) stayed: (org, field, state,
    first_observed_at, last_observed_at, runs, missed, since). A value that a run
    could not read (failed or blocked) is kept, as the comparison of two runs keeps
    it: the run is missed and the interval goes on. So does it over runs that have
    no claim of the field.

    Runs are merged within stretches of so many numbers first, and what is left of
    those is merged again, so a field that a third of all claims are about is dealt
    out by its runs.
    """
    stamp = F.col("retrieved_at")
    one = runs.select("org", "field", F.col("run").cast("long").alias("run"), *_STATE, F.coalesce(F.col("first_seen"), stamp).alias("first_at") if "first_seen" in runs.columns else stamp.alias("first_at"), stamp.alias("last_at"), F.lit(1).cast("long").alias("runs"), F.lit(0).cast("long").alias("missed"))
    parts = _merged(one.withColumn("part", F.floor(F.col("run") / stretch)), "part").drop("part")
    return _merged(parts).select("org", "field", *_STATE, F.col("first_at").alias("first_observed_at"), F.col("last_at").alias("last_observed_at"), "runs", "missed", F.col("run").alias("since"))


def as_of(probes: DataFrame, claims: DataFrame, at: str = "at", by: tuple[str, ...] = ("org",), stretch: int = 30) -> DataFrame:
    """probes with a column ``claim``: the last claim of their key at their time or before, null if there is none.

    Both have the columns of `by` and a date or timestamp `at`; claims have one row for
    each of those, or the greatest of them counts. Time is cut into stretches of so
    many days, in which probes and claims are merged by one window; the last claim
    of each stretch is handed on to later ones, so a key that a third of all rows
    belong to is dealt out by time. Probes without a time meet none.
    """
    held = [c for c in claims.columns if c not in (*by, at)]
    part = F.floor(F.unix_date(F.to_date(at)) / stretch).alias("_part")
    claim = F.struct(F.col(at).alias(at), *held)
    one = claims.where(F.col(at).isNotNull()).select(*by, at, part, claim.alias("claim")).groupBy(*by, "_part", at).agg(F.max("claim").alias("claim"))
    ahead = Window.partitionBy(*by).orderBy("_part")
    lasts = one.groupBy(*by, "_part").agg(F.max("claim").alias("claim"))  # a row for each stretch that has any
    asked = probes.select(F.struct(*(F.col(f"`{c}`") for c in probes.columns)).alias("probe"), *by, at, part)
    stretches = asked.where(F.col(at).isNotNull()).select(*by, "_part").distinct().withColumn("claim", F.lit(None).cast(lasts.schema["claim"].dataType))
    # what each stretch is handed: the last claim of any stretch before it
    handed = lasts.unionByName(stretches).groupBy(*by, "_part").agg(F.max("claim").alias("claim")).withColumn("before", F.last("claim", ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, -1)))
    none = F.lit(None)
    rows = asked.select(*by, at, "_part", F.lit(2).alias("_kind"), none.cast(lasts.schema["claim"].dataType).alias("claim"), "probe")
    rows = rows.unionByName(one.select(*by, at, "_part", F.lit(1).alias("_kind"), "claim", none.cast(asked.schema["probe"].dataType).alias("probe")))
    rows = rows.unionByName(handed.select(*by, none.cast(asked.schema[at].dataType).alias(at), "_part", F.lit(0).alias("_kind"), F.col("before").alias("claim"), none.cast(asked.schema["probe"].dataType).alias("probe")))
    # what is handed on comes first in its stretch, and a claim before the probes of its time
    place = Window.partitionBy(*by, "_part").orderBy(F.when(F.col("_kind") == 0, 0).otherwise(1), at, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.withColumn("claim", F.last("claim", ignorenulls=True).over(place)).where("_kind = 2")
    return met.select("probe.*", F.when(F.col(at).isNotNull(), F.col("claim")).alias("claim"))
