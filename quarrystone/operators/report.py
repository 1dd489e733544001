"""Run reports: counts, percentiles, budgets, coverage, and merged handles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numbers as fn


def percentiles(rows: DataFrame, by: list[str], value: str, percents: tuple[int, ...] = (50, 95)) -> DataFrame:
    """Nearest-rank percentiles of value by group.

    Ranks are taken by a window over distinct values with their counts, so the
    rows of a group are summed up before they meet.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*by)
    placed = counts.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(every).alias("total"))
    at = lambda p: F.least(F.col("total") - 1, F.bround(F.lit(p / 100) * (F.col("total") - 1), 0).cast("long"))
    here = lambda p: (F.col("upto") > at(p)) & (F.col("upto") - F.col("n") <= at(p))
    return placed.groupBy(*by).agg(*(F.max(F.when(here(p), F.col(value))).alias(f"p{p}") for p in percents), F.max("total").alias("n"))


def upper_median(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy(*by)).alias("total"))
    at = F.floor(F.col("total") / 2)
    return placed.groupBy(*by).agg(F.max(F.when((F.col("upto") > at) & (F.col("upto") - F.col("n") <= at), F.col(value))).alias("median"))


def status_counts(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def admitted(rows: DataFrame, block: str, order: list[str], cost: Column, limit: float) -> DataFrame:
    """Rows that a budget admits in order: the running cost stays within the limit.

    The running sum goes in two steps, within blocks and over the blocks' totals,
    so no task holds all rows. `block` is a column that grows with the order.
    """
    rows = rows.withColumn("cost", cost)
    own = Window.partitionBy(block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(F.lit(1)).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(block).agg(F.sum("cost").alias("t")).select(block, F.coalesce(F.sum("t").over(before), F.lit(0)).alias("before"))
    placed = rows.withColumn("own", F.sum("cost").over(own)).join(totals, block)
    return placed.withColumn("spent", F.col("own") + F.col("before")).where(F.col("spent") <= limit).drop("own", "before")


def costs(ledger: DataFrame) -> DataFrame:
    """(provider, usd) with six decimals."""
    return ledger.groupBy("provider").agg(F.round(F.sum("usd"), 6).alias("usd"), F.count(F.lit(1)).alias("requests"))


def merged_handles(observations: DataFrame) -> DataFrame:
    """One row for each profile however often it is declared, with the number of sources."""
    key = fn.bare_url(F.coalesce(F.col("declared_url"), F.col("source_url")))
    return observations.groupBy("organisation_number", "platform", "signal_type", key.alias("profile")).agg(
        F.count_distinct("identity_proof").alias("confirmed_by"), F.array_join(F.array_sort(F.collect_set("identity_proof")), ",").alias("proofs")
    )


def coverage_flags(claims: DataFrame) -> DataFrame:
    """By organisation: whether rating, website, wikidata and accounts are available."""
    has = lambda field: F.coalesce(F.bool_or((F.col("field") == field) & (F.col("availability") == "available")), F.lit(False))
    return claims.groupBy("org").agg(has("places.rating").alias("rating"), has("official_website").alias("website"), has("wikidata.qid").alias("wikidata"), has("financials.revenue").alias("accounts"))


def identity_summary(claims: DataFrame) -> DataFrame:
    """The four identity claims of each organisation side by side, where available."""
    take = lambda field: F.max(F.when((F.col("field") == field) & (F.col("availability") == "available"), F.col("value")))
    return claims.groupBy("org").agg(*(take(f).alias(f) for f in ("legal_name", "legal_form", "municipality", "industry_code")))


def run_totals(envelopes: DataFrame, run_id: str, requested: int, budget: int | None = None) -> DataFrame:
    """One row about a run; envelopes: (org, status, observations, changes, operations) as engine.run builds them."""
    ops = F.col("operations")
    total = envelopes.agg(
        F.count(F.lit(1)).alias("emitted_envelopes"),
        F.coalesce(F.sum(ops["requests"]), F.lit(0)).alias("requests"),
        F.round(F.coalesce(F.sum(ops["third_party_cost_usd"]), F.lit(0.0)), 4).alias("third_party_cost_usd"),
        F.coalesce(F.sum(F.size("observations")), F.lit(0)).alias("observations"),
        F.coalesce(F.sum(F.size("changes")), F.lit(0)).alias("changes"),
        F.coalesce(F.sum(F.size(F.filter("changes", lambda x: x["materiality"] == "material"))), F.lit(0)).alias("material_changes"),
    )
    states = status_counts(envelopes, "status").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("terminal_states"))
    took = percentiles(envelopes.select(ops["runtime_ms"].alias("ms")), [], "ms").select(F.coalesce("p50", F.lit(0)).alias("p50_ms"), F.coalesce("p95", F.lit(0)).alias("p95_ms"))
    within = F.lit(True) if budget is None else F.col("requests") <= budget
    return total.join(states, F.lit(True)).join(took, F.lit(True)).select(
        F.lit(run_id).alias("run_id"), F.lit(requested).cast("long").alias("requested"), "*", F.lit(budget).cast("long").alias("request_budget"), ((F.col("emitted_envelopes") == requested) & within).alias("passed")
    )


def viewer_stats(claims: DataFrame, observations: DataFrame) -> DataFrame:
    """One row: companies, and the whole percent of them with two or more platforms, a rating, a website, a knowledge-base record and accounts."""
    several = observations.groupBy("org").agg((F.count_distinct("platform") > 1).alias("several"))
    rows = coverage_flags(claims).join(several, "org", "left")
    share = lambda flag: F.coalesce(F.floor(F.count_if(flag) * 100 / F.count(F.lit(1)) + 0.5), F.lit(0)).cast("long")
    return rows.agg(F.count(F.lit(1)).alias("companies"), share(F.coalesce("several", F.lit(False))).alias("two_platforms"), *(share(F.col(k)).alias(k) for k in ("rating", "website", "wikidata", "accounts")))


def sketched(rows: DataFrame, by: list[str], value: str, key: str) -> DataFrame:
    """(*by, values, keys): a KLL sketch of whole numbers and a theta sketch of keys, of a few kilobytes each however many rows there are.

    Sketches of runs are kept and merged later; merged() gives what one sketch of
    all their rows would give, within the same error.
    """
    return rows.groupBy(*by).agg(F.kll_sketch_agg_bigint(value).alias("values"), F.theta_sketch_agg(key).alias("keys"))


def merged(sketches: DataFrame, by: list[str], shares: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """(*by, n, p50, p95, ..., distinct) of sketches, merged over all columns but by.

    A percentile's rank is off by 0.0133 at most in 99 of 100 cases (k = 200); the
    count of distinct keys by some hundredths beyond 4,096 and not at all below.
    """
    whole = sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("values").alias("values"), F.theta_union_agg("keys").alias("keys"))
    at = lambda p: F.kll_sketch_get_quantile_bigint("values", F.lit(p)).alias(f"p{round(p * 100)}")
    return whole.select(*by, F.kll_sketch_get_n_bigint("values").alias("n"), *(at(p) for p in shares), F.theta_sketch_estimate("keys").alias("distinct"))


def places_check(collected: DataFrame, names: DataFrame, searches: int, cost: float) -> tuple[DataFrame, DataFrame]:
    """Verdicts on a place search from captured responses, and one row of what it has cost.

    collected: claims as collect makes them (org, field, value, availability, note,
    identity_proof), names: (org, name). A verdict is the state of the rating, its
    proof, and why there is none.
    """
    rating = collected.where(F.col("field") == "places.rating").select("org", F.col("availability").alias("state"), F.col("value").alias("rating"), F.col("identity_proof").alias("proof"), "note")
    rows = names.select("org", "name").join(rating, "org", "left")
    published = rows.agg(F.count_if(F.col("state") == "available").alias("published"))
    told = published.select(F.lit(True).alias("configured"), F.lit(searches).cast("long").alias("searches"), "published", F.round(F.lit(searches * cost), 4).alias("spent_usd"), F.lit(cost).alias("cost_per_search_usd"), F.lit(round(cost * 100, 2)).alias("projected_per_100_companies_usd"))
    return rows, told
