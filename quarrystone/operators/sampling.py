"""Reproducible stratified samples: seeded ranks, round robin, largest remainder."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numbers as fn


def stratum(form: Column, employees: Column, industry: Column, website: Column) -> Column:
    return F.concat_ws(
        "|",
        fn.or_else(form, F.lit("??")),
        fn.employee_band(employees),
        F.substring(fn.or_else(industry, F.lit("??")), 1, 2),
        F.when(website.isNotNull() & (website != ""), "web").otherwise("no-web"),
    )


def _able(rows: DataFrame, exclude: DataFrame | None) -> DataFrame:
    rows = rows.where(F.coalesce(F.col("org"), F.lit("")) != "")
    if exclude is not None:
        rows = rows.join(exclude.select("org"), "org", "left_anti")
    return rows


def _drawn(rows: DataFrame, seed: str, exclude: DataFrame | None) -> DataFrame:
    """rows (org, legal_form, employees, industry_code, website) with stratum and rank."""
    return _able(rows, exclude).select("*", stratum(F.col("legal_form"), F.col("employees"), F.col("industry_code"), F.col("website")).alias("stratum"), fn.seeded_rank(seed, F.col("org")).alias("rank"))


def ranked(rows: DataFrame, seed: str, most: int, exclude: DataFrame | None = None) -> DataFrame:
    """The first `most` of each stratum by rank, with their place in it.

    The bound is a literal, so Spark cuts strata down to it before they are
    exchanged; a sample of n companies can't need more of any stratum.
    """
    return _drawn(rows, seed, exclude).withColumn("place", F.row_number().over(Window.partitionBy("stratum").orderBy("rank", "org"))).where(F.col("place") <= most)


def round_robin(rows: DataFrame, count: int, seed: str) -> DataFrame:
    """One from each stratum in turn until there are count."""
    return ranked(rows, seed, count).orderBy("place", "stratum").limit(count)


def representative(rows: DataFrame, count: int, seed: str, exclude: DataFrame | None = None) -> DataFrame:
    """Strata in proportion to their size, by largest remainder; the largest strata fill what rounding leaves."""
    own = ranked(rows, seed, count, exclude)
    sizes = _drawn(rows, seed, exclude).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("total"))
    share = F.col("n").cast("double") * count / F.col("total")
    strata = sizes.join(F.broadcast(total), F.lit(True)).select("stratum", "n", F.least("n", F.floor(share)).alias("base"), (share - F.floor(share)).alias("rest"))
    every = Window.partitionBy(F.lit(1))  # a row for each stratum only
    strata = strata.withColumn("left_over", F.lit(count) - F.sum("base").over(every)).withColumn("open", (F.col("base") < F.col("n")).cast("int"))
    turn = Window.partitionBy(F.lit(1)).orderBy(F.desc("rest"), "stratum").rowsBetween(Window.unboundedPreceding, 0)
    strata = strata.withColumn("got", F.col("base") + F.when((F.col("open") == 1) & (F.sum("open").over(turn) <= F.col("left_over")), 1).otherwise(0))
    strata = strata.withColumn("short", F.lit(count) - F.sum("got").over(every))
    fill = Window.partitionBy(F.lit(1)).orderBy(F.desc("n"), "stratum").rowsBetween(Window.unboundedPreceding, -1)
    spare = F.col("n") - F.col("got")
    strata = strata.withColumn("take", F.col("got") + F.least(spare, F.greatest(F.lit(0), F.col("short") - F.coalesce(F.sum(spare).over(fill), F.lit(0)))))
    return own.join(F.broadcast(strata.select("stratum", "take")), "stratum").where(F.col("place") <= F.col("take")).drop("take")


def risk_weighted(rows: DataFrame, count: int, seed: str, website_fraction: float = 0.6, exclude: DataFrame | None = None) -> DataFrame:
    """More of those with a website than there are, each part by round robin; nothing runs before the result is read."""
    rows = _able(rows, exclude)
    web = F.coalesce(F.col("website"), F.lit("")) != ""
    first = round_robin(rows.where(web), round(count * website_fraction), seed)
    others = round_robin(rows.where(~web), count, seed).withColumn("_turn", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("place", "stratum")))  # `count` rows at most
    had = F.broadcast(first.agg(F.count(F.lit(1)).alias("_had")))  # one row
    return first.unionByName(others.join(had, F.lit(True)).where(F.col("_turn") <= F.lit(count) - F.col("_had")).drop("_turn", "_had"))


def split(rows: DataFrame, sizes: dict[str, int], order: list[str]) -> DataFrame:
    """Named parts of an ordered selection, one behind the other; only the rows that get a part are numbered."""
    ends = [*accumulate(sizes.values())]
    chosen = rows.orderBy(*order).limit(ends[-1] if ends else 0).withColumn("_place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)))
    label = F.when(F.lit(False), "")
    for name, end in zip(sizes, ends, strict=True):
        label = label.when(F.col("_place") <= end, name)
    return chosen.withColumn("split", label).where("split is not null").drop("_place")


def coverage(selected: DataFrame) -> DataFrame:
    """One row: companies, strata, and the share with a website."""
    web = F.coalesce(F.col("website"), F.lit("")) != ""
    return selected.agg(F.count(F.lit(1)).alias("selected"), F.count_distinct("stratum").alias("strata"), F.round(F.avg(web.cast("double")), 4).alias("website_share"))
