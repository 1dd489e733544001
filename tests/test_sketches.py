"""Sketches that are merged, against exact percentiles and counts; verdicts of the place search."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quarrystone.operators import report

rng = random.Random(4)


def test_merged_sketches_keep_their_bound(spark):
    """Runs of very unlike sizes and ranges: the rank of each merged percentile is off by no more than the sketch says."""
    rows = [(run, "s", int(rng.lognormvariate(6 + run / 4, 1)), f"o{rng.randrange(3000)}") for run in range(12) for _ in range(rng.choice([3, 400, 3000]))]
    rows += [(0, "t", 7, "o1")]
    df = spark.createDataFrame(rows, "run int, stage string, ms long, org string").repartition(5)
    daily = report.sketched(df, ["stage", "run"], "ms", "org")
    got = {r.stage: r for r in report.merged(daily, ["stage"], (0.05, 0.5, 0.95)).collect()}
    values = sorted(ms for _, s, ms, _ in rows if s == "s")
    exact = {r.stage: r for r in report.percentiles(df, ["stage"], "ms").collect()}
    for share in (0.05, 0.5, 0.95):
        told = got["s"][f"p{round(share * 100)}"]
        low, high = (sum(v < told for v in values) / len(values), sum(v <= told for v in values) / len(values))
        assert low - 0.0133 <= share <= high + 0.0133
    assert abs(sum(v < exact["s"].p50 for v in values) / len(values) - 0.5) < 0.0133
    assert got["s"].n == len(values) and got["s"].distinct == len({o for _, s, _, o in rows if s == "s"})  # few keys are counted as they are
    assert (got["t"].p50, got["t"].n, got["t"].distinct) == (7, 1, 1)


def test_many_keys_are_estimated(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("run"), F.lit("s").alias("stage"), F.col("id").alias("ms"), (F.col("id") % 40_000).cast("string").alias("org"))
    got = report.merged(report.sketched(df, ["stage", "run"], "ms", "org"), ["stage"]).first()
    assert abs(got.distinct - 40_000) < 0.06 * 40_000 and got.n == 60_000


def test_place_verdicts(spark):
    claims = spark.createDataFrame([("1", "places.rating", "4.5", "available", None, "p"), ("1", "places.rating_count", "9", "available", None, None), ("2", "places.rating", None, "failed", "Places search failed: HTTP 500", None)], "org string, field string, value string, availability string, note string, identity_proof string")
    verdicts, told = report.places_check(claims, spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C")], "org string, name string"), 3, 0.035)
    assert sorted(tuple(r) for r in verdicts.collect()) == [("1", "A", "available", "4.5", "p", None), ("2", "B", "failed", None, None, "Places search failed: HTTP 500"), ("3", "C", None, None, None, None)]
    row = told.first()
    assert (row.searches, row.published, row.spent_usd, row.projected_per_100_companies_usd) == (3, 1, 0.105, 3.5)
