"""Repeated fields, intervals over any number of runs, and claims as of a time, against plain versions."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest

from quarrystone.operators import reconcile

CLAIM = "org string, field string, pos int, value string, availability string, period string, currency string, statement string, evidence_id string, url string, retrieved_at string, sha string, first_seen string, last_seen string"
rng = random.Random(21)


def claim(org, field, pos, value, state="available", stamp="2024-01-01", first=None, last=None):
    return (org, field, pos, value if state == "available" else None, state, None, None, None, f"ev-{org}-{pos}", "https://x", stamp, "s", first, last)


def test_claims_are_compared_with_the_last_of_their_field(spark):
    before = spark.createDataFrame([claim("1", "f", 0, "a"), claim("1", "f", 1, "b"), claim("2", "f", 0, "x"), claim("2", "g", 5, "y"), claim("2", "g", 2, "z")], CLAIM)
    after = spark.createDataFrame([claim("1", "f", 0, "a"), claim("1", "f", 1, "b"), claim("1", "f", 2, "c"), claim("2", "f", 0, "x"), claim("2", "g", 0, "y")], CLAIM)
    got = sorted((r.org, r.field, r.old_value, r.new_value) for r in reconcile.changes(before, after).collect())
    assert got == [("1", "f", "b", "a"), ("1", "f", "b", "c")]
    assert reconcile.self_changes(after).first()[0] == 2  # three variants of a field: two differ from the last
    report = reconcile.refresh_report(before, after).first()
    assert (report.changes, report.self_changes, report.dropped, report.passed) == (2, 2, 0, False)
    assert reconcile.refresh_report(before, after.where("pos = 0")).first().self_changes == 0


def test_kept_claims_tell_when_they_were_confirmed(spark):
    before = spark.createDataFrame([claim("1", "f", 0, "a", first="2020", last="2023-05-05"), claim("1", "g", 0, "b")], CLAIM)
    after = spark.createDataFrame([claim("1", "f", 0, None, "failed", None), claim("1", "g", 0, None, "blocked", None)], CLAIM)
    got = sorted((r.field, r.value, r.stale, r.refresh_status, r.first_observed_at, r.last_observed_at, r.last_confirmed_at) for r in reconcile.claims(before, after).collect())
    assert got == [("f", "a", True, "failed", "2020", "2023-05-05", "2023-05-05"), ("g", "b", True, "blocked", None, "2024-01-01", "2024-01-01")]


RUN = "org string, field string, run long, value string, availability string, period string, currency string, statement string, retrieved_at string"


def folded(rows):
    """One run after the other, as the comparison of two runs goes."""
    out = []
    held = {}
    for org, field, run, value, state, period, currency, statement, stamp in sorted(rows, key=lambda r: r[2]):
        key, now = (org, field), (value, state, period, currency, statement)
        was = held.get(key)
        if was and state in ("failed", "blocked") and was["read"] == "available":
            was["missed"] += 1
            continue
        read = state if state not in ("failed", "blocked") else was["read"] if was else None
        if was and was["now"] == now:
            was.update(last=stamp, runs=was["runs"] + 1, read=read)
            continue
        held[key] = {"now": now, "first": stamp, "last": stamp, "runs": 1, "missed": 0, "since": run, "read": read}
        out.append((key, held[key]))
    return Counter((*k, *h["now"], h["first"], h["last"], h["runs"], h["missed"], h["since"]) for k, h in out)


@pytest.mark.parametrize("stretch", [1, 3, 64])
def test_intervals_are_what_a_fold_over_runs_gives(spark, stretch):
    rows = []
    for org in range(12):
        for run in range(rng.choice([1, 5, 40])):
            if rng.random() < 0.8:  # a run can lack the field
                state = rng.choice(["available"] * 4 + ["failed", "blocked", "not_available"])
                rows.append((str(org), "f", run, rng.choice(["a", "b", None]) if state == "available" else None, state, rng.choice([None, None, "p"]), None, None, f"d{run:03}"))
    rows += [("hot", "f", run, "ab"[run // 50 % 2], "available", None, None, None, f"d{run:03}") for run in range(400)]
    got = reconcile.intervals(spark.createDataFrame(rows, RUN).repartition(5), stretch)
    assert Counter(map(tuple, got.collect())) == folded(rows)


def test_two_runs_give_what_their_comparison_gives(spark):
    before = [("1", "f", 0, "a", "available", None, None, None, "2023"), ("2", "f", 0, "a", "available", None, None, None, "2023"), ("3", "f", 0, None, "not_available", None, None, None, "2023")]
    after = [("1", "f", 1, "a", "available", None, None, None, "2024"), ("2", "f", 1, None, "failed", None, None, None, None), ("3", "f", 1, "z", "available", None, None, None, "2024")]
    full = lambda rows: spark.createDataFrame([claim(r[0], r[1], 0, r[3], r[4], r[8], r[8] if r[2] == 0 else None) for r in rows], CLAIM).drop("pos", "last_seen")
    want = sorted((r.org, r.value, r.first_observed_at, r.last_observed_at) for r in reconcile.claims(full(before), full(after)).collect())
    spans = reconcile.intervals(spark.createDataFrame(before + after, RUN)).collect()
    last = {r.org: r for r in sorted(spans, key=lambda r: r.since)}
    assert sorted((o, r.value, r.first_observed_at, r.last_observed_at) for o, r in last.items()) == want
    assert reconcile.intervals(spark.createDataFrame([], RUN)).collect() == []


@pytest.mark.parametrize("stretch", [1, 10, 10_000])
def test_as_of(spark, stretch):
    day = lambda n: date(2020, 1, 1) + timedelta(n)
    claims = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([day(rng.randrange(300)), None]), n) for n in range(150)]
    probes = [(n, rng.choice(["hot", "a", "b", "none", None]), rng.choice([day(rng.randrange(-20, 320))] * 4 + [None]), "x") for n in range(200)] + [(0, "hot", day(50), "x")] * 2
    got = reconcile.as_of(spark.createDataFrame(probes, "probe_id int, org string, at date, claim_id string"), spark.createDataFrame(claims, "org string, at date, number int"), stretch=stretch).collect()

    def last(org, at):
        held = [(a, n) for o, a, n in claims if o == org and a is not None and at is not None and a <= at]
        return max(held, default=None)

    assert Counter((r.probe_id, r.org, r.at, tuple(r.claim) if r.claim else None) for r in got) == Counter((n, o, a, last(o, a)) for n, o, a, _ in probes)
