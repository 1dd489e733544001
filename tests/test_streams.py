"""Keyed reconciliation, the changelog source and the fetcher, each against its batch form."""

from __future__ import annotations

import json
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrystone import streaming
from quarrystone.operators import brief, reconcile
from quarrystone.sources import captured, changelog, fetching, transport

CLAIM = "org string, field string, value string, availability string, period string, currency string, statement string, evidence_id string, url string, retrieved_at string, sha string, first_seen string, at timestamp"


def claim(org, value, day, field="legal_name", state="available"):
    at = datetime(2024, 1, day, tzinfo=UTC)
    return (org, field, value, state, None, None, None, "e", "u", f"2024-01-{day:02}", "h", None, at)


def run_stream(spark, folder, runs, checkpoint, seen, late, delay="1 day"):
    for n, rows in enumerate(runs):
        spark.createDataFrame(rows, CLAIM).coalesce(1).write.mode("append").parquet(f"{folder}")
        claims = spark.readStream.schema(CLAIM).option("maxFilesPerTrigger", 1).parquet(folder)
        query = streaming.refresh(claims, lambda df: seen.extend(df.collect()), lambda df: late.extend(df.collect()), checkpoint, delay)
        query.awaitTermination()


def test_keyed_refresh(spark, tmp_path):
    """Runs one after the other, each by a query started again from its checkpoint; a late run lands beside."""
    first = [claim("1", "A", 1), claim("2", "B", 1), claim("3", "C", 1)]
    second = [claim("1", "A2", 5), claim("2", None, 5, state="failed"), claim("3", "C", 5)]
    third = [claim("1", "OLD", 2), claim("2", "B3", 9), claim("3", "C4", 9)]  # the first row comes long after its time
    flush = [claim("zz", "x", 28)]
    seen, late = [], []
    run_stream(spark, str(tmp_path / "in"), [first, second, third, flush], str(tmp_path / "check"), seen, late)
    frame = lambda rows: spark.createDataFrame(rows, CLAIM).drop("at")
    before, middle = frame(first), frame(second)
    kept = reconcile.claims(before, middle, "currency", "statement", "url", "sha").select("org", "field", "value", "availability", "period", "currency", "statement", "evidence_id", "url", F.col("last_observed_at").alias("retrieved_at"), "sha", F.col("first_observed_at").alias("first_seen"))
    want = Counter(tuple(r) for df in (reconcile.changes(before, middle), reconcile.changes(kept, frame(third[1:]))) for r in df.select("org", "change_type", "old_value", "new_value", "old_retrieved_at").collect())
    assert Counter((r.org, r.change_type, r.old_value, r.new_value, r.old_retrieved_at) for r in seen) == want and sum(want.values()) == 4
    assert [(r.org, r.value, r.retrieved_at) for r in late] == [("1", "OLD", "2024-01-02")]


def test_runs_out_of_order_within_the_delay(spark, tmp_path):
    runs = [[claim("1", "A", 1)], [claim("1", "C", 8)], [claim("1", "B", 5)], [claim("zz", "x", 28)], [claim("zz", "x", 30)]]
    seen, late = [], []
    run_stream(spark, str(tmp_path / "in"), runs, str(tmp_path / "check"), seen, late, "10 days")
    assert [(r.old_value, r.new_value) for r in seen if r.org == "1"] == [("A", "B"), ("B", "C")] and late == []


def feed_pages(folder, count, broken=None):
    """Captured pages 0.., each naming the next."""
    folder.mkdir(exist_ok=True)
    for n in range(count):
        url = "https://feed.example/feed" if n == 0 else f"https://feed.example/feed/{n}"
        items = [{"url": f"/ad/{n}-{k}", "_feed_entry": {"uuid": f"{n}-{k}", "status": "ACTIVE" if k else "INACTIVE", "businessName": f"Firm {k}", "sistEndret": f"2024-01-{n + 1:02}"}} for k in range(3)]
        body = "not json" if n == broken else json.dumps({"items": items, "next_url": f"/feed/{n + 1}" if n + 1 < count else None})
        (folder / transport.Captured.name(url)).write_text(json.dumps([{"status": 200, "body": body}]))
    return transport.Captured(f"file://{folder}")


def entries(rows):
    return sorted((r.page_no, r.pos, r.uuid) for r in rows if r.pos is not None)


def test_changelog_is_read_whole(spark, tmp_path):
    changelog.register(spark, feed_pages(tmp_path / "pages", 5))
    got = spark.read.format("changelog").option("start", "https://feed.example/feed").load().collect()
    assert len(entries(got)) == 15 and [r.ok for r in got] == [True] * 20
    pages = spark.createDataFrame([(r.page_no, r.ok, r.next_url) for r in got if r.pos is None], "page_no int, ok boolean, next_url string")
    assert sorted(r.page_no for r in captured.walked(pages, 50).collect()) == [0, 1, 2, 3, 4]
    few = spark.read.format("changelog").option("start", "https://feed.example/feed").option("most", 2).load()
    assert {r.page_no for r in few.collect()} == {r.page_no for r in captured.walked(pages, 2).collect()} == {0, 1}


def test_changelog_stops_where_a_page_fails(spark, tmp_path):
    changelog.register(spark, feed_pages(tmp_path / "pages", 5, broken=2))
    got = spark.read.format("changelog").option("start", "https://feed.example/feed").load().collect()
    assert {(r.page_no, r.ok, r.error) for r in got} == {(0, True, None), (1, True, None), (2, False, "feed page was not JSON")}
    gone = spark.read.format("changelog").option("start", "https://feed.example/none").load().collect()
    assert [(r.ok, r.error) for r in gone] == [(False, "feed page failed: HTTP 404")]


def test_horizon_is_asked_for_on_the_first_page_only():
    asked = []

    def spy(method, url, headers, payload, verify):
        asked.append((url, headers.get("If-Modified-Since"), headers.get("Authorization")))
        return transport.Answer(200, json.dumps({"items": [], "next_url": "/n" if len(asked) < 3 else None}).encode())

    url, n = "https://f.example/", 0
    while url:
        _, url = changelog.read_page(spy, n, url, "t", "Mon")
        n += 1
    assert asked == [("https://f.example/", "Mon", "Bearer t"), ("https://f.example/n", None, "Bearer t"), ("https://f.example/n", None, "Bearer t")]


def test_changelog_streams_on_from_its_offset(spark, tmp_path):
    """Stopped by a bound in the middle, started again from its checkpoint: every page once, as a whole read gives."""
    changelog.register(spark, feed_pages(tmp_path / "pages", 7))
    seen: list = []

    def go(most):
        stream = spark.readStream.format("changelog").option("start", "https://feed.example/feed").option("pages", 2).option("most", most).load()
        q = stream.writeStream.foreachBatch(lambda df, _: seen.extend(df.collect())).option("checkpointLocation", str(tmp_path / "check")).start()
        q.processAllAvailable()
        q.stop()

    go(3)
    assert {r.page_no for r in seen} == {0, 1, 2}
    go(50)
    whole = spark.read.format("changelog").option("start", "https://feed.example/feed").load().collect()
    assert entries(seen) == entries(whole) and len(seen) == len(whole)


ATTEMPTS = [("a", 0, "GET", 503, 0), ("a", 1, "GET", 200, 2), ("b", 0, "GET", 403, 0), ("c", 0, "GET", 429, 0), ("c", 1, "GET", None, 0), ("c", 2, "GET", 500, 0), ("d", 0, "POST", 429, 0), ("e", 0, "GET", None, 0), ("f", 0, "GET", 503, 1), ("f", 1, "GET", None, 0), ("f", 2, "GET", None, 0)]


def test_fetching_gives_what_the_attempts_tell(spark, tmp_path):
    folder = tmp_path / "answers"
    folder.mkdir()
    by_url: dict = {}
    for url, _, method, status, redirects in ATTEMPTS:
        by_url.setdefault((url, method), []).append({"error": "no route"} if status is None else {"status": status, "body": "x", "redirects": redirects})
    for (url, _), answers in by_url.items():
        (folder / transport.Captured.name(f"https://{url}.example/")).write_text(json.dumps(answers))
    asked = spark.createDataFrame([(n, f"https://{u}.example/", m) for n, (u, m) in enumerate(sorted(by_url))], "n int, url string, method string")
    got = fetching.fetch(asked, transport.Captured(f"file://{folder}"), 1000, ["n"], pause=fetching.no_pause).collect()
    state = lambda r: "ok" if r.ok else "blocked" if r.blocked else "failed"
    mine = sorted((r.url[8:9], r.status, state(r), r.requests) for r in got)
    told = brief.fetch_outcomes(spark.createDataFrame([(*t, None) for t in [*ATTEMPTS, ("e", 1, "GET", None, 0), ("e", 2, "GET", None, 0)]], "url string, attempt int, method string, status int, redirects int, error string"))
    assert mine == sorted((r.url, r.status, r.state, r.requests) for r in told.collect())
    a = next(r for r in got if r.url == "https://a.example/")
    assert (a.body, a.sha is not None, a.tls_verified) == ("x", True, True)
    e = next(r for r in got if r.url == "https://e.example/")
    assert (e.error, e.status) == ("no route", None)


def test_certificates_are_passed_over_once(tmp_path):
    name = tmp_path / transport.Captured.name("https://x.example/")
    name.write_text(json.dumps([{"error": "SSL: CERTIFICATE_VERIFY_FAILED"}, {"status": 200, "body": "y", "verified": False}]))
    got = fetching.ask(transport.Captured(f"file://{tmp_path}"), "GET", "https://x.example/", pause=fetching.no_pause)
    assert (got["ok"], got["tls_verified"], got["requests"], got["body"]) == (True, False, 2, "y")
    name.write_text(json.dumps([{"error": "SSL: CERTIFICATE_VERIFY_FAILED"}, {"status": 500, "verified": False}]))
    got = fetching.ask(transport.Captured(f"file://{tmp_path}"), "GET", "https://x.example/", pause=fetching.no_pause)
    assert (got["ok"], got["tls_verified"], got["requests"]) == (False, True, 6)


def test_the_budget_is_granted_in_order(spark, tmp_path):
    asked = spark.createDataFrame([(n, f"https://h{n % 2}.example/{n}", "POST" if n == 0 else "GET") for n in range(6)], "n int, url string, method string")
    got = fetching.fetch(asked, transport.Captured(f"file://{tmp_path}"), 8, ["n"], pause=fetching.no_pause).collect()
    assert sorted((r.n, r.requests, r.error) for r in got) == [(0, 1, "HTTP 404"), (1, 1, "HTTP 404"), (2, 1, "HTTP 404"), *((n, 0, "request budget 8 exhausted") for n in (3, 4, 5))]


def test_pauses_grow():
    waits = []

    def never(*_):
        raise transport.TransportError("x")

    fetching.ask(never, "GET", "https://x.example/", pause=waits.append)
    assert waits == [0.5, 1.0]


@pytest.mark.parametrize("days", [2, 40])
def test_waiting_claims_come_out_once_their_time_has_passed(spark, tmp_path, days):
    stamp = datetime(2024, 1, 1, tzinfo=UTC) + timedelta(days=days)
    rows = [claim("1", "A", 1), (*claim("2", "B", 1)[:-1], stamp)]
    spark.createDataFrame(rows, CLAIM).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = streaming.reconciled(spark.readStream.schema(CLAIM).parquet(str(tmp_path / "in")), "10 days").writeStream.format("memory").queryName(f"paired{days}").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    out.awaitTermination()
    assert [(r.org, r.p, r.c.value) for r in spark.table(f"paired{days}").collect()] == ([("1", None, "A")] if days == 40 else [])
