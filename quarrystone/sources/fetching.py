"""Fetching: a table of requests becomes a table of responses.

Requests are dealt out by host, so a host is asked by one task, one request after
the other. A budget is granted before anything is asked, in the order of the
requests, by what each can cost at most; redirects are known only afterwards and
are counted on top. Nothing here is an exception: what fails is a row that says so.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as fn
from ..operators import report
from ..storage import ship
from .transport import Answer, TransportError

#: Statuses that pass, and refusals of a GET and of a POST.
TRANSIENT = (429, 500, 502, 503, 504)
REFUSED = {"GET": (401, 403, 451), "POST": (401, 403, 429, 451)}
MOST_BYTES = 2_000_000
RETRIES = 2
PAUSE = 0.5  # seconds before the first retry; the next waits that much longer

RESPONSE = "final_url string, ok boolean, blocked boolean, status int, error string, body string, retrieved_at string, sha string, requests int, tls_verified boolean"


def no_pause(seconds: float) -> None:
    """For transports that need no rest."""


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds").replace("+00:00", "Z")


def ask(transport: Callable[..., Answer], method: str, url: str, headers: dict | None = None, payload: object = None, retries: int = RETRIES, pause: Callable[[float], None] = time.sleep) -> dict:
    """One request with its retries, as a row of RESPONSE. A POST is asked once; an unverifiable certificate is passed over once, and the row tells."""
    spent, status, error = 0, None, None

    def told(answer: Answer, verified: bool = True) -> dict:
        ok = answer.status < 400
        body = answer.body[:MOST_BYTES]
        shown = body.decode("utf-8", errors="replace") if ok or method == "POST" else None
        return {"final_url": answer.final_url or url, "ok": ok, "blocked": not ok and answer.status in REFUSED[method], "status": answer.status, "error": None if ok else f"HTTP {answer.status}", "body": shown, "retrieved_at": _now(), "sha": hashlib.sha256(body).hexdigest() if ok else None, "requests": spent, "tls_verified": verified}

    for attempt in range(1 if method == "POST" else retries + 1):
        spent += 1
        try:
            answer = transport(method, url, headers or {}, payload, True)
            spent += answer.redirects
            if method == "POST" or answer.status not in TRANSIENT:
                return told(answer)
            status, error = answer.status, f"HTTP {answer.status}"
        except TransportError as e:
            error = str(e)
            if method == "GET" and "CERTIFICATE_VERIFY_FAILED" in error:
                try:
                    spent += 1
                    answer = transport(method, url, headers or {}, payload, False)
                    spent += answer.redirects
                    if answer.status < 400:
                        return told(answer, False)
                except TransportError:
                    pass
        if method == "GET" and attempt < retries:
            pause(PAUSE * (attempt + 1))
    return {"final_url": None, "ok": False, "blocked": False, "status": status, "error": error or "unknown fetch failure", "body": None, "retrieved_at": _now(), "sha": None, "requests": spent, "tls_verified": True}


def fetch(requests: DataFrame, transport: Callable[..., Answer], budget: int, order: list[str], retries: int = RETRIES, pause: Callable[[float], None] = time.sleep, headers: dict | None = None, block: Column | None = None) -> DataFrame:
    """requests with the columns of RESPONSE; requests: (url, method, ..., perhaps payload as JSON text).

    order: columns that order the requests, and tell them apart, for the budget. A
    request that the budget has no room for is not asked; its row says so. block: a
    value that grows with the order, by which very many requests are summed up.
    """
    import json

    spark = requests.sparkSession
    ship(spark)
    cost = F.when(F.col("method") == "POST", 1).otherwise(1 + retries)
    granted = report.admitted(requests.select(*order, "method", (F.lit(0) if block is None else block).alias("_block")), "_block", order, cost, budget).select(*order, F.lit(True).alias("_granted"))
    known = requests.join(granted, order, "left").withColumn("_granted", F.coalesce("_granted", F.lit(False)))
    if "payload" not in requests.columns:
        known = known.withColumn("payload", F.lit(None).cast("string"))
    known = known.withColumn("_host", fn.host(F.col("url")))
    dealt = known.repartition("_host").sortWithinPartitions("_host", *order)
    names = [c for c in dealt.columns if c not in ("_granted", "_host", "payload")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema if f.name in names), RESPONSE])
    extra = {"final_url": pa.string(), "ok": pa.bool_(), "blocked": pa.bool_(), "status": pa.int32(), "error": pa.string(), "body": pa.string(), "retrieved_at": pa.string(), "sha": pa.string(), "requests": pa.int32(), "tls_verified": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 32):  # a bounded number of bodies at once
                part = b.slice(k, 32)
                told = []
                for r in part.select(["url", "method", "payload", "_granted"]).to_pylist():
                    if r["_granted"]:
                        told.append(ask(transport, r["method"], r["url"], headers, json.loads(r["payload"]) if r["payload"] else None, retries, pause))
                    else:
                        told.append({"final_url": None, "ok": False, "blocked": False, "status": None, "error": f"request budget {budget} exhausted", "body": None, "retrieved_at": _now(), "sha": None, "requests": 0, "tls_verified": True})
                yield pa.record_batch([*(part.column(n) for n in names), *(pa.array([t[n] for t in told], kind) for n, kind in extra.items())], [*names, *extra])

    return dealt.mapInArrow(run, schema)
