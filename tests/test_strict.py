"""Strict snapshot lines, two-phase writers, and the forms of all characters."""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from quarrystone import sinks
from quarrystone.functions import numbers as fn
from quarrystone.sinks import commits
from quarrystone.sources import captured, strict

RUN = dict.fromkeys(("run_id", "started_at", "completed_at", "terminal_status"), "x")
CLAIM = {"field": "f", "value": None, "availability": "available"}
EVIDENCE = dict.fromkeys(("id", "source_url", "source_class", "retrieved_at", "content_sha256"), "x")
GOOD = {"organisation_number": "1", "run": RUN, "claims": [CLAIM], "evidence": [EVIDENCE]}
CASES = [
    ({}, True),
    ({"claims": []}, True),
    ({"claims": [CLAIM, CLAIM | {"odd": 1}]}, False),  # an unknown key, two levels down
    ({"claims": "nonsense"}, False),
    ({"claims": None}, False),
    ({"claims": [CLAIM, None]}, False),
    ({"claims": [{"field": "f"}]}, False),
    ({"claims": [CLAIM | {"availability": "maybe"}]}, False),
    ({"claims": [CLAIM | {"confidence": "0.5"}]}, True),
    ({"claims": [CLAIM | {"confidence": "high"}]}, False),
    ({"claims": [CLAIM | {"value": {"any": [1, {"x": None}]}}]}, True),
    ({"claims": [CLAIM | {"note": None, "reporting_period": None}]}, True),
    ({"claims": [CLAIM | {"field": 7}]}, False),
    ({"claims": [CLAIM | {"evidence_ids": ["a", 1]}]}, False),
    ({"claims": [CLAIM | {"qualifiers": []}]}, False),
    ({"evidence": [EVIDENCE | {"http_status": 200, "tls_verified": True}]}, True),
    ({"evidence": [EVIDENCE | {"http_status": 200.5}]}, False),
    ({"evidence": [{k: v for k, v in EVIDENCE.items() if k != "id"}]}, False),
    ({"run": {**RUN, "more": 1}}, False),
    ({"run": None}, False),
    ({"operations": {"requests": 3, "runtime_ms": "4", "third_party_cost_usd": 0.5}}, True),
    ({"operations": {"requests": 1.5}}, False),
    ({"organisation_number": 1}, False),
    ({"odd": 1}, False),
    ({"errors": [{"stage": "x"}], "summary": {}, "legal_identity": {"a": 1}}, True),
    ({"errors": ["x"]}, False),
]


def test_lines_are_read_strictly(spark):
    lines = [(n, json.dumps(GOOD | more)) for n, (more, _) in enumerate(CASES)] + [(900, "{broken"), (901, "[]"), (902, "null"), (903, json.dumps({k: v for k, v in GOOD.items() if k != "run"}))]
    df = spark.createDataFrame(lines, "n int, line string")
    got = {r.n: r.ok for r in df.select("n", strict.fits(F.try_parse_json("line"), strict.ENVELOPE).alias("ok")).collect()}
    assert got == {n: ok for n, (_, ok) in enumerate(CASES)} | dict.fromkeys((900, 901, 902, 903), False)


def test_the_last_valid_line_counts(spark, tmp_path):
    (tmp_path / "a").write_text("\n".join([json.dumps(GOOD), json.dumps(GOOD | {"claims": []}), json.dumps(GOOD | {"claims": "x"})]))
    (tmp_path / "b").write_text(json.dumps(GOOD | {"organisation_number": "2"}) + "\n" + json.dumps(GOOD | {"odd": 1}))
    got = {r.org: json.loads(r.envelope)["claims"] for r in captured.envelopes(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()}
    assert got == {"1": [], "2": [CLAIM]}


def rows(spark, n, extra=""):
    return spark.range(n).select(F.format_string("%04d", "id").alias("org"), F.concat(F.lit("v" + extra), F.col("id").cast("string")).alias("v"))


def files(folder):
    return {f.name: f.read_bytes() for f in folder.rglob("*") if f.is_file()}


def test_snapshots_are_written_once(spark, tmp_path):
    folder, ran = tmp_path / "s", spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        ran.add(1)
        return x

    df = rows(spark, 500).repartition(7).select("org", counted("v").alias("v"))
    told = sinks.write_snapshot(df, str(folder), run_id="r1").first()
    assert ran.value in (500, 1000)  # a sort by range looks at its rows once before; nothing is written twice
    data = files(folder)
    parts = sorted(n for n in data if n.startswith("part-"))
    assert [(p.file, p.bytes, p.sha256) for p in told.payloads] == [(n, len(data[n]), hashlib.sha256(data[n]).hexdigest()) for n in parts]
    assert told.sha256 == hashlib.sha256("".join(p.sha256 for p in told.payloads).encode()).hexdigest() and told.rows == 500
    lines = b"".join(data[n] for n in parts).decode().splitlines()
    assert [json.loads(x)["org"] for x in lines] == [f"{n:04}" for n in range(500)]
    assert commits.read_manifest(str(folder))["run_id"] == "r1" and commits.snapshot_lines(spark, str(folder)).count() == 500
    again = sinks.write_snapshot(rows(spark, 500).repartition(3), str(folder), run_id="r1").first()
    assert again.sha256 == told.sha256 and files(folder) == data  # a rerun adds nothing
    sinks.write_snapshot(rows(spark, 20, "new"), str(folder))
    assert commits.snapshot_lines(spark, str(folder)).count() == 20 and not [n for n in files(folder) if n in parts]
    assert commits.committed_snapshot(rows(spark, 0).select(F.col("v").alias("line")), str(tmp_path / "none"))["rows"] == 0


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    @F.udf("string")
    def breaks(x):
        if x.endswith("37"):
            raise ValueError("no")
        return x

    folder = tmp_path / "s"
    sinks.write_snapshot(rows(spark, 50), str(folder))
    before = files(folder)
    with pytest.raises(Exception, match="no"):
        commits.committed_snapshot(rows(spark, 200, "x").repartition(5).select(breaks("v").alias("line")), str(folder))
    assert files(folder) == before
    with pytest.raises(Exception, match="no"):
        commits.committed_blobs(rows(spark, 200).repartition(5).select(breaks("v").alias("content")), str(tmp_path / "b"))
    assert files(tmp_path / "b") == {}


def test_blobs_are_there_once(spark, tmp_path):
    folder = tmp_path / "b"
    one = spark.createDataFrame([("x",), ("é",), ("x",), (None,)], "content string").repartition(3)
    commits.committed_blobs(one, str(folder))
    before = files(folder)
    assert set(before) == {hashlib.sha256(x).hexdigest() + ".bin" for x in (b"x", "é".encode(), b"")}
    commits.committed_blobs(one, str(folder))
    assert files(folder) == before
    assert sorted(r.content for r in captured.blobs(spark, str(folder)).collect()) == ["x", "é"]  # Spark reads no empty files


def test_forms_of_all_characters(spark):
    points = [c for c in map(chr, range(1, sys.maxunicode + 1)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    df = spark.createDataFrame([(c,) for c in points], "c string").repartition(4).select("c", fn.flat(F.col("c")).alias("flat"), fn.name_tokens(F.concat(F.lit("x"), "c", F.lit("y"))).alias("tokens"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.c: (r.flat, r.tokens) for r in df.collect()}
    assert all(got[c][0] == unicodedata.normalize("NFKC", c) for c in points)

    def tokens(c):
        plain = unicodedata.normalize("NFKD", f"x{c}y".translate(str.maketrans({"ø": "o", "Ø": "O", "å": "a", "Å": "A", "æ": "ae", "Æ": "AE"}))).encode("ascii", "ignore").decode().lower()
        return [t for t in "".join(k if k.isalnum() else " " for k in plain).split() if len(t) > 1 and t not in fn.LEGAL_WORDS]

    assert [c for c in points if got[c][1] != tokens(c)] == []
