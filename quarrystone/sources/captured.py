"""Sources: organisation lists, universes, snapshots, pools, labels, captured responses and blobs.

Order comes from a position column, never from the order of files. Malformed
lines are skipped or fatal as each format demands.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numbers as fn
from . import strict

UNIVERSE = "organisation_number STRING, legal_form STRING, employees STRING, industry_code STRING, website STRING"
CLAIM = "field STRING, value VARIANT, availability STRING, confidence DOUBLE, reporting_period STRING, evidence_ids ARRAY<STRING>, qualifiers MAP<STRING, STRING>, note STRING"
EVIDENCE = "id STRING, source_url STRING, source_class STRING, retrieved_at STRING, content_sha256 STRING, final_url STRING, claim_span STRING, extraction_method STRING, http_status INT, tls_verified BOOLEAN"
OBSERVATION = "id STRING, organisation_number STRING, platform STRING, signal_type STRING, source_url STRING, retrieved_at STRING, content_sha256 STRING, exact_entity BOOLEAN, identity_proof STRING, acquisition_mode STRING, rights_status STRING, source_class STRING, evidence_span STRING, observed_at STRING, sentiment_label STRING, sentiment_model_version STRING, metrics STRING"
LABEL = "id STRING, exact_entity BOOLEAN, metric_correct BOOLEAN, sentiment_correct BOOLEAN, labelled_by STRING, labelled_at STRING, reviewer STRING, basis STRING, risk_tier STRING, derived_from STRING"


def lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(file_no, pos, line) of text files, gzip or plain; pos orders the lines of a file.

    Files are read line by line and cut into as many tasks as Spark likes. A line's
    pos is made of the start of its stretch of the file and its number there.
    """
    start = F.col("_metadata.file_block_start").cast("decimal(38,0)") * F.lit(1 << 34)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the task, whose stretches of a file follow each other
    every = None
    for n, path in enumerate(paths):
        one = spark.read.text(path).select(F.lit(n).alias("file_no"), (start + within).cast("decimal(38,0)").alias("pos"), F.col("value").alias("line"))
        every = one if every is None else every.unionByName(one)
    return every.where(F.trim("line") != "")


def _field(line: str, *names: str):  # noqa: ANN202
    return F.coalesce(*(F.get_json_object(line, f"$.{x}") for x in names))


def organisations(spark: SparkSession, path: str) -> DataFrame:
    """(org, pos): nine-digit numbers of a list, of JSON lines or bare numbers, the first of each."""
    raw = F.when(F.trim("line").startswith("{"), _field("line", "organisation_number", "organisasjonsnummer")).otherwise(F.col("line"))
    rows = lines(spark, path).select(fn.digits(raw).alias("org"), "pos").where(F.length("org") == 9)
    return rows.groupBy("org").agg(F.min("pos").alias("pos"))


def company_names(spark: SparkSession, path: str) -> DataFrame:
    """(org, name): the last name of each organisation in a list."""
    rows = lines(spark, path).select(fn.digits(_field("line", "organisation_number", "organisasjonsnummer")).alias("org"), _field("line", "name", "navn").alias("name"), "pos")
    return rows.where("org != '' and name is not null").groupBy("org").agg(F.max_by("name", "pos").alias("name"))


def universe(spark: SparkSession, path: str) -> DataFrame:
    """The universe, gzip or plain; a malformed line is fatal."""
    df = spark.read.schema(UNIVERSE).option("mode", "FAILFAST").json(path)
    return df.select(F.col("organisation_number").alias("org"), "legal_form", "employees", "industry_code", "website")


def envelopes(spark: SparkSession, *paths: str) -> DataFrame:
    """(org, file_no, pos, envelope): the last valid line of each organisation.

    A line that isn't an object of the known shape, in all its parts, is skipped:
    unknown keys, missing ones and values of another kind at any depth.
    """
    rows = lines(spark, *paths).withColumn("parsed", F.try_parse_json("line")).where(strict.fits(F.col("parsed"), strict.ENVELOPE))
    good = rows.select(F.try_variant_get("parsed", "$.organisation_number", "string").alias("org"), "file_no", "pos", "line")
    return good.groupBy("org").agg(F.max_by(F.struct("file_no", "pos", "line"), F.struct("file_no", "pos")).alias("m")).select("org", "m.file_no", "m.pos", F.col("m.line").alias("envelope"))


def claims_of(held: DataFrame) -> DataFrame:
    """Claims of envelopes in normal form, with the first resolvable evidence of each; nothing is shuffled, all stays within a row."""
    e = held.select("org", F.from_json("envelope", f"claims ARRAY<STRUCT<field: STRING, value: STRING, availability: STRING, reporting_period: STRING, evidence_ids: ARRAY<STRING>, qualifiers: MAP<STRING, STRING>, note: STRING>>, evidence ARRAY<STRUCT<{EVIDENCE.replace(' STRING', ': STRING').replace(' INT', ': INT').replace(' BOOLEAN', ': BOOLEAN')}>>").alias("e"))
    by_id = F.map_from_entries(F.transform(F.filter("e.evidence", lambda x: x["id"].isNotNull()), lambda x: F.struct(x["id"], x)))
    rows = e.select("org", by_id.alias("by_id"), F.explode("e.claims").alias("c"))
    first = F.get(F.filter("c.evidence_ids", lambda i: F.array_contains(F.map_keys("by_id"), i)), F.lit(0))
    rows = rows.withColumn("ev", F.try_element_at("by_id", first))
    return rows.select("org", "c.field", canonical(F.col("c.value")).alias("value"), "c.availability", F.col("c.reporting_period").alias("period"), F.col("c.qualifiers")["currency"].alias("currency"), F.col("c.qualifiers")["statement_type"].alias("statement"), F.col("ev.id").alias("evidence_id"), F.col("ev.source_url").alias("url"), F.col("ev.retrieved_at").alias("retrieved_at"), F.col("ev.content_sha256").alias("sha"), F.col("c.qualifiers")["first_observed_at"].alias("first_seen"), "c.note")


def canonical(value: Column) -> Column:
    """A text of a JSON value that neither key order, number format nor the order of any list in it changes; other text stays.

    Spark's own parser orders keys and forms numbers; lists are sorted from the
    innermost outwards, which built-in functions cannot do at any depth, so values
    that hold a list go through one vectorised function, in Arrow batches.
    """
    import json

    @F.pandas_udf("string")
    def settled(values: pd.Series) -> pd.Series:
        def sort(x):  # noqa: ANN001, ANN202
            if isinstance(x, dict):
                return {k: sort(x[k]) for k in sorted(x)}
            if isinstance(x, list):
                return sorted(map(sort, x), key=lambda v: json.dumps(v, ensure_ascii=False))
            return int(x) if isinstance(x, float) and x.is_integer() else x

        def one(text):  # noqa: ANN001, ANN202
            try:
                return json.dumps(sort(json.loads(text)), ensure_ascii=False, separators=(",", ":"))
            except (TypeError, ValueError, RecursionError):
                return text

        return values.map(one)

    plain = F.coalesce(F.to_json(F.try_parse_json(value)), value)
    listed = F.contains(plain, F.lit("["))
    return F.when(listed, settled(F.when(listed, plain))).otherwise(plain)


def observations_of(held: DataFrame) -> DataFrame:
    """Observations of envelopes with their places."""
    of = OBSERVATION.replace(" STRING", ": STRING").replace(" BOOLEAN", ": BOOLEAN")
    rows = held.select("file_no", "pos", F.posexplode(F.from_json("envelope", f"observations ARRAY<STRUCT<{of}>>")["observations"]).alias("i", "o"))
    return rows.select("o.*", "file_no", (F.col("pos") * 1_000_000 + F.col("i")).cast("decimal(38,0)").alias("pos"))


def labels(spark: SparkSession, path: str) -> DataFrame:
    """The last label of each id; a malformed line is fatal."""
    rows = lines(spark, path).select("pos", F.from_json("line", LABEL, {"mode": "FAILFAST"}).alias("l"))
    return rows.groupBy("l.id").agg(F.max_by("l", "pos").alias("l")).select("l.*")


DECISION = "id STRING, org STRING, verdict STRING, basis STRING"


def queue(spark: SparkSession, path: str) -> DataFrame:
    """Queued observations in their order; a malformed line is fatal."""
    rows = lines(spark, path).select("pos", F.from_json("line", OBSERVATION, {"mode": "FAILFAST"}).alias("o"))
    return rows.select("o.*", "pos")


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """(decision_no, id, org, verdict, basis): recorded verdicts in their order; a malformed line is fatal."""
    rows = lines(spark, path).select("pos", F.from_json("line", DECISION, {"mode": "FAILFAST"}).alias("d"))
    return rows.select(F.col("pos").alias("decision_no"), "d.*")


def briefs(spark: SparkSession, path: str) -> DataFrame:
    """(id, brief): the last brief of each observation, as JSON text."""
    rows = lines(spark, path).select("pos", "line", F.get_json_object("line", "$.id").alias("id"))
    return rows.where("id is not null").groupBy("id").agg(F.max_by("line", "pos").alias("brief"))


def settings(spark: SparkSession, path: str) -> dict[str, str]:
    """KEY=value lines of a small file, the first of each key; comments, and lines without a key or a value, are left out."""
    text = F.trim("line")
    pair = F.split(text, "=", 2)
    plain = F.trim(F.trim(F.trim(pair[1]), F.lit('"')), F.lit("'"))
    rows = lines(spark, path).where(~text.startswith("#") & F.contains(text, F.lit("="))).select("pos", F.trim(pair[0]).alias("key"), plain.alias("value")).where("key != '' and value != ''")
    return {r.key: r.value for r in rows.groupBy("key").agg(F.min_by("value", "pos").alias("value")).collect()}


def responses(spark: SparkSession, path: str) -> DataFrame:
    """Captured responses: (org, kind, url, ok, blocked, status, body, retrieved_at, sha)."""
    return spark.read.parquet(path)


def fetch_state(status, error=None):  # noqa: ANN001, ANN201
    """ok, blocked or failed from a status; 401, 403 and 451 are refusals."""
    return F.when(status.between(200, 299), "ok").when(status.isin(401, 403, 451), "blocked").otherwise("failed")


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """(sha, content) of a folder of stored payloads; a file whose name isn't its digest is left out."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path)
    rows = rows.select(F.regexp_extract("path", r"([0-9a-f]{64})\.bin$", 1).alias("sha"), "content")
    return rows.where(F.col("sha") == F.sha2("content", 256)).select("sha", F.decode("content", "UTF-8").alias("content"))


def feed_token(text):  # noqa: ANN001, ANN201
    """A token of three parts in a text."""
    return F.nullif(F.regexp_extract(text, r"(eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 1), F.lit(""))


def walked(pages: DataFrame, most: int) -> DataFrame:
    """Feed pages up to the first that failed, has no next, or is the last allowed; pages: (page_no, ok, next_url, ...)."""
    stop = pages.where(~F.col("ok") | F.col("next_url").isNull()).agg(F.min("page_no").alias("stop"))
    return pages.join(F.broadcast(stop), F.lit(True)).where((F.col("page_no") < most) & (F.col("stop").isNull() | (F.col("page_no") <= F.col("stop")))).drop("stop")


def first_with_posts(candidates: DataFrame) -> DataFrame:
    """The first candidate page of each organisation that yields posts; candidates: (org, rank, n_posts, ...)."""
    own = Window.partitionBy("org").orderBy("rank")
    return candidates.where("n_posts > 0").withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n")
