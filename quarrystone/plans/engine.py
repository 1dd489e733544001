"""The engine's commands over tables: run, refresh, select, summarise, viewer, and the audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, brief, reconcile, report, sampling, synthesis
from ..sinks import review_sheet, write_viewer
from ..storage import materialize
from . import collect


@dataclass
class Run:
    """Tables of one run in normal form, and the nested envelopes as a view of them."""

    claims: DataFrame
    changes: DataFrame
    evidence: DataFrame
    envelopes: DataFrame
    report: DataFrame  # envelopes by terminal status

    def totals(self, run_id: str, requested: int, budget: int | None = None) -> DataFrame:
        return report.run_totals(self.envelopes, run_id, requested, budget)


#: Columns of claims that go with their value.
CARRIED = {"confidence": "double", "currency": "string", "statement": "string", "identity_proof": "string", "url": "string", "sha": "string", "note": "string"}
NO_RESULT = "no result produced for this organisation number"


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with the columns that it lacks, null."""
    return df.select("*", *(F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns))


def _gathered(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    return rows.groupBy("org").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))


def run(
    organisations: DataFrame, claims: DataFrame, previous: DataFrame | None, observations: DataFrame, evidence: DataFrame | None = None,
    errors: DataFrame | None = None, anchors: DataFrame | None = None, operations: DataFrame | None = None, run_id: str = "run-1",
) -> Run:
    """Reconcile, assemble one envelope for each input organisation, and report.

    organisations: (org, pos), claims and previous: as in reconcile, with note;
    observations: (org, platform) or as operators.observe builds them; evidence:
    (org, evidence_id, url, sha, ...); errors: (org, stage, message); anchors: (org)
    with a registry record, all if None; operations: (org, requests, runtime_ms,
    third_party_cost_usd). The claims of this run alone decide an organisation's
    state: one without any gets a failed envelope with a claim that says so, and
    what the previous run knew of it isn't passed off as this run's.
    """
    claims = _with(claims, CARRIED)
    previous = claims.limit(0) if previous is None else _with(previous, CARRIED)
    seen = observations if "org" in observations.columns else observations.withColumnRenamed("organisation_number", "org")
    evidence = (claims if evidence is None else evidence).where("evidence_id is not null").select("org", "evidence_id", "url", "sha").distinct()
    changes = materialize(reconcile.changes(previous, claims), "changes")
    kept = reconcile.claims(previous, claims, *CARRIED)
    present = claims.select("org").distinct()
    silent = organisations.select("org").join(present, "org", "left_anti")
    given = {"field": F.lit("legal_name"), "availability": F.lit("failed"), "confidence": F.lit(0.0), "note": F.lit(NO_RESULT), "stale": F.lit(False)}
    kept = kept.unionByName(silent.select("org", *(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kept.schema if f.name != "org")))
    kept = materialize(kept, "claims")  # a run's tables are read by every part of its envelopes
    cited = evidence.unionByName(reconcile.carried_evidence(previous, claims, evidence))
    told = synthesis.build(kept, seen, changes)

    state = F.when(F.col("present").isNull(), "failed")
    rows = organisations.select("org", "pos").join(present.withColumn("present", F.lit(True)), "org", "left")
    if anchors is not None:
        rows = rows.join(anchors.select("org").distinct().withColumn("anchored", F.lit(True)), "org", "left")
        state = state.when(F.col("anchored").isNull(), "completed_without_registry_anchor")
    parts = {
        "claims": _gathered(kept, "claims", "field", "value", "availability", "confidence", "period", "currency", "statement", "evidence_id", "first_observed_at", "last_observed_at", "stale", "refresh_status", "note"),
        "evidence": _gathered(cited, "evidence", "evidence_id", "url", "sha"),
        "observations": _gathered(seen, "observations", *(c for c in ("platform", "id", "signal_type", "source_url", "identity_proof") if c in seen.columns)),
        "changes": _gathered(changes, "changes", "field", "change_type", "materiality", "old_value", "new_value", "old_url", "new_url", "note"),
    }
    if errors is not None:
        parts["errors"] = _gathered(errors, "errors", "stage", "message")
    for name, part in parts.items():
        rows = rows.join(part, "org", "left").withColumn(name, F.coalesce(name, F.array().cast(part.schema[name].dataType)))
    rows = rows.join(report.identity_summary(kept), "org", "left").join(told, "org", "left")
    spent = {"requests": "long", "runtime_ms": "long", "third_party_cost_usd": "double"}
    rows = rows.join(operations.select("org", *spent), "org", "left") if operations is not None else _with(rows, spent)
    envelopes = rows.select(
        "org", "pos", F.lit(run_id).alias("run_id"), state.otherwise("completed").alias("status"),
        F.struct(F.col("org").alias("organisation_number"), "legal_name", "legal_form", "municipality", "industry_code").alias("legal_identity"),
        *parts,
        F.array_distinct(F.transform("observations", lambda o: o["platform"])).alias("platforms"),
        F.struct(*(F.coalesce(F.col(k), F.lit(0).cast(t)).alias(k) for k, t in spent.items())).alias("operations"),
        F.struct("text", "sections", "unknowns", "evidence_ids", "method").alias("summary"),
    )
    return Run(kept, changes, cited, envelopes, report.status_counts(envelopes, "status"))


def run_collected(organisations: DataFrame, found: collect.Collected, previous: DataFrame | None = None, operations: DataFrame | None = None, run_id: str = "run-1") -> Run:
    """A run over what collect.collect has made of captured responses; its tables are written before they are read again."""
    claims, observations, evidence = (materialize(x, n) for x, n in ((found.claims, "collected"), (found.observations, "observations"), (found.evidence, "evidence")))
    return run(organisations, claims, previous, observations, evidence, found.errors, found.anchors, operations, run_id)


def refresh(previous: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes between two snapshots, and the report whose `passed` decides the outcome."""
    return reconcile.changes(previous, current), reconcile.refresh_report(previous, current)


def select(universe: DataFrame, count: int, seed: str, exclude: DataFrame | None = None, risk_weighted: bool = False) -> DataFrame:
    pick = sampling.risk_weighted if risk_weighted else sampling.representative
    return pick(universe, count, seed, exclude=exclude).orderBy("rank")


def summarise(claims: DataFrame, observations: DataFrame, changes: DataFrame) -> DataFrame:
    """(org, text, sections, unknowns, evidence_ids, method) from stored tables."""
    return synthesis.build(_with(claims, CARRIED), observations, changes)


def audit_queue(observations: DataFrame, count: int, blobs: DataFrame | None = None, seed: str = "audit-1") -> tuple[DataFrame, DataFrame | None]:
    """The queue with its observations, and what a machine can label of it."""
    queued = observations.join(audit.queue(observations, count, seed), "id")
    return queued, None if blobs is None else audit.machine_labels(queued, blobs)


def audit_review(queued: DataFrame, labels: DataFrame, tiers: tuple[str, ...] = (), relabel: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """What a reviewer has still to decide, as blocks of text in their order, and the labels that stand.

    Labels are a stored table: a session that was broken off goes on where the
    labels end. relabel: (id) of rows whose labels are taken back.
    """
    kept = labels if relabel is None else labels.join(relabel.select("id"), "id", "left_anti")
    left = audit.pending(queued, kept, tiers)
    return left.join(review_sheet(left), "id").orderBy("turn").select("id", "risk_tier", "turn", "block"), kept


def viewer(claims: DataFrame, observations: DataFrame, path: str, title: str = "Companies") -> None:
    """Write the viewer's pages: profiles with flags, and the shares of all companies at the head."""
    flags = report.coverage_flags(claims)
    names = [c for c in flags.columns if c != "org"]
    told = flags.select("org", F.create_map(*(x for c in names for x in (F.lit(c), F.col(c)))).alias("flags"))
    write_viewer(brief.viewer_profiles(claims, observations).join(told, "org", "left"), path, title, report.viewer_stats(claims, observations))


def audit_label(decisions: DataFrame, queued: DataFrame, labels: DataFrame | None = None, by: str = "human", reviewer: str | None = None, at: str | None = None) -> DataFrame:
    """Labels after decisions, handed on to what inherits; the last decision on a row wins."""
    return audit.labelled(decisions, queued, labels, by, reviewer, at)


def audit_score(labels: DataFrame, observations: DataFrame, minimum: int = 100) -> DataFrame:
    return audit.score(labels, observations, minimum)


def places_check(found: collect.Collected, names: DataFrame, searches: int, cost: float = 0.035) -> tuple[DataFrame, DataFrame]:
    """Whether the place search works: a verdict on each company, and what was asked and spent."""
    return report.places_check(found.claims, names, searches, cost)
