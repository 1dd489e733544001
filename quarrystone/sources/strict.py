"""Strict reading of nested JSON: every key known, every value of its kind, at each depth.

A shape is a dictionary of keys to kinds. A kind is a name below, perhaps with ``?``
(null is allowed) or ``!`` (the key must be there); a shape; or a list of one kind,
whose elements all must fit. Shapes become Columns over a VARIANT, parsed once.

Numbers and flags are taken as lenient readers take them: a number can be a text of
digits, a flag 0 or 1 or a text that says so. Texts must be texts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AVAILABILITIES = ("available", "not_available", "blocked", "not_applicable", "ambiguous", "failed")

#: The lines of a snapshot.
EVIDENCE = {"id": "text!", "source_url": "text!", "source_class": "text!", "retrieved_at": "text!", "content_sha256": "text!", "final_url": "text?", "http_status": "whole?", "claim_span": "text?", "extraction_method": "text?", "tls_verified": "flag"}
CLAIM = {"field": "text!", "value": "any", "availability": "availability!", "confidence": "number", "reporting_period": "text?", "evidence_ids": ["text"], "qualifiers": "object", "note": "text?"}
OBSERVATION = {k: "text!" for k in ("id", "organisation_number", "platform", "signal_type", "source_url", "retrieved_at", "content_sha256", "identity_proof", "acquisition_mode", "rights_status")} | {"exact_entity": "flag!", "metrics": "object?"} | {k: "text?" for k in ("source_class", "evidence_span", "sentiment_label", "sentiment_model_version", "observed_at")}
CHANGE = {"organisation_number": "text!", "field": "text!", "change_type": "text!", "materiality": "text", "old_value": "any", "new_value": "any"} | {k: "text?" for k in ("old_availability", "new_availability", "old_source_url", "new_source_url", "old_retrieved_at", "new_retrieved_at", "old_content_sha256", "new_content_sha256", "reporting_period", "note")}
ENVELOPE = {
    "organisation_number": "text!",
    "run": ({"run_id": "text!", "started_at": "text!", "completed_at": "text!", "terminal_status": "text!"}, "!"),
    "legal_identity": "object",
    "claims": [CLAIM],
    "evidence": [EVIDENCE],
    "observations": [OBSERVATION],
    "changes": [CHANGE],
    "operations": {"requests": "whole", "runtime_ms": "whole", "third_party_cost_usd": "number"},
    "errors": ["object"],
    "summary": "object",
}


def _of_kind(v: Column, kind: str) -> Column:
    said = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    is_text, is_number = said == "STRING", said.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    if kind == "any":
        return F.lit(True)
    if kind == "text":
        return is_text
    if kind == "availability":
        return is_text & text.isin(*AVAILABILITIES)
    if kind == "number":
        return is_number | (said == "BOOLEAN") | is_text & F.trim(text).try_cast("double").isNotNull()
    if kind == "whole":
        return (is_number | is_text) & F.coalesce(F.trim(text).try_cast("double") % 1 == 0, F.lit(False)) | (said == "BOOLEAN")
    if kind == "flag":
        return (said == "BOOLEAN") | is_number & text.isin("0", "1") | is_text & F.lower(text).isin("0", "1", "true", "false", "t", "f", "yes", "no", "y", "n", "on", "off")
    if kind == "object":
        return said.startswith("OBJECT")
    raise ValueError(kind)


def fits(v: Column, kind: object) -> Column:
    """Whether a VARIANT is of a kind; false where it isn't a value at all."""
    if isinstance(kind, tuple):
        kind = kind[0]
    if isinstance(kind, str):
        name, null = kind.rstrip("?!"), kind.endswith("?") or kind == "any"
        own = _of_kind(v, name)
        return F.coalesce(F.when(F.is_variant_null(v), F.lit(null)).otherwise(own), F.lit(False))
    if isinstance(kind, list):
        parts = F.try_variant_get(v, "$", "array<variant>")
        return F.coalesce(F.forall(parts, lambda x: fits(x, kind[0])), F.lit(False))
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    needed = [k for k, x in kind.items() if isinstance(x, str) and x.endswith("!") or isinstance(x, tuple)]
    keys = F.map_keys(fields)
    known = F.size(F.array_except(keys, F.array(*(F.lit(k) for k in kind)))) == 0
    there = F.size(F.array_except(F.array(*(F.lit(k) for k in needed)).cast("array<string>"), keys)) == 0
    ok = (F.schema_of_variant(v).startswith("OBJECT")) & known & there
    for name, x in kind.items():
        part = F.try_variant_get(v, f"$.{name}", "variant")
        ok = ok & (part.isNull() | fits(part, x))
    return F.coalesce(ok, F.lit(False))
