"""Writers: snapshots, manifests, blobs, JSON lines, labels, reports and the viewer."""

from __future__ import annotations

import html
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import ship
from . import commits


def envelope_lines(envelopes: DataFrame) -> DataFrame:
    """(org, line): one JSON line for each envelope, nulls written out."""
    return envelopes.select("org", F.to_json(F.struct(*(c for c in envelopes.columns)), {"ignoreNullFields": "false"}).alias("line"))


def write_snapshot(envelopes: DataFrame, path: str, **info: str) -> DataFrame:
    """Write JSON lines ordered by organisation over as many files as needed; one row back: rows, a digest of all files, and the payloads.

    The plan runs once; digests come from the bytes that are written, and nothing is
    seen before all of it is (see commits). payloads names each file with its size
    and the SHA-256 of its bytes, in the order of the rows.
    """
    told = commits.committed_snapshot(envelope_lines(envelopes).orderBy("org"), path, **info)
    files = [(f["file"], f["bytes"], f["sha256"]) for f in told["payloads"]]
    return envelopes.sparkSession.createDataFrame([(told["rows"], told["sha256"], files)], "rows long, sha256 string, payloads array<struct<file:string,bytes:long,sha256:string>>")


def manifest(run_id: str, organisations: DataFrame, digest: DataFrame) -> DataFrame:
    """(run_id, pos, org, count, sha256): the list of a run in order, with what was written."""
    return organisations.select("pos", "org").join(F.broadcast(digest), F.lit(True)).select(F.lit(run_id).alias("run_id"), "pos", "org", F.col("rows").alias("count"), "sha256", *(["payloads"] if "payloads" in digest.columns else [])).orderBy("pos")


def write_blobs(payloads: DataFrame, path: str) -> None:
    """Add payloads (content) to a folder of blobs by digest; what is there stays, and two writers of one payload make one file."""
    commits.committed_blobs(payloads.dropDuplicates(["content"]), path)


def write_jsonl(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(report: DataFrame, path: str) -> dict:
    """One row as indented JSON; the row is returned."""
    row = json.loads(report.limit(1).toJSON().first())
    text = json.dumps(row, indent=2, ensure_ascii=False, sort_keys=True)
    report.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return row


def review_sheet(rows: DataFrame) -> DataFrame:
    """Blocks of text for a reviewer, divided by dashes; rows: (id, organisation_number, platform, signal_type, risk_tier, identity_proof, source_url, retrieved_at, content_sha256)."""
    line = lambda label, value: F.concat(F.rpad(F.lit(label), 12, " "), F.lit(": "), value)
    block = F.concat_ws("\n", line("observation", F.col("id")), line("company", F.col("organisation_number")), line("platform", F.concat_ws(" / ", "platform", "signal_type")), line("risk tier", F.col("risk_tier")), line("proof", F.col("identity_proof")), line("source", F.col("source_url")), line("retrieved", F.col("retrieved_at")), line("hash", F.concat(F.substring("content_sha256", 1, 16), F.lit("..."))), F.lit(""), F.lit("Does this observation belong to exactly this legal entity?"), F.lit("-" * 78))
    return rows.select("id", block.alias("block"))


def write_changes(changes: DataFrame, path: str) -> None:
    """Changes as JSON lines, by organisation, field, kind and value."""
    write_jsonl(changes, path, ["org", "field", "change_type", "new_value", "old_value"])


PAGE_ROWS = 20_000  # companies on a page of the viewer

_STYLE = "body{font:15px system-ui;margin:2rem auto;max-width:60rem}.s{display:inline-block;margin-right:2rem}.s b{display:block;font-size:1.4rem}details{border-top:1px solid #ccc;padding:.4rem}td{padding:.1rem .6rem;vertical-align:top}.p{background:#eee;border-radius:1rem;padding:0 .6rem;margin-left:.3rem}"
_SCRIPT = """
const $=id=>document.getElementById(id),el=(t,x,c)=>{const e=document.createElement(t);if(x!=null)e.textContent=x;if(c)e.className=c;return e};
for(const [k,v] of Object.entries(STATS)){const s=el('div',null,'s');s.append(el('b',v),k);$('stats').append(s)}
const flags=[...new Set(ROWS.flatMap(r=>Object.keys(r.flags||{})))],on=new Set();
for(const f of flags){const l=el('label',f+' '),b=el('input');b.type='checkbox';b.onchange=()=>{b.checked?on.add(f):on.delete(f);show()};l.prepend(b);$('flags').append(l)}
function card(r){const d=el('details'),s=el('summary',(r.name||r.org)+' · '+r.org+' · '+(r.municipality||''));for(const p of r.platforms||[])s.append(el('span',p,'p'));const t=el('table');
for(const [k,v] of Object.entries(r.fields||{})){const w=el('tr');w.append(el('td',k),el('td',v));t.append(w)}d.append(s,t);return d}
function show(){const q=$('q').value.toLowerCase(),left=ROWS.filter(r=>[r.name,r.org,r.municipality].some(x=>(x||'').toLowerCase().includes(q))&&[...on].every(f=>(r.flags||{})[f]));$('n').textContent=left.length+' shown';$('list').replaceChildren(...left.slice(0,500).map(card))}
$('q').oninput=show;show()
"""


def _page(rows: list[str], stats: str, title: str) -> str:
    safe = lambda x: x.replace("</", "<\\/")
    body = f"<h1>{html.escape(title)}</h1><div id=stats></div><p><input id=q placeholder=filter> <span id=flags></span> <span id=n></span></p><div id=list></div>"
    script = f"const STATS={safe(stats)},ROWS=[{safe(','.join(rows))}];{_SCRIPT}"
    return "".join((f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><style>{_STYLE}</style>{body}<script>{script}</script>").splitlines())


def write_viewer(profiles: DataFrame, path: str, title: str = "Companies", stats: DataFrame | None = None, page_rows: int = PAGE_ROWS) -> None:
    """Self-contained pages over profiles (org, name, municipality, platforms array, and fields map and flags map if they have them).

    Companies with most platforms come first. A page holds page_rows of them; a
    larger selection becomes several pages, each made by a task of its own, one
    file for each page. stats: one row whose columns head every page.
    """
    spark = profiles.sparkSession
    ship(spark)
    head = "{}" if stats is None else (stats.limit(1).toJSON().first() or "{}")
    key = [-F.size(F.coalesce("platforms", F.array())), F.coalesce("name", F.lit("")), F.col("org")]
    pages = max(1, -(-profiles.count() // page_rows))
    laid = profiles.withColumns({f"_k{n}": k for n, k in enumerate(key)})
    order = [f"_k{n}" for n in range(len(key))]
    told = laid.repartitionByRange(pages, *order).sortWithinPartitions(*order).select(F.to_json(F.struct(*profiles.columns)).alias("row"))

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [x for b in batches for x in b["row"]]  # of about one page: ranges are cut by the number of pages
        if rows:
            yield pd.DataFrame({"value": [_page(rows, head, title)]})

    written = told.mapInPandas(render, "value string")
    if profiles.isEmpty():
        written = spark.createDataFrame([(_page([], head, title),)], "value string")
    written.write.mode("overwrite").text(path)
