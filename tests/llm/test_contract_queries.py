"""The registered queries against plain versions, over a whole small table."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections import defaultdict

import pytest
from quarrystone.llm import queries as q

from . import brute


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_op1(spark, sf, docs):
    got = q.op1_sharding(spark, sf).collect()
    text = dict(docs)
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id].encode()) + 1, brute.crc(text[r.doc_id]), "bytes", None)
    load, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        where[text[r.doc_id]].add(r.shard)
    assert all(len(x) == 1 for x in where.values())
    assert set(load) <= set(range(8)) and max(load.values()) == brute.minimax(docs, 8)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_op2(spark, sf, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = rows(q.op2_decontaminate(spark, sf), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(brute.contaminated(docs, items)) and any(r[-1] for r in got)


def test_op4(spark, sf, docs):
    text = dict(docs)
    for r in q.op4_secrets(spark, sf).collect():
        base = brute.secrets(text[r.doc_id])
        assert r.base_sha256 == brute.sha(",".join(base)) and r.n_assign + r.n_access + r.n_hex == len(base)
        assert [x for x in r.spans.split(",") if x and not x.startswith("novel")] == base


def test_op6(spark, sf):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    last = {}
    for i in sorted(pages):
        last[pages[i]] = i
    want = sorted((i, len(x), base64.b32encode(hashlib.sha1(x).digest()).decode(), "response" if last[x] == i else "revisit", None if last[x] == i else last[x]) for i, x in pages.items())
    assert rows(q.op6_warc(spark, sf), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want


def test_op7(spark, sf, docs):
    text = dict(docs)
    for r in q.op7_host_rules(spark, sf).collect():
        own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert own == brute.features(text[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)


def test_op8(spark, sf, docs):
    assert rows(q.op8_recompression(spark, sf), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substring_dedup(docs))


def test_op10(spark, sf, docs):
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in docs:
        ids = plain.encode_ordinary(t or "")
        want.append((i, len(ids), brute.sha(struct.pack(f"<{len(ids)}I", *ids)), brute.sha(t or "")))
    assert rows(q.op10_byte_bpe(spark, sf), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)


def test_op3(spark, sf, docs):
    got = rows(q.op3_jaccard_join(spark, sf), "doc_id", "class_id", "n_links")
    want = sorted(brute.near(docs))
    assert got == want and any(r[2] for r in got)


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_sql(spark, sf, name):
    from tests.oracle_check import compare, connect

    assert compare(spark, connect(sf), name, q.queries()[name], q.oracle_sql()[name], sf) == ""
