from __future__ import annotations

import corpus_pipeline as cp
from quarrystone.llm import surrogates
from quarrystone.storage import table

from . import brute


def test_stages_keep_columns_and_decide(spark, sf):
    docs = table(spark, sf, "documents")
    names, n, sizes = docs.columns, docs.count(), []
    from quarrystone.storage import materialize

    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, sf), f"test-{name}")
        sizes.append(docs.count())
        if name != "tokenisation":
            assert docs.columns == names
            assert docs.where("n_chars != length(text)").count() == 0
    assert n > sizes[0] == sizes[1] > sizes[2] == sizes[3] == sizes[4] > 0


def test_run_has_no_benchmark_window_and_no_near_copies(spark, sf):
    docs = table(spark, sf, "documents")
    for _, stage in cp.STAGES[:4]:
        docs = stage(spark, docs, sf)
    left = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    # a removal can join words on both sides of it to a new window; none does here
    assert not any(r[-1] for r in brute.contaminated(left, items))
    assert cp.run(spark, sf).count() == len(left)


CLASHING = ("doc", "ids", "decoded", "items", "spans", "clean_text", "row", "host", "gone", "kept", "page", "x")
LONG = " ".join(f"long{n % 997} word{n % 89} and{n}" for n in range(12_000))


def _edges(spark):
    prose = "Each of these words stands here once or so, in an order that no other text has: " + " ".join(f"p{n} q{n * 7} r" for n in range(40))
    texts = [None, "", " ", "short", prose, prose, prose + " and a tail", LONG, "\x00 odd \x01 " + prose.replace("p", "z"), "🙂 ünï " + prose.replace("q", "y")]
    rows = [(i, t, "en", None if i % 4 == 0 else "s", None if t is None else -1, *("c",) * len(CLASHING)) for i, t in enumerate(texts)]
    rows += [rows[4], (None, prose.replace("r", "null id"), None, "s", 1, *(None,) * len(CLASHING))]
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema).repartition(3), [(r[0], r[1]) for r in rows]


def test_each_stage_on_edge_cases(spark, sf):
    import base64
    import struct
    from collections import Counter

    import public_tokenizers as P
    import tiktoken

    docs, rows = _edges(spark)
    for name, stage in cp.STAGES[:4]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType, name
        kept = Counter((r.doc_id, r.text) for r in got.collect())
        if name == "quality_rules":
            assert kept == Counter(x for x in rows if x[1] and len(x[1]) > 50)
        if name == "decontamination":
            assert kept == Counter(rows)  # nothing of the benchmark stands here
        if name == "line_dedup":
            assert kept[4, rows[4][1]] == 2 and kept[5, ""] == 1 and kept[0, None] == 1  # the first document keeps its line
        if name == "near_duplicates":
            assert sum(kept[x] for x in {*rows[4:7]}) == 1 and kept[7, LONG] == kept[0, None] == 1
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [(i, plain.encode_ordinary(t or ""), t or "") for i, t in rows]
    want = Counter((i, len(x), struct.pack(f"<{len(x)}I", *x), brute.sha(t)) for i, x, t in ids)
    assert Counter((r.doc_id, r.n_tokens, bytes(r.token_ids), r.text_sha256) for r in cp.tokenisation(spark, docs, sf).collect()) == want


def test_the_chain_on_an_empty_table(spark, sf):
    docs, _ = _edges(spark)
    docs = docs.limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
    assert docs.columns == ["doc_id", "n_tokens", "token_ids", "text_sha256"]


def test_surrogates_are_typed_consistent_and_distinct(spark):
    texts = [
        "Mail Und.34@mail7.example.com, UND.34@MAIL7.EXAMPLE.COM or +1 (826) 555-7388. Card 4111 1111 1111 1111.",
        "Mrs. Anna Smith met John Miller; Mr Miller left with 4111111111111111 and Ольга Петрова from 97.51.17.173.",
        "97.51.17.173", "", None, "version 1.2.3.4.5 and 12 numbers", "97.51.17.173",
    ]
    df = spark.createDataFrame([(i, t, "e", "g") for i, t in enumerate(texts)], "doc_id long, text string, entity string, gaps string")
    got = {r.doc_id: r for r in surrogates.pseudonymise(df, "k").collect()}
    assert len(got) == 7 and got[3].text == "" and got[4].text is None and got[5].text == texts[5]
    words = got[0].text.split()
    mail, again = words[1].rstrip(","), words[2]
    assert mail.upper() == again and mail.endswith(".example") and not mail.startswith("Und")
    assert got[0].text.split("Card ")[1].replace(" ", "").rstrip(".") == got[1].text.split(" with ")[1].split()[0]
    digits = [int(c) for c in got[1].text.split(" with ")[1].split()[0]][::-1]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert got[1].text.startswith("Mrs. ") and "lina " in got[1].text and got[1].text.count(got[1].text.split("Mr ")[1].split()[0]) == 2
    assert any("а" <= c <= "я" for c in got[1].text) and got[2].text == got[6].text != texts[2]
    empty = surrogates.pseudonymise(df.limit(0), "k")
    assert empty.count() == 0


def test_surrogates_of_colliding_entities_differ(spark, monkeypatch):
    from pyspark.sql import functions as F

    real = surrogates._core
    # the first draw gives one surrogate to all, or an entity of the corpus
    monkeypatch.setattr(surrogates, "_core", lambda k, n, a, key: F.when(a == 0, F.lit("97.51.17.173")).otherwise(real(k, n, a, key)))
    df = spark.createDataFrame([(i, f"97.51.17.{i}") for i in range(170, 180)], "doc_id long, text string")
    got = [r.text for r in surrogates.pseudonymise(df, "k").collect()]
    assert len({*got}) == 10 and not any(x.startswith("97.51.17.") for x in got)
