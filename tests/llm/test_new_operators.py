"""Whitening, mixing and conversation repair against plain versions, on the given tables and on edge cases."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.llm import mixing, turns, whitening
from quarrystone.llm import queries as q

from . import brute_new as plain

rng = random.Random(11)


# whitening


def check_whitened(got, rows, most=32):
    """got: rows of components(); the same up to a sign for each component."""
    want, n, shares = plain.whitened(rows, most)
    k = len(shares)
    by_id = defaultdict(list)
    for r in got:
        by_id[str(r[0]), r.deviation].append((r.component, r.whitened))
    assert len(got) == n * k and {r.n for r in got} == {n}
    # equal rows have equal values, so each takes its turn of every component
    table = np.array([w for key in sorted(by_id) for w in np.array([x for _, x in sorted(by_id[key])]).reshape(k, -1).T])
    other = np.array([w for _, _, w in sorted(want, key=lambda r: (str(r[0]), r[1]))])
    assert sorted((str(r[0]), r.deviation) for r in got if r.component == 1) == sorted((str(i), d) for i, d, _ in want)
    signs = np.sign((table * other).sum(axis=0))
    assert np.abs(table - other * signs).max() < 1e-6
    for r in got[: 4 * k]:
        assert abs(r.explained - shares[r.component - 1]) < 1e-9 and 0 <= r.identity_error < 1e-8


def test_op11(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check_whitened(q.op11_whitening(spark, sf).collect(), rows)


ODD = "vec_id string, embedding array<double>, whitened string, n string, at string, component string, deviation string"


def test_whitening_of_odd_rows(spark):
    draw = np.random.default_rng(1)
    vectors = [list(map(float, v)) for v in draw.normal(size=(40, 5))]
    odd = [None, [], [1.0], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], None]
    rows = [(None if k == 3 else f"v{k}", v) for k, v in enumerate(vectors)] + [(f"odd{k}", v) for k, v in enumerate(odd)] + [("v7", vectors[7])]
    df = spark.createDataFrame([(i, v, "x", "x", "x", "x", "x") for i, v in rows], ODD).repartition(4)
    usable = [(i, v) for i, v in rows if v is not None and len(v) == 5 and all(c is not None and np.isfinite(c) for c in v)]
    check_whitened(whitening.components(df).collect(), usable)


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(str(k), [1.0, 2.0], "", "", "", "", "") for k in range(3)], ODD)
    assert whitening.components(same).collect() == []
    empty = whitening.components(spark.createDataFrame([], ODD))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = [(str(k), [float(k), 5.0, -2.0 * k], "", "", "", "", "") for k in range(10)]  # one direction only
    got = whitening.components(spark.createDataFrame(flat, ODD)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12
    with pytest.raises(Exception, match="2\\*\\*40"):
        whitening.components(spark.createDataFrame([("a", [1e300, 0.0], "", "", "", "", "")] * 2, ODD)).collect()


def test_steep_spectra_need_no_expansion(spark):
    draw = np.random.default_rng(2)
    scale = np.concatenate([400 * 0.5 ** np.arange(3), np.zeros(77)])  # three directions in 80 dimensions
    basis = np.linalg.qr(draw.normal(size=(80, 80)))[0]
    rows = [(str(k), list(map(float, v)), "", "", "", "", "") for k, v in enumerate((draw.normal(size=(300, 80)) * scale) @ basis.T)]
    df = spark.createDataFrame(rows, ODD).repartition(3)
    _, model = whitening.whiten(df, most=2)
    assert not model.expanded and model.passes <= whitening.PASSES
    check_whitened(whitening.components(df, most=2).collect(), [(r[0], r[1]) for r in rows], 2)
    assert whitening.whiten(df, most=32)[1].expanded  # the rounded rest has no gaps


# mixing


def check_mix(got, rows, least=0):
    """got: (id, size, source_size, target, taken); rows: (id, text, source)."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += plain.words(text)
    target = plain.targets(sizes)
    assert sorted((str(r[0]), r.size) for r in got) == sorted((str(i), plain.words(t)) for i, t, _ in rows)
    taken = Counter()
    source_of = defaultdict(set)
    for i, _, s in rows:
        source_of[i].add(s)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        if len(source_of[r[0]]) == 1:
            s = next(iter(source_of[r[0]]))
            assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
            taken[s] += r.taken
            assert r.taken >= min(3, int(target[s] / sizes[s] + 1e-9) if sizes[s] else 0) * r.size  # complete epochs come first
    for s in taken:
        if all(len(source_of[i]) == 1 for i, _, t in rows if t == s):
            assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    return taken


def test_op12(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = q.op12_mixing(spark, sf).collect()
    check_mix(got, rows)
    assert Counter(map(tuple, got)) == Counter(map(tuple, q.op12_mixing(spark, sf).collect()))


DOCS = "doc_id long, text string, source string, size long, target string, taken string, `key` string, budget string, cell string, place string, id string, q double"


def test_mixing_of_odd_rows(spark):
    words = lambda n: " ".join(f"w{rng.randrange(99)}" for _ in range(n))
    rows = [(k, words(rng.randrange(1, 40)), "hot") for k in range(60)]
    rows += [(100 + k, words(3), f"s{k}") for k in range(7)]  # targets beyond three epochs
    rows += [(200, None, "hot"), (201, "", "none"), (202, " \t\n", "none"), (203, words(9), None), (None, words(5), None), (204, "x" * 100_000, "é"), (205, words(30_000), "long"), (206, "a b", "")]
    rows += [(300, "same text here", "twin")] * 4
    df = spark.createDataFrame([(i, t, s, 7, "x", "x", "x", "x", "x", "x", "x", 1.0) for i, t, s in rows], DOCS).repartition(5)
    got = mixing.mix(df).collect()
    check_mix(got, rows)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df.repartition(2)).collect()))
    few, mixing.FEW_SOURCES = mixing.FEW_SOURCES, 0
    try:
        assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df).collect()))
    finally:
        mixing.FEW_SOURCES = few
    nothing = mixing.mix(spark.createDataFrame([], DOCS))
    assert nothing.collect() == [] and nothing.columns == ["doc_id", "size", "source_size", "target", "taken"]
    blank = mixing.mix(spark.createDataFrame([(1, None, "a", 7, "x", "x", "x", "x", "x", "x", "x", 1.0)], DOCS)).collect()
    assert [tuple(r) for r in blank] == [(1, 0, 0, 0.0, 0)]


def test_better_documents_are_more_likely(spark):
    """Of a source of which a tenth is taken, a document of four times the quality comes about four times as often."""
    rows = [(k, "one two three four five", "big", 7, "x", "x", "x", "x", "x", "x", "x", 4.0 if k % 2 else 1.0) for k in range(6000)]
    rows += [(10_000 + k, "one two three four five", s, 7, "x", "x", "x", "x", "x", "x", "x", 1.0) for s in ("c", "d") for k in range(700)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), weight_col="q").where("doc_id < 10000").collect()
    share = sum(r.taken for r in got) / sum(r.size for r in got)
    good, poor = (sum(r.taken for r in got if r.doc_id % 2 == odd) for odd in (1, 0))
    assert 0.1 < share < 0.6 and good > 1.5 * poor


# conversations


def digests(spark, rows, schema):
    dropped_too, gone = turns.damaged(spark.createDataFrame(rows, schema).repartition(4))
    return [tuple(r) for r in turns.digests(turns.prepared(dropped_too), gone).collect()]


def test_op13(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = [tuple(r) for r in q.op13_conversation_repair(spark, sf).collect()]
    assert Counter(got) == Counter(plain.conversations(rows)) and len(got) == len({r[0] for r in rows})


def _random_rows(convs, most, roles=("user", "assistant", "system", "tool", None, "uncle", "")):
    texts = ["Yes.", "No!", "cut off", "", None, " \n", "why?", "end. ", "ünï.", "a.\x85"]
    out = []
    for c in range(convs):
        for t in range(rng.randrange(1, most)):
            out.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    return out


SCHEMA = "conv_id long, turn int, role string, text string, id string, mark int, audit string, stretch string, h string, late string"


def test_repair_of_odd_rows(spark):
    rows = _random_rows(150, 9) + [(None, k, "user", "a.") for k in range(5)] + [(None, None, None, None)] + [(900, 1, "user", "a.")] * 3
    rows += [(901, k, "user" if k % 2 == 0 else "assistant", "x" * 50_000 + ".") for k in range(2)]
    got = digests(spark, [(*r, "x", 5, "x", "x", "x", "x") for r in rows], SCHEMA)
    want = plain.conversations(rows)
    assert Counter(got) == Counter(want)
    assert digests(spark, [], SCHEMA) == []


def test_long_conversations_are_cut_into_stretches(spark):
    """One conversation holds most rows; its stretches meet again, with and without turns to cut by."""
    hot = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), f"t {rng.randrange(900)}" + rng.choice([".", ""])) for t in range(1400)]
    hot += [(2, None, rng.choice(["user", "assistant"]), f"n {k}.") for k in range(700)]
    rows = hot + _random_rows(20, 6)
    got = digests(spark, [(*r, "x", 5, "x", "x", "x", "x") for r in rows], SCHEMA)
    assert Counter(got) == Counter(plain.conversations(rows))


def test_repaired_turns(spark):
    """The operator's own output: legal dialogues, kept texts as they stand."""
    rows = _random_rows(60, 12)
    df = spark.createDataFrame([(*r, "x", 5, "x", "x", "x", "x") for r in rows], SCHEMA)
    out = turns.repair(turns.prepared(df)).collect()
    texts = defaultdict(set)
    for c, _, _, t in rows:
        texts[c].add(" " if t is None else t)
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.id, r.position)):
        assert r.text == "" or r.text in texts[r.id]
        by[r.id].append(r.role[0])
    for initials in by.values():
        said = "".join(initials)
        assert said.removeprefix("s") == "ua" * (len(said) // 2) and said != "s"


def test_moves_are_the_least(spark):
    best = {}
    for kind, state, then, cost, letters in turns.moves():
        assert (kind, state, then) not in best
        best[kind, state, then] = cost, letters
    keep_user = 3 * turns.INITIALS.index("u") + turns.FINE
    assert best[keep_user, turns.START, turns.USER] == (0, "K")
    assert best[keep_user, turns.USER, turns.USER] == (2, "D")
    assert best[keep_user, turns.USER, turns.ASSISTANT] == (1, "R")
    assert all("K" not in v[1] and "R" not in v[1] for k, v in best.items() if k[0] % 3 == turns.GONE)


def test_damage_drops_and_repeats(spark):
    df = spark.createDataFrame([(c, t, "user", "a. b!", "x", 5, "x", "x", "x", "x") for c in range(40) for t in range(5)], SCHEMA)
    kept, gone = turns.damaged(df)
    rows = [(c, t, "user", "a. b!") for c in range(40) for t in range(5)]
    assert Counter(map(tuple, kept.collect())) == Counter(plain.after_damage(rows))
    assert gone.where(F.col("id").isNull()).count() == 0
