"""Large nodes of one class are settled without being split, and no link is lost by it."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quarrystone.llm import chosen_path


def test_near_copies_are_not_split_and_keep_their_links(spark, monkeypatch):
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    base, texts = [word() for _ in range(150)], []
    for k in range(120):  # near copies of one text, a few of which have gone far from it
        own = list(base)
        for _ in range(1 if k % 20 else 6):
            own[draw.randrange(150)] = word()
        texts.append(" ".join(own))
    texts += [" ".join(word() for _ in range(60)) for _ in range(40)]
    seen, make = spark.sparkContext.accumulator(0), chosen_path._next_nodes

    def counted(tokens, threshold):
        split = make(tokens, threshold)

        def run(batches):
            def told():
                for b in batches:
                    seen.add(b.num_rows)
                    yield b

            yield from split(told())

        return run

    monkeypatch.setattr(chosen_path, "_next_nodes", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.join(docs, leaf=32).collect()}
    sets = chosen_path.shingle_sets(texts)
    a, b = chosen_path._compare(sets, None, 0.8)
    links = [int(((a == k) | (b == k)).sum()) for k in range(len(texts))]
    label = chosen_path._labels(len(texts), a, b)
    assert got == {k: (int(label[k]), links[k]) for k in range(len(texts))}
    assert max(links) > 100
    assert seen.value == 0
