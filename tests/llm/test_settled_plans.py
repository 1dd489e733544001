"""The plan of the candidates' links doesn't bring along the plans of what the steps before it have made."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quarrystone.llm import chosen_path


def _records(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    texts = []
    for _ in range(12):  # nodes that hold several texts with their near copies: not settled, split at each level
        base = [word() for _ in range(30)]
        for _ in range(9):
            own = list(base)
            own[draw.randrange(30)] = word()
            texts.append(" ".join(own))
    sig = chosen_path.signatures(chosen_path.shingle_sets(texts))
    sig[:, ::2] = 7  # tokens that all share
    sketch = chosen_path.mix(sig.astype("uint64")).astype("uint8")
    return spark.createDataFrame([(k, bytearray(a.tobytes()), bytearray(b.tobytes())) for k, (a, b) in enumerate(zip(sig, sketch, strict=True))], "rec long, sig binary, sketch binary")


def test_plans_of_earlier_steps_stay_behind(spark, capsys):
    records = chosen_path.materialize(_records(spark), "tokens")
    links = chosen_path.loose_links(records, 0.8, 0.5, 3, 8, chosen_path.TOKENS)
    capsys.readouterr()
    links.explain(True)
    plan = capsys.readouterr().out
    assert "large" in plan and "InMemoryRelation" not in plan
    assert links.where(F.col("a") != F.col("b")).count() > 0
