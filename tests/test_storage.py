from __future__ import annotations

from quarrystone import storage


def test_replayable_inputs(spark, sf):
    docs = storage.table(spark, sf, "documents")
    plain = docs.select("doc_id", "text").where("doc_id > 3")
    assert storage.replayable(plain) is plain
    mixed = plain.repartition(3)
    written = storage.replayable(mixed)
    assert written is not mixed and written.count() == mixed.count() and storage.replayable(written) is written


def test_materialize_goes_to_the_shared_folder(spark):
    df = storage.materialize(spark.range(5), "five", compact=True)
    folder = storage.shared_dir(spark).removeprefix("file://")
    assert df.count() == 5 and df.inputFiles() and all(folder in f for f in df.inputFiles())


def test_a_scope_leaves_its_result_alone(spark):
    import os

    from quarrystone import storage

    with storage.scope(spark):
        kept = storage.keep(spark.range(5), now=True)
        storage.materialize(spark.range(3), "between")
        out = storage.materialize(kept.groupBy((kept.id % 2).alias("k")).count(), "result")
    held = storage._held[spark.sparkContext.applicationId]
    assert out.count() == 2 and not kept.is_cached and "result" in held[-1] and not any("between" in x for x in held if isinstance(x, str))
    path = held[-1].removeprefix("file://")
    assert os.path.exists(path)
    storage.clear(spark)
    assert not os.path.exists(path) and spark.conf.get(storage.CLEANUP) == "false"
