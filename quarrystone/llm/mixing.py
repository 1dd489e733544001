"""Mixing sources to target weights by Efraimidis-Spirakis sampling without replacement.

Sources in the order of their code points weigh 1, 2, 3 and so on in turns, and
share all words by weight; a target stops at ``MOST_EPOCHS`` times its source's
words, and what is over is shared again until no target is above. A source is
taken whole as often as its target holds it; the rest of the target is filled in
the order of exponential keys, -ln(u) / quality, smaller ones first, so that a
document of twice the quality is twice as likely to come next. The document that
stands across the budget gives its first words up to it, so each source's words
meet its target to the word.

DataFrame functions only. u is a hash of the seed, the id and the text, so reruns
agree wherever rows stand. No source is sorted as a whole: sizes are counted in
``CELLS`` cells of the key by source, the cell that holds the end of the budget is
counted again in ``CELLS`` finer ones, and only documents of that last cell, one of
some 16 million of a source's, are put in order. Words are counted once; what is
shuffled are counts by source and cell, and no texts.

Defined cases: a null or blank text has size 0, is taken 0 times its words, and has
the least quality; a null source is a source of its own, the last; sources without
words have target 0; repeated rows are documents of their own, and rows with equal
ids and texts have equal keys: which of them comes first doesn't change the result's
rows; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import keep, materialize

WORD = r"[^\x20\x09-\x0D]+"
ODD = r"0-9#*$%&|<>{}=_/\\"
#: A word with digits or symbols: begun where a word begins, without steps back.
ODD_WORD = rf"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D{ODD}]*+[{ODD}]"
MOST_EPOCHS = 3
LEAST_QUALITY = 0.1
SEED = "mix"
CELLS = 4096
LEVELS = 2
BITS = 52  # of a hash that makes u
FEW_SOURCES = 50_000  # plans of so many sources are sent to all tasks, of more they are shuffled


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """Share of the words that hold no digits or symbols, from LEAST_QUALITY to 1."""
    odd = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(ODD_WORD))
    return F.when(size > 0, LEAST_QUALITY + (1 - LEAST_QUALITY) * (size - odd) / size).otherwise(LEAST_QUALITY)


def _hash(id_: Column, text: Column) -> Column:
    """52 bits of a hash of the seed, the id and the text."""
    said = F.concat_ws("\n", F.lit(SEED), F.coalesce(id_.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(said), 1, BITS // 4), 16, 10).cast("long")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None) -> DataFrame:
    """(id, source, size, key): words and exponential key of each row; weight_col: a positive quality of the caller's."""
    text = F.col(text_col)
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text).alias("size"), text.alias("t"), *([F.col(weight_col).cast("double").alias("q")] if weight_col else []))
    weight = F.greatest(F.coalesce("q", F.lit(LEAST_QUALITY)), F.lit(1e-9)) if weight_col else quality(F.col("t"), F.col("size"))
    u = (_hash(F.col("id"), F.col("t")) + 0.5) / F.lit(float(1 << BITS))
    return sized.select("id", "source", "size", (-F.log(u) / weight).alias("key"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Ranks come from ranges of sources, each counted by itself; the share of a
    weight is found in rounds, each one sum over the sources: it only grows, and
    a source that is at its limit stays there.
    """
    order = F.col("source").asc_nulls_last()
    parts = sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = materialize(sizes.repartitionByRange(int(parts), order).withColumn("part", F.spark_partition_id()), "sources", compact=False)
    before, offsets = 0, []
    for r in ranged.groupBy("part").count().orderBy("part").collect():  # a row for each range
        offsets.append((r["part"], before))
        before += r["count"]
    if not offsets:
        return ranged.select("source", "source_size", F.lit(1).cast("long").alias("weight"), F.lit(0.0).alias("target"))
    offset = F.create_map(*(F.lit(x) for pair in offsets for x in pair))[F.col("part")]
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + offset
    placed = keep(ranged.select("source", "source_size", (place % 3 + 1).cast("long").alias("weight")))
    limit = F.col("source_size") * MOST_EPOCHS
    share = 0.0
    while True:
        capped = limit <= F.col("weight") * F.lit(share)
        r = placed.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(capped, limit)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()  # one row
        then = (r["all"] - r["capped"]) / r["weights"] if r["weights"] else share
        if then <= share:
            break
        share = then
    return placed.select("source", "source_size", "weight", F.least(limit.cast("double"), F.col("weight") * F.lit(share)).alias("target"))


def _with_plan(rows: DataFrame, plans: DataFrame, few: bool) -> DataFrame:
    return rows.join(F.broadcast(plans) if few else plans, rows["source"].eqNullSafe(plans["source"]), "left").drop(plans["source"])


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None) -> DataFrame:
    """(id, size, source_size, target, taken) for each row of docs; taken: the words that the mix takes of it, epochs counted."""
    rows = keep(measured(docs, id_col, text_col, source_col, weight_col))
    plans = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_EPOCHS))).otherwise(0).cast("long")
    plans = plans.select("source", "source_size", "target", epochs.alias("epochs"))
    budget = F.when(F.col("epochs") < MOST_EPOCHS, F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")).otherwise(0)
    plans = keep(plans.withColumn("budget", budget).withColumn("cell", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long")), now=True)
    few = plans.count() <= FEW_SOURCES

    # place of a key in (0, 1), evenly spread for documents of quality 1; cells are its leading digits
    place = F.floor((1 - F.exp(-F.col("key"))) * F.lit(float(CELLS**LEVELS))).cast("long")
    placed = rows.withColumn("place", F.least(place, F.lit(CELLS**LEVELS - 1)))
    for level in range(1, LEVELS + 1):
        digit = F.floor(F.col("place") / F.lit(CELLS ** (LEVELS - level))).cast("long")
        inside = F.floor(digit / F.lit(CELLS)) == F.col("cell")
        counts = _with_plan(placed.where("size > 0"), plans, few).where(inside & (F.col("budget") > 0)).groupBy("source", digit.alias("digit"), "budget", "before").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digit"))  # CELLS rows of a source at most
        ends = counts.withColumn("upto", F.col("before") + upto).where("upto >= budget")  # the first of them holds the end
        cut = ends.groupBy("source").agg(F.min(F.struct("digit", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
        cut = cut.select(F.col("source").alias("of"), F.col("cut.digit").alias("cut_cell"), F.col("cut.before").alias("cut_before"))
        plans = keep(
            plans.join(cut, plans["source"].eqNullSafe(cut["of"]), "left").select(
                "source", "source_size", "target", "epochs", "budget", F.coalesce("cut_cell", F.lit(-1)).cast("long").alias("cell"), F.coalesce("cut_before", F.lit(0)).cast("long").alias("before")
            ),
            now=True,
        )
    known = _with_plan(placed, plans, few)
    full = F.col("epochs") * F.col("size")
    sure = known.where((F.col("place") != F.col("cell")) | (F.col("size") == 0)).withColumn("part", F.when((F.col("place") < F.col("cell")) & (F.col("budget") > 0), F.col("size")).otherwise(0))
    order = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    last = known.where((F.col("place") == F.col("cell")) & (F.col("size") > 0)).withColumn("part", F.least(F.col("size"), F.greatest(F.lit(0), F.col("budget") - ahead)))
    out = lambda x: x.select(F.col("id").alias(id_col), "size", "source_size", "target", (full + F.col("part")).cast("long").alias("taken"))
    return out(sure).unionByName(out(last))
