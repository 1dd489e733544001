"""Minimax contiguous partition of ordered atomic groups into shards.

Groups (rows with equal texts) are put in the order of their smallest id and
laid end to end. The smallest shard capacity that lets a greedy walk finish
within the wanted number of shards is found by binary search, and the shards are
cut there. No group is ever divided.

The search runs on the driver over summaries of bounded size: group ends are
counted in ``resolution`` buckets. A greedy walk over buckets gives a lower and
an upper bound of each cut, which proves most capacities feasible or not; only
the stretches that hold undecided cuts are summarised again, more finely.

Defined cases: a null text counts 1 byte and all null texts are one group; an
empty text counts 1 byte and is a group apart from nulls; text_crc32 of a null
text is null; repeated rows are rows of one group each with its own slot; null
ids come first; an empty table gives an empty result; further columns are
ignored; a group larger than every other shard is a shard of its own, and then
later shards can be empty.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize

RESOLUTION = 4096


@dataclass
class _Summary:
    """Ends of groups by bucket: the first, the last and the count of each bucket that has any."""

    first: list[int]
    last: list[int]
    count: list[int]

    def around(self, x: int) -> tuple[int, int, int]:
        """Bounds of the greatest end <= x (0 if none), and the bucket that leaves doubt or -1."""
        i = bisect_right(self.first, x) - 1
        if i < 0:
            return 0, 0, -1
        if x >= self.last[i]:
            return self.last[i], self.last[i], -1
        if self.count[i] <= 2 or x == self.first[i]:
            return self.first[i], self.first[i], -1
        return self.first[i], x, i


def _walk(s: _Summary, total: int, shards: int, capacity: int, upper: bool) -> tuple[bool, list[int], set[int]]:
    """Greedy cuts with the lower or the upper bound of each cut; whether they reach the end."""
    at, cuts, doubt = 0, [], set()
    for _ in range(shards):
        if at + capacity >= total:
            return True, cuts, doubt
        low, high, bucket = s.around(at + capacity)
        if bucket >= 0:
            doubt.add(bucket)
        to = high if upper else low
        if to <= at:
            return False, cuts, doubt
        at = to
        cuts.append(at)
    return at >= total, cuts, doubt


def _summary(ends: DataFrame, stretches: list[tuple[int, int]], known: _Summary | None, resolution: int) -> _Summary:
    """Summarise the ends within the stretches; what is known elsewhere stays."""
    each = max(2, resolution // max(1, len(stretches)))  # two at least, so that every stretch gets finer
    width = F.lit(None).cast("long")
    base = F.lit(None).cast("long")
    inside = F.lit(False)
    for lo, hi in stretches:
        here = (F.col("end") >= lo) & (F.col("end") <= hi)
        inside = inside | here
        width = F.when(here, F.lit(max(1, -(-(hi - lo + 1) // each)))).otherwise(width)
        base = F.when(here, F.lit(lo)).otherwise(base)
    rows = (
        ends.where(inside)
        .select("end", base.alias("b"), F.floor((F.col("end") - base) / width).alias("k"))
        .groupBy("b", "k")
        .agg(F.min("end").alias("f"), F.max("end").alias("l"), F.countDistinct("end").alias("n"))
        .collect()  # at most `resolution` rows and one for each stretch
    )
    got = [(r.f, r.l, r.n) for r in rows]
    if known:
        drop = {lo for lo, _ in stretches}
        got += [(f, l, n) for f, l, n in zip(known.first, known.last, known.count, strict=True) if f not in drop]
    got.sort()
    return _Summary([g[0] for g in got], [g[1] for g in got], [g[2] for g in got])


def minimax_cuts(ends: DataFrame, total: int, largest: int, shards: int, resolution: int = RESOLUTION) -> tuple[int, list[int]]:
    """The smallest capacity for `shards` shards, and the ends of groups where they are cut.

    ends: a column ``end``, the running total of sizes at the end of each group.
    """
    if total <= 0:
        return 0, []
    low, high = max(largest, -(-total // shards)), total
    s = _summary(ends, [(1, total)], None, resolution)
    while True:
        a, b = low, high  # smallest capacity that the lower bounds prove feasible
        while a < b:
            m = (a + b) // 2
            if _walk(s, total, shards, m, upper=False)[0]:
                b = m
            else:
                a = m + 1
        high = a
        a, b = low, high  # smallest capacity that the upper bounds don't prove infeasible
        while a < b:
            m = (a + b) // 2
            if _walk(s, total, shards, m, upper=True)[0]:
                b = m
            else:
                a = m + 1
        low = a
        doubt: set[int] = set()
        if low < high:
            first = _walk(s, total, shards, low, upper=False)[1]
            final = _walk(s, total, shards, high, upper=True)[1]
            spans = [(x + low, y + high) for x, y in zip([0, *first], [0, *final], strict=False)]
            for lo, hi in spans:
                i = max(0, bisect_right(s.first, lo) - 1)
                while i < len(s.first) and s.first[i] <= hi:
                    if s.count[i] > 2:
                        doubt.add(i)
                    i += 1
        else:
            doubt = _walk(s, total, shards, high, upper=False)[2] | _walk(s, total, shards, high, upper=True)[2]
        if not doubt:
            if low < high:
                raise AssertionError("the search must end once no bucket is in doubt")
            return high, _walk(s, total, shards, high, upper=False)[1]
        s = _summary(ends, [(s.first[i], s.last[i]) for i in sorted(doubt)], s, resolution)


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", resolution: int = RESOLUTION) -> DataFrame:
    """Rows of docs with (id, size, text_crc32, shard, slot).

    One exchange groups equal texts by digest, one brings the group's order back
    to its rows (a skewed join if a text is hot) and one range sort lays all rows
    out; a hot group spans several of its partitions.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.when(text.isNull(), F.lit("null")).otherwise(F.sha2(F.encode(text, "UTF-8"), 256)).alias("key"),
    )
    shared = materialize(  # apart, so that Spark can split a hot text's rows in the join
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("ord"), F.sum("size").alias("gsize")).where("n > 1"),
        "shard-groups",
        compact=True,
    )
    placed = (
        rows.join(shared.select("key", "ord", "gsize").hint("merge"), "key", "left")
        .select("id", "size", "crc", "key", F.coalesce("ord", "id").alias("ord"), F.coalesce("gsize", "size").alias("gsize"))
        .withColumn("no_id", F.col("ord").isNotNull())
    )
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["no_id", "ord", "key", "id"]
    laid = materialize(
        placed.repartitionByRange(n, *order).select("*", F.spark_partition_id().alias("part")), "shard-rows"
    )
    here = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    parts = laid.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("gsize").alias("top")).orderBy("part").collect()
    offsets, at, seen = [], 0, 0
    for p in parts:  # one row for each of n partitions
        offsets.append((p.part, at, seen))
        at, seen = at + p.bytes, seen + p.n
    spark = docs.sparkSession
    starts = F.broadcast(spark.createDataFrame(offsets or [(0, 0, 0)], "part int, b0 long, n0 long"))
    ranked = materialize(
        laid.join(starts, "part")
        .select("id", "size", "crc", "key", "no_id", "ord", (F.sum("size").over(here) + F.col("b0")).alias("end"), (F.row_number().over(here) + F.col("n0") - 1).alias("rank")),
        "shard-ranks",
    )
    ends = ranked.groupBy("no_id", "ord", "key").agg(F.max("end").alias("end")).select("end")
    capacity, cuts = minimax_cuts(ends, at, max((p.top for p in parts), default=0), shards, resolution)
    number = F.lit(0)
    for c in cuts:
        number = number + (F.col("end") > c).cast("int")
    numbered = ranked.select("id", "size", "crc", "rank", number.cast("int").alias("shard"))
    first = F.broadcast(numbered.groupBy("shard").agg(F.min("rank").alias("r0")))  # a row for each shard
    return numbered.join(first, "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("rank") - F.col("r0")).cast("long").alias("slot")
    )
