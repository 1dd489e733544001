"""Reconciling a stream of claims with what is known of each field, kept in state.

The state of a field (org, field) is its last claim; nothing else is read or written
when a run comes. Claims wait until the watermark has passed their time, so that
runs which arrive out of order within the allowed delay are compared in the order of
their times. A claim that comes later than that, or is older than what its field
has seen, goes to a side output and changes nothing.

The processor only keeps and pairs claims. What a pair means is told by the same
expressions that compare two snapshots (operators.reconcile).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import reconcile
from ..storage import ship

PARTS = ("value", "availability", "period", "currency", "statement", "evidence_id", "url", "retrieved_at", "sha", "first_seen", "items")
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HELD = ", ".join(["at long", *(f"{p} string" for p in PARTS)])
_OUT = ", ".join(["org string", "field string", "kind string", "at long", *(f"{side}_{p} string" for side in "pc" for p in PARTS)])


def _plain(x: object) -> str | None:
    return None if x is None or x != x else str(x)


class _Pairing(StatefulProcessor):
    """Pairs each claim of a field with the one before it, in the order of time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _HELD)
        self.waiting = handle.getListState("waiting", _HELD)

    def _row(self, key: tuple, kind: str, at: int, before: tuple | None, now: tuple) -> dict:
        sides = {f"p_{p}": v for p, v in zip(PARTS, before or (None,) * len(PARTS), strict=True)} | {f"c_{p}": v for p, v in zip(PARTS, now, strict=True)}
        return {"org": key[0], "field": key[1], "kind": kind, "at": at, **sides}

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        held = self.last.get()
        known = held[0] if held is not None else None
        late = []
        for frame in rows:
            for r in frame.itertuples(index=False):
                now = tuple(_plain(getattr(r, p)) for p in PARTS)
                at = int(r.at_ms)
                if passed > 0 and at <= passed or known is not None and at < known:
                    late.append(self._row(key, "late", at, None, now))
                else:
                    self.waiting.appendValue((at, *now))
                    self.handle.registerTimer(at)
        if late:
            yield pd.DataFrame(late)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        every = [tuple(x) for x in self.waiting.get()]
        due = sorted((x for x in every if x[0] <= passed), key=lambda x: x[0])  # of equal times in the order of arrival
        if not due:
            return
        held = self.last.get()
        before = tuple(held) if held is not None else None
        out = []
        for at, *now in due:
            out.append(self._row(key, "pair", at, before[1:] if before else None, tuple(now)))
            state, was = now[PARTS.index("availability")], before[1 + PARTS.index("availability")] if before else None
            if state in ("failed", "blocked") and was == "available":
                before = (at, *before[1:])  # kept, whatever the run could not read
            else:
                before = (at, *now)
        self.last.update(before)
        left = [x for x in every if x[0] > passed]
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def reconciled(claims: DataFrame, delay: str = "1 day", at: str = "at") -> DataFrame:
    """(org, field, kind, at, p, c) of a stream of claims with a timestamp ``at``, the time of their run.

    kind is ``pair`` for a claim and the one before it (p is null for the first), in
    the order of their times, or ``late``. The session's state store becomes RocksDB,
    which this kind of state needs.
    """
    spark = claims.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    marked = claims.withWatermark(at, delay)
    has = lambda c: c in claims.columns
    items = F.to_json("items") if has("items") else F.lit(None).cast("string")
    # the time goes on as a number: rows that are late by the watermark are told of, not dropped
    slim = marked.select("org", "field", F.unix_millis(at).alias("at_ms"), *(F.col(p) if has(p) else F.lit(None).cast("string").alias(p) for p in PARTS if p != "items"), items.alias("items"))
    flat = slim.groupBy("org", "field").transformWithStateInPandas(_Pairing(), _OUT, "Append", "EventTime")

    def side(s: str):  # noqa: ANN202
        parts = [F.from_json(f"{s}_items", reconcile.ITEMS).alias(p) if p == "items" else F.col(f"{s}_{p}").alias(p) for p in PARTS]
        return F.when(F.col(f"{s}_availability").isNotNull(), F.struct(*parts)).alias(s)

    return flat.select("org", "field", "kind", F.timestamp_millis("at").alias("at"), side("p"), side("c"))


def refresh(claims: DataFrame, emit: Callable[[DataFrame], None], late: Callable[[DataFrame], None], checkpoint: str, delay: str = "1 day", at: str = "at"):  # noqa: ANN201
    """Changes of a stream of claims, batch by batch, to emit; claims that came too late to late.

    Every batch of a query that is started again from its checkpoint is given again
    whole or not at all, as Structured Streaming does; emit and late get equal rows then.
    """

    def one(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        emit(reconcile.changes_of(batch.where("kind = 'pair'").select("org", "field", "p", "c", F.col("at").alias("changed_at")), "changed_at"))
        late(batch.where("kind = 'late'").select("org", "field", "at", "c.*"))
        batch.unpersist()

    return reconciled(claims, delay, at).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
