"""Keyed state of one's own: visits told apart by gaps, running profiles, first rows with a time to live.

What a key keeps is in state variables of a value or a list, in RocksDB under the checkpoint, so a key's state may
be larger than a worker's memory and a query goes on where its checkpoint says. Rows meet the state in
micro-batches; the results do not depend on how rows are cut into batches, nor on their order within a batch.

Rows of a null key share the state of that key. Rows whose time is null are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def kept_on_disk(spark: SparkSession) -> Iterator[None]:
    """State variables need RocksDB; the setting counts when a query starts and is put back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Visits(StatefulProcessor):
    """Rows wait until the watermark has passed the end of their step, then come in order; a visit is given out once its gap has passed too.

    Times are microseconds. There is a timer for the first step of each batch's rows and of those that wait on, and one for the end
    of the open visit's gap; state is read and written once a timer, however many rows are due.
    """

    def __init__(self, key: str, gap: int, step: int):
        self.key, self.gap, self.step = key, gap, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, tie long, kind string, amount long")
        self.open = handle.getValueState("open", "first long, last long, n long, amount long")
        self.path = handle.getListState("path", "kind string")

    def _wake(self, at: int) -> None:
        self.handle.registerTimer((at // self.step + 1) * self.step // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        more = [(r["at_"], r["tie_"], r["kind_"], r["amount_"]) for r in rows]
        self.waiting.appendList(more)
        self._wake(min(m[0] for m in more))
        return iter([])

    def _row(self, key, visit, kinds) -> Row:
        first, last, n, amount = visit
        return Row(**{self.key: key[0]}, first=first, last=last, n=n, amount=amount, path=kinds)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # all steps the watermark has passed: timers set below are past them
        until = timerValues.getCurrentWatermarkInMs() * 1000 // self.step * self.step
        waiting = sorted(self.waiting.get(), key=lambda r: (r[0], r[1]))
        due = [r for r in waiting if r[0] < until]
        if due:
            rest = waiting[len(due) :]
            self.waiting.put(rest) if rest else self.waiting.clear()
            if rest:
                self._wake(rest[0][0])
        was = now = self.open.get() if self.open.exists() else None
        # kinds of the open visit that came now; those before are in state until it is closed
        kinds, stored = [], was is not None
        out = []

        def closed() -> Row:
            return self._row(key, now, ([k for (k,) in self.path.get()] if stored else []) + kinds)

        for at, _, kind, amount in due:
            if now and at - now[1] > self.gap:
                out.append(closed())
                now, kinds, stored = None, [], False
            now = (now[0] if now else at, at, (now[2] if now else 0) + 1, (now[3] if now else 0) + amount)
            kinds.append(kind)
        if now and now[1] + self.gap < until:
            out.append(closed())
            now, kinds, stored = None, [], False
        if was and not stored:
            self.path.clear()
        if now:
            if due:
                self.open.update(now)
            if kinds:
                self.path.appendList([(k,) for k in kinds])
            self._wake(now[1] + self.gap)
        elif was:
            self.open.clear()
        yield from out


def visits(df: DataFrame, key: str, ts: str, kind: Column, amount: Column, tie: Column, gap: str, late: str, step: str = "1 hour") -> DataFrame:
    """(key, first, last, n, amount, path) of each finished visit of a stream: rows of a key no more than gap apart, path their kinds in order of (ts, tie).

    A visit is given out, once, when the watermark, `late` behind the latest row, has passed the end of the step that holds
    the end of its gap. amount is a whole number and is summed. Rows older than the watermark are dropped.
    """
    from ..operators.asof import micros

    rows = df.where(F.col(ts).isNotNull()).select(F.col(key), F.col(ts).cast("timestamp").alias("ts_"), tie.cast("long").alias("tie_"), kind.cast("string").alias("kind_"), amount.cast("long").alias("amount_"))
    timed = rows.withWatermark("ts_", late).withColumn("at_", F.unix_micros("ts_"))
    out = f"{key} {df.schema[key].dataType.simpleString()}, first long, last long, n long, amount long, path array<string>"
    got = timed.groupBy(key).transformWithState(Visits(key, micros(gap), micros(step)), out, "append", "eventTime")
    at = [F.timestamp_micros(c).alias(c) for c in ("first", "last")]
    return got.select(key, *at, "n", "amount", "path")


class Profile(StatefulProcessor):
    """Running counts and sums of a key, and its latest rows."""

    def __init__(self, key: str, latest: int):
        self.key, self.latest = key, latest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "n long, amount long, low long, high long")
        self.recent = handle.getListState("recent", "at long, tie long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, amount, low, high = self.sums.get() if self.sums.exists() else (0, 0, None, None)
        recent = list(self.recent.get())
        for r in rows:
            n, amount, at = n + 1, amount + r["amount_"], r["at_"]
            low, high = at if low is None else min(low, at), at if high is None else max(high, at)
            recent.append((at, r["tie_"]))
            if len(recent) > 4 * self.latest + 64:
                recent = sorted(recent)[-self.latest :]
        recent = sorted(recent)[-self.latest :]
        self.sums.update((n, amount, low, high))
        self.recent.put(recent)
        yield Row(**{self.key: key[0]}, n=n, amount=amount, first=low, last=high, recent=[t for _, t in reversed(recent)])


def profiles(df: DataFrame, key: str, ts: str, amount: Column, tie: Column, latest: int = 3) -> DataFrame:
    """(key, n, amount, first, last, recent) of a stream, a row for each batch that has rows of a key; the one of largest n is the present one.

    recent holds the ties of the latest rows by (ts, tie), the latest first. Sums are of whole numbers.
    """
    rows = df.where(F.col(ts).isNotNull()).select(F.col(key), F.unix_micros(F.col(ts).cast("timestamp")).alias("at_"), tie.cast("long").alias("tie_"), amount.cast("long").alias("amount_"))
    out = f"{key} {df.schema[key].dataType.simpleString()}, n long, amount long, first long, last long, recent array<long>"
    got = rows.groupBy(key).transformWithState(Profile(key, latest), out, "update", "none")
    return got.select(key, "n", "amount", *[F.timestamp_micros(c).alias(c) for c in ("first", "last")], "recent")


class FirstSeen(StatefulProcessor):
    """The first row of a key, and the first after its state has lived its time."""

    def __init__(self, key: str, live: int):
        self.key, self.live = key, live

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", ttlDurationMs=self.live)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = min((r["at_"], r["tie_"]) for r in rows)
        if not self.seen.exists():
            self.seen.update((first[0],))
            yield Row(**{self.key: key[0]}, at=first[0], tie=first[1])


def first_seen(df: DataFrame, key: str, ts: str, tie: Column, live: str = "1 day") -> DataFrame:
    """(key, at, tie): the earliest row of a key in the first batch that has one; again if the key comes back after `live` of processing time."""
    from ..operators.asof import micros

    rows = df.where(F.col(ts).isNotNull()).select(F.col(key), F.unix_micros(F.col(ts).cast("timestamp")).alias("at_"), tie.cast("long").alias("tie_"))
    out = f"{key} {df.schema[key].dataType.simpleString()}, at long, tie long"
    got = rows.groupBy(key).transformWithState(FirstSeen(key, micros(live) // 1000), out, "append", "processingTime")
    return got.select(key, F.timestamp_micros("at").alias("at"), "tie")


def present(updates: DataFrame, key: str, order: str = "n") -> DataFrame:
    """The last of the rows that profiles gave for each key."""
    others = [c for c in updates.columns if c != key]
    return updates.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("u_")).select(key, *[F.col(f"u_.{c}").alias(c) for c in others])
