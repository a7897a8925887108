"""Live state per key with a limited life, on Spark's arbitrary stateful operator and RocksDB.

A key's state ends ``life`` after its newest event, in event time: a timer is set there, moved by every
newer event, and clears the state when the watermark passes it. So the store holds the keys of the last
``life`` and not all that were ever seen. An event older than that whose key has no state any more
would start it anew with a part of the truth; it comes out marked ``late`` instead and goes to a side
table. What the state has given before is in the update log, so nothing is lost by either. ``KeyedLife`` holds any
state of a key; ``CountsInBuckets`` holds counts for many keys at once.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Merge = Callable[[tuple | None, Any], tuple]


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; a started query keeps its settings."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class KeyedLife(StatefulProcessor):
    """Folds the events of a key into a tuple and forgets it ``life_ms`` after its newest event.

    ``merge`` makes the tuple from itself (None at first) and an event with ``us``, its time in microseconds.
    ``show`` gives the fields of the row put out for a key in a micro-batch, from the tuple before and
    after; ``late`` those of an event that came too late. ``over`` ends a state early.
    """

    def __init__(self, key: str, schema: str, merge: Merge, show, late, life_ms: int, over: Callable[[tuple], bool] | None = None):
        self.key, self.schema, self.merge, self.show, self.late, self.life_ms, self.over = key, schema, merge, show, late, life_ms, over

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", f"newest_ms bigint, {self.schema}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self.state.get()
        before = None if held is None else tuple(held[1:])
        newest = None if held is None else held[0]
        now = before
        for row in rows:
            at = None if row.us is None else row.us // 1000
            if now is None and (at is None or at + self.life_ms <= watermark):
                yield Row(**{self.key: key[0], "kind": "late", **self.late(row)})
                continue
            now = self.merge(now, row)
            if at is not None and (newest is None or at > newest):
                newest = at
        if now == before:
            return
        yield Row(**{self.key: key[0], "kind": "update", **self.show(before, now)})
        if held is not None and (newest != held[0] or (self.over and self.over(now))):
            self.handle.deleteTimer(held[0] + self.life_ms)
        if self.over and self.over(now):
            self.state.clear()
            return
        self.state.update((newest, *now))
        if held is None or newest != held[0]:
            self.handle.registerTimer(newest + self.life_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def with_life(events: DataFrame, key: str, columns: dict[str, Column], processor: KeyedLife, output: str, delay: str) -> DataFrame:
    """The rows that ``processor`` puts out for events(key, ts, ...); ``columns`` are what it sees beside ``us``.

    The watermark is taken from ``ts``, but the time goes on as a number, so events behind the watermark
    are not dropped and reach the processor.
    """
    seen = events.withWatermark("ts", delay).select(key, F.unix_micros("ts").alias("us"), *[c.alias(n) for n, c in columns.items()])
    return seen.groupBy(key).transformWithState(processor, output, "Update", "EventTime")


BUCKETS = 1 << 14
ROWS_AT_ONCE = 1 << 20


class CountsInBuckets(StatefulProcessor):
    """Completed and failed items of every key, for a bucket of keys at a time.

    A call to the state costs far more than a count, so it is made once per bucket and not per key. The state is
    ``KeyedLife``'s: a key is forgotten ``life_ms`` after its newest event or when it is done, and what comes
    for a forgotten key with nothing newer in the micro-batch is marked ``late``. The timer of a bucket stands at
    or before the first end of a key; when it fires, it moves to the next one.
    """

    def __init__(self, kind: str, life_ms: int):
        self.kind, self.life_ms = kind, life_ms

    def init(self, handle) -> None:
        self.handle = handle
        numbers = ", ".join(f"{c} array<bigint>" for c in ("newest", "completed", "failed", "total"))
        self.state = handle.getValueState("state", f"due_ms bigint, ids array<{self.kind}>, {numbers}")

    def _keep(self, due: int, held: dict) -> None:
        newest, completed, failed, total = zip(*held.values())
        self.state.update((due, list(held), list(newest), list(completed), list(failed), list(total)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen: dict = {}
        for row in rows:
            for id_, *own in zip(row.id, row.completed, row.failed, row.us, row.total):
                had = seen.get(id_)
                seen[id_] = own if had is None else [had[0] + own[0], had[1] + own[1], _greater(had[2], own[2]), _greater(had[3], own[3])]
        watermark, before = timerValues.getCurrentWatermarkInMs(), self.state.get()
        due = None if before is None else before[0]
        held = {} if before is None else dict(zip(before[1], zip(*before[2:])))
        late, updates, changed = [], [], False
        for id_, (completed, failed, us, total) in seen.items():
            at, own = None if us is None else us // 1000, held.get(id_)
            if own is None and (at is None or at + self.life_ms <= watermark):
                late.append((id_, completed, failed, None))
                continue
            newest, *counts = own or (None, 0, 0, None)
            now = [counts[0] + completed, counts[1] + failed, total]
            if own is not None and now == counts:
                continue
            done = now[0] + now[1]
            updates.append((id_, completed, failed, int(done / total * 100) if total else None))
            if total is None or done < total:
                held[id_], changed = (_greater(newest, at), *now), True
            elif own is not None:
                del held[id_]
                changed = True
        if changed and held:
            first = min(x[0] for x in held.values()) + self.life_ms if due is None else due
            self._keep(first, held)
            if due is None:
                self.handle.registerTimer(first)
        elif changed:
            self.state.clear()
            if due is not None:
                self.handle.deleteTimer(due)
        for kind, found in (("late", late), ("update", updates)):
            if found:
                ids, completed, failed, progress = map(list, zip(*found))
                yield Row(bucket=key[0], kind=kind, ids=ids, completed=completed, failed=failed, progress=progress)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        before = self.state.get()
        if before is not None:
            watermark = timerValues.getCurrentWatermarkInMs()
            held = {i: x for i, x in zip(before[1], zip(*before[2:])) if x[0] + self.life_ms > watermark}
            if held:
                due = min(x[0] for x in held.values()) + self.life_ms
                self._keep(due, held)
                self.handle.registerTimer(due)
            else:
                self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _greater(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket of every stretch of a task's rows, with lists of its ids and their counts."""

    def summed(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how = {"completed": "sum", "failed": "sum", "us": "max", "total": "max"}
        ids = pa.Table.from_batches(some).group_by(["bucket", "id"], use_threads=False).aggregate(list(how.items()))
        ids = ids.select(["bucket", "id", *[f"{c}_{f}" for c, f in how.items()]]).rename_columns(["bucket", "id", *how])
        lists = ids.group_by("bucket", use_threads=False).aggregate([(c, "list") for c in ("id", *how)])
        lists = lists.select(["bucket", *[f"{c}_list" for c in ("id", *how)]]).rename_columns(["bucket", "id", *how])
        return iter(lists.to_batches(max_chunksize=10_000))

    some, rows = [], 0
    for batch in batches:
        some.append(batch)
        rows += batch.num_rows
        if rows >= ROWS_AT_ONCE:
            yield from summed(some)
            some, rows = [], 0
    if rows:
        yield from summed(some)


def counts_with_life(items: DataFrame, key: str, completed: Column, failed: Column, life_ms: int, delay: str) -> DataFrame:
    """items(key, ts, total) -> (key, kind, completed, failed, progress): what each micro-batch adds, and how far
    it brings the key, in whole percent."""
    kind = dict(items.dtypes)[key]
    columns = {"completed": completed.cast("bigint"), "failed": failed.cast("bigint"), "total": F.col("total").cast("bigint")}
    seen = items.withWatermark("ts", delay).select(F.col(key).alias("id"), F.unix_micros("ts").alias("us"), *[c.alias(n) for n, c in columns.items()])
    seen = seen.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int"))
    numbers = ", ".join(f"{c} array<bigint>" for c in ("completed", "failed", "us", "total"))
    in_buckets = seen.mapInArrow(_counted, f"bucket int, id array<{kind}>, {numbers}").groupBy("bucket")
    lists = f"ids array<{kind}>, completed array<bigint>, failed array<bigint>, progress array<bigint>"
    rows = in_buckets.transformWithState(CountsInBuckets(kind, life_ms), f"bucket int, kind string, {lists}", "Update", "EventTime")
    flat = rows.select("kind", F.inline(F.arrays_zip("ids", "completed", "failed", "progress")))
    return flat.select(F.col("ids").alias(key), "kind", "completed", "failed", "progress")
