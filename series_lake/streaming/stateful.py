"""De-duplication with bounded state.

The state is keyed by asset and day slot: day number modulo ``slots``. A slot holds one day, the
newest it has seen of its asset, and the instants of that day that were delivered; a newer day takes
its place. So an asset has at most ``slots`` days of state, a hot asset is spread over its days,
and what is late is decided by the asset's own progress: a point is late only if its asset has
already delivered a day a multiple of ``slots`` days newer. No watermark over all assets takes part,
so a backfill of one asset is not late because others are ahead.

A timer ends a slot that got nothing for ``idle_ms``: its instants go, its day stays as closed, and
later points of that day are late. Timers follow the clock of the batches, which each row is
given when it arrives, so the watermark of that clock never drops a row.

A late point is not lost and not taken for new: it is written with the others, marked ``late``, and
``read_once`` compares the late points with the rows of their days when it reads. Points without
asset or valid time have no day and take the same way. The result is therefore one row per
key whatever the order in which files arrive; where repeats differ, the first arrival wins, among
those of one batch the one whose values are largest as text.

The slots of all assets are dealt over ``buckets`` by a hash of asset and slot, and the state has one
row per bucket: a batch calls the processor once per bucket it touches, not once per asset and day, and
reads and writes the slots of these buckets. Without ``buckets`` every slot has a row and a call of its
own, which suits few assets that deliver very many points a day. Both give the same rows.

Rows are written by a plain file sink, which commits each batch once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from series_lake.functions.timeconv import DAY_MS, floor_div, local_clock, utc_date, valid_ms
from series_lake.operators.merge import merge_history
from series_lake.schemas import DESCRIPTIVE, FLAT, FLAT_DATED, KEY, LEGS
from series_lake.sinks.publish import touched_days
from series_lake.sources.files import scan_if_exists

# The processor travels to the executors with the job: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Days of an asset that are held at once.
SLOTS = 64
#: A slot without arrivals for so long is closed.
IDLE_MS = 7 * DAY_MS
#: Rows of the state that hold the slots of all assets.
BUCKETS = 4096
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTING = "spark.sql.streaming.stateStore.providerClass"

_PAYLOAD = T.StructType([f for f in FLAT.fields if f.name in (*DESCRIPTIVE, *LEGS)])
_SENT = ["coin_id", "timestamp", "payload"]
_OUT = "coin_id string, timestamp long, payload string, late boolean"
_LAID = T.StructType([*FLAT.fields, T.StructField("late", T.BooleanType()), T.StructField("date", T.DateType())])


class OncePerInstant(StatefulProcessor):
    """Lets the first row of each instant of its day through and marks rows of older days late."""

    def __init__(self, idle_ms: int = IDLE_MS):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the slot's day, whether it is closed, and its instants as numbers within the day
        self.slot = handle.getValueState("slot", "day long, closed boolean, timer long, seen array<int>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[1] < 0:  # without a day
            for frame in rows:
                yield frame[_SENT].assign(late=True)
            return
        arrived = pd.concat(list(rows), ignore_index=True)  # the points of a day or so
        held = self.slot.get()
        day, closed, timer, seen = held if held is not None else (None, False, None, None)
        newest = int(arrived["day"].max())
        if day is None or newest > day:
            day, closed, seen = newest, False, None
        late = (arrived["day"] < day) | closed
        if not closed:
            best = arrived[~late].sort_values("payload", ascending=False, kind="stable").drop_duplicates("within")
            known = set(seen or ())
            fresh = best[~best["within"].isin(known)]
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = int(arrived["clock"].max()) + self.idle_ms
            self.handle.registerTimer(timer)
            self.slot.update((day, False, timer, sorted(known | set(fresh["within"].tolist()))))
            if len(fresh):
                yield fresh[_SENT].assign(late=False)
        if late.any():
            yield arrived.loc[late, _SENT].assign(late=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.slot.get()
        if held is not None and held[2] == expiredTimerInfo.getExpiryTimeInMs():
            self.slot.update((held[0], True, None, []))
        return iter(())

    def close(self) -> None:
        pass


class OncePerInstantOfMany(StatefulProcessor):
    """The same for the slots of a bucket at once."""

    def __init__(self, idle_ms: int = IDLE_MS):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # one timer, not after the first end of an open slot; of each slot what ``OncePerInstant`` holds of its own
        self.bucket = handle.getValueState("bucket", "timer long, slots array<struct<coin_id string, slot long, day long, closed boolean, ends long, seen array<int>>>")

    def _held(self) -> tuple[int | None, dict[tuple[str, int], tuple]]:
        held = self.bucket.get()
        return (held[0], {(s[0], s[1]): tuple(s[2:]) for s in held[1]}) if held is not None else (None, {})

    def _hold(self, timer: int | None, slots: dict[tuple[str, int], tuple]) -> None:
        first = min((ends for _, closed, ends, _ in slots.values() if not closed), default=None)
        if timer is not None and first is not None and first < timer:
            self.handle.deleteTimer(timer)
            timer = None
        if timer is None and first is not None:
            timer = first
            self.handle.registerTimer(timer)
        self.bucket.update((timer, [(*key, *slot) for key, slot in slots.items()]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:  # without a day
            for frame in rows:
                yield frame[_SENT].assign(late=True)
            return
        arrived = pd.concat(list(rows), ignore_index=True)
        timer, slots = self._held()
        by_slot = arrived.groupby(["coin_id", "slot"], sort=False)
        number, met = by_slot.ngroup().to_numpy(), by_slot.agg(day=("day", "max"), clock=("clock", "max"))
        known: list[tuple[int, bool, list[int]]] = []  # day, closed and instants of the slots that are met, by number
        for at, newest in zip(met.index, met["day"].tolist(), strict=True):
            day, closed, _, seen = slots.get(at, (None, False, None, None))
            known.append((newest, False, []) if day is None or newest > day else (day, closed, seen or []))
        days, shut = np.array([k[0] for k in known]), np.array([k[1] for k in known])
        late = (arrived["day"].to_numpy() < days[number]) | shut[number]
        # an instant of a slot as one number
        instant = number * DAY_MS + arrived["within"].to_numpy()
        on_time = arrived.assign(number=number, instant=instant)[~late]
        again = on_time["instant"].duplicated(keep=False)
        best = pd.concat([on_time[~again], on_time[again].sort_values("payload", ascending=False, kind="stable").drop_duplicates("instant")])
        seen = np.array([i * DAY_MS + w for i, k in enumerate(known) for w in k[2]], dtype=np.int64)
        fresh = best[~np.isin(best["instant"].to_numpy(), seen)]
        added = fresh.groupby("number")["within"].agg(list).to_dict()
        for i, (at, clock) in enumerate(zip(met.index, met["clock"].tolist(), strict=True)):
            day, closed, within = known[i]
            if not closed:
                slots[at] = (day, False, clock + self.idle_ms, sorted(within + added.get(i, [])))
        self._hold(timer, slots)
        if len(fresh):
            yield fresh[_SENT].assign(late=False)
        if late.any():
            yield arrived.loc[late, _SENT].assign(late=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        timer, slots = self._held()
        if timer == expiredTimerInfo.getExpiryTimeInMs():
            now = timerValues.getCurrentWatermarkInMs()
            ended = {at: (slot[0], True, None, []) for at, slot in slots.items() if not slot[1] and slot[2] <= now}
            self._hold(None, slots | ended)
        return iter(())

    def close(self) -> None:
        pass


def stream_dedupe_stateful(flat: DataFrame, target: str, checkpoint: str, slots: int = SLOTS, idle_ms: int = IDLE_MS, partitions: int | None = None, buckets: int | None = BUCKETS) -> StreamingQuery:
    """New points to the files in ``target``, once per key, state bounded by ``slots`` days per asset.

    Read the result with ``read_once``. ``partitions`` of the state and ``buckets`` stay what they are at the
    first start with a checkpoint; by default there are as many partitions as a shuffle has.
    """
    spark = flat.sparkSession
    payload = F.to_json(F.struct(*_PAYLOAD.names)).alias("payload")
    day = floor_div(valid_ms(F.col("timestamp")), DAY_MS)
    dayless = F.col("coin_id").isNull() | day.isNull()
    slot = F.when(dayless, -1 - F.pmod(F.xxhash64("timestamp", "payload"), F.lit(slots))).otherwise(F.pmod("day", F.lit(slots)))
    # Never null: one null would make floats of all the numbers in its batch, which the state does not take.
    within = F.coalesce(F.pmod("timestamp", F.lit(DAY_MS)).cast("int"), F.lit(0)).alias("within")
    read = flat.select(*KEY, payload, F.coalesce(day, F.lit(0)).alias("day"), within, F.current_timestamp().alias("arrived"))
    clocked = read.withColumns({"slot": slot, "clock": F.unix_millis("arrived")}).withWatermark("arrived", "1 minute")
    if buckets:
        bucket = F.when(dayless, -1 - F.pmod(F.xxhash64("timestamp", "payload"), F.lit(buckets))).otherwise(F.pmod(F.xxhash64("coin_id", "slot"), F.lit(buckets)))
        keyed, processor = clocked.withColumn("bucket", bucket).groupBy("bucket"), OncePerInstantOfMany(idle_ms)
    else:
        keyed, processor = clocked.groupBy("coin_id", "slot"), OncePerInstant(idle_ms)
    once = keyed.transformWithStateInPandas(processor, outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    told = once.select("*", F.from_json("payload", _PAYLOAD).alias("v"))
    rows = told.select(*KEY, *[F.col(f"v.{c}").alias(c) for c in _PAYLOAD.names], local_clock(F.col("timestamp")).alias("date_time"), "late", utc_date(F.col("timestamp")).alias("date"))
    own = {SETTING: PROVIDER} | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    before = {key: spark.conf.get(key) for key in own}
    for key, value in own.items():  # of this query alone: it keeps the settings it starts with
        spark.conf.set(key, value)
    try:
        return (
            rows.select(*_LAID.names).writeStream.format("parquet").partitionBy("late", "date")
            .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def late_points(spark: SparkSession, target: str) -> DataFrame:
    """The points that came late, or have no day, repeats included."""
    return scan_if_exists(spark, target, _LAID).where("late").select(*FLAT_DATED.names)


def read_once(spark: SparkSession, target: str) -> DataFrame:
    """One row per key. Late points are compared with the rows of their days; other days are read
    as they are."""
    rows = scan_if_exists(spark, target, _LAID)
    fresh = rows.where("not late").select(*FLAT_DATED.names)
    late = late_points(spark, target)
    days = touched_days(late)
    if not days:
        return fresh.select(*FLAT.names)
    same_days = fresh.where(F.col("date").isin([d for d in days if d is not None])).select("date", *[F.col(c).alias(f"_{c}") for c in KEY])
    on = (late["date"] == same_days["date"]) & (late["coin_id"] == same_days["_coin_id"]) & (late["timestamp"] == same_days["_timestamp"])
    added = merge_history(late.join(same_days, on, "left_anti"), None, ["date", *KEY])
    return fresh.unionByName(added.select(*FLAT_DATED.names)).select(*FLAT.names)
