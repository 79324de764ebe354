import pandas as pd
import pytest
from series_cases import bag, document
from test_merge import flat

from series_lake.functions.timeconv import DAY_MS
from series_lake.operators.flatten import flatten_series
from series_lake.schemas import FLAT
from series_lake.sources.files import scan_raw
from series_lake.streaming import increments as s
from series_lake.streaming import stateful

DAYS = 12
POINTS = [("hot", d * DAY_MS + m * 60_000, float(d + m)) for d in range(DAYS) for m in range(40)]
POINTS += [(c, d * DAY_MS + 5, 1.0) for c in ("slow", "fast") for d in range(DAYS)]


def deliver(spark, folder, rows):
    flat(spark, *rows).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, target, checkpoint, **options):
    source = spark.readStream.schema(FLAT).parquet(folder)
    query = stateful.stream_dedupe_stateful(source, target, checkpoint, **options)
    query.awaitTermination()
    return query.recentProgress


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_any_order_of_files_gives_each_point_once(spark, tmp_path, order):
    third = len(POINTS) // 3
    newest_first = sorted(POINTS, key=lambda p: -p[1])
    parts = [newest_first[:third] + POINTS[:30], newest_first[third : 2 * third], newest_first[2 * third :] + newest_first[:20]]
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for k in order:
        deliver(spark, folder, parts[k])
        progress = run(spark, folder, target, checkpoint, slots=4)
    got = stateful.read_once(spark, target)
    assert got.columns == FLAT.names
    assert sorted((r.coin_id, r.timestamp, r.price) for r in got.collect()) == sorted(POINTS)
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 2 * 3 * 4  # a slot and its timer for each of four days of three assets


def test_late_points_are_marked_and_none_is_lost(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    day = lambda d: d * DAY_MS + 1
    deliver(spark, folder, [("a", day(20), 1), ("b", day(1), 1)])
    run(spark, folder, target, checkpoint, slots=10)
    assert stateful.late_points(spark, target).count() == 0
    # b is 19 days behind a and still not late; a's tenth day is, a's eleventh has a slot of its own
    deliver(spark, folder, [("a", day(10), 2), ("a", day(11), 2), ("b", day(2), 2), ("b", day(1), 9), ("a", day(10), 2), (None, 5, 1), ("a", None, 1), (None, 5, 1)])
    run(spark, folder, target, checkpoint, slots=10)
    assert sorted((r.coin_id or "", r.timestamp or 0) for r in stateful.late_points(spark, target).collect()) == [("", 5), ("", 5), ("a", 0), ("a", day(10)), ("a", day(10))]
    got = sorted((r.coin_id or "", r.timestamp or 0, r.price) for r in stateful.read_once(spark, target).collect())
    assert got == sorted([("a", day(20), 1.0), ("b", day(1), 1.0), ("a", day(10), 2.0), ("a", day(11), 2.0), ("b", day(2), 2.0), ("", 5, 1.0), ("a", 0, 1.0)])


def test_largest_of_one_batch_wins_and_a_replayed_run_adds_nothing(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    deliver(spark, folder, [("a", 1, 1), ("a", 1, 3), ("a", 1, 2), ("a", 2, None)])
    for _ in range(2):
        run(spark, folder, target, checkpoint)
        assert sorted((r.timestamp, r.price) for r in stateful.read_once(spark, target).collect()) == [(1, 3.0), (2, None)]


class Handle:
    def __init__(self):
        self.held, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Expired:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


def test_an_idle_slot_is_closed_and_its_day_is_late():
    handle, processor = Handle(), stateful.OncePerInstant(idle_ms=100)
    processor.init(handle)

    def arrive(day, within, clock):
        rows = pd.DataFrame({"coin_id": "a", "timestamp": [day * DAY_MS + w for w in within], "payload": "{}", "day": day, "within": within, "clock": clock})
        return [(r.timestamp, r.late) for f in processor.handleInputRows(("a", 3), iter([rows]), None) for r in f.itertuples()]

    assert arrive(3, [1, 2, 1], 1000) == [(3 * DAY_MS + 1, False), (3 * DAY_MS + 2, False)]
    assert arrive(3, [2, 3], 1050) == [(3 * DAY_MS + 3, False)]
    assert handle.timers == {1150} and handle.held[3] == [1, 2, 3]
    list(processor.handleExpiredTimer(("a", 3), None, Expired(1100)))  # of an earlier arrival
    assert handle.held[3] == [1, 2, 3]
    list(processor.handleExpiredTimer(("a", 3), None, Expired(1150)))
    assert handle.held == (3, True, None, [])
    assert arrive(3, [1, 4], 2000) == [(3 * DAY_MS + 1, True), (3 * DAY_MS + 4, True)]
    assert arrive(67, [4], 2000) == [(67 * DAY_MS + 4, False)]


def test_stateless_flatten_reads_the_newest_delivery(spark, landed, tmp_path):
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    folder = landed(
        document("a", [[1, 1.0], [2, 2.0], [2, 3.0]], [[2, 1.0], [1, 1.0]], [[1, 1.0], [2, 1.0], [2, 5.0]]),
        document("b", [[1, 1.0]], [[1, 1.0]], [[1, 1.0]]),
        document("c", [[1, 1.0]], [], [[1, 1.0]]),
    )

    def step():
        s.stream_flatten_documents(s.stream_delivered(spark, folder, max_files=1), target, checkpoint).awaitTermination()
        return bag(s.read_newest(spark, target))

    first = step()
    assert first == bag(flatten_series(scan_raw(spark, folder))) and step() == first
    landed(document("b", [[7, 1.0]], [[7, 1.0]], [[7, 1.0]]), document("d", [[1, 1.0]], [[1, 1.0]], [[1, 1.0]]))
    second = [(r[0], r[1]) for r in (step(), s.read_newest(spark, target).collect())[1]]
    assert sorted(second) == [("a", 1), *[("a", 2)] * 4, ("b", 7), ("d", 1)]
    landed(document("a", [], [], []))  # delivered empty: its rows go
    step()
    assert sorted(r.coin_id for r in s.read_newest(spark, target).collect()) == ["b", "d"]


def test_stateless_flatten_plan_has_no_exchange(spark, landed, tmp_path):
    folder = landed(document("a", [[1, 1.0]], [[1, 1.0]], [[1, 1.0]]))
    query = s.stream_flatten_documents(s.stream_delivered(spark, folder), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    plan = query._jsq.explainInternal(True)
    assert "Exchange" not in plan and "Join" not in plan and "foreachBatch" not in plan.lower()


def test_many_assets_share_rows_of_state_and_give_what_rows_of_their_own_give(spark, tmp_path):
    days = lambda low, high: [(f"a{c}", d * DAY_MS + m, float(c + d + m)) for c in range(60) for d in range(low, high) for m in (1, 2)]
    parts = [days(3, 6) + [(None, 7, 1.0)], days(0, 6) + [("a1", 4 * DAY_MS + 3, 9.0)] * 2, days(0, 3) + [("a1", 4 * DAY_MS + 1, 9.0)]]
    got = {}
    for buckets in (None, 8):
        folder, target, checkpoint = (str(tmp_path / f"{n}{buckets}") for n in ("in", "out", "cp"))
        for part in parts:
            deliver(spark, folder, part)
            progress = run(spark, folder, target, checkpoint, slots=4, partitions=4, buckets=buckets)
        late = sorted((r.coin_id or "", r.timestamp, r.price) for r in stateful.late_points(spark, target).collect())
        got[buckets] = late, sorted((r.coin_id or "", r.timestamp, r.price) for r in stateful.read_once(spark, target).collect())
        held = progress[-1]["stateOperators"][0]["numRowsTotal"]
    assert got[8] == got[None] and got[8][1] == sorted([("", 7, 1.0), ("a1", 4 * DAY_MS + 3, 9.0), *days(0, 6)])
    assert held <= 2 * 8  # a row and a timer per bucket, not per asset and day


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def test_slots_of_a_bucket_are_closed_one_by_one():
    handle, processor = Handle(), stateful.OncePerInstantOfMany(idle_ms=100)
    processor.init(handle)

    def arrive(clock, *points):
        rows = pd.DataFrame([{"coin_id": c, "slot": d % 64, "timestamp": d * DAY_MS + w, "payload": p, "day": d, "within": w, "clock": clock} for c, d, w, p in points])
        return sorted((r.coin_id, r.timestamp, r.payload, r.late) for f in processor.handleInputRows((3,), iter([rows[:1], rows[1:]]), None) for r in f.itertuples())

    def expire(at, watermark):
        list(processor.handleExpiredTimer((3,), Clock(watermark), Expired(at)))
        handle.timers.discard(at)  # as Spark does

    assert arrive(1000, ("a", 3, 1, "x"), ("a", 3, 1, "y"), ("b", 3, 1, "x")) == [("a", 3 * DAY_MS + 1, "y", False), ("b", 3 * DAY_MS + 1, "x", False)]
    assert arrive(1050, ("b", 3, 1, "z"), ("b", 3, 2, "x")) == [("b", 3 * DAY_MS + 2, "x", False)]
    assert handle.timers == {1100}
    expire(1100, 1120)
    assert handle.timers == {1150}  # a is closed, b still open
    assert arrive(1120, ("a", 3, 5, "x"), ("b", 3, 3, "x"), ("b", 67, 3, "x"), ("c", 3, 3, "x")) == sorted(
        [("a", 3 * DAY_MS + 5, "x", True), ("b", 3 * DAY_MS + 3, "x", True), ("b", 67 * DAY_MS + 3, "x", False), ("c", 3 * DAY_MS + 3, "x", False)]
    )
    assert arrive(990, ("d", 3, 1, "x")) == [("d", 3 * DAY_MS + 1, "x", False)]  # a clock behind the others
    assert handle.timers == {1090}
    expire(1090, 5000)
    assert handle.timers == set()
    assert all(late for *_, late in arrive(5000, ("b", 67, 3, "x"), ("c", 3, 4, "x"), ("d", 3, 2, "x")))
    assert arrive(5000, ("a", 67, 1, "x")) == [("a", 67 * DAY_MS + 1, "x", False)]


@pytest.mark.parametrize("buckets", [4, None])
def test_points_without_time_leave_the_others_of_their_batch_as_they_are(spark, tmp_path, buckets):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    points = [("a", 5 * DAY_MS + m, 1.0) for m in (1, 2)] + [("b", 5 * DAY_MS + 3, 1.0)]
    for _ in range(3):
        deliver(spark, folder, [("a", None, 1), (None, 4, 1), *points])
        run(spark, folder, target, checkpoint, slots=4, buckets=buckets)
    got = sorted((r.coin_id or "", r.timestamp or 0, r.price) for r in stateful.read_once(spark, target).collect())
    assert got == sorted([("a", 0, 1.0), ("", 4, 1.0), *points])
    assert stateful.late_points(spark, target).count() == 6
