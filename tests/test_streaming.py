import pytest
from series_cases import bag, document
from test_merge import flat, prices

from series_lake.functions.timeconv import DAY_MS, HOUR_MS
from series_lake.operators.flatten import flatten_series
from series_lake.schemas import FLAT, FLAT_DATED, RAW_STRICT, WH_HIST
from series_lake.sinks.publish import land_bulk, publish_history
from series_lake.sinks.warehouse import incremental_load, map_hist
from series_lake.sources.files import scan_published, scan_raw
from series_lake.streaming import increments as s


def test_stream_flatten_equals_batch_and_loads_once(spark, landed, tmp_path):
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    folder = landed(
        document("a", [[1, 1.0], [2, 2.0], [2, 3.0]], [[2, 1.0], [1, 1.0]], [[1, 1.0], [2, 1.0], [2, 5.0]]),
        document("b", [[1, 1.0]], [[1, 1.0]], [[1, 1.0]]),
        document("c", [[1, 1.0]], [], [[1, 1.0]]),
    )

    def run():
        s.stream_flatten(s.stream_raw(spark, folder, max_files=1), target, checkpoint).awaitTermination()
        return bag(s.read_flat(spark, target))

    first = run()
    assert first == bag(flatten_series(scan_raw(spark, folder)))
    assert run() == first
    landed(document("d", [[1, 1.0]], [[1, 1.0]], [[1, 1.0]]))
    assert len(run()) == len(first) + 1


def test_stream_merge_replay_changes_nothing(spark, tmp_path):
    arriving, history = str(tmp_path / "in"), str(tmp_path / "h")
    publish_history(spark, flat(spark, ("x", 1, 1), ("x", 2, 1)), history)
    flat(spark, ("x", 2, 5), ("x", DAY_MS, 5)).write.parquet(arriving)
    for attempt in range(2):
        s.stream_merge(spark.readStream.schema(FLAT).parquet(arriving), history, str(tmp_path / f"cp{attempt}")).awaitTermination()
        assert prices(scan_published(spark, history)) == [("x", 1, 1.0), ("x", 2, 5.0), ("x", DAY_MS, 5.0)]


def test_stream_flatten_repeats_nothing_after_a_second_landing(spark, landed, tmp_path):
    zone, target, checkpoint = (str(tmp_path / n) for n in ("zone", "out", "cp"))

    def land(name, *coins, price=1.0):
        points = [[1, price], [2, price]] if price else []
        lines = [document(c, points, points, points) for c in coins]
        land_bulk(spark, scan_raw(spark, landed(*lines, name=name), RAW_STRICT), zone, "normal")
        s.stream_flatten(s.stream_raw(spark, f"{zone}/prefix=historical_data"), target, checkpoint).awaitTermination()
        return sorted((r.coin_id, r.timestamp, r.price) for r in s.read_flat(spark, target).collect())

    both = [(c, t, 1.0) for c in "ab" for t in (1, 2)]
    assert land("first", "a", "b") == both
    assert land("second", "c") == both + [("c", 1, 1.0), ("c", 2, 1.0)]
    assert land("third", "a", price=2.0) == [("a", 1, 2.0), ("a", 2, 2.0)] + both[2:] + [("c", 1, 1.0), ("c", 2, 1.0)]
    assert land("fourth", "a", "b", "c", price=None) == []


def test_stream_flatten_joins_split_assets(spark, landed, tmp_path):
    folder = landed(document("a", [[1, 1.0]]), document("a", [], [[1, 2.0]], [[1, 3.0]]))
    s.stream_flatten(s.stream_raw(spark, folder), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert bag(s.read_flat(spark, str(tmp_path / "o"))) == bag(flatten_series(scan_raw(spark, folder)))
    with pytest.raises(Exception, match="several documents"):
        flatten_series(scan_raw(spark, folder), strategy="document").collect()


def test_stream_dedupe_first_arrival_wins(spark, tmp_path):
    arriving, target, checkpoint, repeats = (str(tmp_path / n) for n in ("in", "out", "cp", "again"))
    day = 100 * DAY_MS
    runs = (
        [("x", day, 1), ("x", day + 40 * HOUR_MS, 1)],
        [("x", day + 40 * HOUR_MS, 2), ("x", day, 2), ("x", day + 41 * HOUR_MS, 2)],
    )
    for rows in runs:
        flat(spark, *rows).write.mode("append").parquet(arriving)
        s.stream_dedupe(spark.readStream.schema(FLAT).parquet(arriving), target, checkpoint, repeats).awaitTermination()
    got = prices(s.read_flat(spark, target))
    assert got == [("x", day, 1.0), ("x", day + 40 * HOUR_MS, 1.0), ("x", day + 41 * HOUR_MS, 2.0)]
    again = spark.read.parquet(repeats).collect()
    assert sorted((r.timestamp, r.dropped) for r in again) == [(day, 1), (day + 40 * HOUR_MS, 1)]


@pytest.mark.parametrize("files", [1, 2, 1000])
def test_stream_dedupe_does_not_depend_on_batches(spark, tmp_path, files):
    """Every file holds other assets and spans a month; some points are delivered twice."""
    arriving, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(f"c{i % 8}", 100 * DAY_MS + i * HOUR_MS, i) for i in range(700)]
    flat(spark, *rows, *rows[::3]).repartition(4, "coin_id").write.parquet(arriving)
    stream = spark.readStream.schema(FLAT).option("maxFilesPerTrigger", files).parquet(arriving)
    s.stream_dedupe(stream, target, str(tmp_path / "cp")).awaitTermination()
    assert prices(s.read_flat(spark, target)) == sorted((c, t, float(v)) for c, t, v in rows)


def test_incremental_load(spark, tmp_path):
    published, target, checkpoint = (str(tmp_path / n) for n in ("p", "t", "cp"))

    def load():
        return incremental_load(spark, published, FLAT_DATED, map_hist, target, WH_HIST, checkpoint, max_files=1).count()

    publish_history(spark, flat(spark, ("x", 1, 1), ("x", 2, 1)), published)
    assert load() == 2
    assert load() == 2
    publish_history(spark, flat(spark, ("x", DAY_MS, 1)), published)
    assert load() == 3
    # a run that overlaps: days are rewritten, rows must not come twice
    publish_history(spark, flat(spark, ("x", 2, 5), ("x", DAY_MS, 1), ("y", DAY_MS + 1, 1)), published)
    assert load() == 4
    loaded = incremental_load(spark, published, FLAT_DATED, map_hist, target, WH_HIST, checkpoint)
    assert bag(loaded) == bag(map_hist(scan_published(spark, published)))
