import random

import pytest
from series_cases import bag
from pyspark.sql import Window
from pyspark.sql import functions as F

from series_lake.functions.timeconv import DAY_MS, HOUR_MS
from series_lake.operators import metrics as m


def plain(flat):
    frame = Window.partitionBy("coin_id").orderBy("timestamp").rangeBetween(-DAY_MS, 0)
    so_far = Window.partitionBy("coin_id").orderBy("timestamp").rangeBetween(Window.unboundedPreceding, 0)
    first = F.first("price", ignorenulls=True).over(frame)
    return flat.select(
        "coin_id", "timestamp", "price",
        F.max("price").over(frame).alias("high_24h"),
        F.min("price").over(frame).alias("low_24h"),
        (F.col("price") - first).alias("price_change_24h"),
        F.try_divide((F.col("price") - first) * 100, first).alias("price_change_percentage_24h"),
        F.max("price").over(so_far).alias("ath"),
        F.min("price").over(so_far).alias("atl"),
    )


def points(seed, step):
    rng = random.Random(seed)
    rows = {}
    for _ in range(400):
        # one asset holds most rows; times sit on and around block and frame edges, also before 1970
        coin = "hot" if rng.random() < 0.7 else rng.choice("abc")
        at = rng.randrange(-3 * DAY_MS // step, 4 * DAY_MS // step) * step + rng.choice([0, 0, 1, -1])
        rows[coin, at] = rng.choice([None, 0.0, *range(1, 50)])
    return [(c, t, None if p is None else float(p)) for (c, t), p in rows.items()]


@pytest.mark.parametrize("block", [HOUR_MS, DAY_MS, 15 * 60_000])
@pytest.mark.parametrize("step", [HOUR_MS, 20 * 60_000, DAY_MS // 2])
def test_blocks_equal_plain_windows(spark, block, step):
    flat = spark.createDataFrame(points(block + step, step), "coin_id string, timestamp long, price double")
    want = plain(flat)
    assert bag(m.price_metrics(flat, block)) == bag(want)
    assert bag(m.rolling_24h(flat, block)) == bag(want.drop("ath", "atl"))
    assert bag(m.all_time(flat, block)) == bag(want.select("coin_id", "timestamp", "price", "ath", "atl"))


def test_block_must_divide_the_frame(spark):
    with pytest.raises(ValueError):
        m.rolling_24h(spark.createDataFrame([], "coin_id string, timestamp long, price double"), 7 * HOUR_MS)


def test_rows_survive_repeated_keys(spark):
    flat = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("a", DAY_MS + 1, 3.0)], "coin_id string, timestamp long, price double")
    got = sorted((r.timestamp, r.price, r.high_24h, r.low_24h) for r in m.rolling_24h(flat).collect())
    assert got == [(1, 1.0, 2.0, 1.0), (1, 2.0, 2.0, 1.0), (DAY_MS + 1, 3.0, 3.0, 1.0)]


def test_snapshot_extremes_supply(spark):
    rows = [("a", 1, 5.0, 10.0), ("a", 3, 2.0, 10.0), ("a", 2, 5.0, 10.0), ("a", 4, None, 10.0), ("b", 1, 0.0, 10.0)]
    flat = spark.createDataFrame(rows, "coin_id string, timestamp long, price double, market_cap double")
    assert sorted((r.coin_id, r.timestamp, r.price) for r in m.latest_snapshot(flat).collect()) == [("a", 4, None), ("b", 1, 0.0)]
    assert sorted(map(tuple, m.series_extremes(flat).collect())) == [("a", 5.0, 1, 2.0, 3), ("b", 0.0, 1, 0.0, 1)]
    supply = {(r.coin_id, r.timestamp): r.circulating_supply for r in m.circulating_supply(flat).collect()}
    assert supply["b", 1] is None and supply["a", 1] == 2.0


def test_rows_without_a_key_stay(spark):
    rows = [("a", 1, 1.0), (None, 1, 2.0), ("a", None, 3.0), ("a", 2, 4.0)]
    flat = spark.createDataFrame(rows, "coin_id string, timestamp long, price double")
    for measured in (m.rolling_24h(flat), m.all_time(flat), m.price_metrics(flat)):
        assert measured.count() == len(rows)
        added = [c for c in measured.columns if c not in flat.columns]
        assert all(r[c] is None for r in measured.where("coin_id IS NULL OR timestamp IS NULL").collect() for c in added)
