import random

from series_cases import bag
from pyspark.sql import Window
from pyspark.sql import functions as F

from series_lake.operators import ranking as r


def markets(spark, values):
    return spark.createDataFrame([(f"c{i:05d}", v) for i, v in enumerate(values)], "id string, market_cap double")


def test_rank_equals_window_rank(spark):
    rng = random.Random(3)
    hot = [7.0] * 700 + [rng.uniform(0, 20) for _ in range(800)] + [float(rng.randrange(20)) for _ in range(500)] + [None] * 5
    for values in (hot, [], [None], [1.0], [5.0] * 10):
        frame = markets(spark, values)
        want = frame.withColumn("market_cap_rank", F.rank().over(Window.orderBy(F.desc_nulls_last("market_cap"))).cast("long"))
        for ranges, range_values in ((1, 1), (2, 1), (7, 1), (300, 1), (None, 20), (None, 1_000_000)):
            assert bag(r.with_rank(frame, ranges=ranges, range_values=range_values)) == bag(want)


def test_pages_and_positions(spark):
    frame = markets(spark, [3.0, None, 9.0, 9.0, 1.0, 4.0])
    order = ["c00002", "c00003", "c00005", "c00000", "c00004", "c00001"]
    assert [x.id for x in r.top_n(frame, 4).collect()] == order[:4]
    assert [x.id for n in (1, 2, 3) for x in r.page(frame, n, 2).collect()] == order
    assert [(x.id, x.position) for x in r.with_position(frame, 3).collect()] == list(zip(order, (1, 2, 3)))


def test_deep_page_holds_only_its_rows(spark):
    rng = random.Random(5)
    values = [7.0] * 300 + [rng.uniform(0, 20) for _ in range(300)] + [None] * 60
    frame = markets(spark, values)
    order = [x.id for x in frame.orderBy(F.desc_nulls_last("market_cap"), "id").collect()]
    for number in (9, 26, 28):
        assert [x.id for x in r.page(frame, number).collect()] == order[(number - 1) * 25 : number * 25]
        got = r.page(frame, number, held=0)
        assert [x.id for x in got.collect()] == order[(number - 1) * 25 : number * 25]
        assert "offset=" not in got._jdf.queryExecution().toString()
