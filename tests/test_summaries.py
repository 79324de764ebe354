import datetime
import random
import re

from pyspark.sql import functions as F
from series_cases import bag
from test_merge import flat

from series_lake.functions.timeconv import DAY_MS
from series_lake.operators.metrics import price_metrics
from series_lake.sinks.publish import merge_days, touched_days
from series_lake.sinks.summaries import metrics_with_history, read_summaries, update_summaries
from series_lake.sources.files import scan_published

D0 = 19_800


def day(n):
    return datetime.date(1970, 1, 1) + datetime.timedelta(days=D0 + n)


def rows(rng, days, n=12):
    out = {}
    for asset in ("a", "b"):
        for d in days:
            for _ in range(n):
                out[asset, (D0 + d) * DAY_MS + rng.randrange(DAY_MS)] = rng.choice([None, *[float(rng.randrange(1000))] * 9])
    return [(c, t, p) for (c, t), p in out.items()]


def test_metrics_of_a_run_equal_those_over_all_history(spark, tmp_path):
    rng = random.Random(3)
    history, summaries = str(tmp_path / "h"), str(tmp_path / "s")
    for days in (range(0, 6), range(4, 9), (0, 8, 10)):
        touched = merge_days(spark, flat(spark, *rows(rng, days)), history)
        update_summaries(spark, history, touched, summaries)
    stored = scan_published(spark, history)
    again = str(tmp_path / "again")
    update_summaries(spark, history, [r.date for r in stored.select("date").distinct().collect()], again)
    assert bag(read_summaries(spark, summaries)) == bag(read_summaries(spark, again))
    # the run: a day inside the history, one beyond it, and rows that replace some of the history's
    replaced = [(r.coin_id, r.timestamp, 5000.0) for r in stored.where(f"date = '{day(5)}'").limit(4).collect()]
    run = flat(spark, *rows(rng, (5, 11)), *replaced, (None, 5, 1.0), ("a", None, 1.0))
    got = metrics_with_history(spark, run, [day(5), day(11), None], history, summaries)
    keys = {(r.coin_id, r.timestamp) for r in run.collect()}
    older = [r for r in stored.drop("date").collect() if (r.coin_id, r.timestamp) not in keys]
    everything = price_metrics(run.unionByName(spark.createDataFrame(older, run.schema)))
    want = everything.join(run.select("coin_id", "timestamp").distinct().toDF("c", "t"), F.col("coin_id").eqNullSafe(F.col("c")) & F.col("timestamp").eqNullSafe(F.col("t")), "left_semi")
    assert bag(got.select(*want.columns)) == bag(want)


def test_only_touched_days_and_summaries_are_read(spark, tmp_path):
    rng = random.Random(4)
    history, summaries = str(tmp_path / "h"), str(tmp_path / "s")
    update_summaries(spark, history, merge_days(spark, flat(spark, *rows(rng, range(10))), history), summaries)
    got = metrics_with_history(spark, flat(spark, *rows(rng, (7,))), [day(7)], history, summaries)
    plan = got._jdf.queryExecution().executedPlan().toString()
    days_read = {tuple(re.findall(r"\d{4}-\d\d-\d\d", m)) for m in re.findall(r"PartitionFilters: \[[^\]]*date#\d+ IN \(([^)]*)\)", plan)}
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    of_history = [line for line in scans if "market_cap_rank" in line]
    assert days_read == {(str(day(6)), str(day(7)))} and of_history
    assert all(" IN (" in line or "b_high" in line for line in scans)


def test_without_history(spark, tmp_path):
    run = flat(spark, ("a", 5, 1.0), ("a", 6, 3.0))
    got = metrics_with_history(spark, run, touched_days(run.selectExpr("date'1970-01-01' AS date")), str(tmp_path / "none"), str(tmp_path / "nothing"))
    assert bag(got) == bag(price_metrics(run))
    assert metrics_with_history(spark, run.where("false"), [], str(tmp_path / "none"), str(tmp_path / "nothing")).count() == 0
    update_summaries(spark, str(tmp_path / "none"), [None], str(tmp_path / "s"))
    assert read_summaries(spark, str(tmp_path / "s")).count() == 0
