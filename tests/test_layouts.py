import random

import pytest
from series_cases import bag
from test_merge import flat, prices

from series_lake.functions.timeconv import DAY_MS
from series_lake.operators.merge import merge_history
from series_lake.operators.metrics import latest_snapshot
from series_lake.operators.ranking import page
from series_lake.queries.projections import new_table
from series_lake.schemas import FLAT, MARKETS
from series_lake.sinks import bucketed, current, ranked


def runs(seed, n=3):
    rng = random.Random(seed)
    return [[(rng.choice(["hot", "hot", "a", "b", "c"]), rng.randrange(20 * DAY_MS), float(rng.randrange(9))) for _ in range(120)] for _ in range(n)]


# --- bucketed tables


def test_bucketed_merge_equals_merge_and_needs_no_exchange(spark):
    table, root = new_table(spark, "bucketed")
    history = None
    for k, rows in enumerate(runs(1)):
        run = flat(spark, *rows, ("hot", 5, float(k)), ("hot", 5, float(k) - 1))
        bucketed.merge_bucketed(spark, run, table, root, buckets=4)
        history = merge_history(run, history)
        assert bag(spark.table(table).select(*FLAT.names)) == bag(history)
    once, once_root = new_table(spark, "run")
    bucketed.merge_bucketed(spark, flat(spark, *runs(2, 1)[0]), once, once_root, buckets=4)
    days = bucketed.touched_days(spark.table(once))
    plan = bucketed.merged_with(spark, spark.table(once), table, days)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    held = spark.table(table).where("coin_id = 'hot'").selectExpr("pmod(hash(coin_id, timestamp), 4) AS b").groupBy("b").count().collect()
    assert len(held) == 4
    for bad in (("x", None, 1.0), (None, 1, 1.0)):
        with pytest.raises(ValueError, match="bucketed"):
            bucketed.merge_bucketed(spark, flat(spark, bad), table, root, buckets=4)
    before = bag(spark.table(table))
    assert bucketed.merge_bucketed(spark, flat(spark, ("x", 1, 1)).where("false"), table, root, buckets=4) == [] and bag(spark.table(table)) == before
    assert not [t for t in spark.catalog.listTables(table.split(".")[0]) if "_run_" in t.name]


def test_bucketed_legs_join_without_exchange(spark):
    tables = {}
    for leg in ("price", "market_cap", "volume"):
        name, root = new_table(spark, leg)
        frame = spark.createDataFrame([("a", t, float(t)) for t in range(20) if t % 3 or leg == "price"], f"coin_id string, timestamp long, {leg} double")
        bucketed.create_bucketed(spark, name, root, frame.schema, buckets=4)
        for _ in range(2):  # replaced, not added to
            bucketed.write_bucketed(spark, frame, name, buckets=4)
        tables[leg] = name
    joined = bucketed.join_bucketed(spark, tables)
    assert joined.count() == len([t for t in range(20) if t % 3])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2


# --- the newest rows


def test_newest_rows_equal_those_of_the_history(spark, tmp_path):
    path, history = str(tmp_path / "current"), None
    for rows in (*runs(4), [("a", 25 * DAY_MS, 1.0), ("a", 25 * DAY_MS, 2.0)], [("a", 25 * DAY_MS, 0.5), ("new", 1, 1.0)]):
        run = flat(spark, *rows)
        for _ in range(2):
            current.upsert_current(spark, run, path, buckets=8)
        history = merge_history(run, history)
        assert bag(current.read_current(spark, path)) == bag(latest_snapshot(history))
    assert [r for r in prices(current.read_current(spark, path)) if r[0] == "a"] == [("a", 25 * DAY_MS, 0.5)]


def test_only_folders_of_delivered_assets_are_rewritten(spark, tmp_path):
    import pathlib

    path = str(tmp_path / "current")
    current.upsert_current(spark, flat(spark, *[(f"c{i}", 1, 1.0) for i in range(40)], (None, 1, 1.0), ("t", None, 1.0)), path, buckets=16)
    before = {f: f.stat().st_mtime_ns for f in pathlib.Path(path).rglob("*.parquet")}
    touched = current.upsert_current(spark, flat(spark, ("c3", 2, 5.0), ("t", None, 0.5)), path, buckets=16)
    changed = {int(f.parent.name.split("=")[1]) for f in pathlib.Path(path).rglob("*.parquet") if f not in before}
    assert changed == set(touched) and len(touched) <= 2
    assert sorted((r.coin_id or "", r.price) for r in current.read_current(spark, path).collect() if r.coin_id in ("c3", "t", None)) == [("", 1.0), ("c3", 5.0), ("t", 0.5)]
    assert current.upsert_current(spark, flat(spark, ("x", 1, 1)).where("false"), path) == []


# --- pages


def listing(spark, n=1000):
    rng = random.Random(7)
    rows = [(f"c{i:05d}", "n", "s", "i", 1, None if i % 50 == 0 else float(rng.randrange(200))) for i in range(n)]
    return spark.createDataFrame(rows, MARKETS).repartition(5)


def test_pages_equal_the_ranking(spark, tmp_path):
    markets = listing(spark)
    assert ranked.newest_version(spark, str(tmp_path / "none")) is None
    first = ranked.publish_ranked(markets.limit(3), str(tmp_path / "r"), parts=2)
    version = ranked.publish_ranked(markets, str(tmp_path / "r"), parts=7, row_group=4096)
    assert ranked.newest_version(spark, str(tmp_path / "r")) == version != first
    for number in (1, 2, 20, 40, 41):
        got = ranked.read_page(spark, version, MARKETS, number)
        assert [r.id for r in got.collect()] == [r.id for r in page(markets, number).collect()]
        assert [r.position for r in got.collect()] == list(range(25 * number - 24, 25 * number + 1))[: got.count()]
    assert ranked.read_page(spark, version, MARKETS, 3, 400).count() == 200
    empty = ranked.publish_ranked(markets.where("false"), str(tmp_path / "e"), parts=3)
    assert ranked.read_page(spark, empty, MARKETS, 1).count() == 0


def test_a_deep_page_reads_a_folder_or_two(spark, tmp_path):
    version = ranked.publish_ranked(listing(spark), str(tmp_path / "r"), parts=10)
    plan = ranked.read_page(spark, version, MARKETS, 39)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan or "PushedFilters: [And(" in plan or "GreaterThanOrEqual(nth" in plan
    assert "Exchange rangepartitioning" not in plan and "Window" not in plan
    read = ranked.read_page(spark, version, MARKETS, 39)
    assert read.selectExpr("count(*)").first()[0] == 25
